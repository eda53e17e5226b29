"""Quality checks on small frames with planted defects: each check counts them exactly."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from lakemart.operators import quality


def _contacts(spark):
    rows = [
        (1, "Ann", "ann@x.com", "London", 100.0, datetime(2024, 1, 1)),
        (2, None, "bob@x", "Leeds", -5.0, datetime(2099, 12, 31)),          # null name, bad email, negative, future
        (2, "Bob", "not-an-email", "Leeds", 999999.99, datetime(2024, 1, 2)),  # duplicate key, bad email, outlier
        (3, "", None, "Birmigham", None, None),                            # empty name, typo region, nulls
        (4, "Dee", "dee@x.com", "Paris", 20.0, datetime(1970, 1, 1)),      # region outside domain, too old
        (4, "Dee", "dee@x.com", "Paris", 20.0, datetime(1970, 1, 1)),      # exact duplicate row
    ]
    return spark.createDataFrame(rows, "id long, name string, email string, region string, deal double, ts timestamp_ntz")


def test_counts(spark):
    df = _contacts(spark)
    nr = {r.column_name: r.n_nulls for r in quality.null_report(df, ["name", "email", "deal", "ts"]).collect()}
    assert nr == {"name": 1, "email": 1, "deal": 1, "ts": 1}
    ku = quality.key_uniqueness(df, ["id"]).first()
    assert (ku.total_rows, ku.unique_keys, ku.duplicate_keys, ku.rows_in_duplicates, ku.max_per_key) == (6, 4, 2, 4, 2)
    dup = quality.duplicate_rows(df).collect()
    assert len(dup) == 1 and dup[0].id == 4 and dup[0].n_copies == 2
    rate = quality.duplication_rate(df).first()
    assert (rate.total_rows, rate.distinct_rows, rate.duplicate_rows) == (6, 5, 1)
    dom = {r.value: r.is_allowed for r in quality.domain_check(df, "region", ["London", "Leeds"]).collect()}
    assert dom == {"London": True, "Leeds": True, "Birmigham": False, "Paris": False}
    pat = {r.column_name: r.n_invalid for r in quality.pattern_check(df, {"email": r"^[^@\s]+@[^@\s]+\.[a-z]+$"}).collect()}
    assert pat == {"email": 2}
    rng = {r.rule: r.n_matching for r in quality.range_check(df, {
        "negative": F.col("deal") < 0, "outlier": F.col("deal") > 10000}).collect()}
    assert rng == {"negative": 1, "outlier": 1}
    fr = quality.freshness(df, "ts", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).first()
    assert fr.future_rows == 1
    comp = {r.column_name: float(r.completeness_pct) for r in quality.completeness(df, ["email"]).collect()}
    nul = {r.column_name: float(r.null_pct) for r in quality.null_report(df, ["email"]).collect()}
    assert comp["email"] + nul["email"] == 100.0


def test_referential_and_casts(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "fk long")
    parent = spark.createDataFrame([(1,), (2,)], "pk long")
    r = quality.referential_check(child, parent, "fk", "pk", "c->p").first()
    assert (r.n_rows, r.n_null_keys, r.n_orphans) == (4, 1, 1)
    txt = spark.createDataFrame([("12", "07700 900123"), ("N/A", "abc"), (None, "123")], "n string, phone string")
    c = {x.column_name: x.n_uncastable for x in quality.castability(txt, {"n": "int", "phone": "bigint"}).collect()}
    assert c == {"n": 1, "phone": 2}


def test_geo_and_sequence(spark):
    geo = spark.createDataFrame([(51.5, -0.12), (-0.12, 51.5), (0.0, 0.0), (None, 1.0), (95.0, 0.0)],
                                "lat double, lon double")
    g = quality.geo_check(geo, "lat", "lon", (51.2, -0.6, 51.8, 0.4)).first()
    assert (g.n_missing, g.n_zero, g.n_out_of_range, g.n_swapped) == (1, 2, 1, 1)
    seq = spark.createDataFrame([(1, 2, 3), (2, 1, 3), (1, None, 3)], "a int, b int, c int")
    steps = {r.step: (r.n_valid, r.n_invalid, r.n_missing) for r in quality.sequence_validity(seq, ["a", "b", "c"]).collect()}
    assert steps["a->b"] == (1, 1, 1) and steps["chain"][0] == 1


def _scans(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(set(re.findall(r"(?:FileScan parquet|Scan ExistingRDD|LocalTableScan) ?\[[^\]]*\]", plan)))


def test_profile_scans(spark, tmp_path):
    path = str(tmp_path / "contacts")
    _contacts(spark).write.parquet(path)
    df = spark.read.parquet(path)
    approx = quality.profile(df, ["id", "name", "deal"], approx=True)
    assert _scans(approx) == 1  # sketches are plain aggregates: one pass, one scan
    exact = quality.profile(df, ["id", "name", "deal"])
    assert _scans(exact) <= 2   # plain aggregates + one distinct-count aggregate
    p = {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct) for r in exact.collect()}
    assert p["id"] == (6, 0, 4) and p["name"] == (6, 1, 4)


def test_more_planted_defects(spark):
    from datetime import date
    from decimal import Decimal

    df = _contacts(spark)
    drift = {r.column_name: r.issue for r in quality.schema_drift(
        df, {"id": "bigint", "name": "string", "deal": "decimal(10,2)", "phone": "string"}).collect()}
    assert drift == {"id": "ok", "name": "ok", "deal": "type_mismatch", "phone": "missing",
                     "email": "unexpected", "region": "unexpected", "ts": "unexpected"}
    ln = {r.column_name: (r.min_len, r.max_len) for r in quality.string_lengths(df, ["name"]).collect()}
    assert ln["name"] == (0, 3)
    rules = {r.rule: r.n_violations for r in quality.rule_violations(df, {
        "deal_without_email": F.col("deal").isNotNull() & F.col("email").isNull(),      # cross-column
        "future_contact": F.col("ts") > F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")}).collect()}
    assert rules == {"deal_without_email": 0, "future_contact": 1}
    san = {r.rule: r.n_matching for r in quality.timestamp_sanity(df, {
        "too_old": F.col("ts") < F.lit("1980-01-01 00:00:00").cast("timestamp_ntz")}).collect()}
    assert san == {"too_old": 2}
    vol = {str(r.period): r.n_rows for r in quality.volume(df, "ts", "day").collect()}
    assert vol["1970-01-01"] == 2 and vol["None"] == 1
    out = quality.iqr_outliers(df, "deal").first()
    # values -5, 20, 20, 100, 999999.99: q1 = 20, q3 = 100, fences -100 and 220
    assert (out.q1, out.q3, out.lower_fence, out.upper_fence) == (20.0, 100.0, -100.0, 220.0)
    assert (out.n_below, out.n_above) == (0, 1)
    hier = quality.per_key_cardinality(df, "id", "email").first()
    assert (hier.n_keys, hier.keys_with_multiple, hier.max_per_key) == (4, 1, 2)
    parent = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("5.00"))], "k int, total decimal(18,2)")
    child = spark.createDataFrame([(1, Decimal("4.00")), (1, Decimal("6.00")), (2, Decimal("4.99"))],
                                  "k int, part decimal(18,2)")
    tc = quality.total_consistency(parent, child, "k", "total", "part").first()
    assert (tc.n_keys, tc.n_consistent, tc.n_inconsistent, tc.max_abs_diff) == (2, 1, 1, Decimal("0.01"))
    exp = quality.volume(spark.createDataFrame([(date(2024, 1, d),) for d in (1, 1, 2)], "d date"),
                         "d", "day", expected="mean").collect()
    assert {str(r.period): (r.n_rows, float(r.expected), float(r.deviation_pct)) for r in exp} == \
        {"2024-01-01": (2, 1.5, 33.33), "2024-01-02": (1, 1.5, -33.33)}


def test_exact_quantiles_hot_value(spark):
    import numpy as np
    vals = [5.0] * 400 + [float(i) for i in range(800)]   # one value holds a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    got = quality.distribution(df, "x").first()
    exp = np.percentile(np.array(vals), [25, 50, 75])     # linear interpolation, as percentile / quantile_cont
    assert (got.p25, got.p50, got.p75) == tuple(round(float(e), 6) for e in exp)


def test_distinct_counts_of_all_types_without_expand(spark):
    rows = spark.range(3000).select(
        "id", (F.col("id") % 100 - 50).cast("int").alias("i"), (F.col("id") * 1_000_003 * 7919 - 9_000_000_000).alias("wide"),
        F.expr("date_sub(date'1970-02-01', cast(id % 90 as int))").alias("day"), F.concat(F.lit("s"), F.col("id") % 77).alias("s"),
        F.expr("case when id % 5 = 0 then double('nan') when id % 5 = 1 then -0.0D when id % 5 = 2 then 0.0D else id % 10 end").alias("x"),
        F.expr("timestamp_micros(1700000000000000 + id % 1500)").alias("ts"), F.expr("cast(id % 40 / 4 as decimal(10,2))").alias("d"),
        F.expr("array(id % 3, null)").alias("a"), F.expr("named_struct('p', id % 4, 'q', cast(null as int))").alias("st"),
        F.expr("id % 2 = 0").alias("flag"), F.expr("cast(id % 30 as tinyint)").alias("t"), F.lit(None).cast("int").alias("none"),
        F.expr("case when id % 3 > 0 then id % 9 end").alias("some"), F.expr("cast(cast(id % 11 as string) as binary)").alias("b"))
    want = {c: rows.select(c).where(F.col(c).isNotNull()).distinct().count() for c in rows.columns}
    out = quality.distinct_report(rows, rows.columns)
    assert {r["column_name"]: r["n_distinct"] for r in out.collect()} == want
    assert {r["column_name"]: r["n_distinct"] for r in quality.profile(rows.select("id", "i", "s", "none"), ["id", "i", "s", "none"]).collect()} == {
        c: want[c] for c in ("id", "i", "s", "none")}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r["n_distinct"] for r in quality.distinct_report(rows.limit(0), ["i", "s"]).collect()] == [0, 0]


def test_exact_digests_of_rows(spark):
    """Microseconds tell rows apart; -0.0 and 0.0, and all NaN, are one value, inside nested columns too."""
    ts = spark.createDataFrame([("2024-01-01 00:00:00.123456",), ("2024-01-01 00:00:00.123789",)], "t string")
    for kind in ("timestamp", "timestamp_ntz"):
        df = ts.select(F.col("t").cast(kind).alias("t"))
        assert tuple(quality.duplication_rate(df).first())[:3] == (2, 2, 0)
        assert quality.duplicate_rows(df).count() == 0
    zero = spark.createDataFrame([(0.0, [0.0], (0.0,)), (-0.0, [-0.0], (-0.0,)), (float("nan"), [float("nan")], (1.0,)), (float("nan"), [float("nan")], (1.0,))],
                                 "x double, a array<double>, s struct<y:double>")
    assert tuple(quality.duplication_rate(zero).first())[:3] == (4, 2, 2)
    assert sorted(r["n_copies"] for r in quality.duplicate_rows(zero).collect()) == [2, 2]
    nulls = spark.createDataFrame([(None, "a"), ("a", None), (None, None), (None, None)], "p string, q string")
    assert tuple(quality.duplication_rate(nulls).first())[:3] == (4, 3, 1)


def test_reloaded_files(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 2, None), ("b", 1, "x"), ("c", 1, "x"), ("c", 2, "y"), ("d", 1, "x"), ("d", 1, "x"), ("d", 2, None),
            ("e", 1, "x"), ("e", 2, None), (None, 1, "x"), (None, 2, None)]
    df = spark.createDataFrame(rows, "f string, k int, v string").repartition(5)
    assert sorted(map(tuple, quality.reloaded_files(df, "f").collect())) == [("b", "a", 2), ("e", "a", 2)]
    assert quality.reloaded_files(df.limit(0), "f").count() == 0


def test_quantiles_by_narrowing_histograms(spark, monkeypatch):
    """Ties, huge ranges, infinities and NaN, with cells so few that several rounds are needed."""
    import numpy as np
    rng = np.random.default_rng(2)
    inf, nan = float("inf"), float("nan")
    cases = [rng.normal(size=3000).tolist(), [5.0] * 900 + rng.uniform(4.999999, 5.000001, 300).tolist(), [1.0], [2.0, 1.0], [7.0] * 50,
             (10.0 ** rng.uniform(-300, 300, 700)).tolist(), [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323] * 40, [inf, -inf, 1.0, 2.0, 3.0, inf],
             [np.nextafter(1.0, 2.0), 1.0] * 100 + [0.0]]
    ps = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    for few, cells in ((50_000, 1024), (3, 4)):
        monkeypatch.setattr(quality, "_FEW", few)
        monkeypatch.setattr(quality, "_CELLS", cells)
        for values in cases:
            df = spark.createDataFrame([(v if v is None else float(v),) for v in [*values, None]], "v double")
            got = quality.quantile_values(df, "v", ps, accuracy=100)
            v = sorted(values)
            for p, g in zip(ps, got):
                at = (len(v) - 1) * p
                lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
                want = lo if lo == hi else lo + (hi - lo) * (at - np.floor(at))
                assert g == want or np.isclose(g, want, rtol=1e-14, equal_nan=True), (few, len(values), p, g, want)
    df = spark.createDataFrame([(1.0,), (nan,), (2.0,)], "v double")
    got = quality.quantile_values(df, "v", (0.0, 0.5, 1.0))
    assert got[:2] == [1.0, 2.0] and got[2] != got[2]
    assert quality.quantile_values(df.limit(0), "v", (0.5,)) == [None]
