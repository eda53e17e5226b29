import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemart.llm import queries as Q
from lakemart.llm import urls as U

ODD = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "a://b://c/d", "http://com", "http://com/",
       "http://xcom/", "http://x.com?/en/", "http://www.example.com/en/", "http://example.com/en/1", "http://m.example.com/en/",
       "http://a.net/es/1", "http://a.net/fr", "ftp://é.net/fr/\nq", "http://" + "a" * 20_000 + ".org/p"]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")


def rule(host, path):
    fit = [r for r in Q.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def test_rules_against_plain_python(spark):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(ODD)] + [(3, "://", "x", 1), (None, None, None, None)],
                               "page_id bigint, url string, host string, ratio int")
    rows = U.judge(df, Q.URL_RULES).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r.page_id is not None:
            host, path = parts(ODD[r.page_id])
            want = rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, want and want.name)
            assert r.verdict == want.verdict if want else r.verdict in ("allow", "block")


def naive_counts(urls, p):
    c = Counter()
    for u in urls:
        t = b"\x01" + u.encode()
        for i in range(1, len(t)):
            for k in range(p.order + 1):
                c[k, t[max(0, i - k):i]] += 1
                c[k, t[max(0, i - k):i + 1], "g"] += 1
    return c


def test_ratio_matches_exact_counts(spark):
    p = U.UrlModel(slots=1 << 22)
    good = [f"alpha{i}.org/shop/{i}" for i in range(30)]
    bad = [f"cheap-pills{i}.org/buy" for i in range(30)]
    df = spark.createDataFrame([(u, 1, 0) for u in good] + [(u, 0, 0) for u in bad], "url string, side bigint, fold bigint")
    t = U._count(df, p).toArrow()
    counts = np.zeros((2, 2, p.slots))
    counts[tuple(np.asarray(t[c]) for c in ("side", "kind", "slot"))] = np.asarray(t["n"])
    exact = [naive_counts(bad, p), naive_counts(good, p)]
    for u in ("alphax.org/shop/1", "cheap.org", "q"):
        total, raw = 0.0, b"\x01" + u.encode()
        for side, sign in ((1, 1), (0, -1)):
            for i in range(1, len(raw)):
                prob = 1 / 256
                for k in range(p.order + 1):
                    ctx = raw[max(0, i - k):i]
                    prob = (exact[side][k, raw[max(0, i - k):i + 1], "g"] + p.strength * prob) / (exact[side][k, ctx] + p.strength)
                total += sign * math.log(prob)
        assert U.log_ratio(pa.array([u]), counts, p)[0] == pytest.approx(total / len(u.encode()))


def test_learns_from_rules(spark):
    rules = [U.Rule("allow", "good.com", "/"), U.Rule("block", "bad.com", "/")]
    rows = [(i, f"http://good.com/reading/{i}") for i in range(200)] + [(1000 + i, f"http://bad.com/casino-win/{i}") for i in range(200)]
    rows += [(5000, "http://other.com/reading/77"), (5001, "http://other.com/casino-win/77")]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert got[5000] == "allow" and got[5001] == "block" and got[3] == "allow" and got[1003] == "block"


def test_one_sided_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://good.com/a"), (2, "http://x.org/")], "page_id bigint, url string")
    assert {r.verdict for r in U.judge(df, [U.Rule("allow", "good.com", "/")]).collect()} == {"allow"}
    assert U.judge(df.limit(0), Q.URL_RULES).count() == 0


def test_query_covers_all_pages(spark):
    sf = "/root/testdata/sf0.001"
    out = Q.op9_url_filter(spark, sf)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert out.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert out.where(F.col("verdict").isNull()).count() == 0


def test_models_read_the_whole_url(spark):
    """Query, fragment and scheme decide where host and path say nothing, and so does a text without ://."""
    rules = [U.Rule("allow", "good.com", "/"), U.Rule("block", "bad.com", "/")]
    rows = [(i, f"http://good.com/p?topic=reading-{i}#library") for i in range(200)]
    rows += [(1000 + i, f"http://bad.com/p?topic=casino-win-{i}#jackpot") for i in range(200)]
    rows += [(5000, "http://other.net/p?topic=reading-77#library"), (5001, "http://other.net/p?topic=casino-win-77#jackpot"),
             (5002, "other.net/p?topic=reading-77#library"), (5003, "other.net/p?topic=casino-win-77#jackpot"), (5004, None)]
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert [got[i].verdict for i in range(5000, 5004)] == ["allow", "block", "allow", "block"]
    assert (got[5001].host, got[5001].path, got[5003].host, got[5003].path) == ("other.net", "/p", "", "")
    assert got[5004].verdict in ("allow", "block") and len(got) == len(rows)


def test_production_counts_are_exact(spark):
    """As many n-grams as the data has, each with its own count, and probabilities that stay below 1."""
    p = U.UrlModel()
    urls = [[f"http://{side}{i * 7919 % 100003:05d}.org/{i * 104729 % 999983}?q={i}" for i in range(3000)] for side in "bg"]
    df = spark.createDataFrame([(u, s, 0) for s in (0, 1) for u in urls[s]], "url string, side bigint, fold bigint")
    table = U._count(df, p)
    for s in (0, 1):
        exact = naive_counts(urls[s], p)
        rows = table.where(f"side = {s}").select("kind", "n").toArrow().to_pydict()
        for kind in (0, 1):
            want = Counter(n for key, n in exact.items() if (len(key) == 3) == bool(kind))
            assert Counter(n for k, n in zip(rows["kind"], rows["n"]) if k == kind) == want
    assert table.select("kind", "slot").distinct().count() > 50_000
    chunks = spark.createDataFrame([(i % 3, u) for i, u in enumerate(["http://b00001.org/?q=7", "zzz", "", None, "http://g"])],
                                   "chunk bigint, url string")
    got = {r.url: r.ratio for r in U._with_ratio(chunks, U._by_side(table), p).collect()}
    exact = [naive_counts(u, p) for u in urls]
    for u in ("http://b00001.org/?q=7", "zzz", "http://g"):
        total, raw = 0.0, b"\x01" + u.encode()
        for side, sign in ((1, 1), (0, -1)):
            for i in range(1, len(raw)):
                prob = 1 / 256
                for k in range(p.order + 1):
                    ctx = raw[max(0, i - k):i]
                    prob = (exact[side][k, raw[max(0, i - k):i + 1], "g"] + p.strength * prob) / (exact[side][k, ctx] + p.strength)
                assert prob <= 1
                total += sign * math.log(prob)
        assert got[u] == pytest.approx(total / len(u.encode()))
    assert got[""] == got[None] == 0.0


@pytest.mark.parametrize("threshold", ["256k", "10m", "1g"])
def test_no_n_gram_passes_the_driver(spark, threshold):
    """Spark's estimate of the n-grams is far too low: whatever it broadcasts by size, they are not among it."""
    rules = [U.Rule("allow", "good.com", "/"), U.Rule("block", "bad.com", "/")]
    rows = [(i, f"http://{host}.com/{i * 104729 % 999983}") for i, host in enumerate(["good", "bad", "other"] * 20)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        pages = spark.createDataFrame(rows, "page_id bigint, url string")
        labelled = pages.select(F.lit(0).cast("bigint").alias("chunk"), "url", (F.col("page_id") % 3).alias("side")).where("side < 2")
        counts, _ = U.fit(labelled)
        scored, judged = U._with_ratio(labelled, counts, U.UrlModel()), U.judge(pages, rules)
        for df, n in ((scored, 40), (judged, 60)):
            for _ in range(2):  # the plan before the run, and the one that ran
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "Broadcast" not in plan and "SortMergeJoin" in plan
                assert len(df.collect()) == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
