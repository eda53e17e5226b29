import os

import duckdb
import regex

import corpus_pipeline as P
from lakemart.llm import langid, near_dup, queries, store
from lakemart.llm import sql as S
from lakemart.llm.near_dup import NearDup
from tests.llm.conftest import prose
from tests.llm.test_decontam import edit
from tests.llm.test_near_dup import brute as all_pairs


SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = P.run(spark, SF)
    assert out.columns == [*docs.columns, "slot", "shard"]
    rows = {r.doc_id: r for r in docs.collect()}
    got = out.collect()
    assert 0 < len(got) < len(rows) and len({r.doc_id for r in got}) == len(got)
    assert all(tuple(r)[:len(docs.columns)] == tuple(rows[r.doc_id]) for r in got)


def test_every_stage_takes_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for i, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns if i < 4 else out.columns == [*docs.columns, "slot", "shard"]
            assert (out.count() > 0) == (docs is odd_docs), name


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def duck(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    return con.sql(sql).to_arrow_table().to_pylist()


def test_stages_decide_as_brute_force(spark):
    """Every stage on the whole table, against its operator's own reference."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stage = {name: fn(spark, docs, SF) for name, fn in P.STAGES}

    said = langid.identify(docs).collect()
    assert ids(stage["language_id"]) == sorted(r.doc_id for r in said if r.lang_pred != "und" and r.score >= 0.4)

    same = all_pairs(rows, NearDup(shingle=5, threshold_pct=80))
    assert ids(stage["near_duplicates"]) == sorted(d for d, (_, _, kept) in same.items() if kept)

    split = lambda t: [x.lower() for x in regex.findall(r"[\p{L}\p{N}]+", t or "")]
    items = [split(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [w for w in items if w]
    kept = set(ids(stage["decontamination"]))
    for d, t in rows:
        if d not in kept:
            words = split(t)
            assert any(edit(w, words) <= len(w) // 5 for w in items), d
        else:
            text = f" {' '.join(split(t))} "
            assert not any(f" {' '.join(w)} " in text for w in items), d

    dealt = duck(S.mixing(P.MIX))
    assert all(r["copies"] == 1 for r in dealt)
    assert ids(stage["mixing"]) == sorted(r["doc_id"] for r in dealt)

    placed = {r["doc_id"]: (r["slot"], r["shard"]) for r in duck(S.sharding(queries.SHARDS, queries.SLOTS))}
    assert {r.doc_id: (r.slot, r.shard) for r in stage["sharding"].collect()} == placed


def test_planted_rows_go_and_clean_ones_stay(spark, make_docs):
    """Copies, an edited copy and a document with a benchmark item among documents with nothing in common."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    clean = [(i, prose(4000 + i, 120)) for i in range(20)]
    copy = clean[3][1]
    edited = " ".join("changed" if i == 60 else w for i, w in enumerate(copy.split()))
    docs = make_docs(clean + [(100, copy), (101, copy), (102, edited), (103, f"{prose(1, 30)} {item} {prose(2, 30)}")])
    left = P.near_duplicates(spark, docs, SF)
    assert ids(left) == [*range(20), 103]
    assert ids(P.decontamination(spark, left, SF)) == list(range(20))


def test_passes_leave_only_tables_that_the_result_reads(spark, make_docs, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(store, "scratch_path", lambda spark, name: made.append(str(tmp_path / f"{len(made)}-{name}")) or made[-1])
    base = prose(5, 200)
    out = near_dup.near_duplicates(make_docs([(i, base + f" end{i}") for i in range(30)] + [(50, prose(6, 90))]))
    assert {r.component_id for r in out.collect()} == {0, 50}
    left = {p.split("-", 1)[1] for p in os.listdir(tmp_path)}
    assert left <= {"signatures", "checked", "components", "edges"} and len(os.listdir(tmp_path)) < len(made)
