"""The registered queries of this subpackage: name -> function, name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (ann, decontam, langid, licenses, line_dedup, lm, mixing, near_dup, repair, shards, urls, vector_dup,
                          whitening)
from lakemart.llm import sql as S

QueryFn = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{i:03d}" for i in range(24)]
SLOTS = 2411  # prime, about a hundred slots a shard

MIX = mixing.Mix(levels=("domain", "lang", "source"), percent=60, max_epochs=2, seed=17, weights={
    "domain": {"dom0": 4, "dom1": 3, "dom2": 2, "dom3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 3},
})

# fixed values: the rules of the URL filter
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: Column) -> Column:
    """The tables have no domain; one of four is derived from the source."""
    return F.concat(F.lit("dom"), F.conv(F.substring(F.md5(F.coalesce(source, F.lit(""))), 1, 4), 16, 10).cast("bigint") % 4)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return shards.place(docs, SHARDS, SLOTS, "doc_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's canonical text, the licence it equals, and notices among its lines."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in S.LICENSES.items()])
    known = spark.range(1).select(F.inline(rows))
    long = F.array(*[F.struct(F.lit(v).alias("digest"), F.lit(k).alias("license")) for k, v in S.LICENSE_DIGESTS.items()])
    found = licenses.scan(table(spark, sf_dir, "documents"), known, digests=spark.range(1).select(F.inline(long)))
    return found.withColumn("notices", F.array_join("notices", ","))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, linked at 85 % similarity or more."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"),
                                    near_dup.NearDup(shingle=3, threshold_pct=85))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within 20 % of its words in edits."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents used at the target weights of domain, language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source").withColumn(
        "domain", domain_of(F.col("source")))
    return mixing.select(docs, MIX).select("doc_id", "domain", "lang", "source", "tokens", "copies")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's digest after later repeated runs of lines are gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, to_removed="n_removed")
    return out.select("doc_id", "n_removed", F.md5("text").alias("text_md5"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score(docs, lm.fit(docs))
    return scored.select("doc_id", "n_tokens", "pll",
                         F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens")).alias("pll_per_token"))


def op11_embedding_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label linked at a cosine of 0.98 or more."""
    return vector_dup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text's digest of every damaged conversation."""
    fixed = repair.repair(table(spark, sf_dir, "conversations"), damaged=True)
    return repair.with_digest(fixed).withColumnRenamed("conv", "conv_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight leading whitened components of every vector."""
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), components=8)


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_sharding, op2_license_scan, op3_near_dup, op4_decontamination, op5_ann, op6_language_id, op7_mixing,
        op8_line_dedup, op9_url_filter, op10_lm_score, op11_embedding_dup, op12_conversation_repair, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": S.sharding(SHARDS, SLOTS), "op2_license_scan": S.license_scan(),
            "op7_mixing": S.mixing(MIX), "op8_line_dedup": S.line_dedup(line_dedup.Winnow())}
