"""The training-data pipeline over ``documents``: five stages, each one operator of ``lakemart.llm``.

Every stage takes (spark, docs, sf_dir) and decides which documents go on;
``run`` writes each stage's result to the shared folder and reads it again.

All stages: columns other than ``doc_id``, ``text``, ``lang`` and ``source``
pass unchanged whatever their names, texts of any length are read whole, and
an empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import decontam, langid, mixing, near_dup, queries, shards
from lakemart.llm.store import columns, free_name, written

MIX = replace(queries.MIX, percent=80, max_epochs=1)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; a text in two languages has about half of its words in each.

    Null and empty texts and texts without a letter go. A null ``lang`` or ``doc_id`` only keeps a row from training.
    Repeated rows get the same decision; of languages that tie the first by name wins.
    """
    return langid.keep_known(docs, min_score=0.4)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8.

    The smallest ``doc_id`` of a group stays. Texts without words link with nothing and stay, and so do rows with a null
    ``doc_id``. Rows that repeat a ``doc_id`` count as one document, of which one row stays.
    """
    return near_dup.drop_near_duplicates(docs, near_dup.NearDup(shingle=5, threshold_pct=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold nothing and stay, as does every document if the benchmark is empty. Repeated rows get the
    same decision.
    """
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, dealt by weights of domain, language and source; each document once at most.

    A null ``lang`` or ``source`` is a value of its own, a null ``doc_id`` sorts as the empty text. Rows that tie in the
    seeded order (repeated ids) stay or go together. Null and empty texts have no tokens: they take nothing from the
    budget and stay or go by their place in the order.
    """
    domain, tokens, copies = (free_name(docs, c) for c in ("domain", "tokens", "copies"))
    rows = docs.withColumn(domain, queries.domain_of(F.col("source")))
    plan = replace(MIX, levels=(domain, *MIX.levels[1:]), weights={**MIX.weights, domain: MIX.weights["domain"]})
    return mixing.select(rows, plan, to=copies, to_tokens=tokens).select(*columns(docs))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard, in new columns ``slot`` and ``shard`` (with a suffix if the names are taken).

    Equal ids, and so repeated rows, meet on one shard; null ids share the slot of the empty text.
    """
    return shards.place(docs, queries.SHARDS, queries.SLOTS, "doc_id")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixed),
    ("sharding", sharding),
]

# the first three stages learn models, hash at random or measure edit distance, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages keep, with their shards."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
