"""Licence texts and notices, recognised by the digest of their canonical form.

A text's canonical form ignores case, punctuation, blanks, line breaks,
copyright lines and equivalent spellings. Its SHA-256 digest is joined with the digests
of known licences, so entire texts are compared by equality, never by parts.
The same is done with each line, which finds one-line notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: spellings that count as equal
EQUIVALENT_WORDS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
MAX_BROADCAST_ROWS = 100_000  # of 100 bytes: digest and name

COPYRIGHT_LINE = r"^[^\p{L}\p{N}]*(copyright\b|\(c\)|©|all rights reserved)"


def canonical_line(line: Column) -> Column:
    """Words of a line in one spelling, run together (so that hyphens do not matter); empty for a copyright line."""
    low = F.lower(line)
    words = F.split(F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), " ")
    spelled = F.transform(words, lambda w: F.when(
        w.isin(*EQUIVALENT_WORDS), F.create_map(*[F.lit(x) for kv in EQUIVALENT_WORDS.items() for x in kv])[w]
    ).otherwise(w))
    return F.when(low.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(F.array_join(spelled, ""))


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that have words (an empty array for null)."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), lambda x: x != "")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_digests(licenses: DataFrame, name_col: str = "license", text_col: str = "text") -> DataFrame:
    """``(digest, license)``, one row a digest: of licences with equal canonical texts the first by name."""
    whole = F.array_join(canonical_lines(F.col(text_col)), "")
    return licenses.select(digest(whole).alias("digest"), whole.alias("w"), F.col(name_col).alias("license")).where(
        (F.col("w") != "") & F.col("license").isNotNull()).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         digests: DataFrame | None = None) -> DataFrame:
    """Per row: ``id_col, digest, license, notices``.

    ``licenses`` holds texts, ``digests`` more ``(digest, license)`` rows as ``known_digests`` gives them.

    ``license`` is the known licence that the entire text equals (null if
    none), ``notices`` the sorted names of those that single lines equal.
    Null texts, empty texts and texts of punctuation only share the digest of
    the empty text and match nothing. Rows that repeat an id and a text
    are one document and give one row. Other columns are ignored.
    """
    lines = docs.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("lines"))
    each = lines.select("id", F.col("lines"), digest(F.array_join("lines", "")).alias("digest"))
    # distinct before they become structs: plain strings are told apart by hash, structs pair by pair
    part = each.select("id", "digest", F.array_distinct(F.transform("lines", digest)).alias("each")).select("id", "digest", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("digest").alias("d"))),
        F.transform("each", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("d"))))).alias("p"))
    known = known_digests(licenses)
    if digests is not None:
        known = known.unionByName(digests.select("digest", "license")).groupBy("digest").agg(F.min("license").alias("license"))
    known = known.select(F.col("digest").alias("known"), "license")
    if known.count() <= MAX_BROADCAST_ROWS:
        known = F.broadcast(known)
    found = part.join(known, F.col("p.d") == F.col("known"), "left")
    return found.groupBy("id", "digest").agg(
        F.max(F.when(F.col("p.whole"), F.col("license"))).alias("license"),
        F.array_sort(F.collect_set(F.when(~F.col("p.whole"), F.col("license")))).alias("notices"),
    ).select(F.col("id").alias(id_col), "digest", "license", "notices")
