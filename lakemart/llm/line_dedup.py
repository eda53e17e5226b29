"""Repeated runs of lines, found by winnowing over line hashes.

Method: a gram is the shortest run of lines from some line on that has
``gram_words`` words; a window is such a run with ``window_words`` words. From
each window the least digest among the grams inside is selected as a
fingerprint, so any two texts that share a run of ``window_words`` words
select the same gram in it. Each fingerprint is joined with its first
occurrence, the match is extended both ways while lines are equal, and the
later run is deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.store import free_name, written


@dataclass(frozen=True)
class Winnow:
    """A repeated run of ``window_words`` words always shares a fingerprint with its first occurrence."""

    gram_words: int = 25
    window_words: int = 50


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def _key(id_col: Column, text: Column) -> tuple[Column, Column]:
    """A document is known by its id and its text's digest."""
    return id_col, F.md5(F.coalesce(text, F.lit("")))


def repeated_lines(docs: DataFrame, p: Winnow = Winnow(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, dig, gone)``: per document with repeated runs, the numbers (from 0) of the lines to delete.

    "First" means smallest (id, text digest, line); a null id is smallest.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    i, dig = _key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    docs_lines = docs.select(i.alias("id"), dig.alias("dig"), F.transform(
        F.split(text, "\n"), lambda x, at: F.struct(at.alias("at"), _words(x).alias("n"), F.md5(x).alias("m"))).alias("lines"))
    # rows that repeat id and text are one document; lines without words take no part in matching
    docs_lines = docs_lines.groupBy("id", "dig").agg(F.first("lines").alias("lines")).withColumn(
        "lines", F.filter("lines", lambda x: x["n"] > 0)).where(F.size("lines") > 0)
    docs_lines = written(docs_lines, "lines")
    one = docs_lines.select("id", "dig", F.posexplode("lines").alias("i", "l")).select("id", "dig", "i", "l.n", "l.m")
    doc = Window.partitionBy("id", "dig")
    # words before a line grow by at least one a line, so a range frame over them holds whole lines
    one = one.withColumn("first_word", F.sum("n").over(doc.orderBy("i")) - F.col("n"))
    gram = doc.orderBy("first_word").rangeBetween(0, p.gram_words - 1)
    window = doc.orderBy("first_word").rangeBetween(0, p.window_words - 1)
    one = one.withColumn("gram", F.when(F.sum("n").over(gram) >= p.gram_words, F.md5(
        F.concat_ws("\n", F.collect_list("m").over(gram))))).withColumn("gram_end", F.max("i").over(gram))
    one = one.withColumn("window_end", F.when(F.sum("n").over(window) >= p.window_words, F.max("i").over(window)))
    one = one.withColumn("inside", F.collect_list(F.when(F.col("gram").isNotNull(), F.struct(
        F.col("gram").alias("g"), (-F.col("i")).alias("minus_i"), F.col("gram_end").alias("e")))).over(window))
    prints = one.where("window_end is not null").withColumn(
        "pick", F.array_min(F.filter("inside", lambda x: x["e"] <= F.col("window_end")))
    ).where("pick is not null").select("id", "dig", (-F.col("pick.minus_i")).alias("i"), F.col("pick.g").alias("g")).distinct()
    prints = written(prints, "fingerprints")

    first = prints.groupBy("g").agg(F.min(F.struct("id", "dig", "i")).alias("f"), F.count("*").alias("n")).where("n > 1")
    same = F.col("id").eqNullSafe(F.col("f.id")) & (F.col("dig") == F.col("f.dig"))
    match = prints.join(first, "g").where(~(same & (F.col("i") == F.col("f.i")))).groupBy(
        "id", "dig", F.col("f.id").alias("fid"), F.col("f.dig").alias("fdig"), (F.col("i") - F.col("f.i")).alias("shift")
    ).agg(F.collect_set("i").alias("at"))
    lines = docs_lines.select("id", "dig", F.transform("lines", lambda x: x["m"]).alias("m"),
                              F.transform("lines", lambda x: x["at"]).alias("no"))
    earlier = lines.select(F.col("id").alias("fid"), F.col("dig").alias("fdig"), F.col("m").alias("fm"))

    def on(left, right, names):
        cond = left[names[0]].eqNullSafe(right[names[0]]) & (left[names[1]] == right[names[1]])
        return left.join(right, cond).drop(right[names[0]], right[names[1]])

    both = on(on(match, lines, ("id", "dig")), earlier, ("fid", "fdig"))
    low = F.greatest(F.lit(0), F.col("shift"))
    high = F.least(F.size("m"), F.size("fm") + F.col("shift")) - 1
    # line numbers on the diagonal where the texts differ, with both ends as borders
    differ = F.concat(F.array(low - 1), F.filter(F.sequence(low, high), lambda x: F.get("m", x) != F.get("fm", x - F.col("shift"))),
                      F.array(high + 1))
    # runs lie between neighbouring borders; those with a fingerprint stay, told by one sort of borders and fingerprints
    marks = F.sort_array(F.concat(F.transform("differ", lambda x: F.struct(x.alias("at"), F.lit(0).alias("print"))),
                                  F.transform("at", lambda x: F.struct(x.alias("at"), F.lit(1).alias("print")))))
    after = F.zip_with("marks", F.slice("marks", 2, F.size("marks")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    starts = F.filter("after", lambda x: (x["a"]["print"] == 0) & (x["b"]["print"] == 1))
    ends = F.filter("after", lambda x: (x["a"]["print"] == 1) & (x["b"]["print"] == 0))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct((s["a"]["at"] + 1).alias("s"), (e["b"]["at"] - 1).alias("e")))
    found = both.withColumn("differ", differ).withColumn("marks", marks).withColumn("after", after).withColumn("runs", runs).select(
        "id", "dig", F.flatten(F.transform("runs", lambda r: F.slice("no", r["s"] + 1, r["e"] - r["s"] + 1))).alias("gone"))
    return found.groupBy("id", "dig").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def dedup_lines(docs: DataFrame, p: Winnow = Winnow(), id_col: str = "doc_id", text_col: str = "text",
                to_removed: str | None = None) -> DataFrame:
    """``docs`` with the later occurrences of repeated runs deleted from the text.

    Lines are separated by line feeds and equal only if all their characters
    are. The first occurrence of each line always stays. Lines without words
    are kept. Null and empty texts are unchanged; rows that repeat both id
    and text are one document and get the same text. Extra columns pass
    unchanged. ``to_removed`` names a column for the number of lines deleted.
    """
    gone = repeated_lines(docs, p, id_col, text_col)
    names = {c: free_name(docs, c) for c in ("id", "dig", "gone")}
    gone = gone.select(*[F.col(c).alias(names[c]) for c in ("id", "dig", "gone")])
    i, dig = _key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    out = docs.join(gone, i.eqNullSafe(F.col(names["id"])) & (dig == F.col(names["dig"])), "left")
    # split in a projection of its own: inside the lambda it would run for every line
    parts = free_name(out, "lines")
    out = out.withColumn(parts, F.when(F.col(names["gone"]).isNotNull(), F.split(F.col(f"`{text_col}`"), "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(names["gone"]))
    text = F.when(F.col(names["gone"]).isNull(), F.col(f"`{text_col}`")).otherwise(
        F.array_join(F.transform(kept, lambda at: F.get(F.col(parts), at)), "\n"))
    cols = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if to_removed:
        cols.append(F.coalesce(F.size(names["gone"]), F.lit(0)).alias(to_removed))
    return out.select(*cols)
