"""Repeated passages of lines, found as content-defined chunks; DataFrame functions only.

A line begins a chunk if the hash over its own and the previous line's hash says so, so the cuts inside a passage do not depend on
what stands before it. A long line, a paragraph, is a chunk of its own. Chunks whose hash occurs more than once are compared byte by
byte by grouping on their text; all but the first occurrence go, if the chunk has several lines or is a long line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import SPACED
from postweave.session import pin

# Characters from which a line is long: fifty words of three letters.
LEAST_LINES, LONG = 2, 200
# A line begins a chunk if the first hexadecimal digit is below this: every fourth does.
CUT = "4"
KEY = ["doc_id", "tkey"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text")


def _lined(rows: DataFrame) -> DataFrame:
    """Lines, and line keys, in place of the text; no lines for a null text."""
    lines = F.when(F.col("text").isNotNull(), F.split("text", "\n", -1)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("lines", lines).drop("text")
    return rows.withColumn("keys", F.transform("lines", lambda x: F.md5(x.cast("binary"))))


def _chunks(long: int) -> Column:
    """Array of (begin, end) line numbers of the chunks, ends exclusive, from the columns lines and keys."""
    n = F.size("keys")

    def begins(i: Column) -> Column:
        own, before = i + 1, F.greatest(i, F.lit(1))
        both = F.concat(F.element_at("keys", before), F.element_at("keys", own))
        paragraph = F.greatest(F.length(F.element_at("lines", own)), F.length(F.element_at("lines", before))) >= long
        return (i == 0) | paragraph | (F.substring(F.md5(both.cast("binary")), 1, 1) < CUT)

    begin = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), begins)
    ends = F.concat(F.slice(begin, 2, F.greatest(F.size(begin) - 1, F.lit(0))), F.array(n))
    return F.when(n > 0, F.arrays_zip(begin.alias("begin"), ends.alias("end"))).otherwise(F.array().cast("array<struct<begin:int,end:int>>"))


def _hashed(chunk: Column) -> Column:
    return F.xxhash64(F.slice("keys", chunk["begin"] + 1, chunk["end"] - chunk["begin"]))


def _candidates(docs: DataFrame, least_lines: int, long: int) -> DataFrame:
    """(doc_id, tkey, nth, n_lines, hash, text) of every chunk that may go."""
    rows = _lined(_keyed(docs)).withColumn("chunks", F.transform(_chunks(long), lambda c, i: F.struct(c["begin"].alias("begin"), c["end"].alias("end"), i.alias("nth"))))
    n_lines = lambda c: c["end"] - c["begin"]
    # A chunk of one line is a long line or too short to go.
    rows = rows.withColumn("chunks", F.filter("chunks", lambda c: (n_lines(c) >= least_lines) | (F.length(F.element_at("lines", c["begin"] + 1)) >= long)))
    each = F.transform("chunks", lambda c: F.struct(
        c["nth"].alias("nth"), _hashed(c).alias("hash"), n_lines(c).alias("n_lines"), F.array_join(F.slice("lines", c["begin"] + 1, n_lines(c)), "\n").alias("text")
    ))
    return rows.select(*KEY, F.explode(each).alias("c")).select(*KEY, "c.*")


def repeated_chunks(docs: DataFrame, least_lines: int = LEAST_LINES, long: int = LONG) -> DataFrame:
    """(doc_id, tkey, nth, n_lines): chunks to remove. Rows that repeat id and text count as one document."""
    every = _candidates(docs, least_lines, long)
    # Only hashes travel to be counted, and only texts whose hash repeats are compared.
    again = pin(every.groupBy("hash").count().where("count > 1").select("hash"))
    found = every.join(again, "hash").where(F.col("text").rlike(SPACED))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey", "nth")
    # Grouping on the text itself is the comparison; its digest only names the group. Copies in a task meet before the shuffle.
    groups = found.groupBy("hash", "text").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    groups = pin(groups.select("hash", F.sha2("text", 256).alias("digest"), "first"))
    narrow = every.select(*KEY, "nth", "n_lines", "hash", F.sha2("text", 256).alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey")) & (F.col("nth") == F.col("first.nth"))
    return narrow.join(groups, ["hash", "digest"]).where(~same).select(*KEY, "nth", "n_lines").dropDuplicates([*KEY, "nth"])


def line_dedup(docs: DataFrame, least_lines: int = LEAST_LINES, long: int = LONG) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_chunks, n_removed (chunks), n_removed_lines, text (what stays).

    The first occurrence, by doc_id (null last), text hash and place, stays. Null texts stay null and have no lines; an empty text
    is one empty line. Chunks without words stay. Repeated rows get equal results. An empty table gives no rows. Other columns are
    not read. What is removed may be much, so it meets the texts in an ordinary join at every size.
    """
    per = repeated_chunks(docs, least_lines, long)
    per = per.groupBy(*KEY).agg(F.collect_set("nth").alias("gone")).select(F.col("doc_id").alias("g_doc_id"), F.col("tkey").alias("g_tkey"), "gone")
    # The text itself travels, and is cut into lines after the join.
    rows = _keyed(docs).join(per, F.col("doc_id").eqNullSafe(F.col("g_doc_id")) & (F.col("tkey") == F.col("g_tkey")), "left")
    rows = _lined(rows).withColumn("chunks", _chunks(long))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(F.transform("chunks", lambda c, i: F.struct(c["begin"].alias("begin"), c["end"].alias("end"), i.alias("nth"))), lambda c: ~F.array_contains("gone", c["nth"]))
    rows = rows.withColumn("gone", gone).withColumn("kept", kept)
    stays = F.flatten(F.transform("kept", lambda c: F.slice("lines", c["begin"] + 1, c["end"] - c["begin"])))
    return rows.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("chunks").cast("long").alias("n_chunks"),
        F.size("gone").cast("long").alias("n_removed"), (F.size("lines") - F.size(stays)).cast("long").alias("n_removed_lines"),
        F.when(F.size("lines") > 0, F.array_join(stays, "\n")).alias("text"),
    )
