"""Union, deduplication and limits over raw rows.

All keep-first steps are min-by-arrival aggregates on narrow rows (seq, source, external_id, fp):
partial aggregation shrinks a hot key to one row per map task before the shuffle, where a
row_number window would send the whole key to one task. Text is joined back once, on the unique seq.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from postweave.functions.extract import fingerprint
from postweave.functions.text import blank, or_null
from postweave.session import pin

# Fixed value: the largest run size that a request may ask for. The operators here take any.
REQUEST_MAX = 2_000


def union_sources(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_fingerprint(raw: DataFrame) -> DataFrame:
    return raw.withColumn("fp", fingerprint(F.col("raw_text")))


def dedup_keys(raw: DataFrame) -> DataFrame:
    """The narrow rows that travel through the dedup shuffles."""
    return raw.select("seq", "source", "external_id", fingerprint(F.col("raw_text")).alias("fp"))


def _first_per(keys: DataFrame, *by: Column) -> DataFrame:
    """The row of least seq per key. Only seq is aggregated, by hash; the other columns follow for the survivors."""
    named = [c.alias(f"_k{i}") for i, c in enumerate(by)]
    first = keys.groupBy(*named).agg(F.min("seq").alias("seq")).select("seq")
    return first if keys.columns == ["seq"] else keys.join(first, "seq", "left_semi")


def first_by_external_id(keys: DataFrame) -> DataFrame:
    """First row per id over all sources; a row without id is its own group."""
    ext = F.col("external_id")
    return _first_per(keys, or_null(ext), F.when(blank(ext), F.col("seq")))


def first_by_fingerprint(keys: DataFrame) -> DataFrame:
    return _first_per(keys, F.col("fp"))


def survivors(keys: DataFrame, by_fingerprint: bool = True) -> DataFrame:
    """Keys left after the external-id step and, unless switched off, the fingerprint step."""
    left = first_by_external_id(keys)
    return first_by_fingerprint(left) if by_fingerprint else left


def take_target(kept: DataFrame, target: int | None) -> DataFrame:
    """First `target` rows by arrival; None takes all."""
    if target is None:
        return kept
    if target < 1:
        raise ValueError("target must be positive, or None for all rows")
    return kept.orderBy("seq").limit(target)


def rows_at(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """The raw rows whose seq is in kept."""
    return raw.join(kept.select("seq"), "seq", "left_semi")


def dedup_external_id(raw: DataFrame) -> DataFrame:
    return rows_at(raw, first_by_external_id(raw.select("seq", "external_id")))


def dedup(raw: DataFrame, by_fingerprint: bool = True, target: int | None = None) -> DataFrame:
    return rows_at(raw, take_target(survivors(dedup_keys(raw), by_fingerprint), target))


def dedup_within_fetch(raw: DataFrame, unit: str = "unit") -> DataFrame:
    """First row per (fetch unit, external id); a missing id counts as the empty id.

    Rows keep the id they came with, so prefixed or null ids are passed on unchanged.
    """
    ext = F.coalesce("external_id", F.lit(""))
    first = raw.groupBy(F.col(unit), ext.alias("_ext")).agg(F.min("seq").alias("seq"))
    return rows_at(raw, first)


def dedup_stats(keys: DataFrame, by_fingerprint: bool = True, target: int | None = None, kept: DataFrame | None = None) -> DataFrame:
    """Kept and dropped rows per source; rows that arrive after the target is reached count as neither.

    kept: what the caller has already taken from the keys; else it is computed, once, and pinned.
    """
    if kept is None:
        kept = pin(take_target(survivors(keys, by_fingerprint), target).select("seq", "source"))
    seen = keys
    if target is not None:
        # One row: the arrival of the last row taken, or no limit while the target is not reached.
        limit = kept.agg(F.when(F.count(F.lit(1)) >= target, F.max("seq"))).first()[0]
        seen = keys if limit is None else keys.filter(F.col("seq") <= limit)
    one, none = F.lit(1), F.lit(0)
    both = seen.select("source", one.alias("seen"), none.alias("kept")).unionAll(kept.select("source", none.alias("seen"), one.alias("kept")))
    return both.groupBy("source").agg(F.sum("seen").alias("seen"), F.sum("kept").alias("kept")).select(
        "source", "kept", (F.col("seen") - F.col("kept")).alias("dropped")
    )


def dedup_totals(stats: DataFrame, target: int | None = None) -> DataFrame:
    return stats.agg(
        F.coalesce(F.sum("kept"), F.lit(0)).alias("yielded"),
        F.coalesce(F.sum("dropped"), F.lit(0)).alias("duplicates"),
        F.lit(target).cast("bigint").alias("target"),
    )


def known_ids(store: DataFrame) -> DataFrame:
    return store.filter(~blank(F.col("external_id"))).select("external_id").distinct()


def drop_known(raw: DataFrame, store: DataFrame, spread: int = 1) -> DataFrame:
    """Rows whose id is not yet in the store; rows without id pass.

    A row without id gets its own join key, so such rows spread over all tasks instead of meeting
    at the null key. Ids are unique after dedup, where spread=1 is right; for a batch with hot ids
    spread > 1 splits each id over that many keys and repeats the (id-only) store side as often.
    """
    ext = or_null(F.col("external_id"))
    salt = F.when(ext.isNull(), F.col("seq")).otherwise(F.pmod(F.xxhash64("seq"), F.lit(spread)))
    known = known_ids(store).select(
        F.col("external_id").alias("_ext"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("_salt"),
    )
    left = raw.withColumn("_e", ext).withColumn("_s", salt)
    match = (F.col("_e") == F.col("_ext")) & (F.col("_s") == F.col("_salt"))
    return left.join(known, match, "left_anti").drop("_e", "_s")


def exists_by_external_id(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each distinct wanted external_id: is it stored? One id is asked with a one-row frame."""
    asked = wanted.select("external_id").distinct()
    return asked.join(known_ids(store).withColumn("_hit", F.lit(True)), "external_id", "left").select(
        "external_id", F.coalesce("_hit", F.lit(False)).alias("known")
    )
