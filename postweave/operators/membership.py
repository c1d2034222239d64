"""Which external ids are stored: Bloom filters that are asked before stored ids are read.

`absorb` takes the runs saved since the last time into a level: their ids, laid out by a part of the hash, and a filter in blocks of
32,768 bits, one row per block. An id has its bits in one block, so a question meets one row per level, and blocks are joined by their
number. Ids that no filter knows are new without a look at any stored id; of the others, only the parts of the hash in which they lie
are read, and the answer is exact. Runs that no level holds yet are read as they are. Levels of like size are merged, so an id is
rewritten a few times only. Readers see the levels that the newest whole manifest names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postweave.functions.text import blank, or_null
from postweave.operators import dedup as U
from postweave.operators.jobindex import _path, folders
from postweave.session import pin

PARTS = 64
BLOCK_BITS = 32_768
# Sixteen bits an id and four of them set: of new ids about one in four hundred is looked up in vain.
IDS_PER_BLOCK, PROBES = 2_048, 4
RATIO = 4
_MANIFEST = "kind string, name string, at bigint, ids bigint, blocks bigint"
_IDS = "external_id string, run_id string, part int"
_FILTER = "block bigint, bits binary"


def _part(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(PARTS)).cast("int")


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), value), F.lit(blocks))


def _places(value: Column) -> Column:
    """The places of an id in its block: fifteen bits each of one hash."""
    h = F.xxhash64(F.lit(2), value)
    return F.array(*(F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)))


def bloom_filter(ids: DataFrame, blocks: int) -> DataFrame:
    """block, bits: the filter of the column external_id. Tasks set bits before the shuffle, so a block sends one row per task."""
    bits = ids.select(_block(F.col("external_id"), blocks).alias("block"), F.explode(_places(F.col("external_id"))).alias("place"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _all_set(bits: Column, value: Column) -> Column:
    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1

    return F.forall(_places(value), is_set)


def may_hold(asked: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of asked (external_id) that the filter cannot rule out."""
    keyed = asked.withColumn("block", _block(F.col("external_id"), blocks))
    return keyed.join(bloom, "block").where(_all_set(F.col("bits"), F.col("external_id"))).select(*asked.columns)


@dataclass(frozen=True)
class Levels:
    version: int = 0
    # Name, and its ids and blocks; run, and when its folder was last changed.
    levels: dict[str, tuple[int, int]] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)


class KnownIds:
    """Filters and ids of the table raw_jobs under one root. One `absorb` at a time; readers at any time."""

    def __init__(self, tables):
        self.tables = tables

    def _at(self, *parts: str) -> str:
        return "/".join((self.tables.path("known_ids"), *parts))

    def manifest(self, spark: SparkSession) -> Levels:
        for name in sorted(folders(spark, self._at("manifest")), reverse=True):
            fs, done = _path(spark, self._at("manifest", name, "_SUCCESS"))
            if fs.exists(done):
                # A row per level and a row per run.
                rows = spark.read.schema(_MANIFEST).parquet(self._at("manifest", name)).collect()
                return Levels(int(name.split("=")[1]), {r.name: (r.ids, r.blocks) for r in rows if r.kind == "level"}, {r.name: r.at for r in rows if r.kind == "run"})
        return Levels()

    def _tail(self, spark: SparkSession, held: Levels) -> dict[str, int]:
        """Runs that no level holds as they are now."""
        listed = {n[7:]: at for n, at in folders(spark, self.tables.path("raw_jobs")).items() if n.startswith("run_id=")}
        return {run: at for run, at in listed.items() if held.runs.get(run) != at}

    def _ids_of(self, spark: SparkSession, level: str, repeated: list[str], parts: list[int] | None = None) -> DataFrame:
        """Ids of a level without those of repeated runs; of the parts named, only their folders are opened."""
        root = self._at(level, "ids")
        listed = folders(spark, root) if parts else {}
        there = [f"part={p}" for p in parts or () if f"part={p}" in listed]
        if parts is not None and not there:
            return spark.createDataFrame([], _IDS)
        ids = spark.read.schema(_IDS).option("basePath", root).parquet(*([root] if parts is None else [f"{root}/{p}" for p in there]))
        return ids.where(~F.col("run_id").isin(repeated)) if repeated else ids

    def absorb(self, spark: SparkSession) -> int:
        """Takes the runs that are new, or were repeated, into the levels; the version of the manifest."""
        held = self.manifest(spark)
        tail = self._tail(spark, held)
        if not tail:
            return held.version
        repeated = sorted(set(tail) & set(held.runs))
        rows = self.tables.raw_of_runs(spark, lambda run: run in tail).where(~blank(F.col("external_id")))
        ids = pin(rows.select("external_id", "run_id").distinct())
        n, taken = ids.count(), []
        # What repeated runs held before may stand in any level.
        for name, (size, _) in sorted(held.levels.items(), key=lambda kv: kv[1]):
            if repeated or size <= RATIO * n:
                taken.append(name)
                n += size
        for name in taken:
            ids = ids.unionByName(self._ids_of(spark, name, repeated).drop("part"))
        new, blocks = f"level-{uuid.uuid4().hex}", max(1, -(-n // IDS_PER_BLOCK))
        ids.withColumn("part", _part(F.col("external_id"))).repartition("part").write.partitionBy("part").parquet(self._at(new, "ids"))
        written = self._ids_of(spark, new, [])
        bloom_filter(written, blocks).write.parquet(self._at(new, "filter"))
        entries = [("level", name, None, *sizes) for name, sizes in held.levels.items() if name not in taken] + [("level", new, None, n, blocks)]
        entries += [("run", run, at, None, None) for run, at in sorted((held.runs | tail).items())]
        # The swap: readers look for this folder's _SUCCESS. Of two at once, the later one fails.
        version = max((int(n.split("=")[1]) for n in folders(spark, self._at("manifest"))), default=0) + 1
        spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("error").parquet(self._at("manifest", f"version={version:012d}"))
        return version

    def stored(self, spark: SparkSession, asked: DataFrame, besides: str | None = None) -> DataFrame:
        """external_id of stored rows, holding all those of asked (external_id) that are stored, and as few others as the filters let through.

        besides: a run that is left out, or, with a star at its end, all runs whose names begin so; their folders are not opened.
        Null and empty ids are not stored.
        """
        held = self.manifest(spark)
        tail = self._tail(spark, held)
        out_of = lambda run: besides is not None and (run.startswith(besides[:-1]) if besides.endswith("*") else run == besides)
        run_id = F.col("run_id")
        which = F.lit(True) if besides is None else ~run_id.startswith(besides[:-1]) if besides.endswith("*") else run_id != besides
        repeated = sorted(set(tail) & set(held.runs))
        out = spark.createDataFrame([], "external_id string")
        new = self.tables.raw_of_runs(spark, lambda run: run in tail and not out_of(run))
        if new is not None:
            out = out.unionByName(new.select("external_id"))
        wanted = pin(asked.where(~blank(F.col("external_id"))).select("external_id").distinct()) if held.levels else None
        for name, (_, blocks) in sorted(held.levels.items()):
            bloom = spark.read.schema(_FILTER).parquet(self._at(name, "filter"))
            maybe = pin(may_hold(wanted, bloom, blocks))
            # At most PARTS numbers.
            parts = sorted(r[0] for r in maybe.select(_part(F.col("external_id"))).distinct().collect())
            if parts:
                ids = self._ids_of(spark, name, repeated, parts).where(which)
                out = out.unionByName(ids.join(maybe, "external_id", "left_semi").select("external_id"))
        return out

    def drop_known(self, rows: DataFrame, besides: str | None = None, spread: int = 1) -> DataFrame:
        """Rows whose external id is not stored; rows without id pass. As `dedup.drop_known`, with the filters asked first."""
        asked = rows.select(or_null(F.col("external_id")).alias("external_id"))
        return U.drop_known(rows, self.stored(rows.sparkSession, asked, besides), spread)
