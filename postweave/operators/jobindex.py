"""An index of the stored jobs: what status each job has, and in which file its row lies.

The stores of rows and of status events are folders of runs that are only ever added or replaced whole. The index takes them in
by levels: a compaction reads the runs that no level holds yet (the tail), adds to them the lower levels that have grown too
large, and writes one new level, range-clustered by status and id, with Bloom filters on the id. A manifest, written last and in
one piece, names the levels, the runs they hold and what ranges of ids each file has for each status. So readers see the old state
or the new one; a compaction that stops early leaves a folder that nothing names.

Readers take the levels of the newest manifest and the tail. A run that was repeated after it was taken in counts as tail
again, and what the levels hold of it counts no more.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postweave.session import pin

# Rows of one index file, and by how much a level may be larger than the one below it.
FILE_ROWS, RATIO = 1_000_000, 8
# A level of more files than this gets larger files instead, so what the driver samples, lists and holds of it is bounded.
LEVEL_FILES = 1_000
# Tables whose runs the index takes in.
ROWS, EVENTS = "parsed_jobs", "status_log"

# What is known of a job from its row, and from its last status event. The first fields decide which is the last.
_OF_ROW = "struct<saved_at:timestamp,parsed_at:timestamp,status:string,run_id:string,file:string>"
_OF_EVENT = "struct<reviewed_at:timestamp,event_seq:bigint,status:string,reviewer_notes:string,run_id:string>"
_LEVEL = f"job_id string, status string, of_row {_OF_ROW}, of_event {_OF_EVENT}"
# kind 'run': table and run in `name`, stamp in `at`; kind 'file': folder, file, and of a status the number of rows and the least and
# largest id; `at` is how many of them are events alone, of jobs whose rows lie elsewhere.
_MANIFEST = "kind string, level int, folder string, name string, run_id string, at bigint, status string, n bigint, low string, high string"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the folders in a folder, and when each was last changed."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p) if s.isDirectory()}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in place of what was there."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


@dataclass(frozen=True)
class Manifest:
    """One state of the index: its levels (1 is the newest) with their folders, and the runs they hold."""

    version: int = 0
    levels: dict[int, str] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)
    runs: dict[tuple[str, str], int] = field(default_factory=dict)


class JobIndex:
    """Index beside the tables parsed_jobs and status_log under one root. One compaction at a time; readers at any time.

    An id belongs to one run and its repeats: ids name the run that made them.
    """

    def __init__(self, root: str, row_schema: T.StructType, event_schema: T.StructType):
        self.root, self.row_schema, self.event_schema = root.rstrip("/"), row_schema, event_schema

    def _at(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # --- The manifest.

    def _manifest_path(self, version: int) -> str:
        return self._at("job_index", "manifest", f"version={version:012d}")

    def _versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in folders(spark, self._at("job_index", "manifest")) if n.startswith("version="))

    def _committed(self, spark: SparkSession) -> int:
        """The newest version that was written to its end; 0 if there is none."""
        for v in reversed(self._versions(spark)):
            fs, done = _path(spark, self._manifest_path(v) + "/_SUCCESS")
            if fs.exists(done):
                return v
        return 0

    def _entries(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.schema(_MANIFEST).parquet(self._manifest_path(version))

    def manifest(self, spark: SparkSession) -> Manifest:
        version = self._committed(spark)
        if not version:
            return Manifest()
        entries = self._entries(spark, version)
        # A row per run and a row per level.
        runs = {(r["name"], r["run_id"]): r["at"] for r in entries.where("kind = 'run'").collect()}
        levels = entries.where("kind = 'file'").groupBy("level").agg(F.first("folder").alias("folder"), F.sum("n").alias("n")).collect()
        return Manifest(version, {r["level"]: r["folder"] for r in levels}, {r["level"]: r["n"] for r in levels}, runs)

    # --- The tail.

    def _listed(self, spark: SparkSession) -> dict[tuple[str, str], int]:
        return {(t, n[7:]): at for t in (ROWS, EVENTS) for n, at in folders(spark, self._at(t)).items() if n.startswith("run_id=")}

    def tail(self, spark: SparkSession, manifest: Manifest) -> dict[tuple[str, str], int]:
        """The runs that no level holds as they are now. A run that is being written comes with the next look."""
        def written(table: str, run: str) -> bool:
            fs, p = _path(spark, self._at(table, f"run_id={run}", "_temporary"))
            return not fs.exists(p)

        return {k: at for k, at in self._listed(spark).items() if manifest.runs.get(k) != at and written(*k)}

    def _read_runs(self, spark: SparkSession, name: str, runs: Sequence[str], schema: T.StructType) -> DataFrame:
        """The rows of some runs of a table, with the columns run_id and file; schema has no run_id."""
        full = T.StructType([*(f for f in schema if f.name != "run_id"), T.StructField("run_id", T.StringType())])
        paths = [self._at(name, f"run_id={r}") for r in runs]
        try:
            rows = spark.read.schema(full).option("basePath", self._at(name)).parquet(*paths) if paths else None
        except AnalysisException as e:
            # A run that is being replaced right now is read by the next reader.
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = None
        if rows is None:
            return spark.createDataFrame([], full).withColumn("file", F.lit(None).cast("string"))
        return rows.withColumn("file", F.col("_metadata.file_name"))

    def _of_tail(self, spark: SparkSession, tail: dict, only: Column | None = None) -> DataFrame:
        """What the tail says of jobs, in the form of a level, before rows of one job are brought together."""
        runs = lambda t: sorted(r for n, r in tail if n == t)
        rows = self._read_runs(spark, ROWS, runs(ROWS), self.row_schema).withColumnRenamed("id", "job_id")
        events = self._read_runs(spark, EVENTS, runs(EVENTS), self.event_schema)
        if only is not None:
            rows, events = rows.where(only), events.where(only)
        rows = rows.select("job_id", F.struct("saved_at", "parsed_at", "status", "run_id", "file").cast(_OF_ROW).alias("of_row"), F.lit(None).cast(_OF_EVENT).alias("of_event"))
        events = events.select("job_id", F.lit(None).cast(_OF_ROW).alias("of_row"), F.struct("reviewed_at", "event_seq", "status", "reviewer_notes", "run_id").cast(_OF_EVENT).alias("of_event"))
        return rows.unionByName(events)

    # --- The levels.

    def _level(self, spark: SparkSession, manifest: Manifest, level: int, again: dict, paths: Sequence[str] | None = None) -> DataFrame:
        """A level without what it holds of runs that were repeated since."""
        rows = spark.read.schema(_LEVEL).parquet(*(paths if paths is not None else [manifest.levels[level]]))
        for column, table in (("of_row", ROWS), ("of_event", EVENTS)):
            repeated = sorted(r for t, r in again if t == table)
            if repeated:
                gone = F.col(f"{column}.run_id").isin(repeated)
                rows = rows.withColumn(column, F.when(~F.coalesce(gone, F.lit(False)), F.col(column)))
        return rows

    @staticmethod
    def _again(manifest: Manifest, tail: dict) -> dict:
        return {k: at for k, at in tail.items() if k in manifest.runs}

    @staticmethod
    def _merged(parts: DataFrame) -> DataFrame:
        """One row per job: its last row and its last event, and the status that follows."""
        one = parts.groupBy("job_id").agg(F.max("of_row").alias("of_row"), F.max("of_event").alias("of_event"))
        return one.select("job_id", F.coalesce("of_event.status", "of_row.status").alias("status"), "of_row", "of_event")

    def _parts(self, spark: SparkSession, levels: Sequence[int] | None = None, only: Column | None = None) -> DataFrame:
        manifest = self.manifest(spark)
        tail = self.tail(spark, manifest)
        again = self._again(manifest, tail)
        out = self._of_tail(spark, tail, only)
        for k in sorted(manifest.levels) if levels is None else levels:
            rows = self._level(spark, manifest, k, again).drop("status")
            out = out.unionByName(rows if only is None else rows.where(only))
        return out

    def jobs(self, spark: SparkSession) -> DataFrame:
        """job_id, status, of_row, of_event of every job that has a row."""
        return self._merged(self._parts(spark)).where(F.col("of_row").isNotNull())

    def last_events(self, spark: SparkSession) -> DataFrame:
        """The last status event of every job that has one, from the levels and the tail."""
        one = self._merged(self._parts(spark)).where(F.col("of_event").isNotNull())
        return one.select("job_id", "of_event.status", "of_event.reviewer_notes", "of_event.reviewed_at", "of_event.event_seq")

    # --- Compaction.

    def compact(self, spark: SparkSession, ratio: int = RATIO, file_rows: int = FILE_ROWS) -> int:
        """Takes the tail into the levels; the version of the new manifest, or of the present one if nothing is new.

        The tail and level 1 make the new level 1; if that has more than ratio x file_rows rows, it is level 2 with what level 2
        holds, and so on: a level may be ratio times the one before, and a row is written once per level. Files hold file_rows rows,
        or more where a level would have over LEVEL_FILES of them.
        """
        if ratio < 2 or file_rows < 1:
            raise ValueError("a level is at least twice the one below it, and a file holds a row")
        manifest = self.manifest(spark)
        tail = self.tail(spark, manifest)
        if not tail:
            return manifest.version
        again = self._again(manifest, tail)
        # Repeated runs may stand in any level, so they take all levels with them.
        taken = list(sorted(manifest.levels)) if again else [k for k in (1,) if k in manifest.levels]
        fresh = pin(self._merged(self._of_tail(spark, tail)))
        held = fresh.count() + sum(manifest.rows[k] for k in taken)
        level = max(taken, default=1)
        while held > file_rows * ratio**level:
            level += 1
            if level in manifest.levels and level not in taken:
                taken.append(level)
                held += manifest.rows[level]
        parts = fresh.drop("status")
        for k in taken:
            parts = parts.unionByName(self._level(spark, manifest, k, again).drop("status"))
        folder = self._at("job_index", f"level-{level}-{uuid.uuid4().hex}")
        # Events without their rows come last, so few files hold any.
        order = [F.col("of_row").isNull(), F.col("status"), F.col("job_id")]
        files = min(max(1, -(-held // file_rows)), LEVEL_FILES)
        whole = self._merged(parts).repartitionByRange(files, *order).sortWithinPartitions(*order)
        writer = whole.write.option("parquet.bloom.filter.enabled#job_id", "true").option("parquet.bloom.filter.expected.ndv#job_id", str(max(file_rows, -(-held // files))))
        writer.parquet(folder)
        listed = (
            spark.read.schema(_LEVEL).parquet(folder).select("job_id", "status", F.col("of_row").isNull().alias("alone"), F.col("_metadata.file_name").alias("name"))
            .groupBy("name", "status").agg(F.count(F.lit(1)).alias("n"), F.count_if("alone").alias("at"), F.min("job_id").alias("low"), F.max("job_id").alias("high"))
        )
        null = lambda t: F.lit(None).cast(t)
        named = listed.select(
            F.lit("file").alias("kind"), F.lit(level).alias("level"), F.lit(folder).alias("folder"), "name", null("string").alias("run_id"), "at", "status", "n", "low", "high"
        )
        if manifest.version:
            old = self._entries(spark, manifest.version)
            named = named.unionByName(old.where((F.col("kind") == "file") & ~F.col("level").isin(taken or [0])))
        runs = manifest.runs | tail
        held_runs = spark.createDataFrame([("run", None, None, t, r, at, None, None, None, None) for (t, r), at in sorted(runs.items())], _MANIFEST)
        version = max(self._versions(spark), default=0) + 1
        # The swap: readers look for this folder's _SUCCESS. Two compactions at once want one folder, and the later one fails.
        named.unionByName(held_runs).coalesce(1).write.mode("error").parquet(self._manifest_path(version))
        return version

    def vacuum(self, spark: SparkSession) -> int:
        """Removes manifests and level folders that the newest manifest does not name; how many. Not while others read or compact."""
        version = self._committed(spark)
        if not version:
            return 0
        kept = {f.rsplit("/", 1)[1] for f in self.manifest(spark).levels.values()}
        gone = [self._at("job_index", n) for n in folders(spark, self._at("job_index")) if n.startswith("level-") and n not in kept]
        gone += [self._manifest_path(v) for v in self._versions(spark) if v != version]
        for path in gone:
            fs, p = _path(spark, path)
            fs.delete(p, True)
        return len(gone)

    # --- Look-ups.

    def _files(self, spark: SparkSession, manifest: Manifest, level: int, which: Column) -> list[str]:
        """Files of a level that can hold what is asked for, by the manifest's ranges."""
        entries = self._entries(spark, manifest.version).where((F.col("kind") == "file") & (F.col("level") == level) & which)
        return sorted(f"{manifest.levels[level]}/{r['name']}" for r in entries.select("name").distinct().collect())

    def find(self, spark: SparkSession, ids: Sequence[str]) -> DataFrame:
        """Index rows of a few ids: of every level, only the files whose ranges hold one of them are opened."""
        manifest = self.manifest(spark)
        tail = self.tail(spark, manifest)
        again = self._again(manifest, tail)
        wanted = F.col("job_id").isin(list(ids))
        hit = F.lit(False)
        for i in ids:
            hit = hit | ((F.col("low") <= i) & (F.col("high") >= i))
        out = self._of_tail(spark, tail, wanted)
        for k in sorted(manifest.levels):
            paths = self._files(spark, manifest, k, hit)
            if paths:
                out = out.unionByName(self._level(spark, manifest, k, again, paths).where(wanted).drop("status"))
        return self._merged(out).where(F.col("of_row").isNotNull())

    def find_all(self, spark: SparkSession, ids: DataFrame) -> DataFrame:
        """Index rows of many ids (column job_id)."""
        asked = ids.select("job_id").distinct()
        return self._merged(self._parts(spark).join(asked, "job_id", "left_semi")).where(F.col("of_row").isNotNull())

    def with_status(self, spark: SparkSession, status: str) -> DataFrame:
        """job_id, parsed_at of all jobs of a status. Of the levels, only files that can hold it are read, and ids of newer levels."""
        manifest = self.manifest(spark)
        tail = self.tail(spark, manifest)
        again = self._again(manifest, tail)
        newer = self._merged(self._of_tail(spark, tail))
        if again:
            # What the levels say of repeated runs has to be brought together with the tail.
            both = self._merged(self._parts(spark)).where(F.col("of_row").isNotNull() & (F.col("status") == status))
            return both.select("job_id", F.col("of_row.parsed_at").alias("parsed_at"))
        alone = {k: self._files(spark, manifest, k, F.col("at") > 0) for k in manifest.levels}

        def sure(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
            """Rows of a level (0: the tail) that no event alone in an older level tells of, and ids that need a closer look."""
            out, open_ = rows.where(F.col("of_row").isNotNull()), rows.where(F.col("of_row").isNull()).select("job_id")
            for j in sorted(manifest.levels):
                if j > level and alone[j]:
                    early = self._level(spark, manifest, j, {}, alone[j]).where(F.col("of_row").isNull()).select("job_id")
                    open_ = open_.unionByName(out.join(early, "job_id", "left_semi").select("job_id"))
                    out = out.join(early, "job_id", "left_anti")
            return out.select("job_id", F.col("of_row.parsed_at").alias("parsed_at")), open_

        out, moved = sure(newer.where(F.col("status") == status), 0)
        above = newer.select("job_id")
        for k in sorted(manifest.levels):
            paths = self._files(spark, manifest, k, F.col("status") == status)
            if paths:
                rows = self._level(spark, manifest, k, {}, paths).where(F.col("status") == status)
                found, unsure = sure(rows.join(above, "job_id", "left_anti"), k)
                out, moved = out.unionByName(found), moved.unionByName(unsure)
            if k != max(manifest.levels):
                above = above.unionByName(self._level(spark, manifest, k, {}).select("job_id"))
        moved = pin(moved.distinct())
        if manifest.levels and not moved.isEmpty():
            # Jobs whose row and event lie in different levels.
            rows = self._merged(self._parts(spark).join(moved, "job_id", "left_semi")).where(F.col("of_row").isNotNull() & (F.col("status") == status))
            out = out.unionByName(rows.select("job_id", F.col("of_row.parsed_at").alias("parsed_at")))
        return out

    def rows_of(self, found: DataFrame) -> DataFrame:
        """The stored rows of index rows, with their status, notes and time of review: only the files they lie in are read."""
        spark = found.sparkSession
        found = pin(found)
        # Names of files, of which there are as many as a store has at most.
        where = found.select("of_row.run_id", "of_row.file").distinct().collect()
        full = T.StructType([*(f for f in self.row_schema if f.name != "run_id"), T.StructField("run_id", T.StringType())])
        names = [f.name for f in self.row_schema if f.name != "saved_at"]
        if not where:
            return spark.createDataFrame([], T.StructType([f for f in full if f.name in names]))
        rows = spark.read.schema(full).option("basePath", self._at(ROWS)).parquet(*(self._at(ROWS, f"run_id={r}", f) for r, f in where))
        # Ids of one look-up are pushed down to the row groups.
        few = [r[0] for r in found.select("job_id").limit(11).collect()]
        if len(few) <= 10:
            rows = rows.where(F.col("id").isin(few))
        state = found.select(F.col("job_id").alias("id"), F.col("of_row.saved_at").alias("saved_at"), F.col("of_row.run_id").alias("run_id"), "of_event")
        has = F.col("of_event").isNotNull()
        changed = {c: F.when(has, F.col(f"of_event.{c}")).otherwise(F.col(c)).alias(c) for c in ("status", "reviewer_notes", "reviewed_at")}
        return rows.join(state, ["id", "saved_at", "run_id"]).select(*(changed.get(c, F.col(c)) for c in names))
