"""Job tables: append-only Parquet folders plus a status log; queries over them.

Every save writes its own run_id folder and replaces that folder when repeated, so a retried run
or micro-batch leaves the same table. Rows carry the time of their save; readers see the last saved
row of an id. Status changes are appended events, never updates in place.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postweave import schemas as S
from postweave.operators.jobindex import JobIndex, folders, write_text
from postweave.operators.membership import KnownIds
from postweave.session import pin


@dataclass(frozen=True)
class JobTables:
    """Folder layout of one store, on storage that all executors reach."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _save(self, df: DataFrame, name: str, run_id: str, by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> None:
        writer = df.write.mode("overwrite").partitionBy(*by).options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom})
        writer.parquet(f"{self.path(name)}/run_id={run_id}")

    def save_raw(self, raw: DataFrame, run_id: str) -> None:
        self._save(raw.select(*(f.name for f in S.RAW), _saved_at()), "raw_jobs", run_id, ("source",))

    def save_parsed(self, parsed: DataFrame, run_id: str) -> None:
        """Rows in the order of their ids, with Bloom filters, so that a look-up reads one row group; with what the parser tells of its calls."""
        told = [F.col(f.name) if f.name in parsed.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _CALL_ONLY]
        rows = parsed.select(*(f.name for f in S.PARSED), *told, _saved_at())
        self._save(rows.sortWithinPartitions("id"), "parsed_jobs", run_id, bloom=("id",))

    def save_fetches(self, fetches: DataFrame, run_id: str) -> None:
        self._save(fetches.select(*(f.name for f in S.FETCH)), "fetches", run_id)

    def fetches(self, spark: SparkSession) -> DataFrame:
        """Outcomes of all tries to read a source: what error counts, streaks and breakers are made of."""
        return self._read(spark, "fetches", S.FETCH)

    def parse_calls(self, spark: SparkSession) -> DataFrame:
        """Latency, failed attempts and fallbacks of all parsed rows."""
        return self._read(spark, "parsed_jobs", S.PARSE_CALL)

    def log_status(self, events: DataFrame, run_id: str) -> None:
        self._save(events.select(*(f.name for f in S.STATUS_EVENT)), "status_log", run_id)

    def save_run(self, summary: DataFrame, run_id: str) -> None:
        self._save(summary.select(*(f.name for f in S.RUN if f.name != "run_id")), "runs", run_id)

    def runs(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "runs", S.RUN)

    def save_seen_keys(self, keys: DataFrame, run_id: str) -> None:
        """A row per id and per fingerprint, laid out by a part of its hash."""
        rows = keys.select(F.explode(F.array(
            F.struct(F.lit("id").alias("kind"), F.col("external_id").alias("value")), F.struct(F.lit("fp").alias("kind"), F.col("fp").alias("value")),
        )).alias("k")).select("k.*").filter("value IS NOT NULL").distinct()
        self._save(rows.withColumn("part", seen_part(F.col("value"))).repartition("part"), "seen_keys", run_id, ("part",))

    def seen_keys(self, spark: SparkSession, parts: Sequence[int] | None = None) -> DataFrame:
        """kind, value, run_id; only the given parts of the hash are read. Compacted keys count as the last run they hold."""
        schema = T.StructType([*S.SEEN_KEY, T.StructField("part", T.IntegerType())])
        old = self._read(spark, "seen_compact", schema)
        upto = old.agg(F.max("run_id")).first()[0]
        new = self._read(spark, "seen_keys", schema)
        both = new if upto is None else new.filter(F.col("run_id") > upto).unionByName(old.filter(F.col("run_id") == upto))
        return (both if parts is None else both.filter(F.col("part").isin(*parts))).drop("part")

    def compact_seen_keys(self, spark: SparkSession, upto: str) -> None:
        """Writes the distinct keys of all runs up to one as one table; readers take it in place of those runs' folders."""
        rows = self.seen_keys(spark).filter(F.col("run_id") <= upto).select("kind", "value").distinct()
        self._save(pin(rows.withColumn("part", seen_part(F.col("value")))).repartition("part"), "seen_compact", upto, ("part",))

    def save_breakers(self, states: DataFrame, run_id: str) -> None:
        self._save(states, "breakers", run_id)

    def breakers(self, spark: SparkSession, source_type: T.DataType) -> DataFrame:
        schema = T.StructType([T.StructField("source", source_type), *S.BREAKER])
        return self._read(spark, "breakers", schema)

    def save_timeline(self, rows: DataFrame, run_id: str) -> None:
        self._save(rows, "breaker_timeline", run_id)

    def save_cycle(self, stats: DataFrame, run_id: str) -> None:
        self._save(stats.select(*(f.name for f in S.CYCLE)), "cycles", run_id)

    def cycles(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "cycles", S.CYCLE)

    def _read(self, spark: SparkSession, name: str, schema) -> DataFrame:
        fields = [f for f in schema.fieldNames() if f != "run_id"]
        with_run = T.StructType([f for f in schema if f.name != "run_id"]).add("run_id", "string")
        try:
            rows = spark.read.schema(with_run).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], with_run)
        return rows.select(*fields, "run_id")

    def raw_rows(self, spark: SparkSession) -> DataFrame:
        """All saved rows, earlier versions included."""
        return self._read(spark, "raw_jobs", S.RAW)

    def raw_of_runs(self, spark: SparkSession, wanted: Callable[[str], bool]) -> DataFrame | None:
        """Saved rows of the runs whose names are wanted; other folders are not opened. None if there is no such run."""
        runs = sorted(n[7:] for n in folders(spark, self.path("raw_jobs")) if n.startswith("run_id=") and wanted(n[7:]))
        if not runs:
            return None
        schema = T.StructType([*S.RAW, T.StructField("run_id", T.StringType())])
        return spark.read.schema(schema).option("basePath", self.path("raw_jobs")).parquet(*(self.path(f"raw_jobs/run_id={r}") for r in runs))

    def parsed_rows(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "parsed_jobs", S.PARSED)

    def raw(self, spark: SparkSession) -> DataFrame:
        """The last saved row of every id."""
        return latest_by_id(self._read(spark, "raw_jobs", _versioned(S.RAW))).drop("saved_at")

    def parsed(self, spark: SparkSession) -> DataFrame:
        return latest_by_id(self._read(spark, "parsed_jobs", _versioned(S.PARSED))).drop("saved_at")

    @property
    def index(self) -> JobIndex:
        """Statuses and places of the stored rows, in levels; what is not yet in a level is read from its runs."""
        return JobIndex(self.root, _versioned(S.PARSED), S.STATUS_EVENT)

    def compact_log(self, spark: SparkSession) -> int:
        """Takes the runs saved since the last time into the levels of the index; the version that readers see from now on."""
        return self.index.compact(spark)

    @property
    def known(self) -> KnownIds:
        """Filters over the stored external ids; runs that they do not hold yet are read."""
        return KnownIds(self)

    def last_events(self, spark: SparkSession) -> DataFrame:
        """The last event of every job, without reading runs that a level of the index holds."""
        return self.index.last_events(spark)

    def job(self, spark: SparkSession, job_id: str) -> DataFrame:
        """The current row of one job, or none: the index tells the file, statistics and Bloom filters the row group."""
        return self.index.rows_of(self.index.find(spark, [job_id]))

    def jobs_of(self, spark: SparkSession, ids: DataFrame) -> DataFrame:
        """Current rows of the jobs in ids (job_id)."""
        return self.index.rows_of(self.index.find_all(spark, ids))

    def pending(self, spark: SparkSession, limit: int | None = 50) -> DataFrame:
        """Current rows of the oldest jobs in status parsed, or of all: found in the index, then read where they lie."""
        waiting = self.index.with_status(spark, "parsed")
        if limit is not None:
            waiting = waiting.orderBy("parsed_at", "job_id").limit(limit)
        return self.jobs_of(spark, waiting.select("job_id"))

    def tell(self, spark: SparkSession, run_id: str, step: str, current: int, total: int | None) -> None:
        """Notes how far a run is: one small file per step, written at once and replaced by a repeated run, for other sessions to read."""
        note = {"step": step, "current": current, "total": total, "at": datetime.now(timezone.utc).isoformat()}
        write_text(spark, f"{self.path('progress')}/run_id={run_id}/{step}.json", json.dumps(note))

    def progress(self, spark: SparkSession) -> DataFrame:
        """step, current, total, at, run_id: every step that a run has told of; the last one of a run is where it is."""
        schema = T.StructType([
            T.StructField("step", T.StringType()), T.StructField("current", T.LongType()), T.StructField("total", T.LongType()),
            T.StructField("at", T.TimestampType()), T.StructField("run_id", T.StringType()),
        ])
        if not folders(spark, self.path("progress")):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(self.path("progress"))

    def has_run(self, spark: SparkSession, name: str, run_id: str) -> bool:
        return f"run_id={run_id}" in folders(spark, self.path(name))

    def status_log(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "status_log", S.STATUS_EVENT)


# What a parser tells of a call besides the parsed row.
_CALL_ONLY = [f for f in S.PARSE_CALL if f.name not in S.PARSED.fieldNames()]


def _saved_at() -> Column:
    return F.current_timestamp().alias("saved_at")


def _versioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("saved_at", T.TimestampType())])


SEEN_PARTS = 64


def seen_part(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SEEN_PARTS)).cast("int")


def latest_by_id(rows: DataFrame, version: str = "saved_at") -> DataFrame:
    """The last saved row per id, where an id was saved several times.

    Only (id, version) is aggregated; the wide rows meet the result in one join on unique keys.
    """
    last = rows.groupBy("id").agg(F.max(version).alias(version))
    return rows.join(last, ["id", version], "left_semi")


def status_events(
    ids: DataFrame, status: str | Column, notes: str | Column = "", now: Column | None = None, event_seq: int | Column = 0
) -> DataFrame:
    """Log rows that set a status; ids: job_id plus whatever the columns passed in refer to."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return ids.select(
        "job_id", lit(status).alias("status"), lit(notes).alias("reviewer_notes"),
        (now if now is not None else F.current_timestamp()).alias("reviewed_at"),
        lit(event_seq).cast("bigint").alias("event_seq"),
    )


def update_status(jobs: DataFrame, ids: DataFrame, status: str, notes: str = "", now: Column | None = None, event_seq: int = 0) -> DataFrame:
    """Events for the ids that exist; an unknown id has no effect."""
    if status not in S.STATUSES:
        raise ValueError(f"unknown status: {status}")
    known = ids.select("job_id").distinct().join(jobs.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    return status_events(known, status, notes, now, event_seq)


def latest_events(log: DataFrame) -> DataFrame:
    """The last event per job; written to a new store, it is the log in compact form."""
    event = F.struct("reviewed_at", "event_seq", "status", "reviewer_notes")
    last = log.groupBy("job_id").agg(F.max(event).alias("_e"))
    return last.select("job_id", "_e.status", "_e.reviewer_notes", "_e.reviewed_at", "_e.event_seq")


def current_jobs(parsed: DataFrame, log: DataFrame) -> DataFrame:
    """Parsed rows with the status, notes and time of their last event; reviewed_by stays as saved."""
    last = latest_events(log).select(F.col("job_id").alias("id"), F.struct("*").alias("_e"))
    has = F.col("_e").isNotNull()
    changed = {
        "status": F.when(has, F.col("_e.status")).otherwise(F.col("status")),
        "reviewer_notes": F.when(has, F.col("_e.reviewer_notes")).otherwise(F.col("reviewer_notes")),
        "reviewed_at": F.when(has, F.col("_e.reviewed_at")).otherwise(F.col("reviewed_at")),
    }
    return parsed.join(last, "id", "left").select(
        *(changed[c].alias(c) if c in changed else F.col(c) for c in parsed.columns)
    )


def pending(jobs: DataFrame, limit: int | None = 50) -> DataFrame:
    """The oldest rows still in status parsed, a top-k; all of them, unordered, without limit."""
    waiting = jobs.filter(F.col("status") == "parsed")
    return waiting if limit is None else waiting.orderBy("parsed_at", "id").limit(limit)


def get_by_id(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.filter(F.col("id") == job_id)


def get_all(jobs: DataFrame) -> DataFrame:
    return jobs


def with_source(jobs: DataFrame, raw: DataFrame) -> DataFrame:
    return jobs.join(raw.select(F.col("id").alias("raw_id"), "source"), "raw_id", "left")


def stats(raw: DataFrame, jobs: DataFrame) -> DataFrame:
    """One long table: (section, name, value) with totals, average confidence and counts per status and source.

    Each big table is read and grouped once; the few groups are then folded into one row, which
    gives the totals also for an empty store.
    """
    def entry(section: str, name: Column | str, value: Column) -> Column:
        named = name if isinstance(name, Column) else F.lit(name)
        return F.struct(F.lit(section).alias("section"), named.alias("name"), value.cast("double").alias("value"))

    def counted(df: DataFrame, by: str, *more: Column) -> DataFrame:
        groups = df.groupBy(F.col(by).alias("name")).agg(F.count(F.lit(1)).alias("n"), *more)
        sums = [F.sum(c).alias(c) for c in groups.columns[2:]]
        total = F.coalesce(F.sum("n"), F.lit(0)).alias("n")
        # One element per status or source domain value.
        folded = groups.agg(total, *sums, F.collect_list(F.struct("name", "n")).alias("groups"))
        return folded.withColumn("groups", F.transform("groups", lambda g: entry(f"by_{by}", g["name"], g["n"])))

    sources = counted(raw, "source").select(
        F.inline(F.concat(F.array(entry("total", "raw", F.col("n"))), "groups"))
    )
    average = F.round(F.coalesce(F.try_divide("c", "m"), F.lit(1.0)), 4)
    statuses = counted(jobs, "status", F.sum("confidence").alias("c"), F.count("confidence").alias("m")).select(
        F.inline(F.concat(F.array(entry("total", "parsed", F.col("n")), entry("total", "avg_confidence", average)), "groups"))
    )
    return sources.unionByName(statuses)
