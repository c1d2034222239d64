"""Run, source and latency statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from postweave.operators import ordered as O

# Reported percentiles, runs shown.
PERCENTILES = (50, 95, 99)
RECENT = 10


def _count(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def run_summary(records: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per run.

    records: run_id, source, fetched, duplicate, parsed, outcome (validated/flagged/error), delivered;
    one row per arriving record. A row dropped while fetching is a duplicate only, one found in the
    store is both fetched and a duplicate. runs: run_id, started_at, finished_at.
    """
    per_source = records.groupBy("run_id", "source").agg(
        _count(F.col("fetched")).alias("fetched"),
        _count(F.col("parsed")).alias("parsed"),
        _count(F.col("outcome") == "validated").alias("validated"),
        _count(F.col("outcome") == "flagged").alias("flagged"),
        (_count(F.col("outcome") == "error") + _count(~F.col("delivered"))).alias("errors"),
        _count(F.col("duplicate")).alias("duplicates"),
    )
    return summarise_counts(per_source, runs)


COUNTS = ("fetched", "parsed", "validated", "flagged", "errors", "duplicates")


def summarise_counts(per_source: DataFrame, runs: DataFrame) -> DataFrame:
    """Run rows with the sums of partial counts (run_id, source, COUNTS); a null source counts for the run only."""
    by_source = per_source.groupBy("run_id", "source").agg(*(F.sum(c).alias(c) for c in COUNTS))
    entry = F.when(F.col("source").isNotNull() & (F.col("fetched") > 0), F.struct("source", "fetched"))
    per_run = by_source.groupBy("run_id").agg(
        *(F.sum(c).alias(c) for c in COUNTS),
        # At most one entry per source domain value.
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("per_source"),
    )
    seconds = F.round((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1e6, 2)
    more = [c for c in runs.columns if c not in ("run_id", "started_at", "finished_at")]
    joined = runs.join(per_run, "run_id", "left").select(
        "run_id", "started_at", "finished_at", *more,
        *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS), "per_source", seconds.alias("duration_seconds"),
    )
    rate = F.round(F.col("parsed") / F.col("duration_seconds"), 2)
    return joined.withColumn("jobs_per_second", F.when(F.col("duration_seconds") > 0, rate).otherwise(0.0))


def latency_percentiles(latencies: DataFrame, run: str = "run_id", value: str = "latency") -> DataFrame:
    """p50, p95, p99 per run: the value at position min(int(p/100·n), n-1) of the sorted list.

    Equal values are counted before the first shuffle; the counts of a run are then ranked in
    chunks, so that a run of any size is never sorted by one task.
    """
    counted = latencies.filter(F.col(value).isNotNull()).groupBy(run, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = O.running_sum(O.in_chunks(counted, [run], [value]), run, "_n", "_upto")
    part = rows.groupBy(run, O.CHUNK).agg(F.sum("_n").alias("_part"))
    whole = part.groupBy(run).agg(F.sum("_part").alias("_all"))
    base = part.withColumn("_base", O.total_before("_part", [run])).join(whole, run).drop("_part")
    last = F.col("_base") + F.col("_upto")

    def pick(p: int) -> Column:
        at = F.least(F.floor(F.lit(p / 100.0) * F.col("_all")), F.col("_all") - 1)
        hit = (at >= last - F.col("_n")) & (at < last)
        return F.round(F.max(F.when(hit, F.col(value))), 4).alias(f"p{p}")

    found = rows.join(O.small(base)[0], [run, O.CHUNK]).groupBy(run).agg(*(pick(p) for p in PERCENTILES))
    runs = latencies.select(run).distinct()
    return runs.join(found, run, "left").select(
        run, *(F.coalesce(f"p{p}", F.lit(0.0)).alias(f"p{p}") for p in PERCENTILES)
    )


def lifetime_totals(summaries: DataFrame) -> DataFrame:
    return summaries.agg(
        F.count(F.lit(1)).alias("total_runs"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("fetched", "parsed", "errors")),
    )


def source_totals(records: DataFrame) -> DataFrame:
    return records.filter("fetched").groupBy("source").agg(F.count(F.lit(1)).alias("total"))


def source_errors(outcomes: DataFrame) -> DataFrame:
    """Failed fetches per source; outcomes: source, ok."""
    return outcomes.filter(~F.col("ok")).groupBy("source").agg(F.count(F.lit(1)).alias("errors"))


def recent_runs(summaries: DataFrame, n: int = RECENT) -> DataFrame:
    """Last n finished runs, newest first."""
    done = summaries.filter(F.col("finished_at").isNotNull())
    return done.orderBy(F.desc("finished_at"), F.desc("run_id")).limit(n)


def run_status(runs: DataFrame) -> DataFrame:
    """runs: one row per run with finished_at and error. State of each."""
    state = (
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("finished_at").isNull(), "running")
        .otherwise("completed")
    )
    return runs.withColumn("state", state)


def status_of(runs: DataFrame, run_id: str) -> DataFrame:
    return run_status(runs.filter(F.col("run_id") == run_id))


def cycle_stats(results: DataFrame, *by: str) -> DataFrame:
    """results: success, status; one row per record of a cycle."""
    done = F.col("success")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("fetched"),
        _count(done).alias("parsed"),
        _count(done & (F.col("status") == "sent")).alias("handoff_ok"),
        _count(~done).alias("errors"),
    )


def progress(df: DataFrame, step: str, total: int | None = None) -> tuple[DataFrame, Observation]:
    """df, and what will be known once it has run: step, current, total."""
    seen = Observation(step)
    return df.observe(
        seen, F.lit(step).alias("step"), F.count(F.lit(1)).alias("current"), F.lit(total).cast("bigint").alias("total")
    ), seen


def _count_failures(rows: DataFrame, source: str) -> DataFrame:
    """Adds, per source of a chunk, the failures so far (_fails) and those at its last success (_mark).

    Streams through the sorted partitions; only the last row of a batch is kept for the next.
    """
    at, ok_at = rows.columns.index(source), rows.columns.index("ok")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, fails0, mark0 = (), 0, -1
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names, ok = batch.column(at), np.asarray(batch.column(ok_at).fill_null(False))
            group = O.groups_of(names, last)
            fails = O.sums_in(group, (~ok).astype(np.int64), fails0)
            # Marks rise within a source, so the last one is the largest so far.
            mark = np.where(ok, fails, -1)
            mark[0] = max(mark[0], mark0) if group[0] < 0 else mark[0]
            shift = (group + 1) * (np.int64(1) << 40)
            mark = np.maximum.accumulate(mark + shift) - shift
            last, fails0, mark0 = (names[n - 1].as_py(),), int(fails[-1]), int(mark[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(fails, pa.int64()), pa.array(mark, pa.int64(), mask=mark < 0)], names=[*batch.schema.names, "_fails", "_mark"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, _fails bigint, _mark bigint")


def _streak_parts(outcomes: DataFrame, source: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their failures since the chunk's last success, and one summary per (source, chunk)."""
    fail = F.when(F.col("ok"), 0).otherwise(1)
    rows = _count_failures(O.in_chunks(outcomes, [source], order), source)
    parts = rows.groupBy(source, O.CHUNK).agg(
        F.sum(fail).alias("_part"), F.max("_mark").alias("_mark"), F.count_if("ok").alias("_good"),
    ).withColumn("_before", O.total_before("_part", [source]))
    return rows, parts


def failure_streaks(outcomes: DataFrame, source: str = "source", order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """outcomes: source, order columns, ok. Adds streak: consecutive failures up to the row, 0 on success."""
    rows, parts = _streak_parts(outcomes, source, order)
    mark = F.max(F.col("_before") + F.col("_mark")).over(O.earlier_chunks([source]))
    carry = parts.select(source, O.CHUNK, (F.col("_before") - F.coalesce(mark, F.lit(0))).alias("_carry"))
    # Only a chunk's first source can carry anything over: at most one row per chunk.
    carry, _ = O.small(carry.filter("_carry <> 0"))
    streak = F.col("_fails") - F.coalesce("_mark", -F.coalesce("_carry", F.lit(0)))
    return rows.join(carry, [source, O.CHUNK], "left").select(*outcomes.columns, streak.alias("streak"))


def breaker_stats(
    outcomes: DataFrame, asof: Column, threshold: int = 3, cooldown: float = 60.0,
    source: str = "source", order: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """Per source, from a log of requests that were made: state at asof, current streak and totals.

    After the threshold is reached only a success closes the breaker, so its state follows from the
    streak and the time of the last failure. The first order column is the time.
    """
    _, parts = _streak_parts(outcomes, source, order)
    last = outcomes.groupBy(source).agg(F.max(F.when(~F.col("ok"), F.col(order[0]))).alias("_last"))
    folded = parts.groupBy(source).agg(
        F.sum("_part").alias("total_failures"),
        F.sum("_good").alias("total_successes"),
        F.max(F.col("_before") + F.col("_mark")).alias("_reset"),
    )
    streak = F.col("total_failures") - F.coalesce("_reset", F.lit(0))
    waited = F.unix_micros(asof) - F.unix_micros("_last") >= int(cooldown * 1e6)
    state = (
        F.when(F.col("consecutive_failures") < threshold, "closed").when(waited, "half_open").otherwise("open")
    )
    return (
        folded.join(last, source).withColumn("consecutive_failures", streak)
        .select(source, state.alias("state"), "consecutive_failures", "total_failures", "total_successes")
    )
