"""Counts of fetch tries per source over event time, with rows that come late; the same functions serve batches and streams.

A stream keeps a window open until the watermark has passed its end, so rows that are late by less than `late` still correct it; later
ones are dropped and counted. The watermark that a micro-batch drops by is the one before the last, so a row right behind it is still
taken. A batch has nothing that is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from postweave.streaming.unique import keep_state_on_disk

COUNTS = ("tries", "failures")


def _counts() -> list:
    return [F.count(F.lit(1)).alias("tries"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("failures")]


def _timed(fetches: DataFrame, late: str) -> DataFrame:
    rows = fetches.filter(F.col("ts").isNotNull())
    return rows.withWatermark("ts", late) if rows.isStreaming else rows


def fetch_windows(fetches: DataFrame, length: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """source, window_start, window_end, tries, failures; fetches: source, ts, ok. A row without time belongs to no window; ok null is a failure.

    Tasks count what they hold before the shuffle, so a hot source sends one row per window and task. With `slide` windows overlap.
    """
    span = F.window("ts", length, slide) if slide else F.window("ts", length)
    rows = _timed(fetches, late).groupBy("source", span.alias("w")).agg(*_counts())
    return rows.select("source", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *COUNTS)


def failure_sessions(fetches: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """source, session_start, session_end, failures: failures of a source that are no further apart than `gap` are one outage.

    The end is the last failure plus the gap.
    """
    failed = _timed(fetches, late).filter(~F.coalesce("ok", F.lit(False)))
    rows = failed.groupBy("source", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return rows.select("source", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "failures")


def keep_windows(windows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Writes windows of a stream as they change, a folder per micro-batch; `windows_of` reads them. A repeated batch replaces its folder."""
    keep_state_on_disk(windows.sparkSession)

    def one_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch:012d}")

    writer = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(one_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windows_of(written: DataFrame, *key: str) -> DataFrame:
    """The last counts of each window; written: what keep_windows wrote, with its column batch."""
    rest = [c for c in written.columns if c not in (*key, "batch")]
    last = written.groupBy(*key).agg(F.max(F.struct("batch", *rest)).alias("_last"))
    return last.select(*key, *(F.col(f"_last.{c}").alias(c) for c in rest))


def dropped_late(query: StreamingQuery) -> int:
    """Rows that came too late for any window that was still open, as far as the progress that the query still holds tells."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
