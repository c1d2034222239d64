"""Deduplication of a stream in Spark's own keyed state, which forgets what is older than a time.

The keys of rows that have passed lie in the state store, a part per task, and go when the watermark has passed their time: the
state is as large as the keys of that time, not as the stream is long. Rows stay in the JVM. `cycle.run_cycle` without `within`
keeps all keys for ever, in a table, and lets the first row of a batch win; here one of the rows that arrive in one micro-batch wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postweave.functions.extract import fingerprint
from postweave.functions.text import blank

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State stores of streams started from now on lie in RocksDB, with changes only in the checkpoint, unless the session names another store."""
    if "HDFSBackedStateStoreProvider" in spark.conf.get(_PROVIDER):
        spark.conf.set(_PROVIDER, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def unique_rows(rows: DataFrame, within: str, by_fingerprint: bool = True, at: str = "fetched_at") -> DataFrame:
    """The first row to arrive per external id, and of these the first per fingerprint, of rows no further apart than `within`.

    Time is the column `at`, or the time of arrival where it is null. Rows without external id are no duplicates of each other by
    id. A row more than `within` older than the newest seen is late: it is dropped and counted (numRowsDroppedByWatermark in the
    progress of the stream). Works on batches as well, where nothing is late and `within` does not matter.
    """
    names = rows.columns
    ext = F.col("external_id")
    # A row without id has a key of its own, so such rows spread over all tasks.
    key = F.when(blank(ext), F.concat(F.lit("#"), F.col("seq").cast("string"))).otherwise(F.concat(F.lit("="), ext))
    timed = rows.withColumns({"_at": F.coalesce(F.col(at).cast("timestamp"), F.current_timestamp()), "_key": key})
    if not rows.isStreaming:
        one = timed.dropDuplicates(["_key"])
        return (one.withColumn("_fp", fingerprint(F.col("raw_text"))).dropDuplicates(["_fp"]) if by_fingerprint else one).select(*names)
    one = timed.withWatermark("_at", within).dropDuplicatesWithinWatermark(["_key"])
    if by_fingerprint:
        one = one.withColumn("_fp", fingerprint(F.col("raw_text"))).dropDuplicatesWithinWatermark(["_fp"])
    return one.select(*names)
