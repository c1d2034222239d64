"""The same jobs over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from postweave.operators import breaker as B
from postweave.operators import dedup as U
from postweave.operators import metrics as M
from postweave.operators.tables import JobTables, seen_part
from postweave.plans.intake import SINGLE_NOTE, Intake, results
from postweave.session import pin
from postweave.streaming.unique import keep_state_on_disk, unique_rows


BATCH = "batch-"


def batch_run_id(epoch: int) -> str:
    return f"{BATCH}{epoch:012d}"


def run_cycle(
    intake: Intake, raw: DataFrame, checkpoint: str, by_fingerprint: bool = True, available_now: bool = True,
    compact_every: int = 100, within: str | None = None,
) -> StreamingQuery:
    """Takes in a stream of raw rows. First of a kind wins, within a micro-batch and over all of them.

    Every id and fingerprint that passed the id step is kept in the narrow table seen_keys, laid out
    by hash: a batch reads the parts of the hash in which its own keys lie, and never stored texts. Of
    raw_jobs it reads the ids of other runs only, not those of the stream. Every `compact_every`
    batches the key folders become one. Each micro-batch writes folders named after its number: a
    repeated batch replaces its own rows, and its own earlier attempt is left out of the comparison.
    Statistics of each batch go to the table cycles.

    With `within`, a time such as '30 days', keys lie in Spark's own state and are forgotten after that time (`unique_rows`): no
    key folders, and of rows alike in one micro-batch any one wins.
    """
    def one_unique_batch(batch: DataFrame, epoch: int) -> None:
        run_id = batch_run_id(epoch)
        left = pin(intake.tables.known.drop_known(batch.select("seq", "external_id"), besides=BATCH + "*"))
        parsed, sent = intake.process(U.rows_at(batch, left), run_id, SINGLE_NOTE)
        intake.tables.save_cycle(M.cycle_stats(results(parsed, sent)), run_id)

    def one_batch(batch: DataFrame, epoch: int) -> None:
        spark, run_id = batch.sparkSession, batch_run_id(epoch)
        tables = intake.tables
        first = pin(U.first_by_external_id(U.dedup_keys(batch)))
        # At most SEEN_PARTS numbers.
        parts = [r[0] for r in first.select(F.explode(F.array(seen_part(F.col("external_id")), seen_part(F.col("fp"))))).distinct().collect()]
        seen = tables.seen_keys(spark, parts).filter(F.col("run_id") != run_id)
        ids = seen.filter("kind = 'id'").select(F.col("value").alias("external_id"))
        fresh = pin(U.drop_known(first, ids.unionByName(tables.known.stored(spark, first, besides=BATCH + "*"))))
        left = fresh
        if by_fingerprint:
            fps = seen.filter("kind = 'fp'").select(F.col("value").alias("fp")).distinct()
            left = U.first_by_fingerprint(fresh).join(fps, "fp", "left_anti")
        left = pin(left)
        tables.save_seen_keys(fresh, run_id)
        if compact_every and epoch and epoch % compact_every == 0:
            tables.compact_seen_keys(spark, batch_run_id(epoch - 1))
        parsed, sent = intake.process(U.rows_at(batch, left), run_id, SINGLE_NOTE)
        tables.save_cycle(M.cycle_stats(results(parsed, sent)), run_id)

    if within:
        keep_state_on_disk(raw.sparkSession)
        raw = unique_rows(raw, within, by_fingerprint)
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one_unique_batch if within else one_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_breakers(
    tables: JobTables, attempts: DataFrame, checkpoint: str, threshold: int = B.THRESHOLD,
    cooldown: float = B.COOLDOWN, available_now: bool = True,
) -> StreamingQuery:
    """Breaker timeline over a stream of attempts (source, ts, seq, ok) that arrive in order.

    Every micro-batch is worked on in chunks, like a batch, so no source is bound to one task. The
    breakers after batch n are a table that batch n+1 starts from; timeline rows go to their own table.
    """
    kind = attempts.schema["source"].dataType

    def one_batch(batch: DataFrame, epoch: int) -> None:
        run_id = batch_run_id(epoch)
        known = tables.breakers(batch.sparkSession, kind)
        before = known.filter(F.col("run_id") == batch_run_id(epoch - 1)).drop("run_id")
        named = batch.select("source", F.unix_micros("ts").alias("us"), "seq", "ok")
        walked = pin(B.walk(named, threshold, cooldown, before))
        tables.save_breakers(B.breakers_after(walked, before), run_id)
        tables.save_timeline(walked, run_id)

    writer = attempts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
