"""Review actions over the current jobs: results for the caller and status events for the log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from postweave.operators import deliver as D
from postweave.operators.tables import pending, status_events

# Statuses that may be approved, size of the queue that a request without ids may ask for.
APPROVABLE = ("parsed", "failed")
QUEUE = 1_000

# Takes payloads and the id of the run they belong to; gives delivery outcomes.
Send = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Action:
    results: DataFrame  # requested_id, success, job_id, status, message; one row per requested id
    events: DataFrame   # rows for the status log


def _requests(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """Distinct requested ids with the job they name: an id listed twice is acted on once."""
    asked = ids.select(F.col("job_id").alias("requested_id")).distinct()
    return asked.join(jobs, F.col("requested_id") == F.col("id"), "left")


def _result(success: Column, job_id: Column, status: Column, message: Column) -> list[Column]:
    return [
        "requested_id", success.alias("success"), job_id.cast("string").alias("job_id"),
        status.cast("string").alias("status"), message.alias("message"),
    ]


def _not_found() -> Column:
    return F.concat(F.lit("Job "), "requested_id", F.lit(" not found"))


def decide_approval(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requested jobs with refusal: null where the job may be sent, else the reason."""
    wrong = F.concat(F.lit("Job "), "requested_id", F.lit(" is in status "), "status", F.lit(", cannot approve"))
    return _requests(ids, jobs).withColumn(
        "refusal",
        F.when(F.col("id").isNull(), _not_found()).when(~F.col("status").isin(*APPROVABLE), wrong),
    )


def approve(
    ids: DataFrame, jobs: DataFrame, reviewer: str, notes: str = "",
    *, send: Send, run_id: str = "review", now: Column | None = None, event_seq: int = 2,
) -> Action:
    """Sends the approvable jobs and marks them sent, or failed with the error as notes.

    reviewer is part of the request and, like in the status log, not stored with the job.
    """
    asked = decide_approval(ids, jobs)
    allowed = asked.filter(F.col("refusal").isNull())
    sent = send(D.to_payload(allowed, now), run_id)
    ok = F.coalesce("ok", F.lit(False))
    results = asked.select("requested_id", "refusal").join(
        sent.withColumnRenamed("job_id", "_sent"), F.col("requested_id") == F.col("_sent"), "left"
    ).select(*_result(
        ok, F.when(F.col("refusal").isNull(), F.col("requested_id")), F.when(ok, "sent"),
        F.coalesce("refusal", "error", F.lit("")),
    ))
    return Action(results, D.delivery_status(sent, notes, now, event_seq))


def approve_batch(ids: DataFrame, jobs: DataFrame, reviewer: str, **options) -> Action:
    return approve(ids, jobs, reviewer, "", **options)


def reject(ids: DataFrame, jobs: DataFrame, reviewer: str, reason: str, now: Column | None = None, event_seq: int = 2) -> Action:
    """From any status; the reason becomes the notes, the reviewer is not stored."""
    asked = _requests(ids, jobs)
    found = F.col("id").isNotNull()
    results = asked.select(*_result(
        found, F.col("id"), F.when(found, "rejected"), F.when(~found, _not_found()).otherwise(""),
    ))
    hit = asked.filter(found).select(F.col("id").alias("job_id"))
    return Action(results, status_events(hit, "rejected", reason, now, event_seq))


def for_each_request(ids: DataFrame, results: DataFrame) -> DataFrame:
    """One result per list entry, repeats included, in place of one per distinct id."""
    return ids.select(F.col("job_id").alias("requested_id")).join(results, "requested_id")


def queue_targets(
    jobs: DataFrame, confidence_min: float | None = None, exclude_flagged: bool = False, limit: int | None = None
) -> DataFrame:
    """Ids of pending rows that pass the filters; with a limit, of the oldest that many rows before filtering."""
    rows = pending(jobs, limit)
    if confidence_min is not None:
        rows = rows.filter(F.col("confidence") >= confidence_min)
    if exclude_flagged:
        rows = rows.filter(F.size("validation_issues") == 0)
    return rows.select(F.col("id").alias("job_id"))


def bulk_action(
    action: str, jobs: DataFrame, reviewer: str, reason: str = "", ids: DataFrame | None = None,
    confidence_min: float | None = None, exclude_flagged: bool = False, limit: int | None = None, **options,
) -> Action:
    """Approves or rejects the given ids, or else the filtered queue: all of it, or of its first `limit` rows."""
    targets = ids if ids is not None else queue_targets(jobs, confidence_min, exclude_flagged, limit)
    if action == "approve":
        return approve_batch(targets, jobs, reviewer, **options)
    if action == "reject":
        return reject(targets, jobs, reviewer, reason, **{k: v for k, v in options.items() if k not in ("send", "run_id")})
    raise ValueError(f"Invalid bulk action: {action}")


def auto_approvable(jobs: DataFrame, threshold: float) -> DataFrame:
    """Pending jobs without issues at or above the threshold; documented by the service, off by default."""
    ok = (F.col("status") == "parsed") & (F.col("confidence") >= threshold) & (F.size("validation_issues") == 0)
    return jobs.filter(ok)
