"""Delivery of accepted records to files or to an injected sender."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postweave import schemas as S
from postweave.session import pin

MAX_TRIES = 3
OUTCOME = "job_id string, ok boolean, attempts int, error string"
_NAMES = ("job_id", "ok", "attempts", "error")
_ARROW = pa.schema(list(zip(_NAMES, (pa.string(), pa.bool_(), pa.int32(), pa.string()))))


class SendError(Exception):
    """Raised by a sender; status is the answer code, None when no answer came."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def to_payload(jobs: DataFrame, now: Column | None = None) -> DataFrame:
    """The flat record the receiver gets."""
    return jobs.select(
        F.col("id").alias("job_id"), "job_title", "company", "location", "remote",
        F.col("salary.min").alias("salary_min"), F.col("salary.max").alias("salary_max"),
        F.coalesce("salary.currency", F.lit(S.DEFAULT_CURRENCY)).alias("salary_currency"),
        "required_skills", "preferred_skills", "years_experience", "employment_type",
        F.col("description_clean").alias("description"),
        (now if now is not None else F.current_timestamp()).alias("submitted_at"),
    )


def write_jsonl(payloads: DataFrame, path: str, mode: str = "append") -> None:
    """Writes JSON lines, nulls written out."""
    payloads.write.mode(mode).option("ignoreNullFields", "false").json(path)


def attempt(send: Callable[[dict], None], body: dict, max_tries: int) -> tuple[str, bool, int, str | None]:
    """job_id, ok, attempts, error. A refusal (code below 500) ends at once, other failures are tried again without delay."""
    for n in range(1, max_tries + 1):
        try:
            send(body)
        except Exception as e:  # noqa: BLE001 - the injected sender may raise anything
            status = getattr(e, "status", None)
            if n == max_tries or not isinstance(e, SendError) or (status is not None and status < 500):
                return body["job_id"], False, n, str(e)
        else:
            return body["job_id"], True, n, None
    raise ValueError("a payload is tried at least once")


def deliver(payloads: DataFrame, send: Callable[[dict], None], max_tries: int = MAX_TRIES) -> DataFrame:
    """Sends each payload from the executors; one outcome row per job.

    Delivery is at least once: a repeated task sends again, so receivers key by job_id, and callers pin
    or write the outcomes before using them. `outbox` sends again only what is in doubt.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            outcomes = [attempt(send, body, max_tries) for body in part.to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, o)) for o in outcomes], schema=_ARROW)

    return payloads.mapInArrow(batches, OUTCOME)


def to_files(root: str) -> Callable[[DataFrame, str], DataFrame]:
    """A way to send: writes the payloads as JSON lines to the run's folder, then reports what stands there as delivered.

    A repeated run replaces its folder.
    """
    def send(payloads: DataFrame, run_id: str = "once") -> DataFrame:
        path = f"{root.rstrip('/')}/run_id={run_id}"
        write_jsonl(payloads, path, "overwrite")
        return _delivered(payloads.sparkSession.read.schema(payloads.schema).json(path))

    return send


def to_sender(send: Callable[[dict], None], max_tries: int = MAX_TRIES) -> Callable[[DataFrame, str], DataFrame]:
    """A way to send: one call per payload, with the outcomes pinned so that no later use sends again."""
    return lambda payloads, run_id="once": pin(deliver(payloads, send, max_tries))


def _delivered(written: DataFrame) -> DataFrame:
    """Outcome rows for payloads read back from where they were written."""
    return written.select(
        "job_id", F.lit(True).alias("ok"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error")
    )


def delivery_status(outcomes: DataFrame, note: str = "Bulk auto-handoff", now: Column | None = None, event_seq: int = 1) -> DataFrame:
    """Status events: sent with the note, or failed with the error text."""
    from postweave.operators.tables import status_events

    status = F.when(F.col("ok"), "sent").otherwise("failed")
    notes = F.when(F.col("ok"), note).otherwise(F.col("error"))
    return status_events(outcomes, status, notes, now, event_seq)


def delivery_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.count_if("ok").alias("sent"), F.count_if(~F.col("ok")).alias("errors"))
