"""Delivery through an outbox: what was sent is staged as it is sent, and a repeated task or job sends only what is in doubt.

The payloads are written to a Python data source. A task names the jobs of a small batch in a claim file, sends them, and stages their
outcomes; when all tasks are done, the driver's commit marks the run. A job is `claimed` (may have been sent), `sent` (its outcome
stands) or `confirmed` (sent in a run that was committed). Jobs are dealt to tasks by their id, so a repeated task finds what it staged
before; a repeated job leaves out all that were sent. Only jobs that were claimed and have no outcome may reach the receiver twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import batched

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from postweave.operators.deliver import MAX_TRIES, OUTCOME, attempt
from postweave.operators.jobindex import folders
from postweave.session import pin

_SENT = f"{OUTCOME}, at timestamp, run_id string"
_CLAIMED = "job_id string, run_id string"


def _files(root: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes file:/x where others write file:///x.
    return fs.FileSystem.from_uri("file:///" + root[6:].lstrip("/") if root.startswith("file:/") else root)


def _put(root: str, name: str, rows: list[dict]) -> None:
    """A file of JSON lines that is there whole or not at all."""
    where, base = _files(root)
    path = f"{base}/{name}"
    folder, last = path.rsplit("/", 1)
    where.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with where.open_output_stream(hidden) as out:
        out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
    where.move(hidden, path)


def _lines(root: str, folder: str, prefix: str) -> Iterator[dict]:
    where, base = _files(root)
    for f in where.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True)):
        if f.base_name.startswith(prefix):
            with where.open_input_stream(f.path) as part:
                yield from map(json.loads, part.read().splitlines())


@dataclass
class _Done(WriterCommitMessage):
    sent: int


class _Writer(DataSourceArrowWriter):
    """Takes whole Arrow batches: a payload reaches the sender as the dict that `deliver` gives it, without a row object in between."""

    def __init__(self, root: str, run_id: str, send: Callable[[dict], None], batch: int, max_tries: int):
        self.root, self.run, self.send, self.batch, self.max_tries = root, f"run_id={run_id}", send, batch, max_tries

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        mine = f"part-{TaskContext.get().partitionId():06d}-"
        # What earlier tries of this task have sent.
        done = {o["job_id"] for o in _lines(self.root, f"sent/{self.run}", mine) if o["ok"]}
        n = 0
        bodies = (body for part in iterator for body in part.to_pylist())
        for rows in batched((b for b in bodies if b["job_id"] not in done), self.batch):
            name = f"{self.run}/{mine}{uuid.uuid4().hex}.json"
            _put(self.root, f"claimed/{name}", [{"job_id": r["job_id"]} for r in rows])
            outcomes = [attempt(self.send, r, self.max_tries) for r in rows]
            at = datetime.now(timezone.utc).isoformat()
            _put(self.root, f"sent/{name}", [dict(zip(("job_id", "ok", "attempts", "error"), o)) | {"at": at} for o in outcomes])
            n += len(rows)
        return _Done(n)

    def commit(self, messages: list) -> None:
        _put(self.root, f"committed/{self.run}/done.json", [{"sent": sum(m.sent for m in messages if m)}])

    def abort(self, messages: list) -> None:
        """What was sent stays staged; the run is not committed."""


def _source(name: str, *parts) -> type[DataSource]:
    class OutboxSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return _Writer(*parts)

    return OutboxSource


@dataclass(frozen=True)
class Outbox:
    """Ledger of deliveries under one folder that all executors reach; root is an absolute path or a URI that pyarrow's file systems know."""

    root: str

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{name}"
        return spark.read.schema(schema).json(path) if folders(spark, path) else spark.createDataFrame([], schema)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """job_id, ok, attempts, error, run_id: one row per job that was tried; the success if there is one, else the last failure."""
        last = self._read(spark, "sent", _SENT).groupBy("job_id").agg(F.max(F.struct("ok", "at", "attempts", "error", "run_id")).alias("o"))
        return last.select("job_id", "o.ok", "o.attempts", "o.error", "o.run_id")

    def ledger(self, spark: SparkSession) -> DataFrame:
        """job_id, state: claimed, sent, confirmed, or failed for what was refused."""
        committed = self._read(spark, "committed", "sent bigint, run_id string").select("run_id").distinct().withColumn("whole", F.lit(True))
        tried = self.outcomes(spark).join(committed, "run_id", "left")
        state = F.when(~F.col("ok"), "failed").when(F.col("whole"), "confirmed").otherwise("sent")
        claimed = self._read(spark, "claimed", _CLAIMED).select("job_id").distinct()
        return claimed.join(tried.select("job_id", state.alias("state")), "job_id", "full").select("job_id", F.coalesce("state", F.lit("claimed")).alias("state"))

    def deliver(self, payloads: DataFrame, send: Callable[[dict], None], run_id: str, tasks: int = 64, batch: int = 100, max_tries: int = MAX_TRIES) -> DataFrame:
        """Sends the payloads that were not sent yet, `batch` of them between two entries of the ledger; their outcomes, one row per job.

        Payloads that repeat a job_id go one after the other in one task. A repeated run may use its old run_id or a new one, but
        the same number of tasks where it is a repeat by Spark. Jobs that were refused are tried again. No payloads, no rows.
        """
        spark = payloads.sparkSession
        left = payloads.join(self.outcomes(spark).where("ok").select("job_id"), "job_id", "left_anti").select(*payloads.columns)
        name = f"outbox_{uuid.uuid4().hex}"
        spark.dataSource.register(_source(name, self.root.rstrip("/"), run_id, send, batch, max_tries))
        left.repartition(tasks, "job_id").write.format(name).mode("append").save()
        asked = payloads.select("job_id").distinct()
        return pin(self.outcomes(spark).join(asked, "job_id", "left_semi").select("job_id", "ok", "attempts", "error"))


def to_outbox(root: str, send: Callable[[dict], None], **options) -> Callable[[DataFrame, str], DataFrame]:
    """A way to send for `Intake`: through an outbox."""
    return lambda payloads, run_id="once": Outbox(root).deliver(payloads, send, run_id, **options)
