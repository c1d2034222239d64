"""Whole jobs: single and bulk intake, and review, over one set of job tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from postweave import schemas as S
from postweave.functions import rules as R
from postweave.functions.extract import is_remote
from postweave.functions.jsonval import text_or_null
from postweave.functions.text import or_null, stable_uuid
from postweave.operators import dedup as U
from postweave.operators import deliver as D
from postweave.operators import latency as L
from postweave.operators import metrics as M
from postweave.operators import parse as P
from postweave.operators import review as V
from postweave.operators.tables import JobTables, latest_events
from postweave.operators.validate import validate, with_outcome
from postweave.session import pin
from postweave.sources import grid as G

log = logging.getLogger(__name__)

# Notes left in the status log.
SINGLE_NOTE = "Auto-handoff"
BULK_NOTE = "Bulk auto-handoff"
REVIEWER = "system"

Parser = Callable[[DataFrame], DataFrame]


def hybrid_parser(primary: Parser, fallback: Parser = P.parse_structured) -> Parser:
    """The primary parser first, the fallback for what it left open. The primary returns pinned rows."""
    return lambda raw: P.hybrid_parse(raw, primary(raw), fallback)


def _seen(step: Observation) -> int:
    """Rows of a step that has run; a plan that turned out empty tells nothing."""
    return step.get.get("current") or 0


@dataclass(frozen=True)
class Intake:
    """What a run needs besides its rows. Every part can be replaced by another function.

    send has no default: what is marked sent has been written or accepted somewhere. With review_gate
    set, rows stay in status parsed until they are approved.
    """

    tables: JobTables
    send: V.Send
    parse: Parser = P.parse_structured
    rules: Sequence[R.Rule] = R.STANDARD
    review_gate: bool = False

    def of_run(self, rows: DataFrame, run_id: str) -> DataFrame:
        return rows.filter(F.col("run_id") == run_id)

    def process(self, raw: DataFrame, run_id: str, note: str) -> tuple[DataFrame, DataFrame | None]:
        """Saves, parses, validates, saves and delivers; the saved parsed rows and delivery outcomes.

        Each stage reads what the one before has written, so a lost executor costs a stage at most.
        Ids name the run, source and arrival: other runs have other ids, a repeated run the same. Jobs
        whose status is already sent are not sent again.
        """
        spark = raw.sparkSession
        # Events can only name ids of this run if the run was here before.
        again = self.tables.has_run(spark, "parsed_jobs", run_id)
        named = raw.withColumn("id", stable_uuid(F.lit(run_id), F.col("source"), F.col("seq").cast("string")))
        named, seen = M.progress(named, "saving")
        self.tables.save_raw(named, run_id)
        n = _seen(seen)
        self.tables.tell(spark, run_id, "saving", n, n)
        saved = self.of_run(self.tables.raw_rows(spark), run_id).drop("run_id")
        stamped = validate(self.parse(saved), self.rules).withColumns(
            {"reviewed_by": F.lit(REVIEWER), "reviewed_at": F.current_timestamp()}
        )
        stamped, seen = M.progress(stamped, "parsing", n)
        self.tables.save_parsed(stamped, run_id)
        done = _seen(seen)
        self.tables.tell(spark, run_id, "parsing", done, n)
        parsed = self.of_run(self.tables.parsed_rows(spark), run_id)
        if self.review_gate:
            return parsed, None
        left = parsed
        if again:
            ids = parsed.select(F.col("id").alias("job_id"))
            told = self.tables.status_log(spark).filter(F.col("run_id") != run_id).join(ids, "job_id", "left_semi")
            gone = pin(latest_events(told).filter("status = 'sent'").select("job_id"))
            left = parsed.join(gone, F.col("id") == F.col("job_id"), "left_anti")
        sent = self.send(D.to_payload(left), run_id)
        events, seen = M.progress(D.delivery_status(sent, note), "delivering", done)
        self.tables.log_status(events, run_id)
        self.tables.tell(spark, run_id, "delivering", _seen(seen), done)
        return parsed, sent


@dataclass(frozen=True)
class Request:
    """What a bulk run is asked for. Boards are asked by grid(); rows of boards that do not filter are filtered here."""

    queries: Sequence[str]
    locations: Sequence[str] = ("",)
    sources: Sequence[str] = tuple(r[0] for r in G.GRID_RULES)
    target: int | None = U.REQUEST_MAX
    date_posted: str | None = None
    remote_only: bool = False
    employment_types: str = ""
    category: str | None = None
    by_fingerprint: bool = True

    def grid(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The page requests of the run."""
        row = [(run_id, list(self.queries), list(self.locations), list(self.sources))]
        return G.fetch_grid(spark.createDataFrame(row, "run_id string, queries array<string>, locations array<string>, sources array<string>"))

    def wanted(self, raw: DataFrame, asof: datetime | None = None) -> DataFrame:
        """Raw rows that the request asks for. A row that does not say when, what kind or what category it is passes that test."""
        meta = F.try_parse_json(F.col("metadata"))
        said = lambda *names: F.coalesce(*(or_null(text_or_null(meta, f"$.{n}")) for n in names), F.lit(None).cast("string"))
        row = F.struct(*[F.col(c) for c in raw.columns]).alias("row")
        rows = raw.select(
            row, said("posted_at", "published_at", "pub_date").try_cast("timestamp").alias("posted_at"),
            said("employment_type", "contract_type").alias("employment_type"), said("category").alias("category"),
            is_remote(F.col("raw_text")).alias("is_remote"),
        )
        if self.date_posted and self.date_posted != "any":
            rows = G.recency_filter(rows, self.date_posted, F.lit(asof) if asof else F.current_timestamp(), unsaid=True)
        rows = G.employment_type_filter(rows, self.employment_types, unsaid=True)
        rows = G.category_filter(rows, self.category, unsaid=True)
        return G.remote_only_filter(rows, self.remote_only).select("row.*")


def results(parsed: DataFrame, sent: DataFrame | None) -> DataFrame:
    """One row per record: success, job_id, status, message, errors (its validation issues)."""
    if sent is None:
        return parsed.select(
            F.lit(True).alias("success"), F.col("id").alias("job_id"), "status", F.lit("").alias("message"),
            F.col("validation_issues").alias("errors"),
        )
    ok = F.col("ok")
    trouble = F.concat(F.lit("Parse OK, handoff failed: "), F.coalesce("error", F.lit("")))
    return parsed.select(F.col("id").alias("job_id"), "validation_issues").join(sent, "job_id").select(
        ok.alias("success"), "job_id", F.when(ok, "sent").otherwise("failed").alias("status"),
        F.when(ok, "").otherwise(trouble).alias("message"), F.col("validation_issues").alias("errors"),
    )


def ingest(intake: Intake, raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """Takes in rows as they are, without deduplication: a pasted text, or the rows of one cycle."""
    return results(*intake.process(raw, run_id or str(uuid.uuid4()), SINGLE_NOTE))


def _fetch(intake: Intake, spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], run_id: str) -> list[tuple]:
    """(rows, pinned narrow keys) of each source; the outcome of every try is logged.

    The keys of all sources are made side by side, so a source that cannot be read shows before the
    run begins and does not stop the others. Texts are not copied: they are read again where they are saved.
    """
    def one(item: tuple[int, tuple[str, Callable[[], DataFrame]]]) -> tuple:
        i, (name, read) = item
        try:
            rows = read()
            return rows, pin(U.dedup_keys(rows)), (name, datetime.now(timezone.utc), i, True, None)
        except Exception as e:  # noqa: BLE001 - whatever stops one source
            log.error("source %s failed: %s", name, e)
            return None, None, (name, datetime.now(timezone.utc), i, False, str(e)[:1000])

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(sources)))) as pool:
        tried = list(pool.map(one, enumerate(sources.items())))
    intake.tables.save_fetches(spark.createDataFrame([t[2] for t in tried], S.FETCH), run_id)
    intake.tables.tell(spark, run_id, "fetching", sum(t[0] is not None for t in tried), len(tried))
    return [t[:2] for t in tried if t[0] is not None]


def run_bulk(
    spark: SparkSession, intake: Intake, sources: Mapping[str, Callable[[], DataFrame]],
    target: int | None = None, by_fingerprint: bool = True, run_id: str | None = None, request: Request | None = None,
) -> DataFrame:
    """Fetch, dedup, drop known, save, parse, validate, deliver. One row of run statistics.

    sources: a function per source that returns its raw rows; seq must be unique over all of them. With
    a request only its sources are read, its filters apply to their rows, and its target and dedup
    settings replace the arguments.

    The run's row says running from the start. Whatever stops the run closes it as failed, with one
    error more than was counted so far.
    """
    run_id = run_id or str(uuid.uuid4())
    started = datetime.now(timezone.utc)
    if request is not None:
        target, by_fingerprint = request.target, request.by_fingerprint
        sources = {n: (lambda read=read: request.wanted(read())) for n, read in sources.items() if n in request.sources}

    def close(records: DataFrame | None, finished: datetime | None, error: str | None, latency: DataFrame | None = None) -> DataFrame:
        times = spark.createDataFrame(
            [(run_id, started, finished, error)], "run_id string, started_at timestamp, finished_at timestamp, error string"
        )
        counts = M.summarise_counts(records if records is not None else spark.createDataFrame([], _RECORD), times)
        summary = pin(L.with_latency(counts, latency))
        intake.tables.save_run(summary, run_id)
        return summary

    close(None, None, None)
    records = latency = None
    try:
        fetched = _fetch(intake, spark, sources, run_id)
        if sources and not fetched:
            raise RuntimeError("all sources failed")
        if fetched:
            raw, keys = U.union_sources(*(f for f, _ in fetched)), U.union_sources(*(k for _, k in fetched))
            kept = pin(U.take_target(U.survivors(keys, by_fingerprint), target))
            # The run's own folder is left out, so that a repeated run finds its rows new again.
            new = pin(intake.tables.known.drop_known(kept, besides=run_id))
            records = pin(_fetched(run_id, U.dedup_stats(keys, by_fingerprint, target, kept), kept, new))
            records = records.unionByName(_processed(run_id, *intake.process(U.rows_at(raw, new), run_id, BULK_NOTE)))
            latency = _latency(intake, spark, run_id)
        return close(records, datetime.now(timezone.utc), None, latency)
    except Exception as e:  # noqa: BLE001 - the run ends, its row tells why
        log.error("run %s failed: %s", run_id, e)
        one_more = spark.createDataFrame([(run_id, None, 0, 0, 0, 0, 1, 0)], _RECORD)
        return close(one_more, datetime.now(timezone.utc), str(e)[:1000])


def _latency(intake: Intake, spark: SparkSession, run_id: str) -> DataFrame | None:
    """A sketch per source of what the parser's calls took; None if the parser tells of no calls."""
    calls = intake.of_run(intake.tables.parse_calls(spark), run_id).filter(F.col("latency").isNotNull()).select("run_id", "raw_id", "latency")
    if calls.isEmpty():
        return None
    of = intake.of_run(intake.tables.raw_rows(spark), run_id).select(F.col("id").alias("raw_id"), "source")
    return L.sketches(calls.join(of, "raw_id"), "run_id", "source")


_RECORD = (
    "run_id string, source string, fetched bigint, parsed bigint, validated bigint, "
    "flagged bigint, errors bigint, duplicates bigint"
)


def _part(run_id: str, df: DataFrame, source: str | None = None, **counts) -> DataFrame:
    """Partial counts of the run; rows counted for the run only carry no source."""
    both = {c.split()[0]: F.lit(0) for c in _RECORD.split(", ")[2:]} | counts
    name = F.col(source) if source else F.lit(None).cast("string")
    return df.select(F.lit(run_id).alias("run_id"), name.alias("source"), *(c.cast("bigint").alias(n) for n, c in both.items()))


def _fetched(run_id: str, dropped: DataFrame, kept: DataFrame, new: DataFrame) -> DataFrame:
    n = F.count(F.lit(1)).alias("n")
    return U.union_sources(
        _part(run_id, dropped, "source", fetched=F.col("kept"), duplicates=F.col("dropped")),
        _part(run_id, kept.agg(n), duplicates=F.col("n")),
        _part(run_id, new.agg(n), duplicates=-F.col("n")),
    )


def _processed(run_id: str, parsed: DataFrame, sent: DataFrame | None) -> DataFrame:
    outcome = with_outcome(parsed).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    is_ = lambda o: F.when(F.col("outcome") == o, F.col("n")).otherwise(0)
    out = _part(run_id, outcome, parsed=F.col("n"), validated=is_("validated"), flagged=is_("flagged"), errors=is_("error"))
    return out if sent is None else out.unionByName(_part(run_id, D.delivery_counts(sent), errors=F.col("errors")))


def review(intake: Intake, spark: SparkSession, action: str, reviewer: str, **options) -> DataFrame:
    """Carries out a review action over the stored jobs and logs its events; the results.

    Results and events are fixed before the log changes, because both are read from it.
    """
    run_id = f"review-{uuid.uuid4()}"
    ids = options.get("ids")
    # The index tells which rows are read: those of the ids, or of the queue.
    jobs = intake.tables.jobs_of(spark, ids) if ids is not None else intake.tables.pending(spark, options.get("limit"))
    options = {"send": intake.send, "run_id": run_id, **options} if action == "approve" else options
    # The rows are fixed first: they are used again after sending, when the log may have grown.
    done = V.bulk_action(action, pin(jobs), reviewer, **options)
    answer, events = pin(done.results), pin(done.events)
    intake.tables.log_status(events, run_id)
    return answer
