"""Every operator as a query over the given tables: name → function of (spark, sf_dir)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postweave.catalog import inputs as I
from postweave.catalog import payloads as L
from postweave.functions import extract as X
from postweave.functions import rules as R
from postweave.functions.names import names_in
from postweave.operators import breaker as B
from postweave.operators import dedup as U
from postweave.operators import deliver as D
from postweave.operators import latency as Q
from postweave.operators import metrics as M
from postweave.operators import model as N
from postweave.operators import outbox as O
from postweave.operators import parse as P
from postweave.operators import review as V
from postweave.operators import tables as T
from postweave.operators import validate as W
from postweave.plans import intake as J
from postweave.session import pin, shared_dir
from postweave.sources import grid as G
from postweave.sources import html as H
from postweave.sources import landed as S
from postweave.streaming import cycle as C
from postweave.streaming import landing as Z
from postweave.streaming import windows as Y

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TARGET = 200
THRESHOLD = 0.6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(c: str | Column) -> Column:
    return F.array_join(c, "|")


def _flat(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "raw_id", "job_title", "company", "location", "remote", F.col("salary.min").alias("salary_min"),
        F.col("salary.max").alias("salary_max"), F.col("salary.currency").alias("salary_currency"),
        _joined("required_skills").alias("skills"), "employment_type", "description_clean",
        "confidence", "model_used", _joined("parse_warnings").alias("warnings"),
    )


def _flat_raw(raw: DataFrame) -> DataFrame:
    return raw.select("seq", "source", "external_id", "raw_text", "source_url")


def _new_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/postweave-{uuid.uuid4()}"


# ── extraction ──────────────────────────────────────────────────────────────────────────────────

def _of_text(name: str, *columns: Callable[[Column], Column], alias: tuple[str, ...] = ()) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = F.col("raw_text")
        return I.postings(spark, sf_dir).select("id", *(c(text).alias(a) for c, a in zip(columns, alias)))

    QUERIES[name] = run


_of_text("extract_title", X.title, alias=("title",))
_of_text("extract_company", X.company, alias=("company",))
_of_text("extract_location", X.location, alias=("location",))
_of_text("extract_skills", lambda t: _joined(X.skills(t)), alias=("skills",))
_of_text("extract_names_one_pass", lambda t: _joined(names_in(t, X.SKILLS)), alias=("skills",))
_of_text("extract_employment_type", X.employment_type, alias=("employment_type",))
_of_text("is_remote", X.is_remote, alias=("remote",))
_of_text("clean_description_of_postings", X.description, alias=("description",))
_of_text("fingerprint_of_postings", X.fingerprint, alias=("fp",))


@query
def extract_salary(spark, sf_dir):
    found = I.postings(spark, sf_dir).select("id", X.salary(F.col("raw_text")).alias("s"))
    return found.select("id", F.col("s.min").alias("salary_min"), F.col("s.max").alias("salary_max"),
                        F.col("s.currency").alias("currency"), F.col("s.period").alias("period"))


@query
def extract_from_documents(spark, sf_dir):
    """All text fields over whole documents."""
    t = F.col("text")
    found = I.table(spark, sf_dir, "documents").select(
        "doc_id", X.title(t).alias("title"), X.company(t).alias("company"), X.location(t).alias("location"),
        X.salary(t).alias("s"), _joined(X.skills(t)).alias("skills"), X.employment_type(t).alias("employment_type"),
        X.is_remote(t).alias("remote"),
    )
    return found.select("doc_id", "title", "company", "location", F.col("s.min").alias("salary_min"),
                        F.col("s.max").alias("salary_max"), "skills", "employment_type", "remote")


@query
def extract_whole_word_skills(spark, sf_dir):
    found = X.skills(F.col("raw_text"), whole_words=True)
    return I.postings(spark, sf_dir).select("id", _joined(found).alias("skills"))


@query
def clean_description(spark, sf_dir):
    d = X.description(F.col("text"))
    return I.table(spark, sf_dir, "documents").select("doc_id", d.alias("description"))


@query
def clean_description_uncut(spark, sf_dir):
    d = X.description(F.col("text"), lines=None, chars=None)
    return I.table(spark, sf_dir, "documents").select("doc_id", d.alias("description"))


@query
def fingerprint(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", X.fingerprint(F.col("text")).alias("fp"))


@query
def parse_generic(spark, sf_dir):
    return _flat(P.parse_generic(I.postings(spark, sf_dir)))


@query
def parse_workable(spark, sf_dir):
    return _flat(P.parse_workable(I.postings(spark, sf_dir)))


@query
def parse_structured(spark, sf_dir):
    return _flat(P.parse_structured(I.postings(spark, sf_dir)))


@query
def build_prompt(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw_text"))
    return P.build_prompt(docs).select("doc_id", F.length("prompt").alias("chars"), F.md5("prompt").alias("digest"))


@query
def build_prompt_uncut(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw_text"))
    return P.build_prompt(docs, chars=None).select("doc_id", F.length("prompt").alias("chars"), F.md5("prompt").alias("digest"))


@query
def decode_model_json(spark, sf_dir):
    parsed = P.decode_model_json(L.answers(spark, sf_dir))
    return parsed.select(
        "raw_id", "job_title", "company", "location", "remote", F.col("salary.min").alias("salary_min"),
        F.col("salary.max").alias("salary_max"), F.col("salary.currency").alias("salary_currency"),
        F.col("salary.period").alias("salary_period"), _joined("required_skills").alias("skills"),
        "years_experience", "confidence", F.size("parse_warnings").alias("warnings"),
    )


def _stub_model(prompt: str) -> str:
    n = len(prompt)
    if n % 7 == 0:
        raise RuntimeError("no capacity")
    return '{"job_title": ' if n % 5 == 0 else json.dumps({"job_title": f"Role {n}", "confidence": 0.9})


def _stub_fallback(prompt: str) -> str:
    if len(prompt) % 2:
        raise RuntimeError("no capacity")
    return json.dumps({"job_title": f"Second {len(prompt)}", "confidence": 0.8})


def _by_model(spark, sf_dir) -> DataFrame:
    return N.extract_with_model(
        I.postings(spark, sf_dir), _stub_model, "first", fallback=_stub_fallback, fallback_name="second"
    )


@query
def extract_with_model(spark, sf_dir):
    return _by_model(spark, sf_dir).select("raw_id", "job_title", "confidence", "model_used", "failed_attempts", "used_fallback")


@query
def extract_with_model_once(spark, sf_dir):
    """Equal postings cost one call, and the second run takes the first one's answers."""
    answers = N.Answers(_new_dir(spark))
    for _ in range(2):
        got = N.extract_with_model(
            I.postings(spark, sf_dir), _stub_model, "first", fallback=_stub_fallback, fallback_name="second", chars=None, answers=answers, in_flight=4
        )
    return got.select("raw_id", "job_title", "confidence", "model_used", "used_fallback")


@query
def parse_generic_uncut(spark, sf_dir):
    """Whole descriptions of whole texts."""
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("manual").alias("source"), F.col("text").alias("raw_text"))
    return P.parse_generic(docs, limits=P.UNCUT).select(F.col("raw_id").cast("bigint").alias("doc_id"), F.col("description_clean").alias("description"))


@query
def parse_stats(spark, sf_dir):
    return P.parse_stats(_by_model(spark, sf_dir))


@query
def parse_failure_row(spark, sf_dir):
    failed = I.table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        F.col("event_id").cast("string").alias("raw_id"), F.lit("stub").alias("model_used"), F.col("props").alias("error")
    )
    return P.failure_rows(failed).select("raw_id", "job_title", "confidence", "model_used", _joined("parse_warnings").alias("warnings"))


@query
def hybrid_overlay(spark, sf_dir):
    primary = P.decode_model_json(L.answers(spark, sf_dir))
    both = P.hybrid_overlay(primary, P.parse_structured(I.postings(spark, sf_dir)))
    return both.select("raw_id", "job_title", "model_used", "confidence", _joined("parse_warnings").alias("warnings"))


@query
def hybrid_parse(spark, sf_dir):
    raw, primary = I.postings(spark, sf_dir), pin(P.decode_model_json(L.answers(spark, sf_dir)))
    both = J.hybrid_parser(lambda _: primary)(raw)
    return both.select("raw_id", "job_title", "model_used", "confidence", _joined("parse_warnings").alias("warnings"))


# ── validation ──────────────────────────────────────────────────────────────────────────────────

def _rule(name: str, rule: R.Rule) -> None:
    QUERIES[name] = lambda spark, sf_dir: I.jobs(spark, sf_dir).select("id", rule().alias("issue"))


_rule("rule_title", R.title_present)
_rule("rule_skills", R.skills_present)
_rule("rule_confidence", R.confidence_high_enough)
_rule("rule_salary", R.salary_sane)
_rule("rule_parse_failed", R.parse_succeeded)
_rule("rule_company", R.company_present)
_rule("rule_location", R.location_or_remote)
_rule("rule_employment_type", R.employment_type_present)


@query
def validate_standard(spark, sf_dir):
    return W.validate(I.jobs(spark, sf_dir)).select("id", _joined("validation_issues").alias("issues"), "is_valid")


@query
def validate_strict(spark, sf_dir):
    return W.validate(I.jobs(spark, sf_dir), R.STRICT).select("id", _joined("validation_issues").alias("issues"), "is_valid")


@query
def validation_outcome(spark, sf_dir):
    checked = W.validate(I.jobs(spark, sf_dir))
    return W.outcome_counts(checked, "employment_type").withColumn("avg_confidence", F.round("avg_confidence", 6))


@query
def outcome_per_source(spark, sf_dir):
    """Extraction, validation and outcome counts per source."""
    checked = W.validate(P.parse_generic(I.postings(spark, sf_dir), carry=("source",)))
    return W.outcome_counts(checked, "source").withColumn("avg_confidence", F.round("avg_confidence", 6))


# ── union, deduplication, limits ────────────────────────────────────────────────────────────────

@query
def union_sources(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.lit("manual").alias("source"), F.col("text").alias("raw_text"))
    raw = I.postings(spark, sf_dir).select("seq", "source", "external_id", "raw_text")
    return U.union_sources(raw, docs).select("seq", "source", "external_id", F.length("raw_text").alias("chars"))


@query
def dedup_within_fetch(spark, sf_dir):
    raw = I.postings(spark, sf_dir).withColumn("unit", F.concat_ws("|", "source", F.col("seq") % 3))
    return U.dedup_within_fetch(raw).select("seq", "unit", "external_id")


@query
def dedup_external_id(spark, sf_dir):
    return U.dedup_external_id(I.postings(spark, sf_dir)).select("seq", "source", "external_id")


def _document_keys(spark, sf_dir) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("seq"), "source", F.lit(None).cast("string").alias("external_id"),
                       X.fingerprint(F.col("text")).alias("fp"))


@query
def dedup_fingerprint(spark, sf_dir):
    return U.first_by_fingerprint(_document_keys(spark, sf_dir)).select("seq", "source", "fp")


@query
def dedup_postings(spark, sf_dir):
    return _flat_raw(U.dedup(I.postings(spark, sf_dir)))


@query
def take_target(spark, sf_dir):
    return _flat_raw(U.dedup(I.postings(spark, sf_dir), target=TARGET))


@query
def dedup_stats(spark, sf_dir):
    return U.dedup_stats(_document_keys(spark, sf_dir))


@query
def dedup_stats_until_target(spark, sf_dir):
    return U.dedup_stats(U.dedup_keys(I.postings(spark, sf_dir)), target=U.REQUEST_MAX)


@query
def dedup_totals(spark, sf_dir):
    return U.dedup_totals(U.dedup_stats(U.dedup_keys(I.postings(spark, sf_dir)), target=U.REQUEST_MAX), U.REQUEST_MAX)


def _stored(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("mark") == "F")


@query
def drop_known(spark, sf_dir):
    raw = I.postings(spark, sf_dir)
    return U.drop_known(raw.filter(F.col("mark") != "F"), _stored(raw), spread=4).select("seq", "external_id")


@query
def drop_known_by_filter(spark, sf_dir):
    """As drop_known, against a store whose ids lie behind Bloom filters: two runs in a level, a third one not yet."""
    raw = I.postings(spark, sf_dir)
    tables = T.JobTables(f"{_new_dir(spark)}/store")
    done = raw.filter("mark = 'F'").drop("mark")
    for n in range(3):
        tables.save_raw(done.filter(F.col("seq") % 3 == n), f"run-{n}")
        if n == 1:
            tables.known.absorb(spark)
    return tables.known.drop_known(raw.filter("mark <> 'F'"), spread=4).select("seq", "external_id")


@query
def exists_by_external_id(spark, sf_dir):
    raw = I.postings(spark, sf_dir)
    return U.exists_by_external_id(_stored(raw), raw.filter(F.col("external_id").isNotNull()))


# ── sources ─────────────────────────────────────────────────────────────────────────────────────

def _source(name: str, read: Callable[[DataFrame], DataFrame], pages: Query) -> None:
    QUERIES[name] = lambda spark, sf_dir: read(pages(spark, sf_dir)).select(
        "seq", "id", "source", "external_id", "raw_text", "source_url", "metadata"
    )


_source("raw_from_jsearch", S.raw_from_jsearch, L.jsearch_pages)
_source("raw_from_adzuna", S.raw_from_adzuna, L.adzuna_pages)
_source("raw_from_workable", S.raw_from_workable, L.workable_pages)
_source("raw_from_rss", S.raw_from_rss, L.rss_feeds)


@query
def streaming_landed(spark, sf_dir):
    """Payload folders of two sources as one stream into a table."""
    root = _new_dir(spark)
    landed = {"workable": f"{root}/workable", "indeed_rss": f"{root}/feeds"}
    for pages, folder in ((L.workable_pages, landed["workable"]), (L.rss_feeds, landed["indeed_rss"])):
        pages(spark, sf_dir).write.json(folder)
    rows = Z.raw_of_folders(spark, landed, files_per_batch=4)
    rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start(f"{root}/raw").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/raw").select("source", "external_id", "raw_text", "source_url")


@query
def unreadable_feeds(spark, sf_dir):
    """Feeds that could not be read, with the number of postings that are lost with each."""
    lost = S.unreadable_pages(L.rss_feeds(spark, sf_dir), feed=True)
    rows = I.view(spark, sf_dir, I.POSTINGS).groupBy(F.floor(F.col("seq") / L.PAGE_SIZE).alias("page_seq")).agg(F.count(F.lit(1)).alias("postings"))
    return lost.join(rows, "page_seq").select("page_seq", "unit", "postings")


def _links(name: str) -> None:
    QUERIES[f"html_job_links_{name}"] = lambda spark, sf_dir: H.html_job_links(
        L.search_pages(spark, sf_dir), H.BOARDS[name]
    ).select("seq", "unit", "title", "url")


def _details(name: str) -> None:
    QUERIES[f"html_detail_text_{name}"] = lambda spark, sf_dir: H.html_detail_text(
        L.detail_pages(spark, sf_dir), H.BOARDS[name]
    )


for _board in H.BOARDS:
    _links(_board)
    _details(_board)


@query
def raw_from_html(spark, sf_dir):
    """Links whose targets are the given pages themselves: page n links to every page of its unit."""
    board = H.BOARDS["jobgurus"]
    links = I.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"), F.concat(F.lit("unit"), F.col("page_id") % 7).alias("unit"),
        F.lit("engineer").alias("query"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.concat(F.lit("Job "), F.col("page_id")).alias("title"), "url",
    )
    return H.raw_from_html(links, H.html_detail_text(L.detail_pages(spark, sf_dir), board), board).select(
        "seq", "unit", "external_id", "metadata", "raw_text")


@query
def raw_manual(spark, sf_dir):
    texts = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("raw_text"))
    return S.raw_manual(texts).select("seq", "source", "external_id", "metadata", S.healthy_text(F.col("raw_text")).alias("healthy"),
                                      F.length("raw_text").alias("chars"))


@query
def fetch_grid(spark, sf_dir):
    """One run per region: its market segments as queries, its nations as locations."""
    n, c = I.table(spark, sf_dir, "nation"), I.table(spark, sf_dir, "customer")
    requests = c.join(n, c.c_nationkey == n.n_nationkey).groupBy(F.col("n_regionkey").cast("string").alias("run_id")).agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("queries"), F.array_sort(F.collect_set("n_name")).alias("locations"),
    ).withColumn("sources", F.array(*(F.lit(r[0]) for r in G.GRID_RULES)))
    return G.fetch_grid(requests)


@query
def country_code(spark, sf_dir):
    place = F.element_at(F.array(*(F.lit(p) for p in COUNTRY_WORDS)), (F.col("c_custkey") % len(COUNTRY_WORDS) + 1).cast("int"))
    named = I.table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(" ", "c_mktsegment", place).alias("location"))
    return named.select("c_custkey", "location", G.country_code(F.col("location")).alias("country"))


COUNTRY_WORDS = ("", "United Kingdom", "Canada", "Australia", "Germany", "Chicago", "Ukraine", "Austin", "Denver", "Oslo")
ASOF = "2000-01-01 00:00:00"


def _recency(window: str) -> None:
    def run(spark, sf_dir):
        rows = I.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("posted_at"))
        return G.recency_filter(rows, window, F.lit(ASOF).cast("timestamp")).select("o_orderkey")

    QUERIES[f"recency_filter_{window}"] = run


for _window in ("today", "3days", "week", "month", "any"):
    _recency(_window)


@query
def remote_only_filter(spark, sf_dir):
    return G.remote_only_filter(I.jobs(spark, sf_dir), flag="remote").select("id")


@query
def employment_type_filter(spark, sf_dir):
    return G.employment_type_filter(I.table(spark, sf_dir, "orders"), "1-URGENT, 5-LOW", "o_orderpriority").select("o_orderkey")


@query
def category_filter(spark, sf_dir):
    return G.category_filter(I.table(spark, sf_dir, "customer"), "BUILDING", "c_mktsegment").select("c_custkey")


# ── tables ──────────────────────────────────────────────────────────────────────────────────────

def _job_row(jobs: DataFrame) -> DataFrame:
    return jobs.select("id", "raw_id", "status", "job_title", "confidence", "reviewer_notes")


@query
def save_raw(spark, sf_dir):
    store = T.JobTables(_new_dir(spark))
    raw = I.postings(spark, sf_dir)
    store.save_raw(raw.filter(F.col("mark") == "F").withColumn("raw_text", F.lit("an earlier text")), "run-9")
    store.save_raw(raw, "run-10")
    return _flat_raw(store.raw(spark))


@query
def save_parsed(spark, sf_dir):
    store = T.JobTables(_new_dir(spark))
    store.save_parsed(I.jobs(spark, sf_dir), "run-1")
    return _job_row(store.parsed(spark))


def _current(spark, sf_dir) -> DataFrame:
    return T.current_jobs(I.jobs(spark, sf_dir), I.status_log(spark, sf_dir))


@query
def update_status(spark, sf_dir):
    ids = I.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    events = T.update_status(I.jobs(spark, sf_dir), ids, "rejected", "by list", event_seq=1)
    return _job_row(T.current_jobs(I.jobs(spark, sf_dir), events))


@query
def current_jobs(spark, sf_dir):
    return _job_row(_current(spark, sf_dir))


@query
def pending_jobs(spark, sf_dir):
    return _job_row(T.pending(_current(spark, sf_dir)))


@query
def get_by_id(spark, sf_dir):
    return _job_row(T.get_by_id(_current(spark, sf_dir), "7"))


@query
def get_all(spark, sf_dir):
    return _job_row(T.get_all(I.jobs(spark, sf_dir)))


@query
def store_stats(spark, sf_dir):
    return T.stats(I.postings(spark, sf_dir), _current(spark, sf_dir))


def _written(df: DataFrame) -> DataFrame:
    path = _new_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _indexed(spark, sf_dir) -> T.JobTables:
    """The jobs as twelve runs and their events as three; most of them are in levels of the index, the last ones are its tail."""
    store = T.JobTables(_new_dir(spark))
    jobs, log = _written(I.jobs(spark, sf_dir)), _written(I.status_log(spark, sf_dir))
    for i in range(12):
        store.save_parsed(jobs.filter(F.pmod(F.xxhash64("id"), F.lit(12)) == i), f"run-{i}")
        if i in (3, 6, 9):
            store.log_status(log.filter(F.pmod("event_seq", F.lit(3)) == i // 3 - 1), f"events-{i}")
        if i in (4, 5, 8):
            store.index.compact(spark, ratio=2, file_rows=1_000)
    return store


@query
def job_from_index(spark, sf_dir):
    return _job_row(_indexed(spark, sf_dir).job(spark, "7"))


@query
def jobs_from_index(spark, sf_dir):
    ids = I.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    return _job_row(_indexed(spark, sf_dir).jobs_of(spark, ids))


@query
def pending_from_index(spark, sf_dir):
    return _job_row(_indexed(spark, sf_dir).pending(spark))


@query
def status_from_index(spark, sf_dir):
    store = _indexed(spark, sf_dir)
    return _job_row(T.current_jobs(store.parsed(spark), store.last_events(spark)))


@query
def with_source(spark, sf_dir):
    raw = I.postings(spark, sf_dir).withColumn("id", F.concat(F.lit("r"), "id"))
    return T.with_source(_current(spark, sf_dir), raw).select("id", "raw_id", "source", "status")


# ── review and delivery ─────────────────────────────────────────────────────────────────────────

def _asked(spark, sf_dir) -> DataFrame:
    """Labelled documents name the jobs asked for; some of these do not exist, some are named twice."""
    labels = I.table(spark, sf_dir, "labels")
    one = labels.select(F.concat(F.when(F.col("doc_id") % 10 == 0, "none").otherwise(""), "doc_id").alias("job_id"))
    return one.unionByName(labels.filter(F.col("quality") == 1).select(F.col("doc_id").cast("string").alias("job_id")))


def _refusing(body: dict) -> None:
    n = int(body["job_id"])
    if n % 5 == 0:
        raise D.SendError("refused", 400)
    if n % 5 == 1:
        raise D.SendError("down", 503)


@query
def approve(spark, sf_dir):
    return V.approve(_asked(spark, sf_dir), I.jobs(spark, sf_dir), "ann", "fine", send=D.to_sender(_refusing)).results


@query
def approve_events(spark, sf_dir):
    events = V.approve(_asked(spark, sf_dir), I.jobs(spark, sf_dir), "ann", "fine", send=D.to_sender(_refusing)).events
    return events.select("job_id", "status", "reviewer_notes")


@query
def reject(spark, sf_dir):
    return V.reject(_asked(spark, sf_dir), I.jobs(spark, sf_dir), "ann", "spam").results


@query
def approve_batch(spark, sf_dir):
    asked = _asked(spark, sf_dir)
    done = V.approve_batch(asked, I.jobs(spark, sf_dir), "ann", send=D.to_files(_new_dir(spark)))
    return V.for_each_request(asked, done.results)


@query
def bulk_action(spark, sf_dir):
    jobs = W.validate(I.jobs(spark, sf_dir)).drop("is_valid")
    return V.bulk_action("reject", jobs, "ann", "old", confidence_min=THRESHOLD, exclude_flagged=True, limit=V.QUEUE).results


@query
def bulk_action_all(spark, sf_dir):
    """The whole queue, whatever its length."""
    jobs = W.validate(I.jobs(spark, sf_dir)).drop("is_valid")
    return V.bulk_action("reject", jobs, "ann", "old", confidence_min=THRESHOLD, exclude_flagged=True).results


@query
def auto_approve(spark, sf_dir):
    return V.auto_approvable(W.validate(I.jobs(spark, sf_dir)), THRESHOLD).select("id")


def _payload(df: DataFrame) -> DataFrame:
    return df.select("job_id", "job_title", "company", "location", "remote", "salary_min", "salary_max", "salary_currency",
                     _joined("required_skills").alias("skills"), "employment_type", "description")


@query
def to_payload(spark, sf_dir):
    return _payload(D.to_payload(I.jobs(spark, sf_dir)))


@query
def write_jsonl(spark, sf_dir):
    payloads, path = D.to_payload(I.jobs(spark, sf_dir)), _new_dir(spark)
    D.write_jsonl(payloads, path)
    return _payload(spark.read.schema(payloads.schema).json(path))


@query
def deliver(spark, sf_dir):
    return D.to_sender(_refusing)(D.to_payload(I.jobs(spark, sf_dir)))


@query
def deliver_through_outbox(spark, sf_dir):
    """As deliver; what was sent is staged as it is sent, and a second delivery only tries those again that were refused."""
    jobs, box = D.to_payload(I.jobs(spark, sf_dir)), O.Outbox(f"{_new_dir(spark)}/outbox")
    box.deliver(jobs, _refusing, "run-1", tasks=8, batch=1_000)
    return box.deliver(jobs, _refusing, "run-2", tasks=8, batch=1_000)


@query
def delivery_status(spark, sf_dir):
    sent = D.to_sender(_refusing)(D.to_payload(I.jobs(spark, sf_dir)))
    return D.delivery_status(sent).select("job_id", "status", "reviewer_notes")


# ── run statistics ──────────────────────────────────────────────────────────────────────────────

def _runs(spark, sf_dir) -> DataFrame:
    span = I.records(spark, sf_dir).groupBy("run_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    return span.select("run_id", "started_at", F.when(F.col("n") % 9 != 0, F.col("last")).alias("finished_at"),
                       F.when(F.col("n") % 5 == 0, "stopped").alias("error"))


def _summaries(spark, sf_dir) -> DataFrame:
    return M.run_summary(I.records(spark, sf_dir), _runs(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    per_source = F.transform(F.array_sort(F.map_entries("per_source")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _summaries(spark, sf_dir).select(
        "run_id", *M.COUNTS, _joined(per_source).alias("per_source"), "duration_seconds", "jobs_per_second")


@query
def latency_percentiles(spark, sf_dir):
    return M.latency_percentiles(I.records(spark, sf_dir))


def _run_rows(spark, sf_dir) -> DataFrame:
    """Run rows with their latency sketches, as they are stored."""
    return _written(Q.with_latency(_summaries(spark, sf_dir), Q.sketches(I.records(spark, sf_dir), "run_id", "source")))


@query
def run_latency(spark, sf_dir):
    """Percentiles as they stand in the run rows: those of up to 200 latencies are exact."""
    return _run_rows(spark, sf_dir).select("run_id", *(f"p{p}" for p in M.PERCENTILES))


@query
def lifetime_latency(spark, sf_dir):
    """Percentiles over all runs from the run rows, and whether their rank in all latencies is within the bound of the sketch."""
    found = Q.lifetime_latency(_run_rows(spark, sf_dir)).first()
    n = F.count("latency")

    def close(p: int) -> Column:
        value, slack = F.lit(found[f"p{p}"]), Q.RANK_ERROR + 1 / n
        under, upto = F.count_if(F.round("latency", 4) < value), F.count_if(F.round("latency", 4) <= value)
        return ((under / n <= p / 100 + slack) & (upto / n >= p / 100 - slack)).alias(f"p{p}_close")

    return I.records(spark, sf_dir).agg(n.alias("seen"), F.lit(found["latencies"]).alias("latencies"), *(close(p) for p in M.PERCENTILES))


@query
def latency_by_window(spark, sf_dir):
    """Runs and latencies per day in which runs ended; percentiles rise."""
    found = Q.latency_by_window(_run_rows(spark, sf_dir), "1 day")
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "runs", "latencies", ((F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99"))).alias("rising"))


@query
def lifetime_totals(spark, sf_dir):
    return M.lifetime_totals(_summaries(spark, sf_dir))


@query
def source_totals(spark, sf_dir):
    return M.source_totals(I.records(spark, sf_dir))


@query
def source_errors(spark, sf_dir):
    return M.source_errors(I.records(spark, sf_dir))


@query
def recent_runs(spark, sf_dir):
    return M.recent_runs(_summaries(spark, sf_dir)).select("run_id", *M.COUNTS)


@query
def run_status(spark, sf_dir):
    return M.run_status(_runs(spark, sf_dir)).select("run_id", "state")


@query
def cycle_stats(spark, sf_dir):
    done = F.coalesce("delivered", F.lit(False))
    rows = I.records(spark, sf_dir).select("source", done.alias("success"), F.when(done, "sent").otherwise("failed").alias("status"))
    return M.cycle_stats(rows, "source")


def _instant(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query
def fetch_windows(spark, sf_dir):
    """Tries and failures of every source by the hour."""
    rows = Y.fetch_windows(I.records(spark, sf_dir), "1 hour")
    return rows.select("source", _instant("window_start"), _instant("window_end"), *Y.COUNTS)


@query
def failure_sessions(spark, sf_dir):
    """Outages: failures of a source that are no more than two hours apart."""
    rows = Y.failure_sessions(I.records(spark, sf_dir), "2 hours")
    return rows.select("source", _instant("session_start"), F.unix_micros("session_end").alias("end_us"), "failures")


@query
def streaming_fetch_windows(spark, sf_dir):
    """The hourly windows of a stream of tries that land in three parts, as they stand in the end."""
    root = _new_dir(spark)
    rows = I.records(spark, sf_dir).select("source", "ts", "ok", "seq")
    for n in range(3):
        rows.filter(F.col("seq") % 3 == n).write.parquet(f"{root}/landed/part={n}")
    stream = spark.readStream.schema("source string, ts timestamp, ok boolean").parquet(f"{root}/landed/part=*")
    windows = Y.fetch_windows(stream.select("source", "ts", "ok"), "1 hour", late="5000 days")
    Y.keep_windows(windows, f"{root}/windows", f"{root}/progress").awaitTermination()
    last = Y.windows_of(spark.read.parquet(f"{root}/windows"), "source", "window_start", "window_end")
    return last.select("source", _instant("window_start"), *Y.COUNTS)


@query
def progress(spark, sf_dir):
    """Counts seen while the validation step runs, as a table."""
    df, seen = M.progress(W.validate(I.jobs(spark, sf_dir)), "validating")
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["step"], seen.get["current"])], "step string, current bigint")


def _attempts(spark, sf_dir) -> DataFrame:
    return I.records(spark, sf_dir).select(F.col("source_id").alias("source"), "ts", "seq", "ok")


@query
def failure_streaks(spark, sf_dir):
    return M.failure_streaks(_attempts(spark, sf_dir)).select("source", "seq", "streak")


@query
def breaker_timeline(spark, sf_dir):
    return B.breaker_timeline(_attempts(spark, sf_dir), cooldown=86_400.0).select("source", "seq", "ok", "state", "skipped", "consecutive")


@query
def breaker_stats(spark, sf_dir):
    asof = F.lit("2024-02-15 00:00:00").cast("timestamp")
    return M.breaker_stats(_attempts(spark, sf_dir), asof, threshold=2, cooldown=30 * 86_400.0)


# ── whole jobs ──────────────────────────────────────────────────────────────────────────────────

def _intake(spark, root: str, **options) -> J.Intake:
    """A store whose payloads go to files beside it."""
    return J.Intake(T.JobTables(f"{root}/store"), D.to_files(f"{root}/delivered"), **options)


def _delivered(spark, root: str) -> DataFrame:
    """Payloads as they stand in the files, of all runs."""
    return spark.read.schema("job_id string, job_title string, run_id string").json(f"{root}/delivered")


@query
def ingest_manual(spark, sf_dir):
    """Counts of the results, and how many of their payloads stand in the delivered files."""
    texts = I.spread_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("raw_text"))
    root = _new_dir(spark)
    done = J.ingest(_intake(spark, root), S.raw_manual(texts), "run-1")
    both = done.join(_delivered(spark, root).select("job_id", F.lit(1).alias("written")), "job_id", "left")
    return both.groupBy("success", "status", F.size("errors").alias("issues")).agg(F.count(F.lit(1)).alias("jobs"), F.count("written").alias("written"))


@query
def ingest_two_runs(spark, sf_dir):
    """Two runs whose rows are numbered alike: every row has an id of its own, and a rejection in one run stays in it."""
    docs = I.spread_table(spark, sf_dir, "documents")
    root = _new_dir(spark)
    store = _intake(spark, root)
    for run, text in (("run-9", F.col("text")), ("run-10", F.concat(F.lit("Title: Second\n"), "text"))):
        J.ingest(store, S.raw_manual(docs.select(F.col("doc_id").alias("seq"), text.alias("raw_text"))), run)
    jobs = store.tables.parsed(spark)
    second = jobs.filter(F.col("run_id") == "run-10").select(F.col("id").alias("job_id"))
    store.tables.log_status(T.update_status(jobs, second, "rejected", "again", event_seq=3), "by-hand")
    now = T.current_jobs(store.tables.parsed(spark), store.tables.status_log(spark))
    return now.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("jobs"), F.count_distinct("id").alias("ids"))


def _by_source(spark, sf_dir) -> dict[str, Callable[[], DataFrame]]:
    raw = I.postings(spark, sf_dir)
    feeds = {s: (lambda s=s: raw.filter(F.col("source") == s)) for s in ("workable", "jsearch_api", "adzuna_api", "indeed_rss", "manual")}
    return feeds | {"broken": lambda: spark.read.parquet(f"{sf_dir}/no-such-table.parquet")}


@query
def bulk_ingest(spark, sf_dir):
    """A store that already knows some ids takes in the rest; one of the sources fails."""
    store = _intake(spark, _new_dir(spark))
    store.tables.save_raw(_stored(I.postings(spark, sf_dir)), "run-0")
    done = J.run_bulk(spark, store, _by_source(spark, sf_dir), run_id="run-1")
    per_source = F.transform(F.array_sort(F.map_entries("per_source")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return done.select(*M.COUNTS, _joined(per_source).alias("per_source"))


def _stream_of_parts(spark, sf_dir, **options) -> DataFrame:
    """Raw rows kept of postings that land in three parts. A part is a micro-batch, whatever the number of its files: the stream is
    run when it has landed, and goes on behind it when the next one has."""
    root = _new_dir(spark)
    store, raw = _intake(spark, root), I.postings(spark, sf_dir).drop("mark")
    top = raw.agg(F.max("seq")).scalar()
    for i in range(3):
        part = raw.filter((F.col("seq") * 3 > top * i) if i else F.lit(True)).filter(F.col("seq") * 3 <= top * (i + 1))
        part.write.mode("append").parquet(f"{root}/landed/part={i}")
        rows = spark.readStream.schema(raw.schema).parquet(f"{root}/landed/part=*")
        C.run_cycle(store, rows, f"{root}/progress", **options).awaitTermination()
    return store.tables.raw(spark)


@query
def streaming_ingest(spark, sf_dir):
    """Postings land in three parts; the stream keeps the rows that one batch over all would keep."""
    return _flat_raw(_stream_of_parts(spark, sf_dir))


@query
def streaming_ingest_in_state(spark, sf_dir):
    """The same stream with its keys in Spark's state: rows kept per external id."""
    kept = _stream_of_parts(spark, sf_dir, by_fingerprint=False, within="5000 days")
    return kept.groupBy("external_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def review_queue(spark, sf_dir):
    """Approves the sound part of the queue of a gated run, then counts the jobs by status."""
    root = _new_dir(spark)
    store = _intake(spark, root, review_gate=True)
    J.ingest(store, I.postings(spark, sf_dir), "run-1")
    J.review(store, spark, "approve", "ann", confidence_min=0.5, exclude_flagged=True)
    jobs = T.current_jobs(store.tables.parsed(spark), store.tables.status_log(spark))
    written = _delivered(spark, root).select(F.col("job_id").alias("id"), F.lit(1).alias("written"))
    return jobs.join(written, "id", "left").groupBy("status").agg(F.count(F.lit(1)).alias("jobs"), F.count("written").alias("written"))
