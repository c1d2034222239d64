"""Record shapes and value domains shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Status and source domains, and marker titles.
STATUSES = ("raw", "parsed", "approved", "rejected", "sent", "failed")
SOURCES = (
    "manual", "jsearch_api", "indeed_rss", "adzuna_api",
    "workable", "myjobmag", "fuzu", "jobgurus", "jobberman",
)
UNKNOWN_TITLE = "[UNKNOWN]"
FAILED_TITLE = "[PARSE FAILED]"
RULE_PARSER = "structured_parser"
DEFAULT_CURRENCY = "USD"
DEFAULT_PERIOD = "yearly"

RAW = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("external_id", T.StringType()),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("source_url", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("metadata", T.StringType()),
])

SALARY = T.StructType([
    T.StructField("min", T.IntegerType()),
    T.StructField("max", T.IntegerType()),
    T.StructField("currency", T.StringType()),
    T.StructField("period", T.StringType()),
])

_STRINGS = T.ArrayType(T.StringType())

PARSED = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("raw_id", T.StringType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("remote", T.BooleanType()),
    T.StructField("salary", SALARY),
    T.StructField("required_skills", _STRINGS),
    T.StructField("preferred_skills", _STRINGS),
    T.StructField("years_experience", T.IntegerType()),
    T.StructField("education_level", T.StringType()),
    T.StructField("employment_type", T.StringType()),
    T.StructField("description_clean", T.StringType()),
    T.StructField("parsed_at", T.TimestampType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("parse_warnings", _STRINGS),
    T.StructField("validation_issues", _STRINGS),
    T.StructField("reviewer_notes", T.StringType()),
    T.StructField("reviewed_at", T.TimestampType()),
    T.StructField("reviewed_by", T.StringType()),
])

STATUS_EVENT = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("reviewer_notes", T.StringType()),
    T.StructField("reviewed_at", T.TimestampType()),
    T.StructField("event_seq", T.LongType(), False),
])

# An id or a fingerprint (kind id or fp) that a stream has taken in.
SEEN_KEY = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("value", T.StringType()),
])

# State of one source's breaker: microseconds of the failure that opened it (-1: closed), failures in a row.
BREAKER = T.StructType([T.StructField("opened", T.LongType()), T.StructField("failures", T.LongType())])

# One try to read a source in a run, and one answer of a parser.
FETCH = T.StructType([
    T.StructField("source", T.StringType(), False), T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType()),
    T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType()),
])
PARSE_CALL = T.StructType([
    T.StructField("raw_id", T.StringType()), T.StructField("job_title", T.StringType()), T.StructField("model_used", T.StringType()),
    T.StructField("latency", T.DoubleType()), T.StructField("failed_attempts", T.IntegerType()), T.StructField("used_fallback", T.BooleanType()),
])

CYCLE = T.StructType([T.StructField(c, T.LongType()) for c in ("fetched", "parsed", "handoff_ok", "errors")])

RUN = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("error", T.StringType()),
    *(T.StructField(c, T.LongType()) for c in ("fetched", "parsed", "validated", "flagged", "errors", "duplicates")),
    T.StructField("per_source", T.MapType(T.StringType(), T.LongType())),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("jobs_per_second", T.DoubleType()),
    T.StructField("latencies", T.LongType()),
    *(T.StructField(p, T.DoubleType()) for p in ("p50", "p95", "p99")),
    # A quantile sketch of the latencies of each source.
    T.StructField("latency_sketches", T.MapType(T.StringType(), T.BinaryType())),
])

# One landed payload: a page of an API answer, a feed document or an HTML page.
# page_seq is the arrival order of payloads; unit names the fetch it belongs to.
PAGE = T.StructType([
    T.StructField("page_seq", T.LongType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("query", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])
