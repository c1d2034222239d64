"""Validation rules: each takes nothing and returns a Column that is the issue text or null."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from postweave import schemas as S
from postweave.functions.text import blank

# Thresholds and issue texts.
MIN_CONFIDENCE = 0.5
MIN_SALARY = 10_000
MAX_SALARY = 5_000_000
NO_TITLE = "Missing or invalid job title"
NO_SKILLS = "No required skills extracted — verify manually"
LOW_CONFIDENCE = "Low LLM confidence (%d%%) — review extraction carefully"
LOW_SALARY = "Suspiciously low salary min: %d"
HIGH_SALARY = "Suspiciously high salary max: %d"
CROSSED_SALARY = "Salary min (%d) exceeds max (%d)"
PARSE_FAILED = "LLM parsing failed — raw text may be corrupt or too short"
NO_COMPANY = "Missing company name"
NO_LOCATION = "Missing location and not marked as remote"
NO_EMPLOYMENT = "Missing employment type"

Rule = Callable[[], Column]


def title_present() -> Column:
    t = F.col("job_title")
    return F.when(blank(t) | t.isin(S.UNKNOWN_TITLE, S.FAILED_TITLE), NO_TITLE)


def skills_present() -> Column:
    n = F.coalesce(F.size("required_skills"), F.lit(0))
    return F.when(n <= 0, NO_SKILLS)


def confidence_high_enough() -> Column:
    c = F.col("confidence")
    return F.when(c < MIN_CONFIDENCE, F.format_string(LOW_CONFIDENCE, F.rint(c * 100).cast("int")))


def salary_sane() -> Column:
    """At most one issue; a missing or zero bound is not judged."""
    lo, hi = F.col("salary.min"), F.col("salary.max")
    return (
        F.when((lo != 0) & (lo < MIN_SALARY), F.format_string(LOW_SALARY, lo))
        .when((hi != 0) & (hi > MAX_SALARY), F.format_string(HIGH_SALARY, hi))
        .when((lo != 0) & (hi != 0) & (lo > hi), F.format_string(CROSSED_SALARY, lo, hi))
    )


def parse_succeeded() -> Column:
    return F.when(F.col("job_title").contains(S.FAILED_TITLE), PARSE_FAILED)


def company_present() -> Column:
    return F.when(blank(F.col("company")), NO_COMPANY)


def location_or_remote() -> Column:
    return F.when(blank(F.col("location")) & ~F.coalesce(F.col("remote"), F.lit(False)), NO_LOCATION)


def employment_type_present() -> Column:
    return F.when(blank(F.col("employment_type")), NO_EMPLOYMENT)


STANDARD: Sequence[Rule] = (
    title_present, skills_present, confidence_high_enough, salary_sane, parse_succeeded,
)
STRICT: Sequence[Rule] = (*STANDARD, company_present, location_or_remote, employment_type_present)


def issues(rules: Sequence[Rule] = STANDARD) -> Column:
    return F.array_compact(F.array(*(rule() for rule in rules)))


def outcome() -> Column:
    """error for a failed parse, else flagged or validated by the issues found."""
    return (
        F.when(F.col("job_title").contains(S.FAILED_TITLE), "error")
        .when(F.size("validation_issues") > 0, "flagged")
        .otherwise("validated")
    )
