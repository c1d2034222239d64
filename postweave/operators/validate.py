"""Annotates parsed rows with issues; never drops a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from postweave.functions import rules as R


def validate(parsed: DataFrame, rules: Sequence[R.Rule] = R.STANDARD) -> DataFrame:
    """Sets validation_issues (in rule order) and is_valid. Add rules by passing a longer list."""
    return parsed.withColumn("validation_issues", R.issues(rules)).withColumn(
        "is_valid", F.size("validation_issues") == 0
    )


def with_outcome(validated: DataFrame) -> DataFrame:
    return validated.withColumn("outcome", R.outcome())


def outcome_counts(validated: DataFrame, *by: str) -> DataFrame:
    rows = with_outcome(validated)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("parsed"),
        *(F.count_if(F.col("outcome") == o).alias(a)
          for o, a in (("validated", "validated"), ("flagged", "flagged"), ("error", "errors"))),
        F.avg("confidence").alias("avg_confidence"),
    )
