"""Shapes of the plans of headline queries: scans, joins, kinds of aggregation."""

import re

import pytest

from postweave.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def nodes(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"^[\s:*+|()\d-]*\b([A-Z][A-Za-z]+)", plan, re.M), plan


def test_outcome_per_source_reads_each_table_once(spark):
    kinds, plan = nodes(spark, "outcome_per_source")
    assert plan.count("FileScan parquet") == 3 and kinds.count("SortMergeJoin") + kinds.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("name", ["dedup_postings", "dedup_external_id", "dedup_fingerprint", "dedup_within_fetch"])
def test_first_per_key_is_a_hash_aggregate(spark, name):
    kinds, _ = nodes(spark, name)
    assert "SortAggregate" not in kinds and "Window" not in kinds and kinds.count("HashAggregate") >= 2


def test_counts_until_a_target_scan_once_more_only(spark):
    """What was kept is pinned, so the statistics read the keys once."""
    _, plan = nodes(spark, "dedup_stats_until_target")
    assert plan.count("FileScan parquet") == 3


@pytest.mark.parametrize("name", ["parse_structured", "validate_standard", "store_stats", "raw_from_jsearch"])
def test_no_python(spark, name):
    _, plan = nodes(spark, name)
    assert not re.search("EvalPython|InPandas|InArrow", plan)
