import duckdb
import pytest

import __spark_entry__ as entry
from postweave.catalog import inputs as I
from postweave.catalog.inputs import TABLES
from postweave.catalog.oracles import ORACLES
from postweave.catalog.queries import QUERIES
from tests.check_oracles import compare

SF_DIR = "/root/testdata/sf0.001"
# One query per kind of work; tests.check_oracles covers all of them.
SAMPLE = (
    "parse_structured", "dedup_stats_until_target", "validate_strict", "raw_from_adzuna", "html_detail_text_fuzu", "fetch_grid",
    "store_stats", "approve", "run_summary", "latency_percentiles", "breaker_timeline", "decode_model_json",
)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "parsed", "validated", "flagged", "errors", "avg_confidence"] and df.count() == 5


@pytest.mark.parametrize("name", SAMPLE)
def test_sample(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")


def test_costly_scans_lie_over_all_cores(spark, tmp_path):
    """One row group is one task: its rows are dealt to all cores before they are parsed, none lost."""
    spark.range(1000).selectExpr("id AS o_orderkey", "repeat('x', 50) AS t").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    got = I.spread_table(spark, str(tmp_path), "orders")
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert min(got.rdd.glom().map(len).collect()) > 0 and got.distinct().count() == 1000
