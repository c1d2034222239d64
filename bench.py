"""Times the headline queries on one machine and prints one JSON line.

A table of one file with one row group is one task, whatever the machine; on a cluster a table has many. So the tables are
first written anew, one file per core, which is not timed. `queries` are first runs, `warm` second ones.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from postweave.catalog.inputs import TABLES
from postweave.catalog.queries import QUERIES
from postweave.session import local_session

# Fields, dedup, validation, statistics, ordered state, pages and whole jobs.
HEADLINE = (
    "extract_from_documents", "parse_structured", "clean_description", "fingerprint", "dedup_fingerprint", "dedup_postings",
    "dedup_stats", "drop_known", "validate_standard", "outcome_per_source", "store_stats", "current_jobs", "run_summary",
    "latency_percentiles", "failure_streaks", "breaker_timeline", "raw_from_jsearch", "raw_from_rss", "html_job_links_jobgurus",
    "html_detail_text_jobgurus", "decode_model_json", "hybrid_overlay", "deliver", "bulk_ingest",
)


def lay_out(spark, sf_dir: str, files: int) -> str:
    root = tempfile.mkdtemp(prefix="postweave-bench-")
    for name in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        rows.repartition(files).write.parquet(f"{root}/{name}.parquet")
    return root


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    n = int(cores) if cores.isdigit() else 8
    spark = local_session(cores=cores, partitions=n)
    tables = lay_out(spark, sf_dir, n)
    # One untimed query starts the JVM's code paths and the Python workers.
    timed(spark, "html_job_links_fuzu", tables)
    cold = {name: timed(spark, name, tables) for name in HEADLINE}
    warm = {name: timed(spark, name, tables) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(cold.values()), 3), "unit": "sec", "queries": cold,
        "warm": warm, "warm_total": round(sum(warm.values()), 3), "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
