"""Latency sketches of run rows: exact while small, within the rank bound beyond, and merged from run rows alone."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from postweave.operators import latency as L
from postweave.operators import metrics as M
from postweave.operators import parse as P
from postweave.operators import tables as T
from postweave.plans import intake as J
from tests.test_jobs import raw_rows

SEEN = "run_id string, source string, latency double"


def plain(values, p):
    s = sorted(values)
    return round(s[min(int(p / 100 * len(s)), len(s) - 1)], 4) if s else 0.0


def test_small_runs_are_exact_and_large_ones_close(spark):
    rnd = random.Random(5)
    rows = [(f"r{k}", f"s{i % 3}", rnd.choice([rnd.expovariate(1), float(i % 4)])) for k, n in enumerate((1, 2, 3, 4, 20, 100, 199)) for i in range(n)]
    large = [("large", f"s{rnd.randint(0, 2)}", rnd.lognormvariate(0, 2)) for _ in range(20_000)]
    odd = [("empty", "s0", None), ("nan", "s1", float("nan")), ("r1", None, 9.0)]
    seen = spark.createDataFrame(rows + large + odd, SEEN).repartition(3)
    runs = L.with_latency(seen.select("run_id").distinct(), L.sketches(seen, "run_id", "source")).persist()
    values = {}
    for r, _, x in rows + large + odd:
        values.setdefault(r, []).extend([x] if x is not None and x == x else [])
    for row in runs.collect():
        own = values[row.run_id]
        assert row.latencies == len(own)
        for p in M.PERCENTILES:
            got = row[f"p{p}"]
            if len(own) <= L.K:
                assert got == plain(own, p), (row.run_id, p)
            else:
                under, upto = sum(round(x, 4) < got for x in own) / len(own), sum(round(x, 4) <= got for x in own) / len(own)
                assert under - L.RANK_ERROR <= p / 100 + 1e-4 and upto + L.RANK_ERROR >= p / 100 - 1e-4
    # Over all runs, and per source, from the run rows alone.
    every = [x for v in values.values() for x in v]
    life = L.lifetime_latency(runs).first()
    assert life.latencies == len(every)
    assert abs(sum(x <= life.p95 for x in every) / len(every) - 0.95) < 2 * L.RANK_ERROR
    by = {r.source: r.latencies for r in L.lifetime_latency(runs, "source").collect()}
    assert by["s1"] == sum(1 for _, s, x in rows + large + odd if s == "s1" and x is not None and x == x) and by[""] == 1
    runs.unpersist()


def test_windows_and_no_runs(spark):
    seen = spark.createDataFrame([(f"r{k}", "s", float(k)) for k in range(6)], SEEN)
    ends = seen.select("run_id").withColumn("finished_at", F.when(F.col("run_id") != "r5", F.timestamp_seconds(F.substring("run_id", 2, 1).cast("int") * 1000)))
    runs = L.with_latency(ends, L.sketches(seen, "run_id", "source"))
    got = [(r.runs, r.latencies, r.p50) for r in L.latency_by_window(runs).orderBy("window_start").collect()]
    assert got == [(4, 4, 2.0), (1, 1, 4.0)]
    none = L.lifetime_latency(L.with_latency(ends.limit(0), None)).first()
    assert (none.latencies, none.p50, none.p99) == (0, 0.0, 0.0)


def test_run_rows_carry_latency(spark, tmp_path):
    def slow(raw):
        took = {"latency": F.col("seq") / 10, "failed_attempts": F.lit(0), "used_fallback": F.lit(False)}
        rows = P.parse_structured(raw)
        return rows.join(raw.select(F.col("id").alias("raw_id"), "seq"), "raw_id").withColumns(took).drop("seq")

    tables = T.JobTables(f"{tmp_path}/store")
    from postweave.operators import deliver as D

    raw = raw_rows(spark, [(i, "manual", f"x{i}", f"Title: Job {i}", None) for i in range(1, 9)])
    done = J.run_bulk(spark, J.Intake(tables, D.to_files(f"{tmp_path}/out"), parse=slow), {"manual": lambda: raw}, run_id="r").first()
    assert (done.latencies, done.p50, done.p95) == (8, 0.5, 0.8)
    saved = tables.runs(spark).first()
    assert (saved.p99, list(saved.latency_sketches)) == (0.8, ["manual"])
    assert L.lifetime_latency(tables.runs(spark)).first().p50 == 0.5
