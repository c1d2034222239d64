from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postweave.operators import breaker as K
from postweave.operators import metrics as M
from postweave.operators.tables import JobTables
from postweave.streaming.cycle import run_breakers

SLOW = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def rank(values, p):
    s = sorted(values)
    return round(s[min(int(p / 100.0 * len(s)), len(s) - 1)], 4) if s else 0.0


def test_percentile_golden(spark):
    df = spark.createDataFrame([("r", float(v)) for v in (1, 2, 3, 4)] + [("none", None)], "run_id string, latency double")
    got = {r.run_id: tuple(r)[1:] for r in M.latency_percentiles(df).collect()}
    assert got == {"r": (3.0, 4.0, 4.0), "none": (0.0, 0.0, 0.0)}


@settings(**SLOW)
@given(st.dictionaries(st.sampled_from("abc"), st.lists(st.integers(0, 12).map(float), max_size=60), min_size=1))
def test_percentiles_equal_sorted_list(spark, runs):
    df = spark.createDataFrame([(k, v) for k, vs in runs.items() for v in vs] + [(k, None) for k in runs], "run_id string, latency double")
    got = {r.run_id: (r.p50, r.p95, r.p99) for r in M.latency_percentiles(df).collect()}
    assert got == {k: tuple(rank(vs, p) for p in (50, 95, 99)) for k, vs in runs.items()}


ATTEMPTS = st.lists(st.tuples(st.sampled_from("aaab"), st.integers(0, 40), st.booleans()), min_size=1, max_size=70)


def log(spark, rows):
    rows = [(s, at(t), i, ok) for i, (s, t, ok) in enumerate(sorted(rows, key=lambda r: r[1]))]
    return rows, spark.createDataFrame(rows, "source string, ts timestamp, seq long, ok boolean")


def walk(rows, threshold, cooldown):
    """Breaker by the book, one source after the other."""
    out = {}
    for source in {r[0] for r in rows}:
        mode, since, run = "closed", None, 0
        for _, ts, seq, ok in (r for r in rows if r[0] == source):
            if mode == "open" and (ts - since).total_seconds() >= cooldown:
                mode = "half_open"
            seen, skipped = mode, mode == "open"
            if not skipped:
                if ok:
                    mode, run = "closed", 0
                else:
                    run, since = run + 1, ts
                    if mode == "half_open" or run >= threshold:
                        mode = "open"
            out[seq] = (seen, skipped, run)
    return out


@settings(**SLOW)
@given(ATTEMPTS, st.sampled_from([1, 2, 3]), st.sampled_from([0.0, 1.0, 7.0]))
def test_breaker_timeline_over_chunks(spark, rows, threshold, cooldown):
    rows, df = log(spark, rows)
    got = K.breaker_timeline(df, threshold, cooldown, chunks=6).collect()
    assert {r.seq: (r.state, r.skipped, r.consecutive) for r in got} == walk(rows, threshold, cooldown)


def test_breaker_chunk_maps_compose():
    """Exit states through chunk maps equal a plain replay, for many cuts of one dense log."""
    import random

    import numpy as np

    rnd = random.Random(3)
    for _ in range(400):
        n, thr, wait = rnd.randint(1, 40), rnd.randint(1, 4), rnd.choice([0, 1, 5, 30])
        ts = np.array(sorted(rnd.randint(0, 60) for _ in range(n)))
        ok = np.array([rnd.random() < rnd.choice([0.1, 0.5]) for _ in range(n)])
        state, i = K.State(), 0
        while i < n:
            j = min(n, i + rnd.randint(1, 9))
            state = K.step(state, *K.exits(ts[i:j], ok[i:j], thr, wait), wait)
            i = j
        _, _, since, streak = K.replay(ts, ok, K.State(), thr, wait)
        assert state == (since[-1], streak[-1])


def test_breaker_stream_equals_batch(spark, tmp_path):
    rows, df = log(spark, [("a", t, t % 5 == 0) for t in range(60)] + [("b", t, t % 2 == 0) for t in range(30)])
    for part in range(3):
        df.filter((F.col("seq") % 90 >= part * 30) & (F.col("seq") % 90 < part * 30 + 30)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    tables = JobTables(f"{tmp_path}/store")
    run_breakers(tables, stream, f"{tmp_path}/ck", 3, 7.0).awaitTermination()
    got = spark.read.parquet(tables.path("breaker_timeline")).collect()
    assert {r.seq: (r.state, r.skipped, r.failures) for r in got} == walk(rows, 3, 7.0)


@settings(**SLOW)
@given(ATTEMPTS)
def test_streaks_and_stats(spark, rows):
    rows, df = log(spark, rows)
    run, want, last = {}, {}, {}
    for source, ts, seq, ok in rows:
        run[source] = 0 if ok else run.get(source, 0) + 1
        want[seq] = run[source]
        if not ok:
            last[source] = ts
    assert {r.seq: r.streak for r in M.failure_streaks(df).collect()} == want
    asof = at(43)
    for r in M.breaker_stats(df, F.lit(asof), threshold=2, cooldown=20.0).collect():
        mine = [x for x in rows if x[0] == r.source]
        bad = sum(not x[3] for x in mine)
        state = "closed" if run[r.source] < 2 else "half_open" if (asof - last[r.source]).total_seconds() >= 20 else "open"
        assert tuple(r) == (r.source, state, run[r.source], bad, len(mine) - bad)


def test_hot_source_is_split_over_chunks(spark):
    from postweave.operators.ordered import CHUNK, in_chunks

    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("source"), "id")
    sizes = in_chunks(df, ["source"], ["id"], 8).groupBy("source", CHUNK).count().filter("source = 'hot'").collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 1200


def test_progress(spark):
    df, seen = M.progress(spark.range(7), "saving", 9)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"step": "saving", "current": 7, "total": 9}


def test_one_busy_source_within_one_cooldown(spark):
    """One source with nine tenths of the rows, all within one cooldown, in chunks of a few rows."""
    import random

    rnd = random.Random(3)
    rows = [("busy" if i % 10 else f"s{i}", i, rnd.random() < 0.6) for i in range(900)]
    df = spark.createDataFrame([(s, i, ok) for s, i, ok in rows], "source string, seq long, ok boolean").withColumn("ts", F.timestamp_seconds("seq"))
    one = K.breaker_timeline(df, 3, 10_000.0, chunks=1).collect()
    many = K.breaker_timeline(df, 3, 10_000.0, chunks=40).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and any(r.skipped for r in one)
    assert sorted(map(tuple, M.failure_streaks(df).collect())) == sorted(
        (s, i, ok, t, n) for (s, i, ok, t), n in zip(df.collect(), _streaks(rows))
    )


def _streaks(rows):
    now, out = {}, []
    for s, _, ok in rows:
        now[s] = 0 if ok else now.get(s, 0) + 1
        out.append(now[s])
    return out
