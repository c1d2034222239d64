"""Windows over event time: late rows correct them while they are open, and are counted apart afterwards."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from postweave.streaming import windows as W

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
KIND = "source string, ts timestamp, ok boolean"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def land(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(path)


def flat(df):
    return {tuple(str(x) for x in r) for r in df.collect()}


BATCHES = [
    [("a", at(1), True), ("a", at(2), False), ("b", at(3), True), ("b", None, True)],
    [("a", at(12), None), ("b", at(14), True)],
    [("a", at(4), False)],
    [("a", at(100), True)],
    [("b", at(101), True)],
    [("b", at(5), False)],
]


def test_late_rows_correct_open_windows_and_are_counted_after_that(spark, tmp_path):
    stream = W.fetch_windows(land(spark, f"{tmp_path}/in", BATCHES), "10 minutes", "30 minutes")
    query = W.keep_windows(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination()
    got = W.windows_of(spark.read.parquet(f"{tmp_path}/out"), "source", "window_start", "window_end")
    in_time = [r for i, rows in enumerate(BATCHES) for r in rows if i != 5]
    assert flat(got) == flat(W.fetch_windows(spark.createDataFrame(in_time, KIND), "10 minutes"))
    # The window of minute 0 was corrected by the row of the third batch; the last came after its end.
    a = got.filter((F.col("source") == "a") & (F.col("window_start") == F.lit(at(0)))).first()
    assert (a.tries, a.failures) == (3, 2)
    assert W.dropped_late(query) == 1


def test_over_a_restart(spark, tmp_path):
    for part in (BATCHES[:2], BATCHES[2:4]):
        stream = W.fetch_windows(land(spark, f"{tmp_path}/in", part), "10 minutes", "30 minutes")
        W.keep_windows(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = W.windows_of(spark.read.parquet(f"{tmp_path}/out"), "source", "window_start", "window_end")
    assert flat(got) == flat(W.fetch_windows(spark.createDataFrame(sum(BATCHES[:4], []), KIND), "10 minutes"))


def test_windows_that_overlap(spark):
    rows = spark.createDataFrame([("a", at(7), True)], KIND)
    assert W.fetch_windows(rows, "10 minutes", slide="5 minutes").count() == 2
    assert W.fetch_windows(rows.limit(0), "10 minutes").count() == 0


def test_outages_are_sessions(spark, tmp_path):
    rows = [("a", at(m), False) for m in (0, 3, 6, 20)] + [("a", at(4), True), ("b", at(3), None), ("b", at(8), False), ("b", at(14), False)]
    df = spark.createDataFrame(rows, KIND)
    want = {("a", at(0), at(11), 3), ("a", at(20), at(25), 1), ("b", at(3), at(13), 2), ("b", at(14), at(19), 1)}

    def plain(d):
        return {(r.source, r.session_start.astimezone(timezone.utc), r.session_end.astimezone(timezone.utc), r.failures) for r in d.collect()}

    assert plain(W.failure_sessions(df, "5 minutes")) == want
    # As a stream a session grows, so only closed ones are written.
    order = [[r] for r in rows] + [[("z", at(500), False)], [("z", at(501), False)]]
    stream = W.failure_sessions(land(spark, f"{tmp_path}/in", order), "5 minutes", "60 minutes")
    q = stream.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True)
    q.format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination()
    assert plain(spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")) == want
