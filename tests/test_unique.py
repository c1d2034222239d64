"""Streams deduplicated in Spark's state: equal to batch, over restarts, and of bounded size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postweave.operators import deliver as D
from postweave.operators import tables as T
from postweave.plans import intake as J
from postweave.streaming import cycle as C
from postweave.streaming.unique import unique_rows
from tests.test_jobs import raw_rows

DAY = 86_400


def land(spark, tmp_path, rows, days):
    """One file per row, in order: every row is a micro-batch of its own."""
    df = raw_rows(spark, rows).withColumn("fetched_at", F.timestamp_seconds(F.element_at(F.array(*map(F.lit, days)), (F.col("seq") - rows[0][0] + 1).cast("int")) * DAY))
    for r in rows:
        df.filter(F.col("seq") == r[0]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_equal_to_batch_and_over_a_restart(spark, tmp_path):
    rows = [(0, "manual", "a", "Title: x", None), (1, "manual", "b", "Title: x", None), (2, "manual", None, "Title: z", None), (3, "manual", "", "Title: w", None),
            (4, "manual", "b", "Title: y", None), (5, "manual", "a", "Title: v", None)]
    tables = T.JobTables(f"{tmp_path}/store")
    intake = J.Intake(tables, D.to_files(f"{tmp_path}/out"))
    tables.save_raw(raw_rows(spark, [(99, "manual", "known", "Title: q", None)]), "bulk")
    stream = land(spark, tmp_path, rows[:4], [10] * 4)
    C.run_cycle(intake, stream, f"{tmp_path}/ck", within="30 days").awaitTermination()
    more = rows[4:] + [(6, "manual", "c", "Title: u", None), (7, "manual", "known", "Title: t", None)]
    stream = land(spark, tmp_path, more, [11] * 4)
    C.run_cycle(intake, stream, f"{tmp_path}/ck", within="30 days").awaitTermination()
    assert sorted(r.seq for r in tables.raw_of_runs(spark, lambda r: r != "bulk").collect()) == [0, 2, 3, 6]
    assert tables.cycles(spark).agg(F.sum("fetched")).first()[0] == 4
    # The same rows as one batch over all.
    assert unique_rows(raw_rows(spark, rows + more), "30 days").count() == 5


def test_state_is_bounded_by_the_watermark_and_late_rows_are_counted(spark, tmp_path):
    rows = [(i, "manual", f"id{i}", f"Title: t{i}", None) for i in range(8)] + [(8, "manual", "late", "Title: late", None), (9, "manual", "id9", "Title: t9", None)]
    days = [10 * i for i in range(8)] + [1, 80]
    stream = land(spark, tmp_path, rows, [d + 100 for d in days])
    out = []
    query = (
        unique_rows(stream, "15 days", by_fingerprint=False).writeStream.option("checkpointLocation", f"{tmp_path}/ck")
        .foreachBatch(lambda b, e: out.extend(r.seq for r in b.select("seq").collect())).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(out) == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert max(s.numRowsTotal for s in states) <= 5 < len(rows)
    assert sum(s.numRowsDroppedByWatermark for s in states) == 1


@pytest.mark.parametrize("by_fingerprint", [True, False])
def test_rows_of_one_batch(spark, by_fingerprint):
    rows = [(i, "manual", f"id{i % 3}", f"Title: t{i % 2}", None) for i in range(12)] + [(20, "manual", None, "Title: n", None), (21, "manual", None, "Title: n", None)]
    got = unique_rows(raw_rows(spark, rows), "1 day", by_fingerprint).collect()
    ids = [r.external_id for r in got]
    assert len([i for i in ids if i]) == len({i for i in ids if i})
    assert ids.count(None) == (1 if by_fingerprint else 2) and (by_fingerprint or len(ids) == 5)
