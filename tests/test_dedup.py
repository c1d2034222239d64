import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postweave.operators import dedup as U
from tests import bruteforce as B

ROW = st.tuples(
    st.sampled_from("abc"), st.sampled_from([None, "", "1", "2", "3", "4"]), st.sampled_from(["Title: x", "Title: y", "z", "w -"])
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, s, e, t) for i, (s, e, t) in enumerate(rows)], "seq long, source string, external_id string, raw_text string"
    )


def fp(text):
    return hashlib.md5(B.fingerprint_text(text).encode()).hexdigest()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=40), st.booleans(), st.sampled_from([None, 1, 3, 5]))
def test_equals_greedy_loop(spark, rows, by_fp, target):
    raw = frame(spark, rows)
    kept, dropped = B.keep_first([(s, e, fp(t)) for s, e, t in rows], by_fp, target)
    assert sorted(r.seq for r in U.dedup(raw, by_fp, target).collect()) == kept
    stats = {r.source: (r.kept, r.dropped) for r in U.dedup_stats(U.dedup_keys(raw), by_fp, target).collect()}
    per = {s: [0, 0] for s in "abc"}
    for i in kept:
        per[rows[i][0]][0] += 1
    for s, n in dropped.items():
        per[s][1] = n
    assert {s: tuple(v) for s, v in per.items() if any(v)} == {s: v for s, v in stats.items() if any(v)}



def test_two_sources_with_the_same_rows(spark):
    """Five rows each, same ids: 5 kept, 5 duplicates."""
    five = [("dev", f"dev_{'dup' if i == 2 else i}", f"Title: Dev Engineer {i}\nCompany: Mock") for i in range(5)]
    totals = U.dedup_totals(U.dedup_stats(U.dedup_keys(frame(spark, five + five)), target=50), 50).first()
    assert (totals.yielded, totals.duplicates, totals.target) == (5, 5, 50)


def test_within_fetch_keeps_one_row_without_id(spark):
    raw = frame(spark, [("a", None, "1"), ("a", "", "2"), ("a", "9", "3"), ("b", None, "4"), ("a", "9", "5")])
    assert sorted(r.seq for r in U.dedup_within_fetch(raw.withColumn("unit", F.col("source"))).collect()) == [0, 2, 3]


def test_drop_known_keeps_twins_and_rows_without_id(spark):
    raw = frame(spark, [("a", "1", "x"), ("a", "2", "x"), ("a", "2", "y"), ("a", None, "x"), ("a", "", "x")])
    store = frame(spark, [("a", "1", "q"), ("a", "", "q"), ("a", None, "q")])
    for spread in (1, 5):
        assert sorted(r.seq for r in U.drop_known(raw, store, spread).collect()) == [1, 2, 3, 4]


def test_target_bounds(spark):
    import pytest

    with pytest.raises(ValueError):
        U.take_target(frame(spark, []), 0)
    rows = [(None, str(i), "x") for i in range(2500)]
    assert U.take_target(frame(spark, rows), 2001).count() == 2001


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = U.survivors(U.dedup_keys(frame(spark, [("a", "1", "x")])))._jdf.queryExecution().toString()
    assert "partial_min" in plan and "Window" not in plan
