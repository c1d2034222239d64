"""Answers of a model by content: one call for equal postings, none for a repeated run, whole texts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from postweave.operators import model as N
from postweave.operators import parse as P
from tests.test_jobs import raw_rows


def test_equal_postings_cost_one_call_and_a_rerun_none(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def model(prompt: str) -> str:
        calls.add(1)
        if "bad" in prompt:
            raise RuntimeError("no answer")
        return json.dumps({"job_title": f"Role {len(prompt)}", "confidence": 0.9})

    texts = ["same text"] * 6 + ["other", "bad one", "bad one", "x" * 20_000, "x" * 20_000 + "y"]
    raw = raw_rows(spark, [(i, "manual", None, t, None) for i, t in enumerate(texts)]).withColumn("id", F.col("seq").cast("string")).repartition(3)
    answers = N.Answers(f"{tmp_path}/answers")

    def run(name="m", **options):
        before = calls.value
        rows = N.extract_with_model(raw, model, name, template="T {raw_text}", chars=None, answers=answers, max_attempts=2, in_flight=3, **options).collect()
        return {int(r.raw_id): r for r in rows}, calls.value - before

    first, n = run()
    # Four texts that are answered and two tries of one that is not.
    assert n == 4 + 2 and len(first) == len(texts)
    assert [first[i].job_title for i in (0, 5, 6, 9, 10)] == ["Role 11", "Role 11", "Role 7", "Role 20002", "Role 20003"]
    assert first[7].job_title == first[8].job_title == "[PARSE FAILED]"
    # One record tells of the calls; the sum of attempts is that of the calls that failed.
    assert sum(r.failed_attempts for r in first.values()) == 2 and sum(r.latency is not None for r in first.values()) == 5
    again, n = run()
    assert n == 2 and {i: r.job_title for i, r in again.items()} == {i: r.job_title for i, r in first.items()}
    # Another model is another question.
    assert run("other")[1] == 6
    assert answers.read(spark).count() == 8


def test_without_answers_every_record_is_asked(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(prompt: str) -> str:
        calls.add(1)
        return json.dumps({"job_title": "R"})

    raw = raw_rows(spark, [(i, "manual", None, "same", None) for i in range(5)]).withColumn("id", F.col("seq").cast("string"))
    assert len(N.extract_with_model(raw, model, "m", in_flight=4).collect()) == calls.value == 5


def test_limits_reach_the_parsers(spark):
    long = "Title: A\nRequirements: all of it\n" + "\n".join(f"line {i}" for i in range(300))
    plain = "Title: B\n" + "word " * 1000
    raw = raw_rows(spark, [(0, "manual", None, long, None), (1, "workable", None, plain, '{"title": "B"}')]).withColumn("id", F.col("seq").cast("string"))
    for parse, i in ((P.parse_generic, 0), (P.parse_workable, 1), (P.parse_structured, 0), (P.parse_structured, 1)):
        rows = raw.filter(F.col("seq") == i)
        cut, whole = (parse(rows, **k).first().description_clean for k in ({}, {"limits": P.UNCUT}))
        assert len(cut) < len(whole) and (whole.endswith("line 299") or whole.count("word") == 1000)
