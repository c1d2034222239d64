"""Calls an injected model function per record, inside Arrow batches."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postweave.operators import parse as P
from postweave.session import pin

ANSWER = "raw_id string, model_used string, response string, failed_attempts int, used_fallback boolean, latency double, error string"
MAX_ATTEMPTS = 3


def _whole(x) -> bool:
    return x is None or float(x) == float(x) // 1


def _texts(x) -> bool:
    return isinstance(x, list) and all(isinstance(i, str) for i in x)


def _text(x) -> bool:
    return isinstance(x, str)


def _text_or_none(x) -> bool:
    return x is None or isinstance(x, str)


def _flag(x) -> bool:
    return isinstance(x, bool) or x in (0, 1) or str(x).lower() in ("t", "true", "y", "yes", "1", "f", "false", "n", "no", "0")


_FITS = {
    "remote": _flag,
    "job_title": _text, "company": _text_or_none, "location": _text_or_none,
    "required_skills": _texts, "preferred_skills": _texts, "parse_warnings": _texts,
    "years_experience": _whole, "education_level": _text_or_none, "employment_type": _text_or_none,
    "description_clean": _text_or_none, "confidence": lambda x: isinstance(float(x), float),
}
_MONEY_FITS = {"min": _whole, "max": _whole, "currency": _text, "period": _text}


def _usable(text: str) -> bool:
    """Does the answer decode? Tells whether another attempt is due; the decoding itself runs in Spark."""
    text = text.strip()
    if text.startswith("```"):
        text = text.split("```")[1].removeprefix("json")
    answer = json.loads(text)
    money = answer.get("salary") or {}
    return all(ok(answer[k]) for k, ok in _FITS.items() if k in answer) and all(
        ok(money[k]) for k, ok in _MONEY_FITS.items() if k in money
    )


def ask(
    prompts: DataFrame,
    model: Callable[[str], str],
    name: str,
    fallback: Callable[[str], str] | None = None,
    fallback_name: str = "",
    max_attempts: int = MAX_ATTEMPTS,
    in_flight: int = 1,
) -> DataFrame:
    """prompts: id, prompt. One answer row per record, whether it succeeded or not.

    A call fails when it raises or when its answer does not decode. The main model gets
    max_attempts calls, the fallback one. Batches follow spark.sql.execution.arrow.maxRecordsPerBatch;
    repartition the input to set how many calls run side by side. Answers come from outside, so pin
    or write the result before using it twice. A task has up to in_flight calls open at once; it takes the
    next batch when all of the last one are answered.
    """
    plan = [(model, name, False)] * max_attempts + ([(fallback, fallback_name, True)] if fallback else [])

    def one(raw_id: str, prompt: str) -> tuple:
        error = ""
        for i, (call, label, is_fallback) in enumerate(plan):
            start = time.monotonic()
            try:
                answer = call(prompt)
                if not _usable(answer):
                    raise ValueError("answer has a field of the wrong type")
            except Exception as e:  # noqa: BLE001 - any failure of the injected call is a failed attempt
                error = error if is_fallback else str(e)
            else:
                return raw_id, label, answer, min(i, max_attempts), is_fallback, time.monotonic() - start, None
        return raw_id, name, None, max_attempts, False, 0.0, f"All {max_attempts} parse attempts failed: {error}"

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in ANSWER.split(", ")]
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            for f in frames:
                yield pd.DataFrame(list(pool.map(one, f["id"], f["prompt"])), columns=cols)

    return prompts.select("id", "prompt").mapInPandas(batches, ANSWER)


@dataclass(frozen=True)
class Answers:
    """Answers by the content of what was asked, in a folder that all executors reach."""

    root: str

    def read(self, spark: SparkSession) -> DataFrame:
        schema = ANSWER.replace("raw_id", "key")
        try:
            return spark.read.schema(schema).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def add(self, answers: DataFrame) -> None:
        """Appends in one commit: a task that is repeated leaves one copy of its answers."""
        answers.write.mode("append").parquet(self.root)


def ask_once(prompts: DataFrame, answers: Answers, model: Callable[[str], str], name: str, fallback: Callable[[str], str] | None = None, fallback_name: str = "", **options) -> DataFrame:
    """As ask, but equal prompts are asked together, and what was answered before is not asked again.

    The key is a hash of models and prompt, hence of template and text. Answers are stored before they are used; failures are not,
    so that a later run tries again. Of the records that share an answer, the one of least id tells of its attempts and latency if
    it was given now; the others made no call.
    """
    spark = prompts.sparkSession
    keyed = prompts.select("id", F.sha2(F.concat_ws("\n", F.lit(name), F.lit(fallback_name), F.col("prompt")), 256).alias("key"), "prompt")
    known = answers.read(spark)
    # Partial aggregation leaves one prompt a task of those that many records share.
    asked = pin(keyed.groupBy("key").agg(F.min("prompt").alias("prompt"), F.min("id").alias("first")).join(known.select("key"), "key", "left_anti"))
    new = pin(ask(asked.select(F.col("key").alias("id"), "prompt"), model, name, fallback, fallback_name, **options).withColumnRenamed("raw_id", "key"))
    answers.add(new.filter(F.col("response").isNotNull()))
    # Two runs at once may both have asked: one answer per key is taken.
    old = known.join(new.select("key"), "key", "left_anti").groupBy("key").agg(F.min(F.struct(*(c for c in known.columns if c != "key"))).alias("a")).select("key", "a.*")
    every = new.join(asked.select("key", "first"), "key").unionByName(old.withColumn("first", F.lit(None).cast(prompts.schema["id"].dataType)))
    mine = F.coalesce(F.col("id") == F.col("first"), F.lit(False))
    told = {"failed_attempts": F.when(mine, F.col("failed_attempts")).otherwise(0), "latency": F.when(mine, F.col("latency"))}
    names = [c.split()[0] for c in ANSWER.split(", ")]
    return keyed.select("id", "key").join(every, "key").withColumns(told).withColumnRenamed("id", "raw_id").select(*names)


CALL_COLUMNS = ("failed_attempts", "used_fallback", "latency")


def to_parsed(answers: DataFrame, now: Column | None = None, carry: Sequence[str] = CALL_COLUMNS) -> DataFrame:
    """Answers as parsed rows, in one pass: a record without a response is a failure row that tells its error."""
    parsed = P.decode_model_json(answers, now, ("error", *carry))
    told = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.col("parse_warnings"))
    return parsed.withColumn("parse_warnings", told).drop("error")


def extract_with_model(
    raw: DataFrame, model: Callable[[str], str], name: str, now: Column | None = None,
    template: str = P.PROMPT, chars: int | None = P.PROMPT_CHARS, answers: Answers | None = None, **options,
) -> DataFrame:
    """Prompt, call and decode; parsed rows plus failed_attempts, used_fallback and latency.

    The prompt holds the first `chars` characters of the text, or all of it with None. With `answers`, equal postings cost one call
    and a repeated run none. The result is pinned, so that neither a lost executor nor a second use calls the model again.
    """
    prompts = P.build_prompt(raw, template, chars)
    got = ask(prompts, model, name, **options) if answers is None else ask_once(prompts, answers, model, name, **options)
    return pin(to_parsed(got, now))
