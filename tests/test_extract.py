import hashlib

import pytest
from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from postweave.functions import extract as X
from postweave.functions.text import strip
from tests import bruteforce as B

# id: (text, title, company, location, salary, employment, skills, remote)
GOLDENS = {
    "F1": ("\nSenior Backend Engineer - Remote (US)\nTechCorp Inc | $140,000 - $180,000/year\n\nRequirements:\n"
           "- Strong proficiency in Python (FastAPI or Django) or Go\n- PostgreSQL and Redis expertise\n",
           "Senior Backend Engineer", None, "Python", (140000, 180000), None,
           ["Python", "Go", "Django", "FastAPI", "PostgreSQL", "Redis", "SQL"], True),
    "F2": ("Title: Dev\nCompany: Acme\nLocation: Lagos, Nigeria\nEmployment Type: full-time\nSalary: 50000 - 60000 GBP yearly",
           "Dev", "Acme", "Lagos, Nigeria", (50000, 60000), "full-time", ["Go"], False),
    "F3": ("Title: \nCompany: Acme", "Company: Acme", "Acme", None, None, None, [], False),
    "F4": ("Title: A\r\nCompany: B\r\nPay: 90k to 120k", "A", "B", None, (90000, 120000), None, [], False),
    "F5": ("Location: Nairobi\nhybrid - Kenya\ncontract role at Foo Bar in Accra", None, "Foo Bar", "Nairobi",
           None, None, ["AI"], True),
    "F6": ("Salary: $1,200,000 - $1,500,000; pay 15-25/hr; 140-180k", None, None, None,
           (1200000, 1500000), None, [], False),
}

PIECES = [
    "Title:", "Company:", "Location:", "title", "company ", "location: ", "Senior Engineer", "at Foo & Co.", "remote - ",
    "hybrid", "in Accra, Ghana", "\n", "\r\n", "\n\n", " ", " ", " ", "\x1c", "\x85", "$120,000 - $90k", "15-25",
    "90k to 120k", "salary: 1,0000-20000", "pay 10 to 99999999999999999999", "00k-12k", "USD 200 – 300", "Full time",
    "$", "EUR", "GBP 45", "/year", " yearly", "/hr", "to", "k", "120,500", "77",
    "Employment Type: part-time", "contract", "contractors", "About us", "  Requirements:", "what you'll do ", "description",
    "Python/Go", "e-mail JAVASCRIPT", "NoSQL C++ C#", "İstanbul ſtraße", "K", "|", "-", "x" * 101, ":", "a\tb",
]


def columns():
    t = F.col("t")
    s = X.salary(t)
    return [
        X.title(t).alias("title"), X.company(t).alias("company"), X.location(t).alias("location"),
        s["min"].alias("lo"), s["max"].alias("hi"), X.employment_type(t).alias("employment"),
        X.skills(t).alias("skills"), X.is_remote(t).alias("remote"), X.description(t).alias("description"),
        X.fingerprint(t).alias("fp"),
    ]


def expected(t):
    lo, hi = B.salary(t) or (None, None)
    return (
        B.title(t), B.company(t), B.location(t), lo, hi, B.employment(t), B.skills(t),
        "remote" in t.lower() or "hybrid" in t.lower(), B.description(t),
        hashlib.md5(B.fingerprint_text(t).encode()).hexdigest(),
    )


def run(spark, texts):
    return [tuple(r) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(*columns()).collect()]


@pytest.mark.parametrize("name", GOLDENS)
def test_goldens(spark, name):
    text, *want = GOLDENS[name]
    title, company, location, lo, hi, emp, skills, remote, _, _ = run(spark, [text])[0]
    assert [title, company, location, (lo, hi) if lo else None, emp, skills, remote] == want


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=80, max_size=120))
def test_equals_bruteforce(spark, texts):
    for text, got in zip(texts, run(spark, texts)):
        assert got == expected(text), repr(text)


def test_whole_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text, got in zip(texts, run(spark, texts)):
        assert got == expected(text)


def test_description_line_cap(spark):
    text = "intro\n Requirements:\n" + "\n".join(f"  item {i} \n" for i in range(150))
    assert run(spark, [text])[0][8] == B.description(text)
    assert run(spark, [text])[0][8].count("\n") == 99


def test_whole_word_skills(spark):
    df = spark.createDataFrame([("google email, C++ and Go",)], "t string")
    assert df.select(X.skills(F.col("t"), whole_words=True)).first()[0] == ["Go", "C++"]


def test_plan_has_no_python(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(*columns())._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("EvalPython", "InPandas", "InArrow"))


def test_salary_digits_of_other_scripts(spark):
    arabic = "Salary: \u0665\u0660\u0660\u0660\u0660 - \u0666\u0660\u0660\u0660\u0660"
    wide = "pay 5\uff10\uff10\uff10\uff10 to 60\u0966\u0966\u0966"
    df = spark.createDataFrame([(arabic,), (wide,)], "t string")
    assert [tuple(r.s)[:2] for r in df.select(X.salary(F.col("t")).alias("s")).collect()] == [(50000, 60000)] * 2


def test_description_without_limits(spark):
    text = "Requirements:\n" + "\n".join(f"line {i}" for i in range(300))
    df = spark.createDataFrame([(text,), ("x" * 5000,)], "t string")
    full = [r[0] for r in df.select(X.description(F.col("t"), None, None)).collect()]
    assert full == [text, "x" * 5000]
    assert [len(r[0].split("\n")) for r in df.select(X.description(F.col("t"))).collect()] == [100, 1]


def test_strip_trims_as_python_without_a_pattern(spark):
    marks = [chr(i) for i in range(0x3001) if chr(i).isspace()] + ["​", "﻿", "\x00", "x", "\U0001f600"]
    texts = [*(m + "a " + m + " b" + m for m in marks), "".join(marks[:-5]), "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"))
    assert all(r.s == (None if r.t is None else r.t.strip()) for r in df.collect())
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_salary_hint_passes_only_what_may_be_a_range(spark):
    texts = ["- priority 1-URGENT", "5 to ten", "90k to 120k", "Pay: 5,000 - USD 9,000", "20,000–EUR\n30,000"]
    got = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").rlike(X._RANGE_HINT).alias("h")).collect()}
    assert got == dict(zip(texts, [False, False, True, True, True]))
