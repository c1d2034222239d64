"""One pass for many names: equal to one search per name, also where names overlap or hold each other."""

from __future__ import annotations

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postweave.functions import extract as X
from postweave.functions.names import names_in

NAMES = ["go", "Django", "a", "ab", "abc", "bcd", "c++", "C#", "R", "x.y", "é", "日本", "aa", "GO"]


def expected(text, names):
    return [n for n in names if n and n.lower() in text.lower()]


def test_equal_to_a_search_per_name(spark):
    rows = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet="abcdgonj+#.xyré日本 ÉR\n$\\", max_size=25))
    def collect(t):
        rows.append(t)

    collect()
    rows += ["", "abcd", "DJANGO", "cssass", "aaa" * 5_000]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select("t", names_in(F.col("t"), NAMES).alias("n")).collect()
    assert all(r.n == expected(r.t, NAMES) for r in got) and len(got) == len(rows)
    assert spark.createDataFrame([(None,)], "t string").select(names_in(F.col("t"), NAMES).alias("n")).first().n is None
    assert spark.createDataFrame([("x",)], "t string").select(names_in(F.col("t"), [""]).alias("n")).first().n == []


def test_the_fixed_skills(spark):
    text = "; ".join(X.SKILLS[::2]) + "\nJavaScript, cssass and NoSQL"
    row = spark.createDataFrame([(text,)], "t string").select(names_in(F.col("t"), X.SKILLS).alias("a"), X.skills(F.col("t")).alias("b")).first()
    assert row.a == row.b


def test_five_thousand_names(spark):
    names = [f"tool {i * 7919 % 100_003}" for i in range(5_000)] + ["x" * 3_000]
    text = f"a {names[3]} b {names[4_999].upper()} c" + "x" * 3_000
    row = spark.createDataFrame([(text,)], "t string").select(names_in(F.col("t"), names).alias("n")).first()
    assert row.n == expected(text, names) and names[5_000] in row.n
