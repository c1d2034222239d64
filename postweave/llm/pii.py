"""Personal data in texts: fixed patterns, and identifiers that stand in the same contexts; DataFrame functions only.

The fixed patterns give the base spans. They are also the seeds of a bootstrap: the one or two words before a seed are lexical
patterns. A pattern's confidence for a kind is the share of all its occurrences in the corpus that are followed by a known
instance of that kind; an instance's is that of its patterns combined. Confident patterns find further tokens with digits, and
confident tokens become known instances of the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from postweave.session import pin

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that a search takes linear time and constant stack: runs are possessive, and a match begins
# where a run begins (or, for emails, where the last match ended). A card's chain of digits is matched whole or not at all.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
CONTEXT_CHARS = 200
SUPPORT, PATTERN_CONFIDENCE, INSTANCE_CONFIDENCE, ROUNDS = 5, 0.7, 0.9, 3
KEY = ["doc_id", "tkey"]


def _pieces(kind: str) -> Column:
    """Matches of a pattern in order: kind, value, length of the text before it since the last match, and the end of that text."""
    text = F.col("text")
    pattern = F.lit(PATTERNS.get(kind, TOKEN))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS.get(kind, TOKEN), -1)
    rows = F.zip_with(
        found, F.slice(gaps, 1, F.size(found)),
        lambda v, g: F.struct(F.lit(kind).alias("kind"), v.alias("value"), F.length(g).alias("gap"), F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS).alias("tail")),
    )
    may = text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")
    return F.when(may, rows).otherwise(F.array().cast("array<struct<kind:string,value:string,gap:int,tail:string>>"))


def _valid() -> Column:
    """Does a match pass the further conditions of its kind?"""
    digits = F.regexp_replace("value", "[^0-9]", "")
    # A part is at most 255, however many zeros lead it.
    parts = F.forall(F.split("value", r"\."), lambda p: p.rlike("^0*(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0
    return (
        F.when(F.col("kind") == "ip", parts).when(F.col("kind") == "card", luhn)
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15)).otherwise(F.lit(True))
    )


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, kind, value, start, end, tail) of all matches, kind 'token' for tokens with a digit; repeated rows once."""
    pieces = F.concat(*[_pieces(k) for k in (*KINDS, "token")])
    rows = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("tkey"), "text").select(*KEY, F.posexplode(pieces).alias("nth", "m"))
    rows = rows.select(*KEY, "nth", "m.*").dropDuplicates([*KEY, "nth"])
    run = Window.partitionBy(*KEY, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(run)
    rows = rows.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("value"))
    return rows.where(_valid()).select(*KEY, "kind", "value", "start", "end", "tail")


def _contexts(rows: DataFrame) -> DataFrame:
    """A row per occurrence and pattern: the word before it, and the two words before it; lower case."""
    words = F.filter(F.split(F.lower("tail"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The value stands apart from the word before it, else that is no word of its own.
    apart = F.col("tail").rlike(r"[\x20\x09-\x0D]$")
    n = F.size("words")
    one = F.when(n >= 1, F.element_at("words", -1))
    two = F.when(n >= 2, F.concat_ws(" ", F.element_at("words", -2), F.element_at("words", -1)))
    return (
        rows.where(apart).withColumn("words", words).withColumn("pattern", F.explode(F.array(one, two))).where("pattern IS NOT NULL").drop("words", "tail")
    )


def _occurrences(docs: DataFrame, patterns: DataFrame, most: int) -> DataFrame:
    """(pattern, total): how often each pattern is followed by any token, over all texts."""
    wanted = F.broadcast(patterns) if patterns.count() <= most else patterns
    words = F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = docs.where("text IS NOT NULL").select(words.alias("w"))
    ones = texts.select(F.explode(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))).alias("pattern"))
    pairs = texts.where(F.size("w") > 2).select(F.explode(F.zip_with(F.slice("w", 1, F.size("w") - 2), F.slice("w", 2, F.size("w") - 2), lambda a, b: F.concat_ws(" ", a, b))).alias("pattern"))
    return reduce(DataFrame.union, [x.join(wanted, "pattern") for x in (ones, pairs)]).groupBy("pattern").agg(F.count("*").alias("total"))


def _bootstrap(docs: DataFrame, base: DataFrame, tokens: DataFrame, support: int, pattern_confidence: float, instance_confidence: float, rounds: int, most: int) -> DataFrame | None:
    """(value, kind) of further instances, or None. tokens: tokens with digits apart from base spans."""
    seeds = _contexts(base).select("pattern", "kind", "value")
    free = pin(_contexts(tokens).select("pattern", "value"))
    new = None
    for _ in range(rounds):
        known = seeds if new is None else seeds.union(free.join(new, "value").select("pattern", "kind", "value"))
        # Pre-aggregated: one row per pattern, kind and value, then per pattern and kind.
        per = known.groupBy("pattern", "kind", "value").agg(F.count("*").alias("n")).groupBy("pattern", "kind").agg(F.count("*").alias("instances"), F.sum("n").alias("n"))
        induced = pin(per.where(F.col("instances") >= support))
        # Only patterns before tokens that are not known yet can find any.
        useful = pin(induced.join(free.select("pattern").distinct(), "pattern", "left_semi").select("pattern").distinct())
        if useful.isEmpty():
            break
        total = _occurrences(docs, useful, most)
        good = induced.join(total, "pattern").withColumn("confidence", F.col("n") / F.col("total")).where(F.col("confidence") >= pattern_confidence)
        good = good.select("pattern", "kind", F.least("confidence", F.lit(0.999)).alias("confidence"))
        # An instance's confidence: that not all of its distinct patterns are wrong.
        edges = free.distinct().join(good, "pattern")
        scored = edges.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("confidence")).where(F.col("confidence") >= instance_confidence)
        best = scored.groupBy("value").agg(F.max(F.struct("confidence", "kind")).alias("best")).select("value", F.col("best.kind").alias("kind"))
        best = pin(best)
        grown = best.count()
        if not grown or (new is not None and grown == new.count()):
            new = best if grown else new
            break
        new = best
    return new


def pii_spans(
    docs: DataFrame, support: int = SUPPORT, pattern_confidence: float = PATTERN_CONFIDENCE, instance_confidence: float = INSTANCE_CONFIDENCE,
    rounds: int = ROUNDS, most: int = 200_000,
) -> DataFrame:
    """One row per row of docs: doc_id, n_<kind> for the four kinds, base (array of kind, start, end), found (the same with those found).

    Positions are code points, ends exclusive. Found spans have the kind 'like_<kind>' and do not touch base spans. Null texts have
    none. Repeated rows get equal results. Up to `most` patterns are sent to all tasks, more are joined by shuffles.
    """
    every = pin(_found(docs))
    base, tokens = every.where("kind <> 'token'"), every.where("kind = 'token' AND length(value) >= 5")
    b = base.select(*[F.col(c).alias(f"b_{c}") for c in (*KEY, "start", "end")])
    touch = (F.col("doc_id").eqNullSafe(F.col("b_doc_id"))) & (F.col("tkey") == F.col("b_tkey")) & (F.col("start") < F.col("b_end")) & (F.col("end") > F.col("b_start"))
    tokens = pin(tokens.join(b, touch, "left_anti"))
    new = _bootstrap(docs, base, tokens, support, pattern_confidence, instance_confidence, rounds, most)
    spans = base.select(*KEY, "kind", "start", "end")
    if new is not None:
        found = tokens.drop("kind").join(new, "value").select(*KEY, F.concat(F.lit("like_"), "kind").alias("kind"), "start", "end")
        spans = spans.union(found)
    kinds = [*KINDS, *(f"like_{k}" for k in KINDS)]
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    per = spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans"))
    per = per.select(F.col("doc_id").alias("p_doc_id"), F.col("tkey").alias("p_tkey"), "spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("tkey")).join(per, F.col("doc_id").eqNullSafe(F.col("p_doc_id")) & (F.col("tkey") == F.col("p_tkey")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"))
    plain = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = rows.select("doc_id", spans.alias("spans"))
    return rows.select(
        "doc_id", *[F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        plain(F.filter("spans", lambda s: s["rank"] <= len(KINDS))).alias("base"), plain(F.col("spans")).alias("found"),
    )


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
