"""Quality rules whose cutoffs are chosen under a bound on falsely rejected documents.

A rule rejects a document whose feature lies above a cutoff. Labelled documents are split by a hash of their id: one half fits,
the other is the holdout. Words that mark toxic documents are learned from the fitting half. In every stratum the cutoffs of the
other six rules form one sequence, those that reject the fewest good documents of the fitting half first, and the holdout tests
it in that order: a step is taken as long as the exact (Clopper-Pearson) upper bound on the share of good documents that all steps
so far reject together stays within the allowed risk. A fixed order needs no correction over its steps. The toxic-word rule has a
sequence and half of risk and error level of its own; strata share the error level (Bonferroni). Strata whose labels could not
pass a single step are tested together as one; a stratum without good labels is judged by the base rules only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import small_batches
from postweave.session import pin

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "word_length", "blocked_share")
# Mildest first.
GRIDS = {
    "symbol_share": [0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.075, 0.05, 0.04, 0.03, 0.02, 0.01],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeat_share": [0.18, 0.15, 0.12, 0.1, 0.08, 0.06, 0.04],
    "upper_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "mark_share": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25],
    "word_length": [60.0, 40.0, 30.0, 25.0, 20.0, 17.5, 15.0, 12.5, 11.0, 10.0],
    "blocked_share": [0.1, 0.05, 0.02, 0.01, 0.005, 0.002, 0.0],
}
TOXIC = "blocked_share"
WINDOW = 5
FEATURES = pa.struct([(c, pa.int64()) for c in COUNTS] + [(s, pa.float64()) for s in SHARES])
_MARKS = re.compile(r"[!?|*~^_=+<>]")
_LETTERS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in windows of five found twice or more, each word once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    # Equal hashes are compared as words.
    groups: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(twice).tolist():
        groups.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    covered = np.zeros(len(words), bool)
    for at in groups.values():
        if len(at) > 1:
            for i in at:
                covered[i : i + WINDOW] = True
    return int(covered.sum())


def measure(text: str | None, blocked: frozenset[bytes] = frozenset()) -> tuple:
    """Counts and shares of one text, in the order of COUNTS and SHARES."""
    text = text or ""
    data = text.encode()
    words = data.split()
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    seen: set[bytes] = set()
    lines = dups = 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dups += 1
            seen.add(line)
    repeated = _repeated(words)
    n = len(words)
    bad = 0
    if blocked:
        plain = data.lower().translate(_LETTERS).split()
        if not blocked.isdisjoint(plain):
            bad = sum(w in blocked for w in plain)
    upper = sum(map(data.count, map(bytes, zip(range(65, 91)))))
    return (
        n, chars, symbols, dups, repeated,
        symbols / max(chars, 1), dups / max(lines, 1), repeated / max(n, 1), upper / max(chars, 1),
        len(_MARKS.findall(text)) / max(n, 1), chars / max(n, 1), bad / max(n, 1),
    )


def features(text: Column, blocked: Sequence[str] = ()) -> Column:
    """Struct of the counts and shares of a text; null counts as the empty text."""
    words = frozenset(w.encode() for w in blocked)

    @F.arrow_udf(returnType=_ddl())
    def run(batch: pa.Array) -> pa.Array:
        rows = [measure(x.as_py(), words) for x in batch]
        columns = list(zip(*rows)) if rows else [()] * len(FEATURES)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FEATURES)], fields=list(FEATURES))

    # Marked so, a filter on what it gives is not pushed below it, where it would run a second time.
    return run.asNondeterministic()(text)


def _ddl() -> str:
    return "struct<" + ",".join([f"{c}:bigint" for c in COUNTS] + [f"{s}:double" for s in SHARES]) + ">"


def stratum(lang: Column) -> Column:
    """Two lower-case letters of the language, else 'other': 677 strata at most."""
    code = F.regexp_extract(F.lower(F.coalesce(lang, F.lit(""))), "^[a-z]{2}", 0)
    return F.when(code == "", "other").otherwise(code)


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest share under which k or fewer of n are not rarer than error."""
    if k >= n:
        return 1.0

    def tail(p: float) -> float:
        a, b = math.log(p), math.log1p(-p)
        return math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * a + (n - i) * b) for i in range(k + 1)
        )

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if 0 < mid < 1 and tail(mid) > error:
            low = mid
        else:
            high = mid
    return high


def _one_label(labels: DataFrame) -> DataFrame:
    """One row per labelled document: good if every label of it says so."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(((F.min("quality") == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)).alias("good"), F.max("toxic").alias("toxic"))
        .select("doc_id", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    )


def _fitting(doc_id: Column) -> Column:
    """Is the labelled document of the half that rules are fitted on, and not of the holdout?"""
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(2)) == 0


def blocked_words(docs: DataFrame, labels: DataFrame, sample: int = 20_000, least: float = 0.5, error: float = 0.05, size: int = 1000) -> list[str]:
    """Words that mark toxic documents, learned from at most `sample` labelled documents of the fitting half (those of least hash).

    A word is taken if the exact lower bound on the share of toxic documents among those holding it is over `least`, with the
    error level shared by all words tried; of these the `size` that most toxic documents hold.
    """
    chosen = _one_label(labels).where(_fitting(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    words = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("toxic", F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "), " "))).alias("word"))
        .where(F.length("word") > 2)
        .groupBy("word").agg(F.sum(F.lit(1)).alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("k"))
    )
    words = pin(words)
    level = error / max(words.count(), 1)
    # Even if all k documents are toxic, the bound passes `least` only from this k on.
    enough = math.ceil(math.log(level) / math.log(least))
    rows = words.where((F.col("k") >= enough) & (F.col("k") > least * F.col("n"))).orderBy(F.desc("k"), "word").limit(size).collect()
    return sorted(r["word"] for r in rows if 1 - upper_bound(r["n"] - r["k"], r["n"], level) > least)


def _passed(steps: int, rejected: dict[int, int], n: int, level: float, allowed: float) -> int:
    """How many steps pass in order; rejected: documents by the step that rejects them first."""
    k, known = 0, None
    for step in range(steps):
        more = rejected.get(step, 0)
        if more or known is None:
            k, known = k + more, upper_bound(k + more, n, level)
        if known > allowed:
            return step
    return steps


def calibrate(measured: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per stratum with a cutoff for each rule (infinite where none is safe).

    Of good documents of a stratum, all rules together reject at most a share of `risk`; the chance that this fails anywhere is
    at most `error`. Strata of few labels are one stratum here. measured: doc_id, stratum and the shares. Labels of unknown
    documents and null labels count for nothing.
    """
    good = _one_label(labels).where("good").select("doc_id", _fitting(F.col("doc_id")).alias("fitting"))
    labelled = pin(measured.select("doc_id", "stratum", *SHARES).join(good, "doc_id"))
    tried = [
        F.sum((F.col("fitting") & (F.col(s) > c)).cast("long")).alias(f"{s}_{i}") for s in SHARES for i, c in enumerate(GRIDS[s])
    ]
    # At most 677 rows.
    rows = labelled.groupBy("stratum").agg(F.sum((~F.col("fitting")).cast("long")).alias("n"), *tried).collect()
    level, allowed = error / 2 / max(len(rows), 1), risk / 2
    enough = math.log(level) / math.log1p(-allowed)
    # Which strata are pooled depends on their numbers of labels alone.
    pools: dict[str | None, list] = {}
    for r in rows:
        pools.setdefault(r["stratum"] if r["n"] >= enough else None, []).append(r)
    paths, places = {}, []
    for pool, members in pools.items():
        cost = {(s, i): sum(r[f"{s}_{i}"] for r in members) for s in SHARES for i in range(len(GRIDS[s]))}
        paths[pool] = sorted((x for x in cost if x[0] != TOXIC), key=lambda x: (cost[x], x[1], SHARES.index(x[0])))
        place = {x: k for k, x in enumerate(paths[pool])} | {(TOXIC, i): i for i in range(len(GRIDS[TOXIC]))}
        # Place of the first step of a rule that rejects a document by how many cutoffs of the rule it stays under.
        of = [[place.get((s, i), len(cost)) for i in range(len(GRIDS[s]) + 1)] for s in SHARES]
        places += [(r["stratum"], *of) for r in members]
    out = []
    if places:
        ddl = "stratum string, " + ", ".join(f"at_{s} array<int>" for s in SHARES)
        sent = F.broadcast(measured.sparkSession.createDataFrame(places, ddl))
        first = {s: F.element_at(f"at_{s}", sum((F.col(s) <= c).cast("int") for c in GRIDS[s]) + F.lit(1)) for s in SHARES}
        held = labelled.where(~F.col("fitting")).join(sent, "stratum").select("stratum", F.least(*[first[s] for s in SHARES if s != TOXIC]).alias("others"), first[TOXIC].alias("toxic"))
        # At most 64 x 8 rows per stratum.
        counts = held.groupBy("stratum", "others", "toxic").count().collect()
        for pool, members in pools.items():
            names, n = {r["stratum"] for r in members}, sum(r["n"] for r in members)
            cuts = dict.fromkeys(SHARES, math.inf)
            for rule, path in (("others", paths[pool]), ("toxic", [(TOXIC, i) for i in range(len(GRIDS[TOXIC]))])):
                rejected: dict[int, int] = {}
                for r in counts:
                    if r["stratum"] in names:
                        rejected[r[rule]] = rejected.get(r[rule], 0) + r["count"]
                for s, i in path[: _passed(len(path), rejected, n, level, allowed)]:
                    cuts[s] = GRIDS[s][i]
            out += [(name, *cuts.values()) for name in sorted(names)]
    schema = "stratum string, " + ", ".join(f"max_{s} double" for s in SHARES)
    return measured.sparkSession.createDataFrame(pd.DataFrame(out, columns=["stratum", *(f"max_{s}" for s in SHARES)]) if out else [], schema)


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed and kept. cutoffs has 677 rows at most."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = [F.col(s) <= F.coalesce(f"max_{s}", F.lit(math.inf)) for s in SHARES]
    fine = passes[0]
    for p in passes[1:]:
        fine = fine & p
    return (
        measured.join(F.broadcast(cutoffs), "stratum", "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & fine)
        .drop(*(f"max_{s}" for s in SHARES))
    )


def measured_docs(docs: DataFrame, blocked: Sequence[str] = ()) -> DataFrame:
    """doc_id, stratum and the measured columns of every document."""
    return small_batches(docs).select("doc_id", stratum(F.col("lang")).alias("stratum"), features(F.col("text"), blocked).alias("q")).select(
        "doc_id", "stratum", "q.*"
    )


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, kept.

    Null or empty texts have no words and fail the base rules. Repeated rows are judged alike, each for itself. A null language
    falls into the stratum 'other'. Empty labels leave only the base rules. Other columns of docs are not read.
    """
    measured = pin(measured_docs(docs, blocked_words(docs, labels)))
    return judge(measured, calibrate(measured, labels, risk, error)).select("doc_id", *COUNTS, "base_failed", "kept", "stratum", *SHARES)


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """The rows of docs, all columns unchanged, that the rules keep."""
    blocked = blocked_words(docs, labels)
    cutoffs = calibrate(pin(measured_docs(docs, blocked)), labels, risk, error)
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), stratum(F.col("lang")).alias("stratum"), features(F.col("text"), blocked).alias("q"))
    return judge(row.select("row", "stratum", "q.*"), cutoffs).where("kept").select("row.*")
