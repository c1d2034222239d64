"""Toxic texts, seen through the noise they are written in.

A written text is taken as a noisy copy of a plain one: letters are replaced by look-alike digits and signs, repeated, or set apart
by blanks and points. Every word that may be such a copy becomes a lattice of what each sign can stand for, and the likeliest way
through it (Viterbi) under a character model of the corpus is its restored form. The restored texts are scored: letter n-grams that
toxic training texts hold much more often than others are the features of a logistic regression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import small_batches, stored
from postweave.session import pin

# What digits and signs can stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "€": "e", "£": "l", "¢": "c",
}
# Signs that may be put between the letters of a word.
BETWEEN = frozenset(".,-_*'~^/\\:;#%&=`´·")
# Logarithms (base 10) of what the channel does to a sign: replaces it, repeats it, puts a sign beside it.
REPLACED, REPEATED, INSERTED = -0.7, -0.5, -0.7
# Signs of a lattice; a longer word is decoded in pieces of this many.
PIECE = 64
# Classes of the character model: no letter, a to z, other letters and digits; and how many of them make a state with the next one.
CLASSES, ORDER = 28, 4
_STATES = CLASSES ** (ORDER - 1)
# Sizes in bytes of the letter n-grams that are features; blanks stand at their ends only.
SIZES = (4, 5, 6, 7)
FEATURES = 1_000
CANDIDATES = 100_000
# Labelled texts of either kind that the regression is fitted on.
SAMPLE = 3_000
THRESHOLD = 0.7
# A missed toxic text weighs as much as so many false alarms.
COST = 3
_EDGE = ".,;:!?\"'()[]{}»«„“”…"
_APART = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")
_ODD = re.compile(r"[^a-zª-￿\U00010000-\U0010ffff]|([a-z])\1\1")
_LETTER = re.compile(r"[a-z]")


def held_out(doc_id: Column) -> Column:
    """Is the remainder of crc32 of the id as text by 3 one? A document without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --- The character model.

_CLASS = np.zeros(256, np.int32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = _CLASS[192:] = CLASSES - 1


def letter_classes(text: str | None) -> np.ndarray:
    """Classes of the characters of a text, three blanks before and one after it; runs of others than letters are one."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    # A character beyond ASCII counts by its first byte.
    kinds = _CLASS[data[(data & 0xC0) != 0x80]]
    kinds = np.concatenate((np.zeros(ORDER - 1, np.int32), kinds, np.zeros(1, np.int32)))
    again = np.zeros(len(kinds), bool)
    again[ORDER - 1 :] = (kinds[ORDER - 1 :] == 0) & (kinds[ORDER - 2 : -1] == 0)
    return kinds[~again]


def letter_counts(docs: DataFrame) -> DataFrame:
    """gram, n: how often each run of four classes stands in the texts; at most 28^4 rows."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**ORDER, np.int64)
        for batch in batches:
            for text in batch.column(0):
                kinds = letter_classes(text.as_py())
                grams = kinds[: len(kinds) - ORDER + 1].copy()
                for i in range(1, ORDER):
                    grams = grams * CLASSES + kinds[i : len(kinds) - ORDER + 1 + i]
                # A short text does not walk over all counts.
                if len(grams) < 10_000:
                    np.add.at(counts, grams, 1)
                else:
                    counts += np.bincount(grams, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def letter_model(counts: DataFrame) -> np.ndarray:
    """Logarithm (base 10) of the chance of each class after three others: Witten-Bell mixed with shorter contexts."""
    table = counts.toArrow()
    full = np.zeros(CLASSES**ORDER)
    full[table["gram"].to_numpy()] = table["n"].to_numpy()
    chance = np.full(CLASSES, 1 / CLASSES)
    for k in range(1, ORDER + 1):
        # Counts of the last k classes of all runs.
        n = full.reshape(-1, CLASSES**k).sum(axis=0).reshape(-1, CLASSES)
        kinds = np.maximum((n > 0).sum(axis=1, keepdims=True), 1)
        lower = np.tile(chance.reshape(-1, CLASSES), (len(n) // max(chance.size // CLASSES, 1), 1))
        chance = ((n + kinds * lower) / (n.sum(axis=1, keepdims=True) + kinds)).ravel()
    return np.log10(chance).astype(np.float32)


# --- The channel.

def _class_of(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else CLASSES - 1 if c.isalnum() else 0


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For every sign (or run of one sign) of a lower-case word, what it can stand for and the logarithm of the chance."""
    nodes = []
    for c, run in groupby(word):
        n = len(list(run))
        if c in LOOKALIKES:
            plain = (c * n, 0.0) if c.isalnum() else (" ", 0.0)
            ways = [plain, *((x, REPLACED + (REPEATED if n > 1 else 0)) for x in LOOKALIKES[c])]
            if n > 1:
                ways += [(2 * x, REPLACED + (REPEATED if n > 2 else 0)) for x in LOOKALIKES[c]]
            if c in BETWEEN:
                ways.append(("", INSERTED))
            nodes.append(ways)
        elif c.isalnum():
            if n == 1:
                nodes.append([(c, 0.0)])
            else:
                nodes.append([(2 * c, REPEATED if n > 2 else 0.0), (c, REPEATED)])
        elif c in BETWEEN or c == " ":
            nodes.append([(" ", 0.0), ("", INSERTED)])
        else:
            nodes.append([(" ", 0.0)])
    return nodes


class Restorer:
    """Restored forms of words and texts under a character model."""

    def __init__(self, model: np.ndarray, remembered: int = 200_000):
        self.model, self.known, self.most = model.tolist(), {}, remembered

    def decode(self, nodes: list[list[tuple[str, float]]]) -> str:
        """The likeliest way through the lattice; of equal ones the first."""
        model, classes = self.model, _class_of
        states: dict[int, tuple[float, str]] = {0: (0.0, "")}
        for ways in [*nodes, [(" ", 0.0)]]:
            after: dict[int, tuple[float, str]] = {}
            for state, (cost, text) in states.items():
                for letters, chance in ways:
                    to, total = state, cost + chance
                    for c in letters:
                        k = classes(c)
                        # Blanks beside each other are one.
                        if k or to % CLASSES:
                            total += model[to * CLASSES + k]
                            to = (to * CLASSES + k) % _STATES
                    old = after.get(to)
                    if old is None or total > old[0]:
                        after[to] = (total, text + letters)
            states = after
        return max(states.values(), key=lambda s: s[0])[1][:-1]

    def _pieces(self, word: str) -> str:
        """The restored form of a word or of letters set apart, piece by piece, with one blank between its parts."""
        nodes = lattice(word)
        parts = [self.decode(nodes[i : i + PIECE]) for i in range(0, len(nodes), PIECE)]
        return " ".join("".join(parts).split())

    def word(self, word: str) -> str:
        """The restored form of one word without blanks, in lower case; a word that leaves no choice stays."""
        found = self.known.get(word)
        if found is None:
            low = word.lower()
            bare = low.strip(_EDGE)
            found = bare
            if _LETTER.search(bare) and (_ODD.search(bare) or low[0] in LOOKALIKES):
                # A sign at the end is rather a mark, one at the beginning may be a letter.
                found = self._pieces(bare if low[0] not in LOOKALIKES else low.rstrip(_EDGE))
            if len(word) <= PIECE:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[word] = found
        return found

    def text(self, text: str | None) -> str:
        """All words of a text restored, one blank between them; letters that stand apart may become words."""
        plain = _APART.sub(lambda m: f" {self._pieces(m[0].lower())} ", " ".join((text or "").split()))
        return " ".join(map(self.word, plain.split()))


# --- The features.

def grams(text: str) -> np.ndarray:
    """Every n-gram of the text as a number: its bytes, and its size in the highest byte; blanks at its ends only."""
    data = np.frombuffer(f" {text} ".encode(), np.uint8)
    blanks = np.concatenate(([0], np.cumsum(data == 32)))
    out, code, held = [], data.astype(np.uint64), 1
    for size in SIZES:
        k = len(data) - size + 1
        if k <= 0:
            break
        while held < size:
            code = (code[:-1] << np.uint64(8)) | data[held:]
            held += 1
        inside = blanks[size - 1 : size - 1 + k] == blanks[1 : 1 + k]
        out.append(code[inside] | np.uint64(size << 56))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


class Lookup:
    """Places of numbers in a sorted list of some; a table of bits spares most look-ups."""

    def __init__(self, kept: np.ndarray):
        self.kept, self.bits = kept, max(16, len(kept).bit_length() + 5)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self._slot(kept)] = True

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The distinct places, ascending, of those of x that are listed."""
        x = np.unique(x[self.maybe[self._slot(x)]])
        if not len(self.kept) or not len(x):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.kept, x), len(self.kept) - 1)
        return at[self.kept[at] == x]


def _in_texts(texts: DataFrame) -> DataFrame:
    """gram, n: number of texts that hold each n-gram."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def folded(parts: list[np.ndarray]) -> pa.RecordBatch:
        gram, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(n, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for text in batch.column(0):
                parts.append(np.unique(grams(text.as_py())))
                held += len(parts[-1])
                if held > 3_000_000:
                    yield folded(parts)
                    parts, held = [], 0
        if parts:
            yield folded(parts)

    return texts.select("restored").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _places(texts: DataFrame, kept: np.ndarray) -> DataFrame:
    """toxic, places: which of the listed n-grams each text holds."""
    schema = pa.schema([("toxic", pa.int32()), ("places", pa.list_(pa.int32()))])
    sent = texts.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(sent.value)
        for batch in batches:
            places = pa.array([find(grams(t.as_py())) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), places], schema=schema)

    return texts.select(F.col("toxic").cast("int").alias("toxic"), "restored").mapInArrow(run, "toxic int, places array<int>")


# --- The regression.

def fitted(places: list[list[int]], toxic: np.ndarray, weights: np.ndarray, features: int, penalty: float = 0.02, rounds: int = 400) -> np.ndarray:
    """Weights of the features and the intercept of a logistic regression with a quadratic penalty (accelerated gradient steps)."""
    x = np.zeros((len(places), features + 1), np.float32)
    for i, p in enumerate(places):
        x[i, p] = 1
    x[:, features] = 1
    share = weights / weights.sum()
    keep = np.full(features + 1, penalty / max(len(places), 1) * 10, np.float32)
    keep[features] = 0
    # A bound on the curvature of the loss by power iteration.
    v = np.ones(features + 1, np.float32)
    for _ in range(20):
        v = x.T @ (share * (x @ v)).astype(np.float32)
        v /= np.linalg.norm(v) or 1
    rate = 1 / (0.25 * float(v @ (x.T @ (share * (x @ v)).astype(np.float32))) + float(keep.max()) + 1e-9)
    w = y = np.zeros(features + 1, np.float32)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ y, -30, 30)))
        step = y - rate * (x.T @ (share * (p - toxic)).astype(np.float32) + keep * y)
        y, w = step + t / (t + 3) * (step - w), step
    return w


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic of the training ids that docs holds; several labels of an id are one, toxic if any of them is."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    one = one.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    return one.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> dict:
    """Character model (of all texts), the n-grams that tell toxic texts, sorted, their weights, and the intercept.

    Features and weights come from `sample` labelled training texts of either kind at most, those whose ids have the least hash; they
    stand for the numbers of all labelled ones. Without texts of both kinds the intercept alone is the model.
    """
    spark = docs.sparkSession
    model = letter_model(letter_counts(docs))
    rows = pin(_labelled(docs, labels))
    found = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = [found.get(k, 0) for k in (0, 1)]
    prior = float(np.log((most[1] + 0.5) / (most[0] + 0.5)))
    bare = {"model": model, "kept": np.zeros(0, np.int64), "weights": np.zeros(0), "intercept": prior}
    if not all(most):
        return bare
    sent = spark.sparkContext.broadcast(model)
    of_kind = [rows.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    # Only ids and labels are sent, 2 x sample at most, and only the texts of these ids are shuffled; of several texts of an id one counts.
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = own.join(F.broadcast(of_kind[0].unionByName(of_kind[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # As many parts as have some work each.
    chosen = chosen.repartition(1 + sum(min(m, sample) for m in most) // 250)
    texts = stored(chosen.select("toxic", _restored(sent)(F.col("text")).alias("restored")), "toxic-sample")
    n0, n1 = (min(m, sample) for m in most)
    # Two texts at least hold what is a sign of anything.
    top = _in_texts(texts.where("toxic = 1")).where(F.col("n") >= max(2, n1 // 500)).orderBy(F.desc("n"), "gram").limit(CANDIDATES).toArrow()
    gram, k1 = top["gram"].to_numpy(), top["n"].to_numpy()
    order = np.argsort(gram)
    gram, k1 = gram[order], k1[order]
    held = _places(texts.where("toxic = 0"), gram).select(F.explode("places").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n")).toArrow()
    k0 = np.zeros(len(gram))
    k0[held["place"].to_numpy()] = held["n"].to_numpy()
    # Twice the log-likelihood ratio of different shares against one share, for n-grams that toxic texts hold more often.
    def told(k, n, p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)
    both = (k0 + k1) / (n0 + n1)
    gain = told(k1, n1, k1 / n1) + told(k0, n0, k0 / n0) - told(k1, n1, both) - told(k0, n0, both)
    gain[k1 / n1 < 2 * k0 / n0] = -1
    best = np.sort(np.argsort(-gain, kind="stable")[:features])
    kept = gram[best[gain[best] > 0]]
    # At most 2 x sample rows of at most `features` places.
    hits = _places(texts, kept).collect()
    toxic = np.array([r["toxic"] for r in hits], np.float32)
    scale = np.where(toxic == 1, COST * most[1] / n1, most[0] / n0)
    w = fitted([r["places"] for r in hits], toxic, scale, len(kept))
    sent.destroy()
    return {"model": model, "kept": kept, "weights": w[:-1].astype(float), "intercept": float(w[-1])}


def _restored(sent):
    @F.arrow_udf(returnType="string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(sent.value)
        for texts in batches:
            yield pa.array([restorer.text(t.as_py()) for t in texts], pa.string())

    return run


def restore(docs: DataFrame) -> DataFrame:
    """docs with a column `restored`: the text as the character model of docs reads it. A null text is restored as an empty one."""
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(letter_model(letter_counts(docs)))
    return docs.withColumn("restored", _restored(sent)(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (1 from a score of `threshold` on).

    Of docs only doc_id and text are read, of labels doc_id and toxic; labels of held-out ids are not read. A null text is an empty
    one, and an empty text has the score of a text without any sign. Repeated rows score alike, each for itself. Labels of ids that
    docs does not hold and null labels count for nothing. Without training texts of both kinds all texts have the share of toxic ones.
    """
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample, features))

    @F.arrow_udf(returnType="double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learned = sent.value
        restorer, find, weights = Restorer(learned["model"]), Lookup(learned["kept"]), learned["weights"]
        for texts in batches:
            sums = [learned["intercept"] + float(weights[find(grams(restorer.text(t.as_py())))].sum()) for t in texts]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(sums, float), -700, 700))), pa.float64())

    # Marked so, the score is computed once for both columns.
    score = scored.asNondeterministic()(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
