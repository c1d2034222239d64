"""Ranked search, hard negatives and toxicity against plain versions."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postweave.llm import lexical, negatives, toxicity
from postweave.llm.best import Best
from tests.llm.fixtures import DOCS, alnum, awkward, clashing

ITEMS = "item_id long, text string"


# --- Ranked search.

def plain_ranking(docs, items, top=50):
    texts = [(d, Counter(alnum(t))) for d, t in docs if alnum(t)]
    n, length = len(texts), sum(sum(c.values()) for _, c in texts)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(alnum(t))
    df = Counter(t for _, c in texts for t in c)
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, c in texts:
            m = 50 + 50 * sum(c.values()) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


SEARCHED = [
    (1, "the data of Straße 42"), (2, "x1 x2 x3, x4; naïve5"), (2, "blue7 GREEN7 blue7"), (3, None), (4, ""), (5, " ?! "), (None, "the data"),
    (6, "nowhere-to-be-found"), (7, "W12 w13 w14"), (8, "K 😀"), (9, "run1 run2 word3 is the data3 é4"), (10, "x" * 20_000),
]


@pytest.mark.parametrize("block,top", [(lexical.BLOCK, 50), (4_000, 3)])
def test_ranking_equals_a_plain_one(spark, block, top):
    rows = awkward()
    docs = clashing(spark.createDataFrame(rows, DOCS)).repartition(5)
    got = lexical.ranked_search(docs, clashing(spark.createDataFrame(SEARCHED, ITEMS)), top, block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_ranking([r[:2] for r in rows], SEARCHED, top)


def test_terms_are_whole_and_overlap(spark):
    texts = [(1, "ab abc bc c"), (2, "abab"), (3, "AB,ab.ab\x00c"), (4, "a b c")]
    items = [(1, "ab"), (2, "abc bc"), (3, "c ab b")]
    got = lexical.ranked_search(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, got.collect())) == sorted(plain_ranking(texts, items))
    size, found, n = lexical.Automaton(["ab", "b", "c"]).counts("AB,ab.ab\x00c cc")
    assert (size, found.tolist(), n.tolist()) == (5, [0, 2], [3, 1])


def test_equal_scores_come_by_id_and_repeated_rows_count(spark):
    texts = [(i, "same words here") for i in (9, 3, 3, 7, None)] + [(1, "other")]
    got = lexical.ranked_search(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([("q", "words")], "item_id string, text string"), top=4)
    assert [(r["rank"], r["doc_id"]) for r in got.orderBy("rank").collect()] == [(1, 3), (2, 3), (3, 7), (4, 9)]


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame(awkward()[:5], DOCS), spark.createDataFrame(SEARCHED, ITEMS)
    for a, b in ((docs.where("false"), items), (docs, items.where("false"))):
        got = lexical.ranked_search(a, b)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_best_keeps_what_a_sort_keeps():
    rnd = np.random.default_rng(4)
    group, score, key = rnd.integers(0, 7, 5000), rnd.integers(-9, 9, 5000), rnd.integers(0, 300, 5000)
    best = Best(8, 6)
    for i in range(0, 5000, 100):
        best.add(group[i : i + 100], score[i : i + 100], key[i : i + 100])
        if i % 700 == 0:
            best.fold()
    got = sorted(zip(*(x.tolist() for x in best.fold())))
    want = [e for g in range(8) for e in sorted(zip(group.tolist(), score.tolist(), key.tolist()), key=lambda e: (e[0], -e[1], e[2])) if e[0] == g]
    want = sorted(e for _, es in itertools.groupby(want, key=lambda e: e[0]) for e in list(es)[:6])
    assert got == want


# --- Hard negatives.

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows):
    pool = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            pool.append((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    first = lambda scored, k: sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
    out = []
    for a in {p for p in pool if p[0] is not None and p[0] % 100 == 0}:
        scored = [(sum(x * y for x, y in zip(a[2], p[2])), p[0], p[1]) for p in pool]
        for ps, pid, _ in first([s for s in scored if s[2] == a[1] and s[1] != a[0]], 5):
            hard = first([s for s in scored if s[2] != a[1] and 80 * ps <= 100 * s[0] <= 100 * ps], 5)
            out += [(a[0], pid, r + 1, nid, ps, ns) for r, (ns, nid, _) in enumerate(hard)]
    return sorted(out, key=repr)


def vectors(seed, n, dim=6, spread=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.randint(-1, spread) / 4 for _ in range(dim)], rnd.randint(0, 3)) for i in range(n)]
    return [(i * 20, v, k) for i, v, k in rows[: n // 2]] + rows[n // 2 :]


@pytest.mark.parametrize("block_bytes", [negatives.BLOCK_BYTES, 500])
def test_negatives_equal_plain_ones(spark, block_bytes):
    odd = [
        (100, None, 1), (200, [1.0, None], 1), (300, [float("nan")] * 3, 1), (None, [0.5] * 6, 2), (None, [0.5] * 6, 0), (400, [0.5] * 6, None), (500, [], 2),
        (600, [0.25] * 9, 3), (700, [float("inf")], 0), (-100, [-0.5] * 6, 1), (800, [0.0] * 6, 2), (3, [0.5] * 6, 1), (3, [0.5] * 6, 1),
    ]
    rows = vectors(1, 80) + odd
    rows += [r for r in rows[:6]]
    df = clashing(spark.createDataFrame(rows, VECTORS)).withColumns({c: F.lit(1) for c in ("anchor", "place", "slot", "score", "vector")})
    got = negatives.hard_negatives(df.repartition(3), block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_negatives(rows)


def test_negatives_of_large_numbers_and_of_one_label(spark):
    rows = [(100 * i, [float(3**i) * 10, 1.0], i % 2) for i in range(12)]
    assert sorted(map(tuple, negatives.hard_negatives(spark.createDataFrame(rows, VECTORS)).collect()), key=repr) == plain_negatives(rows)
    alone = [(i * 100, [1.0, 2.0], 4) for i in (1, 2, 3, 4, 5, 6)]
    assert negatives.hard_negatives(spark.createDataFrame(alone, VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    # Numbers of more than 64 bits become the nearest of 64.
    huge = np.array([[1e25, 0.0]])
    assert negatives.products(huge, np.array([[1e25, 1.0], [-1e25, 1.0]])).tolist() == [[2**63 - 1, 1 - 2**63]]


# --- Toxicity.

def model_of(*texts):
    full = Counter()
    for t in texts:
        k = toxicity.letter_classes(t).tolist()
        full.update(tuple(k[i : i + 4]) for i in range(len(k) - 3))

    class Counts:
        def toArrow(self):
            import pyarrow as pa

            return pa.table({"gram": [((a * 28 + b) * 28 + c) * 28 + d for a, b, c, d in full], "n": list(full.values())})

    return toxicity.letter_model(Counts())


PLAIN = "you are an idiot and a moron of the worst kind stupid clown said the loser to all of them " * 20 + "the data of the day is in the house " * 30


def likeliest(model, word):
    """The best way through the lattice by trying all."""
    best = None
    for way in itertools.product(*toxicity.lattice(word)):
        total, state = sum(c for _, c in way), 0
        for c in "".join(x for x, _ in way) + " ":
            k = toxicity._class_of(c)
            if k or state % 28:
                total += float(model[state * 28 + k])
                state = (state * 28 + k) % 28**3
        best = total if best is None else max(best, total)
    return best


def test_decoding_finds_the_likeliest_way():
    model = model_of(PLAIN)
    restorer = toxicity.Restorer(model)
    for word in ("1d10t", "m0r0n", "5tup1d", "cl*wn", "s.t.u", "i d i", "1055er", "aa!!", "$$$", "x", "..", "é1é", "m--0"):
        got = restorer.decode(toxicity.lattice(word))
        # The found way has the cost of the best one: spelled alone it can only be as good.
        nodes = toxicity.lattice(word)
        ways = [w for w in itertools.product(*nodes) if "".join(x for x, _ in w) == got]
        costs = []
        for way in ways:
            total, state = sum(c for _, c in way), 0
            for c in got + " ":
                k = toxicity._class_of(c)
                if k or state % 28:
                    total += float(model[state * 28 + k])
                    state = (state * 28 + k) % 28**3
            costs.append(total)
        assert max(costs) == pytest.approx(likeliest(model, word)), word


def test_disguised_words_are_restored():
    restorer = toxicity.Restorer(model_of(PLAIN))
    for written in ("1d10t", "id!ot", "i d i o t", "I.D.I.O.T", "iiidiooot", "i-d-i-o-t!", "!diot"):
        assert restorer.text(f"an {written} and") == "an idiot and", written
    assert restorer.text("The data, of 2024: (day)") == "the data of 2024 day"
    assert restorer.text(None) == restorer.text(" \n") == ""
    # Words of one sign, of signs only, and very long ones; a piece never meets the next.
    assert restorer.text("|| ### 42") == "|| ### 42"
    assert len(restorer.text("1l" * 500_000)) > 400_000


def test_model_is_a_chance():
    chance = 10 ** model_of(PLAIN, "", None).astype(float).reshape(-1, 28)
    assert np.allclose(chance.sum(axis=1), 1, atol=1e-4) and (chance > 0).all()


def test_grams_and_lookup():
    got = toxicity.grams("ab cd")
    read = {int(g & (2**56 - 1)).to_bytes(8, "big")[-(int(g) >> 56) :].decode() for g in got}
    text = " ab cd "
    assert read == {text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1) if " " not in text[i + 1 : i + n - 1]}
    kept = np.sort(np.unique(toxicity.grams("what is to be found here")))
    find = toxicity.Lookup(kept)
    other = toxicity.grams("found elsewhere is not here what")
    assert find(other).tolist() == sorted({kept.tolist().index(x) for x in other.tolist() if x in kept.tolist()})
    assert toxicity.Lookup(np.zeros(0, np.int64))(other).tolist() == [] and toxicity.grams("").tolist() == []


def _texts(seed, n):
    rnd = random.Random(seed)
    words = ["house", "data", "river", "of", "the", "walking", "green", "always", "number", "under"]
    rude = ["idiot", "moron", "stupid", "loser"]
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.3
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            text.insert(rnd.randint(0, len(text)), rnd.choice(rude))
        docs.append((i, " ".join(text), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxic_texts_are_told_from_others(spark):
    docs, labels = _texts(3, 400)
    leet = str.maketrans("ios", "10$")
    hidden = [(1000 + i, t.translate(leet) if k else t, "en", "a", 0) for (i, t, *_), (_, _, k) in zip(docs[:40], labels)]
    odd = [(None, "idiot", None, None, None), (5000, None, None, None, None), (5001, "", None, None, None), docs[0], (5002, "idiot " * 50_000, None, None, None), (5003, "x" * 1_000_000, "", "", 1)]
    more = [(i, None, None) for i in (1, 2)] + [(None, 1, 1), (10**9, 1, 1), (0, 1, labels[0][2])]
    df = clashing(spark.createDataFrame(docs + hidden + odd, DOCS)).withColumns({c: F.lit(1) for c in ("toxic", "restored", "score", "held_out")})
    got = toxicity.toxicity(df, clashing(spark.createDataFrame(labels + more, LABELS)))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(docs) + len(hidden) + len(odd)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    by = {r["doc_id"]: r["predicted"] for r in rows}
    unseen = [(i, k) for i, _, k in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(by[i] == k for i, k in unseen)
    # Disguises are rare beside the plain words here; as common as these, the character model takes them for words of their own.
    assert sum(by[1000 + i] == k for i, _, k in labels[:40]) >= 38
    assert by[None] == by[5002] == 1 and by[5000] == by[5001] == by[5003] == 0


def test_labels_of_held_out_ids_and_other_columns_do_not_matter(spark):
    docs, labels = _texts(4, 150)
    turned = [(i, 1, 1 - k) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, 1, k) for i, _, k in labels]
    other = [(i, t, "de", f"s{i % 3}", 9) for i, t, *_ in docs]
    read = lambda d, x: sorted(map(tuple, toxicity.toxicity(spark.createDataFrame(d, DOCS), spark.createDataFrame(x, LABELS)).collect()))
    assert read(docs, labels) == read(other, turned)


def test_toxicity_without_labels_or_texts(spark):
    docs, labels = spark.createDataFrame(_texts(5, 20)[0], DOCS), spark.createDataFrame(_texts(5, 20)[1], LABELS)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == 20 and {r["score"] for r in none} == {0.5}
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_restored_texts(spark):
    docs = clashing(spark.createDataFrame([(1, PLAIN * 50, "en", "a", 1), (2, "an 1d10t", "en", "a", 1), (3, None, None, None, None)], DOCS))
    got = {r["doc_id"]: r["restored"] for r in toxicity.restore(docs).collect()}
    assert got[2] == "an idiot" and got[3] == ""
