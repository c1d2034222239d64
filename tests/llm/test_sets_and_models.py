import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from postweave.llm import jaccard as J
from postweave.llm import lm as M
from postweave.llm import mixing as X
from postweave.llm import tokens as K
from postweave.llm import common
from postweave.llm.components import components
from tests.llm.fixtures import DOCS, awkward, clashing, spaced


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, DOCS)).repartition(3).cache()


# ── Jaccard join ────────────────────────────────────────────────────────────────────────────────

def plain_groups(rows):
    """Smallest id reachable by links, and set sizes, by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = spaced(t)
        sets.append((i, frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])))
    group = list(range(len(sets)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and min(len(x), len(y)) * 100 >= 90 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 90 * (len(x) + len(y) - both):
                    group[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[find(k)].append(i)
    return sorted(((i, len(s), (min(least[find(k)], default=None) if s else i)) for k, (i, s) in enumerate(sets)), key=repr)


def near_copies(n=60, size=80, seed=3):
    """A chain of texts, each a few words from the last, and a hub of copies with one word changed."""
    rng = np.random.default_rng(seed)
    base = [f"t{x}" for x in rng.integers(0, 10_000, size)]
    out = []
    for i in range(n):
        base = list(base)
        base[int(rng.integers(0, size))] = f"c{i}"
        out.append((1000 + i, " ".join(base)))
    hub = [f"h{x}" for x in rng.integers(0, 10_000, size)]
    for i in range(n):
        own = list(hub)
        own[i] = f"z{i}"
        out.append((2000 + i, " ".join(own)))
    shared = " ".join(f"s{k}" for k in range(30))
    out += [(3000 + i, " ".join(f"u{i}v{k}" for k in range(40)) + " " + shared) for i in range(30)]
    out += [(4000 + i, shared) for i in range(5)] + [(5000, shared + " s30"), (5001, "a b c"), (5002, "A B C d"), (5003, "a b"), (5004, "A b")]
    return out


def test_jaccard_against_all_pairs(spark, rows):
    every = [r[:2] for r in rows] + near_copies()
    df = clashing(spark.createDataFrame(every, "doc_id long, text string").repartition(5))
    got = J.jaccard_groups(df)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == plain_groups(every)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    # One row of each group of rows with words stays, and all rows without words.
    groups = got.where("component IS NOT NULL").select("component").distinct().count() + got.where("component IS NULL").count()
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == groups and {1000, 4000, 5003} <= set(ids) and 4001 not in ids
    assert J.jaccard_groups(df.limit(0)).count() == 0


def test_filters_lose_no_similar_pair(spark):
    """The prefix and image filters, held against all similar pairs of random sets."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: max(1, int(len(a) * rng.uniform(0.85, 1)))], rng.integers(0, 2**63, int(rng.integers(0, 8))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        assert set(a[: J._prefix(len(a))].tolist()) & set(b[: J._prefix(len(b))].tolist())
        (*x, fx), (*y, fy) = J.images_of(a), J.images_of(b)
        allowed = len(a) + len(b) - 2 * -(-90 * (len(a) + len(b)) // 190)
        assert sum(((p ^ q) % 2**64).bit_count() for p, q in zip(x, y)) <= allowed
        assert np.abs(np.frombuffer(fx, "<u2").astype(int) - np.frombuffer(fy, "<u2").astype(int)).sum() <= allowed


def test_shingles_met_in_sets_of_other_sizes_only_are_left_out(spark, monkeypatch):
    """A short text in front of a long one that many share: rare shingles meet, but no sets of similar sizes."""
    kept = {}

    def stored(df, name):
        kept[name] = df, common.stored(df, name)
        return kept[name][1]

    monkeypatch.setattr(J, "stored", stored)
    body = " ".join(f"b{k}" for k in range(200))
    rows = []
    for i in range(30):
        head = " ".join(f"h{i}x{k}" for k in range(30))
        rows += [(2 * i, head), (2 * i + 1, f"{head} {body}")]
    rows.append((100, "h0x0 changed " + rows[1][1]))
    got = J.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == plain_groups(rows)
    plan, shared = kept["jaccard-shared"]
    sizes = {r["size"] for r in shared.select("size").distinct().collect()}
    # The one pair of similar sizes is there, the thirty short texts are not.
    assert sizes == {228, 230} and shared.select("node").distinct().count() == 2
    # The texts are read once for them, and a node has one row for a shingle.
    assert plan._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert shared.count() == shared.select("token", "node").distinct().count()


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 120)] + [(200, 201), (201, 200), (300, 300)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    want = {i: 0 for i in range(51)} | {i: 100 for i in range(100, 120)} | {200: 200, 201: 200}
    assert {r.node: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ── mixing ──────────────────────────────────────────────────────────────────────────────────────

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over
        if len(capped) == len(names):
            return {s: 2.0 * sizes[s] for s in names}


def test_mix_meets_targets(spark, docs, rows):
    got = X.mix(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((i, len(spaced(t))) for i, t, *_ in rows), key=repr)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(spaced(t))
    want = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = X.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, ((r.doc_id, r.taken) for r in got))) == sorted(map(repr, ((r.doc_id, r.taken) for r in again)))


def test_mixed_documents_hold_the_words_taken(spark, docs):
    plan = {}
    for r in X.mix(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    mixed = X.mixed(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(spaced(r.text))
    # Repeated rows at a cut share its words evenly, so a few may be left out.
    assert all(abs(words[i] - n) <= 3 for i, n in plan.items())
    assert X.mix(docs.limit(0)).count() == 0 and X.mixed(docs.limit(0)).count() == 0


def test_mix_of_many_sources_and_empty_ones(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 40:02}") for i in range(400)] + [(900, None, "empty"), (901, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(spaced(t))
    want = plain_targets(sizes)
    taken = Counter()
    for r in X.mix(df).collect():
        assert abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_edited_copies_meet_at_their_source(spark, monkeypatch):
    """Copies that are similar to their source only are linked in as many pairs as there are copies, not compared with each other."""
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 5_000, 400)]
    texts = [" ".join(base)]
    for c in range(60):
        own = list(base)
        for x in rng.choice(400, 7, replace=False):
            own[x] = f"c{c}x{x}"
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    asked, verified = [], J._verified
    monkeypatch.setattr(J, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    got = J.jaccard_groups(df, 5, 80, 100).select("doc_id", "component_id").collect()
    assert {r.component_id for r in got} == {0} and sum(asked) <= 180


# ── token shards ────────────────────────────────────────────────────────────────────────────────

@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_slots_are_a_permutation(n):
    assert sorted(K.permute(np.arange(n), n, 9).tolist()) == list(range(n))
    assert n < 64 or K.permute(np.arange(n), n, 9).tolist() != K.permute(np.arange(n), n, 10).tolist()


def read_back(path, layout, start, n):
    import glob

    out = []
    while n:
        shard, byte = layout.place(int(K.permute(np.array([start // layout.seq_len]), layout.n_sequences, layout.seed)[0]))
        at = start % layout.seq_len
        k = min(n, layout.seq_len - at)
        with open(glob.glob(f"{path}/shards/shard={shard}/part-*")[0], "rb") as f:
            f.seek(byte + 2 * at)
            out += np.frombuffer(f.read(2 * k), "<u2").tolist()
        start, n = start + k, n - k
    return out


def test_shards_hold_every_text(spark, docs, rows, tmp_path):
    got, layout = K.materialise(docs, f"{tmp_path}/out", seq_len=64, least_shard=7, seed=3)
    with open(K.TOKENIZER, "rb") as f:
        decode = K._encoder(f.read(), K.PATTERN).decode
    found, slots = [], set()
    for r in got.collect():
        ids = read_back(f"{tmp_path}/out", layout, r.start, r.n_tokens)
        assert not ids or ids[-1] == layout.end_id
        found.append((r.doc_id, decode(ids[:-1]) if ids else ""))
        slots.update((r.start // 64 + k) for k in range(r.n_sequences))
    assert sorted(map(repr, found)) == sorted(repr((i, t or "")) for i, t, *_ in rows)
    assert slots == set(range(layout.n_sequences))
    sizes = {f.stat().st_size for f in (tmp_path / "out" / "shards").rglob("part-*")}
    assert max(sizes) == 7 * layout.stride and sum(f.stat().st_size for f in (tmp_path / "out" / "shards").rglob("part-*")) == layout.n_sequences * layout.stride


def test_shards_of_nothing(spark, docs, tmp_path):
    got, layout = K.materialise(docs.limit(0), f"{tmp_path}/a")
    assert got.count() == 0 and layout.n_sequences == 0
    got, layout = K.materialise(docs.where("text IS NULL"), f"{tmp_path}/b")
    assert [r.first_slot for r in got.collect()] == [None, None] and layout.n_sequences == 0


# ── language model ──────────────────────────────────────────────────────────────────────────────

def test_lm_base_scores(spark, docs, rows):
    texts = [(i, spaced(t) + ["</s>"]) for i, t, *_ in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts}
    counts = Counter(w for i, t in texts if not held[i] for w in t)
    total, norm = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    want = sorted(((i, held[i], len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 0.5) / norm) for w in t), 6)) for i, t in texts), key=repr)
    for size in (5, 200, 65_536):
        got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in M.lm_scores(docs, size).collect()]
        assert sorted(got, key=repr) == want
    assert M.lm_scores(docs.limit(0)).count() == 0


def plain_model(train, alphabet):
    """Witten-Bell trigram probabilities over the alphabet, by recursion; every other word by its class and its share of it."""
    counts = Counter(w for t in train for w in t)
    norm = sum(counts.values()) + 0.5 * (len(counts) + 1)
    p1 = lambda w: (counts[w] + 0.5) / norm
    symbol = lambda w: w if w in alphabet or w == "</s>" else None
    rest = 1 - sum(p1(w) for w in alphabet) - p1("</s>")
    seen = defaultdict(Counter)
    for t in train:
        s = ["</s>", "</s>", *map(symbol, t)]
        for i in range(2, len(s)):
            seen[tuple(s[i - 2 : i])][s[i]] += 1
            seen[(s[i - 1],)][s[i]] += 1

    def p(context, s):
        if not context:
            return rest if s is None else p1(s)
        if context not in seen:
            return p(context[1:], s)
        c = seen[context]
        return (c[s] + len(c) * p(context[1:], s)) / (sum(c.values()) + len(c))

    def score(text):
        s, out = ["</s>", "</s>", *map(symbol, text)], 0.0
        for i, w in enumerate(text):
            out += math.log10(p(tuple(s[i : i + 2]), s[i + 2])) + (math.log10(p1(w) / rest) if s[i + 2] is None else 0.0)
        return out

    return score


def test_lm_scores_follow_the_model(spark):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"v{x}" for x in rng.zipf(1.4, 40) if x < 400)) for i in range(120)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    train = [spaced(t) + ["</s>"] for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    # The operator's own choice of frequent words is the alphabet.
    counts = Counter(w for t in train for w in t[:-1])
    names = {int(M.hashes(w)[0]): w for w in counts}
    alphabet = {names[h] for h in M.frequent_words(df)[: M.ALPHABET - 2]}
    score = plain_model(train, alphabet)
    got = {r.doc_id: r.score for r in M.lm_scores(df).collect()}
    assert all(abs(got[i] - score(spaced(t) + ["</s>"])) < 1e-6 for i, t in texts)


def test_lm_learns_order(spark):
    """Held-out texts in the trained order score better than the unigrams and than the same words shuffled."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(20)]
    texts = []
    for i in range(300):
        at, out = int(rng.integers(0, 20)), []
        for _ in range(30):
            out.append(words[at])
            at = (at + 1) % 20 if rng.random() < 0.9 else int(rng.integers(0, 20))
        texts.append((i, " ".join(out)))
    probe = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 5 == 1]
    ordered = [(i, " ".join(words[(k + i) % 20] for k in range(30))) for i in probe[:20]]
    mixed = [(i, " ".join(rng.permutation(t.split()).tolist())) for i, (_, t) in zip(probe[20:40], ordered)]
    got = {r.doc_id: r for r in M.lm_scores(spark.createDataFrame(texts + ordered + mixed, "doc_id long, text string")).collect()}
    good, bad = sum(got[i].score for i, _ in ordered), sum(got[i].score for i, _ in mixed)
    assert good > sum(got[i].base_score for i, _ in ordered) + 200 and good > bad + 200


def test_lm_learns_every_word(spark):
    """Pairs of rare words beyond the most frequent ones have trigrams of their own, at every size of what is sent to tasks."""
    rng = np.random.default_rng(6)
    texts = [(i, " ".join(f"a{x} b{x} c{x}" for x in rng.permutation(300)[:40])) for i in range(200)]
    probe = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:10]
    ordered = [(i, " ".join(f"a{x} b{x} c{x}" for x in rng.permutation(300)[:20])) for i in probe[:5]]
    mixed = [(i, " ".join(rng.permutation(t.split()).tolist()) + " unseen") for i, (_, t) in zip(probe[5:], ordered)]
    texts += ordered + mixed
    train = [spaced(t) + ["</s>"] for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    score = plain_model(train, {w for t in train for w in t[:-1]})
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for size in (3, 65_536):
        got = {r.doc_id: r for r in M.lm_scores(df, size).collect()}
        assert len(got) == len(texts) and all(abs(got[i].score - score(spaced(t) + ["</s>"])) < 1e-6 for i, t in texts)
    good, bad = sum(got[i].score for i, _ in ordered), sum(got[i].score for i, _ in mixed)
    assert good > sum(got[i].base_score for i, _ in ordered) + 400 and good > bad + 400


def test_lm_tables_are_small(spark, tmp_path, monkeypatch):
    """What the model keeps in the shared folder is a few bytes a token, whatever the words; scores don't depend on chunks and parts."""
    rng = np.random.default_rng(8)
    texts = [(i, " ".join(f"v{x}" for x in rng.zipf(1.3, 500))) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(common, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    want = {r.doc_id: r.score for r in M.lm_scores(df).collect()}
    used = sum(f.stat().st_size for f in tmp_path.rglob("part-*")) / (200 * 501)
    assert used < 6
    monkeypatch.undo()
    monkeypatch.setattr(M, "HELD", 3_000)
    monkeypatch.setattr(M, "PART", 7_000)
    got = {r.doc_id: r.score for r in M.lm_scores(df, 50).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_stored_leaves_no_shuffle_files_setting(spark, tmp_path):
    before = spark.conf.get(common.CLEANUP, None)
    assert common.stored(spark.range(10).groupBy("id").count(), "kept").count() == 10
    assert spark.conf.get(common.CLEANUP, None) == before
