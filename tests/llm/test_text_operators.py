import hashlib
import re

import pytest
from pyspark.sql import functions as F

from postweave.llm import decontaminate as D
from postweave.llm import licenses as L
from postweave.llm import linechunks as C
from postweave.llm import pii as P
from postweave.llm import quality as Q
from tests.llm.fixtures import DOCS, alnum, awkward, clashing, spaced


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, DOCS)).repartition(3).cache()


def by_id(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# ── licences ────────────────────────────────────────────────────────────────────────────────────

LICENCES = [
    (1, "Released under the MIT License. Mit license!"), (2, "mit-LICENSE; apache license 2"), (3, "general public licence"),
    (4, "GNU General Public License as published"), (5, None), (6, ""), (7, "license mit"), (8, "MITKLICENSE mit licensK"),
    (9, "Redistribution and use in source and binary forms, with or without modification"), (10, "redistribution and use in binary forms"),
    (11, "cc by nc 4 0"), (12, "smit license"), (2, "mit-LICENSE; apache license 2"), (None, "mit license"), (13, "mit " * 500 + "license " * 500),
]


def base_places(text):
    w, out = alnum(text), []
    for label, phrase, _ in L.BASE:
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return w, out


def test_licences_against_plain_search(spark, rows):
    every = [(i, t) for i, t, *_ in rows] + LICENCES
    got = L.license_scan(clashing(spark.createDataFrame(every, "doc_id long, text string")))
    want = []
    for i, t in every:
        w, places = base_places(t)
        want.append((i, len(w), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places}))))
    assert by_id(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    more = {r.doc_id: (r.labels, r.score) for r in got.collect()}
    assert more[9][0] == "bsd" and 0.5 < more[9][1] < 1 and more[10] == ("", 0.0) and more[11] == ("cc-by-nc", 1.0) and more[4][0] == "gpl"


def test_licences_by_shuffle(spark):
    df = spark.createDataFrame(LICENCES, "doc_id long, text string")
    names = ("doc_id", "n_base", "labels", "score")
    assert by_id(L.license_scan(df, most=0), *names) == by_id(L.license_scan(df), *names)
    assert L.license_scan(df.limit(0)).count() == 0


# ── decontamination ─────────────────────────────────────────────────────────────────────────────

ITEMS = [(7, " ".join(f"q{i}" for i in range(20))), (11, "Short ITEM here"), (12, "one"), (5, None), (6, "..."), (None, "two words"), (7, "Two words")]


def plain_hits(text, items, n=13):
    w, hit, ids = alnum(text), set(), set()
    for i, t in items:
        if i is None or t is None:
            continue
        own = alnum(t)
        k = min(n, len(own))
        for a in range(len(own) - k + 1 if own else 0):
            for b in range(len(w) - k + 1):
                if w[b : b + k] == own[a : a + k]:
                    ids.add(str(i))
                    hit.update(range(b, b + k))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination_against_plain_search(spark, rows):
    quiz = " ".join(f"Q{i}" for i in range(20))
    every = [r[:2] for r in rows] + [(200, f"start {quiz} end"), (201, " ".join(f"q{i}" for i in range(12))), (202, "a short item, here; one"), (203, quiz + " " + quiz)]
    df = clashing(spark.createDataFrame(every, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(((i, *plain_hits(t, ITEMS)) for i, t in every), key=repr)
    assert by_id(D.contamination(df, items), *names) == want
    # The same in blocks of a few words, which cut the longer items.
    blocks = D.with_hits(df.select("doc_id", "text"), items, block_words=3).select("doc_id", "found.*")
    whole = D.with_hits(df.select("doc_id", "text"), items).select("doc_id", "found.*")
    assert by_id(blocks, *blocks.columns) == by_id(whole, *whole.columns)


def test_decontamination_removes(spark):
    quiz = " ".join(f"q{i}" for i in range(13))
    df = clashing(spark.createDataFrame([(1, f"Keep this, {quiz}! and this", 9), (2, "clean", 5), (3, None, 0)], "doc_id long, text string, n_chars int"))
    items = spark.createDataFrame([(1, quiz)], "item_id long, text string")
    kept = D.decontaminate(df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    cut = {r.doc_id: (r.text, r.n_chars, r.node) for r in D.decontaminate(df, items, "spans").collect()}
    assert cut == {1: ("Keep this, ! and this", 21, "other"), 2: ("clean", 5, "other"), 3: (None, None, "other")}
    assert D.contamination(df, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0 and D.contamination(df.limit(0), items).count() == 0


# ── line chunks ─────────────────────────────────────────────────────────────────────────────────

def plain_dedup(rows):
    """(doc_id, text) → kept text, by the rule written out over lines."""
    chunks = []
    for i, t in dict.fromkeys(rows):
        if t is None:
            continue
        lines = t.split("\n")
        keys = [hashlib.md5(x.encode()).hexdigest() for x in lines]
        begins = [k for k in range(len(lines)) if k == 0 or max(map(len, lines[k - 1 : k + 1])) >= 200 or hashlib.md5((keys[k - 1] + keys[k]).encode()).hexdigest()[0] < "4"]
        for nth, (b, e) in enumerate(zip(begins, begins[1:] + [len(lines)])):
            chunks.append((i, t, nth, lines[b:e]))
    seen, kept = {}, {}
    for i, t, nth, lines in chunks:
        seen.setdefault("\n".join(lines), set()).add((i is None, i or 0, C_HASH[t], nth))
    for i, t, nth, lines in chunks:
        body = "\n".join(lines)
        gone = min(seen[body]) != (i is None, i or 0, C_HASH[t], nth) and spaced(body) and (len(lines) >= 2 or len(body) >= 200)
        kept.setdefault((i, t), []).extend([] if gone else lines)
    return {k: "\n".join(v) for k, v in kept.items()}


C_HASH = {}


def test_line_chunks_against_plain_rule(spark, rows):
    passage = "\n".join(f"line {i} of a passage" for i in range(40))
    wide = " ".join(f"w{i}" for i in range(80))
    every = [r[:2] for r in rows] + [(300 + k, f"head {k}\n{'x' * k}\n{passage}\ntail {k}") for k in range(6)]
    every += [(400, f"a\n{wide}\nb"), (401, f"c\n{wide}\nd"), (402, "\n\n\n\n"), (403, "\n\n\n\n")]
    df = clashing(spark.createDataFrame(every, "doc_id long, text string"))
    C_HASH.update({r[0]: r[1] for r in df.select("text", F.xxhash64("text")).collect()})
    want = plain_dedup(every)
    got = C.line_dedup(df)
    assert by_id(got, "doc_id", "text") == sorted(((i, None if t is None else want[i, t]) for i, t in every), key=repr)
    removed = {r.doc_id: r.n_removed_lines for r in got.collect()}
    # Whatever stands before the passage, most of it is found.
    assert removed[300] == 0 and all(removed[300 + k] >= 25 for k in range(1, 6)) and removed[401] == 1
    assert C.line_dedup(df.limit(0)).count() == 0


# ── personal data ───────────────────────────────────────────────────────────────────────────────

def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(k, a, e) for a, _, e, k in sorted(out)]


PERSONAL = [
    "a@b.c_d@e.f", "x@y", "a.b+c%d@ex-1.co.uk. z", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.000.1.1", "4111 1111 1111 1111", "4111-1111 1111-1111 2",
    "4111  1111 1111 1111", "+1 (202) 555-0199 or +12 3", "+1+1234567890123", "😀 é a@b.c K 9.9.9.9", "4" * 30, "1 " * 20_000, "a" * 50_000 + "@", "+1" + "(" * 20_000,
    "11111111111111111111 4111111111111111",
]


def test_personal_data_against_plain_patterns(spark, rows):
    every = [r[:2] for r in rows] + [(500 + i, t) for i, t in enumerate(PERSONAL)]
    got = P.pii_spans(clashing(spark.createDataFrame(every, "doc_id long, text string")))
    found = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in got.collect()), key=repr)
    assert found == sorted(((i, plain_spans(t)) for i, t in every), key=repr)
    counts = got.select("doc_id", *[f"n_{k}" for k in P.KINDS]).where("doc_id = 502").first()
    assert tuple(counts)[1:] == (1, 0, 0, 0)


def test_personal_data_in_known_contexts(spark):
    rows = [(i, f"blah call {700 + i}-{1000 + i * 7} now") for i in range(5)]
    rows += [(100 + i, f"please call +1 202 555 0{100 + i} soon") for i in range(60)] + [(200, "the 12345-678 thing"), (201, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1_000_000, 0):
        found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in P.pii_spans(df, most=most).collect()}
        assert found[0] == [("like_phone", 10, 18)] and all(len(found[i]) == 1 for i in range(5)) and found[200] == [] and found[100] == [("phone", 12, 27)]
    assert P.pii_spans(df.limit(0)).count() == 0


# ── quality rules ───────────────────────────────────────────────────────────────────────────────

def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup, seen = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {x for x in windows if windows.count(x) > 1} if len(w) < 500 else {x for x, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + j for i, x in enumerate(windows) if x in often for j in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts(spark, docs, rows):
    more = [(600, "a b c d e a b c d e f"), (601, "# $ | <x>\n# $ | <x>\n \n \nb"), (602, "é " * 30)]
    every = [r[:2] for r in rows] + more
    df = spark.createDataFrame(every, "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(clashing(df), labels)
    want = []
    for i, t in every:
        c = plain_counts(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((i, *c, failed, not failed))
    assert by_id(got, "doc_id", *Q.COUNTS, "base_failed", "kept") == sorted(want, key=repr)
    assert Q.quality_rules(df.limit(0), labels).count() == 0
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(plain_counts(r[1])[0] >= 10 and 5 * plain_counts(r[1])[4] <= plain_counts(r[1])[0] for r in rows)


def test_upper_bound_is_exact():
    for k, n, e in ((0, 10, 0.05), (3, 50, 0.01), (20, 1000, 0.001)):
        p = Q.upper_bound(k, n, e)
        tail = sum(__import__("math").comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - e) < 1e-6
    assert Q.upper_bound(5, 5, 0.1) == 1.0 and Q.upper_bound(0, 0, 0.1) == 1.0


def test_cutoffs_respect_the_risk_and_reject_bad_documents(spark):
    good = [(i, " ".join(f"word{i}x{j}" for j in range(30)), "en") for i in range(3000)]
    bad = [(10_000 + i, " ".join(f"b{i}x{j}###" for j in range(30)), "en") for i in range(200)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2900)] + [(10_000 + i, 0, 0) for i in range(100)] + [(None, 1, 0), (77, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in Q.quality_rules(docs, labels).collect()}
    assert not any(got[10_000 + i] for i in range(200)) and sum(not got[i] for i in range(3000)) <= 0.02 * 3000
    # With a handful of labels nothing can be promised, so nothing is rejected beyond the base rules.
    few = {r.doc_id: r.kept for r in Q.quality_rules(docs, labels.limit(50)).collect()}
    assert all(few.values())


def test_few_labels_suffice_and_small_strata_are_pooled(spark):
    """1,600 good labels of one language and 1,400 over seven small ones: bad and toxic documents go in all of them."""
    good = [(i, " ".join(f"word{i}x{j}" for j in range(30)), "en" if i < 1600 else "l" + "abcdefg"[i % 7]) for i in range(3000)]
    bad = [(10_000 + i, " ".join(f"b{i}x{j}###" for j in range(30)), t[2]) for i, t in enumerate(good[1500:1700])]
    toxic = [(20_000 + i, " ".join(f"word{i}y{j}" for j in range(29)) + " nasty", t[2]) for i, t in enumerate(good[1400:1800])]
    docs = spark.createDataFrame(good + bad + toxic, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(t[0], 1, 0) for t in good] + [(t[0], 0, 1) for t in toxic[::2]], "doc_id long, quality int, toxic int")
    assert Q.blocked_words(docs, labels) == ["nasty"]
    got = {r.doc_id: r.kept for r in Q.quality_rules(docs, labels).collect()}
    assert not any(got[t[0]] for t in bad + toxic) and sum(not got[t[0]] for t in good) <= 0.02 * 3000
    # Labels that words are learned from are no holdout: without them no cutoff is found.
    fitting = labels.where(Q._fitting(F.col("doc_id")))
    assert Q.blocked_words(docs, fitting) == ["nasty"] and all(r.kept for r in Q.quality_rules(docs, fitting).collect())
