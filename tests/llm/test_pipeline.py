import importlib.util
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from postweave.llm import jaccard, mixing, tokens
from tests.llm.fixtures import DOCS, awkward, clashing, spaced
from tests.llm.test_sets_and_models import near_copies, plain_groups
from tests.llm.test_text_operators import plain_counts, plain_hits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    quiz = " ".join(f"q{k}" for k in range(20))
    rows = awkward() + [(i, t, "en", "abc"[i % 3], len(t)) for i, t in near_copies(30)]
    rows += [(9000, f"see {quiz} now", "en", "a", 0), (9001, f"{quiz} " + " ".join(f"n{k}" for k in range(2000)), "en", "a", 0)]
    clashing(spark.createDataFrame(rows, DOCS)).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, quiz)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), rows


def test_stages_against_plain_versions(spark, folder):
    root, rows = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    good = P.quality_rules(spark, docs, root)
    ok = [r for r in rows if plain_counts(r[1])[0] >= 10 and 5 * plain_counts(r[1])[4] <= plain_counts(r[1])[0]]
    assert good.columns == docs.columns and Counter(r.doc_id for r in good.collect()) == Counter(r[0] for r in ok)
    single = P.near_copies(spark, good, root)
    groups = plain_groups([r[:2] for r in ok])
    ids = Counter(r.doc_id for r in single.collect())
    assert single.columns == docs.columns and set(ids) == {g for _, _, g in groups} and sum(ids.values()) == len({g for _, _, g in groups})
    clean = P.decontamination(spark, single, root)
    text = {r[0]: r[1] for r in ok}
    items = [(1, " ".join(f"q{k}" for k in range(20)))]
    assert {r.doc_id for r in clean.collect()} == {i for i in ids if not plain_hits(text[i], items)[4]} and 9001 in {r.doc_id for r in clean.collect()}
    mix = P.source_mix(spark, clean, root)
    taken = {r.doc_id: r.taken for r in mixing.mix(clean).collect()}
    words = Counter()
    for r in mix.collect():
        words[r.doc_id] += len(spaced(r.text))
    assert mix.columns == docs.columns and {i: n for i, n in taken.items() if n} == dict(words)
    with open(tokens.TOKENIZER, "rb") as f:
        encode = tokens._encoder(f.read(), tokens.PATTERN).encode_ordinary
    shards = P.token_shards(spark, mix, root)
    assert Counter((r.doc_id, r.n_tokens) for r in shards.collect()) == Counter((r.doc_id, len(encode(r.text)) + 1) for r in mix.collect())


def test_near_copies_share_four_fifths_of_five_word_shingles(spark):
    """Two separate words changed: 86 of 106 five-word shingles in common (a copy), 92 of 104 of three words. Three changed and two more: 81 of 113."""
    words = [f"w{k}" for k in range(100)]
    changed = lambda *at: " ".join("x" if k in at else w for k, w in enumerate(words))
    texts = [(1, changed()), (2, changed(30, 60)), (3, changed(20, 50, 80) + " y z")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], DOCS)
    assert {r.doc_id for r in P.near_copies(spark, docs, "").collect()} == {1, 3}
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()} == {1: 1, 2: 2, 3: 3}


def test_run_is_the_stages_in_order(spark, folder):
    root, _ = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, root)
    got = P.run(spark, root)
    key = lambda df: Counter((r.doc_id, r.n_tokens) for r in df.collect())
    assert key(got) == key(docs) and [n for n, _ in P.STAGES][1] == "n-gram Jaccard join"


def test_empty_tables(spark, folder, tmp_path):
    root, _ = folder
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{root}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_entry_names_one_query_per_operator():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert importlib.util.find_spec("postweave.llm") and set(entry.oracle_sql()) <= set(names)
