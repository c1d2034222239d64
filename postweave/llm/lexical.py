"""Ranked lexical search without a document index: an automaton of all item terms reads the texts and counts terms directly.

The terms of the items, guarded by a blank on either side, make one Aho-Corasick automaton. A text, lower-cased and with blanks for
everything that is not part of a term, runs through it once; what the automaton puts out are the occurrences of whole terms, and
a table from terms to items turns them into scores. The first pass over the documents counts documents, lengths and the documents
that hold each term; the second scores, and every task keeps the best documents of each item. Items go to the tasks in blocks of
bounded size, one block after the other, so nothing that is sent grows with the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postweave.llm.best import LARGEST, Best, ranked
from postweave.llm.common import ALNUM, ALNUM_BYTES, lower_ascii, small_batches, stored

TOP = 50
# Characters of terms, and 1,000 for every item, that are sent to a task at once.
BLOCK = 2_000_000
ITEM_COST = 1_000
# Scores (documents times items) that a task computes at once.
CELLS = 500_000
_BLANKED = bytes(ord(chr(i).lower()) if i < 128 and ALNUM_BYTES[i] else i if ALNUM_BYTES[i] else 32 for i in range(256))
_GUARD = " "
# What the first pass counts besides terms.
_TEXTS, _LENGTH = -1, -2


class Automaton:
    """Finds the terms of a list in a text, as whole terms, in one pass."""

    def __init__(self, terms: list[str]):
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(terms):
            self.trie.add_word(f"{_GUARD}{t}{_GUARD}", i)
        self.trie.make_automaton()

    def counts(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Terms in the text, repeats counted; which of the list occur, ascending; how often."""
        data = (text or "").encode().translate(_BLANKED)
        inside = np.frombuffer(data, np.uint8) != 32
        size = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
        if not size:
            return 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.fromiter(map(itemgetter(1), self.trie.iter(f"{_GUARD}{data.decode()}{_GUARD}")), np.int64)
        return size, *np.unique(found, return_counts=True)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms; rows of one id are one item. Items without id or without terms are left out."""
    terms = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(ALNUM), F.lit(0))
    single = items.where(F.col("item_id").isNotNull()).select("item_id", F.explode(terms).alias("term")).distinct()
    return single.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _blocks(items: DataFrame, block: int) -> Iterator[DataFrame]:
    """item_terms with a number `item` from 0 in each block; a block costs at most `block`, or is one item."""
    of_id = items.schema["item_id"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, at, n, held = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            blocks, places = [], []
            for cost in batch.column(2).to_pylist():
                if n and held + cost > block:
                    at, n, held = at + 1, 0, 0
                blocks.append(at)
                places.append(n)
                n, held = n + 1, held + cost
            numbers = [pa.array(x, pa.int64()) for x in ([task] * len(blocks), blocks, places)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *numbers], names=["item_id", "terms", "part", "block", "item"])

    cost = F.aggregate("terms", F.lit(ITEM_COST).cast("long"), lambda a, t: a + F.length(t))
    one = stored(item_terms(items).withColumn("cost", cost), "items")
    total = one.agg(F.coalesce(F.sum("cost"), F.lit(0))).first()[0]
    table = stored(one.repartition(1 + total // block).mapInArrow(packed, f"item_id {of_id}, terms array<string>, part bigint, block bigint, item bigint"), "item-blocks")
    # One row per block.
    for part, k in [tuple(r) for r in table.select("part", "block").distinct().orderBy("part", "block").collect()]:
        yield table.where((F.col("part") == part) & (F.col("block") == k))


def _counted(docs: DataFrame, sent) -> DataFrame:
    """term, n: documents that hold each term; as terms -1 and -2, documents with a term and all their terms."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value["terms"]
        automaton, df = Automaton(terms), np.zeros(len(terms), np.int64)
        texts = length = 0
        for batch in batches:
            for text in batch.column(0):
                size, found, _ = automaton.counts(text.as_py())
                df[found] += 1
                texts, length = texts + (size > 0), length + size
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, _TEXTS, _LENGTH], pa.int32()), pa.array(np.r_[df[at], texts, length], pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _scored(docs: DataFrame, sent, top: int) -> DataFrame:
    """item, doc_id, score: the best documents of each item among those of every task."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        automaton, weights, starts, owners, items = Automaton(block["terms"]), block["weights"], block["starts"], block["owners"], block["items"]
        best, step = Best(items, top), max(1, CELLS // items)
        for batch in batches:
            ids = batch.column(0).fill_null(LARGEST).to_numpy(zero_copy_only=False)
            for first in range(0, len(ids), step):
                own = ids[first : first + step]
                counts = [automaton.counts(text.as_py()) for text in batch.column(1)[first : first + step]]
                held = np.array([len(c[1]) for c in counts])
                term, tf = (np.concatenate([c[i] for c in counts]) for i in (1, 2))
                # Lengths are whole numbers of any size, so that no product overflows.
                m = np.array([50 + (50 * c[0] * block["n"]) // block["length"] for c in counts], np.int64)
                part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, held)))
                # Every occurrence of a term counts for all items that have it.
                many = starts[term + 1] - starts[term]
                begin = np.repeat(starts[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                cell = np.repeat(np.repeat(np.arange(len(own)), held) * items, many) + owners[begin]
                scores = np.zeros(len(own) * items, np.int64)
                np.add.at(scores, cell, np.repeat(part, many))
                scores = scores.reshape(len(own), items)
                row, item = np.nonzero((scores > 0) & (scores >= best.floor[None, :]))
                best.add(item, scores[row, item], own[row])
        item, score, key = best.fold()
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(key, pa.int64(), mask=key == LARGEST), pa.array(score, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item int, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of every item, of those with a score above 0.

    docs: doc_id, text; items: item_id, text; other columns are not read. Null and empty texts have no terms. Equal scores come by
    ascending doc_id, documents without id after them. Repeated rows of documents are documents of their own. Rows of one item_id
    are one item with the terms of all; items without id or terms are not in the result. Without documents or items it is empty.
    """
    small_batches(docs)
    spark, out = docs.sparkSession, None
    for part in _blocks(items, block):
        # At most `block` characters of terms.
        own = sorted(part.select("item", "terms").collect(), key=itemgetter("item"))
        terms = sorted({t for r in own for t in r["terms"]})
        number = {t: i for i, t in enumerate(terms)}
        pairs = np.array(sorted((number[t], r["item"]) for r in own for t in r["terms"]), np.int64).reshape(-1, 2)
        sent = spark.sparkContext.broadcast({"terms": terms})
        # A row per term of the block, and two.
        counts = {r["term"]: r["n"] for r in _counted(docs, sent).collect()}
        sent.destroy()
        n = counts.get(_TEXTS, 0)
        if not n:
            break
        sent = spark.sparkContext.broadcast({
            "terms": terms, "n": n, "length": counts[_LENGTH], "items": len(own), "owners": pairs[:, 1],
            "weights": np.array([weight(n, counts[i]) if i in counts else 0 for i in range(len(terms))], np.int64),
            "starts": np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1)),
        })
        best = ranked(_scored(docs, sent, top), ["item"], "score", "doc_id", top, "rank")
        done = stored(best.join(part.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        sent.destroy()
        out = done if out is None else out.unionByName(done)
    empty = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint"
    return out if out is not None else spark.createDataFrame([], empty)
