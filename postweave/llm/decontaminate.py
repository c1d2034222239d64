"""Benchmark passages in training texts: hashed n-gram windows, verified word by word.

The windows of the benchmark (n consecutive words of an item, or the whole of a shorter item) are hashed into a sorted array,
which goes to every task in blocks of bounded size. A task hashes all windows of a batch of documents with prefix sums, looks
them up, and compares the words of every hit with those of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postweave.llm.common import Words, small_batches

N = 13
BLOCK_WORDS = 2_000_000


class Windows:
    """The windows of a block of items, found by hash and compared by word."""

    def __init__(self, items: list[tuple[str, bytes]], n: int = N):
        self.ids = [i for i, _ in items]
        self.texts = [Words(t) for _, t in items]
        hashes, owners, places, sizes = [], [], [], []
        for k, w in enumerate(self.texts):
            size = min(n, len(w.hash))
            if size:
                h = w.windows(size)
                hashes.append(h)
                owners.append(np.full(len(h), k))
                places.append(np.arange(len(h)))
                sizes.append(np.full(len(h), size))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        h = join(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner, self.place, self.size = (join(x, np.int64)[order] for x in (owners, places, sizes))
        self.sizes = sorted(set(self.size.tolist()))
        # A small table of hash bits spares most look-ups in the sorted hashes.
        self.bits = max(16, int(len(h)).bit_length() + 4)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self.hash >> np.uint64(64 - self.bits)] = True

    def spans(self, doc: Words) -> list[tuple[int, int, int]]:
        """(first word, number of words, item) of every occurrence in the document."""
        found = []
        for size in self.sizes:
            h = doc.windows(size)
            for at in np.flatnonzero(self.maybe[h >> np.uint64(64 - self.bits)]).tolist():
                lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
                if lo < hi:
                    own = doc.words(at, size)
                    found += [
                        (at, size, int(self.owner[k])) for k in range(lo, hi)
                        if self.size[k] == size and self.texts[self.owner[k]].words(int(self.place[k]), size) == own
                    ]
        return found


def scan(text: str | None, windows: Windows) -> tuple[int, list[int], list[int], list[str]]:
    """Number of words; starts and ends (in words) of the merged hit ranges; ids of the items that occur."""
    doc = Words((text or "").encode())
    spans = windows.spans(doc)
    starts: list[int] = []
    ends: list[int] = []
    for at, size, _ in sorted(spans):
        if ends and at <= ends[-1]:
            ends[-1] = max(ends[-1], at + size)
        else:
            starts.append(at)
            ends.append(at + size)
    return len(doc.hash), starts, ends, sorted({windows.ids[k] for _, _, k in spans})


_FOUND = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_FOUND_DDL = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,items:array<string>>"


def blocks(benchmark: DataFrame, n: int = N, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """The items, partition by partition, in blocks of about block_words words; a longer item is cut where its windows stay whole."""
    block: list[tuple[str, bytes]] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        words = Words(row[1].encode())
        k = len(words.hash)
        if not k:
            continue
        step = max(block_words, 2 * n)
        for at in range(0, max(k - n + 1, 1) if k > step else 1, step):
            stop = min(at + step + n - 1, k) - 1 if k > step else k - 1
            part = words.lower[words.start[at] : words.end[stop]].tobytes()
            block.append((row[0], part))
            held += stop - at + 1
            if held >= block_words:
                yield block
                block, held = [], 0
    if block:
        yield block


def with_hits(docs: DataFrame, benchmark: DataFrame, n: int = N, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with a column `found`: n_words, starts and ends of hit word ranges, items.

    Every block is one column computed from the text in the same pass; the ranges of several blocks are merged in the row.
    Null texts have no words. Items without words, without id or without text match nothing. Items that share an id count once.
    """
    found = None
    small_batches(docs)
    for block in blocks(benchmark, n, block_words):
        sent = docs.sparkSession.sparkContext.broadcast((block, n))
        one = _finder(sent)(F.col("text"))
        found = one if found is None else _merged()(found, one)
    if found is None:
        found = _finder(docs.sparkSession.sparkContext.broadcast(([], n)))(F.col("text"))
    return docs.withColumn("found", found)


def _finder(sent):
    made = []

    @F.arrow_udf(returnType=_FOUND_DDL)
    def find(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Windows(*sent.value))
        rows = [scan(x.as_py(), made[0]) for x in texts]
        return pa.array([dict(zip(("n_words", "starts", "ends", "items"), r)) for r in rows], _FOUND)

    return find


def _merged():
    @F.arrow_udf(returnType=_FOUND_DDL)
    def merge(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            starts: list[int] = []
            ends: list[int] = []
            for s, e in sorted([*zip(x["starts"], x["ends"]), *zip(y["starts"], y["ends"])]):
                if ends and s <= ends[-1]:
                    ends[-1] = max(ends[-1], e)
                else:
                    starts.append(s)
                    ends.append(e)
            out.append({"n_words": x["n_words"], "starts": starts, "ends": ends, "items": sorted({*x["items"], *y["items"]})})
        return pa.array(out, _FOUND)

    return merge


def _judged(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    n_hit = F.aggregate(F.zip_with("found.starts", "found.ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return with_hits(docs, benchmark, n).withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("found.n_words"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit word ranges."""
    return _judged(docs.select("doc_id", "text"), benchmark, n).select(
        "doc_id", F.col("found.n_words").alias("n_words"), "n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), "contaminated",
        F.col("found.starts").alias("hit_starts"), F.col("found.ends").alias("hit_ends"),
    )


def cut_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the hit word ranges; what stands between the words of a range goes with it."""
    words = Words(text.encode())
    data, out, at = text.encode(), [], 0
    for s, e in zip(starts, ends):
        out.append(data[at : words.start[s]])
        at = words.end[e - 1]
    return b"".join([*out, data[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = N) -> DataFrame:
    """The rows of docs without contaminated documents, or ('spans') all rows with the hit ranges cut out of the texts.

    All columns of docs stay as they are, whatever their names. In 'spans', n_chars follows the text if there is such a column.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    judged = _judged(docs.select(row, "text"), benchmark, n)
    if remove == "documents":
        return judged.where(~F.col("contaminated")).select("row.*")
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")

    @F.arrow_udf(returnType="string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([t if t is None or not f["starts"] else cut_spans(t, f["starts"], f["ends"]) for t, f in zip(texts.to_pylist(), found.to_pylist())], pa.string())

    out = judged.select("row", cut("text", "found").alias("cut"))
    changed = {"text": F.col("cut"), **({"n_chars": F.length("cut").cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})}
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in names])
