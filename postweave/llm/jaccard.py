"""Documents linked by the Jaccard similarity of their word n-grams, with rare-first prefix filtering.

Documents with equal sets form one node, so copies never meet in pairs. The shingles of a node are ordered by an estimate of
how many documents hold them (rarest first), and only a prefix that two similar sets must share is joined. Pairs pass length,
positional and suffix filters and are verified once by the whole sets.

Links are asked for up to connectivity: in a first round every node is compared with one pivot of each of its prefix shingles,
which joins up a large group of near copies in as many pairs as it has rows; the second round compares what shares a prefix
shingle and is not connected yet, and is complete for these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from postweave.llm.common import SPACED_BYTES, Words, small_batches, stored
from postweave.llm.components import components
from postweave.session import pin

N = 3
# Similarity as a fraction, so that every bound is exact.
NUM, DEN = 90, 100
SKETCH_BITS, SLICES = 21, 64
# Two short images of a set: whether the elements of each of 512 hash classes are odd in number, as eight 64-bit numbers, and
# the number of elements in each of 128 hash ranges.
ODD, FINE = 8, 128
_ODD = [f"odd{i}" for i in range(ODD)]


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of the whole sequence if it is shorter; none without words."""
    words = Words((text or "").encode(), SPACED_BYTES)
    if not len(words.hash):
        return np.zeros(0, np.uint64)
    own = np.sort(words.windows(min(n, len(words.hash))))
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    return own[first]


def node_of(own: np.ndarray, salt: int) -> int | None:
    """Number of a set; None of the empty one."""
    if not len(own):
        return None
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little", signed=True)


def second_of(own: np.ndarray) -> int | None:
    return node_of(own, 1 << 32) if len(own) else None


def images_of(own: np.ndarray) -> tuple:
    """The eight numbers of odd classes, and the counts per range as bytes (full counts stay at their largest value)."""
    odd = np.bincount(((own >> np.uint64(32)) & np.uint64(64 * ODD - 1)).astype(np.int64), minlength=64 * ODD) & 1
    fine = np.bincount((own >> np.uint64(57)).astype(np.int64), minlength=FINE)
    return *np.packbits(odd.astype(np.uint8)).view("<i8").tolist(), np.minimum(fine, 65535).astype("<u2").tobytes()


def _measured(docs: DataFrame, n: int, salt: int) -> DataFrame:
    """Per document (doc_id, tkey, n_shingles, node, second, images), and per task the slices of its shingle counts.

    tkey is a hash of the text. A shingle counts in one of 2^21 cells, once per document.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("tkey", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("second", pa.int64()),
        *((o, pa.int64()) for o in _ODD), ("fine", pa.binary()), ("slice", pa.int32()), ("cells", pa.binary()),
    ])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            rows = []
            for doc_id, tkey, text in zip(*batch.columns):
                own = shingles(text.as_py(), n)
                np.add.at(cells, (own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                rows.append((doc_id.as_py(), tkey.as_py(), len(own), node_of(own, salt), second_of(own), *images_of(own), None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], names=names)
        for i, part in enumerate(np.split(cells, SLICES)):
            if part.any():
                packed = zstandard.compress(part.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((None,) * (6 + ODD) + (i, packed), schema)], names=names)

    ddl = ", ".join(f"{c} bigint" for c in ("doc_id", "tkey", "n_shingles", "node", "second", *_ODD)) + ", fine binary, slice int, cells binary"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tkey"), "text").mapInArrow(run, ddl)


def _sketch(measured: DataFrame) -> np.ndarray:
    """Documents per cell: the tasks' counts summed slice by slice; its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(zstandard.decompress(cells), "<u4").astype(np.int64)
        for i, part in total.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "cells": pa.array([part.astype("<i8").tobytes()], pa.binary())})

    slices = measured.where("slice IS NOT NULL").select("slice", "cells").repartition(SLICES, "slice").mapInArrow(run, "slice int, cells binary")
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    for i, cells in slices.toLocalIterator():
        out[i] += np.frombuffer(cells, "<i8")
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


def _prefix(size, num: int = NUM, den: int = DEN):
    """Length of the prefix of a set that meets every similar set's prefix: size - ceil(t size) + 1."""
    return size - -(-num * size // den) + 1


def _entries(docs: DataFrame, sketch, n: int, salt: int, num: int, den: int) -> DataFrame:
    """(token, node, size, place) for every prefix shingle of every document that has one."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            parts = []
            done: set[int] = set()
            for text in batch.column(0):
                own = shingles(text.as_py(), n)
                node = node_of(own, salt)
                if node is None or node in done:
                    continue
                done.add(node)
                k = _prefix(len(own), num, den)
                seen = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                # Rarest first; own is sorted, so equal counts are in the order of their hashes.
                first = np.argsort(seen, kind="stable")[:k]
                parts.append((own[first].view(np.int64), np.full(k, node), np.full(k, len(own), np.int32), np.arange(k, dtype=np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*parts), schema)], schema=schema)

    return docs.select("text").mapInArrow(run, "token bigint, node bigint, size int, place int")


def _shared(entries: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The distinct entries whose shingle is also in the prefix of another node of a size that a similar set can have.

    In the order of sizes the next set on either side is the one nearest in size, so no link is lost. Most shingles that meet by
    chance, which grow faster than the texts, do so in texts of other lengths. The entries are made and dealt once; a shingle has at
    most one row for each node.
    """
    rows = entries.repartition("token").dropDuplicates(["token", "node"])
    by_size = Window.partitionBy("token").orderBy("size", "node")
    smaller, larger = F.lag("size").over(by_size), F.lead("size").over(by_size)
    near = (den * smaller >= num * F.col("size")) | (den * F.col("size") >= num * larger)
    return rows.withColumn("near", near).where("near").drop("near")


def _sets(docs: DataFrame, wanted: DataFrame, n: int, salt: int, most: int = 500_000) -> DataFrame:
    """(node, size, own) of the wanted (node, w_doc_id, w_tkey): the sorted hashes.

    Up to `most` wanted rows are sent to all tasks; beyond, texts are shuffled by key.
    """
    wanted = pin(wanted)
    sent = F.broadcast(wanted) if wanted.count() <= most else wanted
    keyed = docs.select(F.col("doc_id").cast("long").alias("k"), F.xxhash64("text").alias("t"), "text")
    texts = keyed.join(sent, F.col("k").eqNullSafe(F.col("w_doc_id")) & (F.col("t") == F.col("w_tkey"))).select("node", "text")
    schema = pa.schema([("node", pa.int64()), ("size", pa.int32()), ("own", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(*batch.columns):
                node, own = node.as_py(), shingles(text.as_py(), n)
                if node_of(own, salt) == node:  # and not another text of the same key
                    rows.append((node, len(own), own.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return texts.mapInArrow(run, "node bigint, size int, own binary").dropDuplicates(["node"])


def _need(a: Column, b: Column, num: int = NUM, den: int = DEN) -> Column:
    """Least intersection of two similar sets of these sizes."""
    return F.ceil(F.lit(num) * (a + b) / F.lit(num + den)).cast("int")


def _may_be_similar(a: str, b: str, num: int = NUM, den: int = DEN) -> Column:
    """Length and suffix filter of two sides with prefixes a and b.

    An element of only one set turns one class from even to odd or back, so classes that differ are at most as many as such elements.
    """
    size, other = F.col(f"{a}size"), F.col(f"{b}size")
    lengths = den * F.least(size, other) >= num * F.greatest(size, other)
    apart = F.lit(0)
    for o in _ODD:
        apart = apart + F.bit_count(F.col(f"{a}{o}").bitwiseXOR(F.col(f"{b}{o}")))
    return lengths & (apart <= size + other - 2 * _need(size, other, num, den))


def _fine_apart(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (np.frombuffer(b"".join(v.to_pylist()), "<u2").reshape(-1, FINE).astype(np.int32) for v in (a, b))
    return pa.array(np.abs(x - y).sum(1).astype(np.int32))


def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = ((np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(a, b))
    return pa.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs], pa.int32())


def _side(df: DataFrame, x: str) -> DataFrame:
    return df.select(*[F.col(c).alias(x if c == "node" else f"{x}_{c}") for c in df.columns])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, salt: int, num: int, den: int) -> DataFrame:
    """Those of the distinct pairs (a, b) that are similar: filtered by fine ranges, then by the whole sets, once each."""
    fine = nodes.select("node", "size", "fine")
    apart = F.arrow_udf(_fine_apart, T.IntegerType())
    allowed = F.col("a_size") + F.col("b_size") - 2 * _need(F.col("a_size"), F.col("b_size"), num, den)
    likely = pairs.join(_side(fine, "a"), "a").join(_side(fine, "b"), "b").where(apart("a_fine", "b_fine") <= allowed).select("a", "b")
    likely = stored(likely, "jaccard-likely")
    if likely.isEmpty():
        return likely
    ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = stored(_sets(docs, nodes.join(ends, "node").select("node", "w_doc_id", "w_tkey"), n, salt), "jaccard-sets")
    both = likely.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").withColumn("common", F.arrow_udf(_common, T.IntegerType())("a_own", "b_own"))
    return both.where(den * F.col("common") >= num * (F.col("a_size") + F.col("b_size") - F.col("common"))).select("a", "b")


def _pivots(shared: DataFrame, num: int, den: int) -> DataFrame:
    """(token, pivot): the node of each shingle that has the largest part of its prefix in common with others.

    Every change to a copy makes shingles that no other text has, and these are the rarest, so they come first. The text that copies
    were made of, or the copy with the fewest changes, has the fewest of them, and the other copies are more similar to it than to
    each other.
    """
    rows = shared.select("token", "node", "size")
    central = rows.groupBy("node").agg((F.count("*") / _prefix_of(F.first("size"), num, den)).alias("part"))
    return rows.join(central, "node").groupBy("token").agg(F.max(F.struct("part", "node")).alias("best")).select("token", F.col("best.node").alias("pivot"))


def _prefix_of(size: Column, num: int, den: int) -> Column:
    return size - F.ceil(F.lit(num) * size / F.lit(den)).cast("int") + 1


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def jaccard_groups(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per row of docs: doc_id, tkey, n_shingles, node, component_id.

    Links are similarities of num/den and more over the sets of n-word shingles.
    component_id is the smallest doc_id that links reach. Null or wordless texts have no shingles and stand alone. Repeated rows
    and rows with equal sets share a component. A null doc_id takes part in links; a component of nothing else has a null id, as
    has a lone document without id. An empty table gives no rows. Other columns are not read.
    """
    small_batches(docs)
    salt = 0
    while True:
        measured = stored(_measured(docs, n, salt), "jaccard-measured")
        per = measured.where("slice IS NULL").drop("slice", "cells")
        # Different sets under one number would be taken for one: then all get other numbers.
        clash = per.where("node IS NOT NULL").groupBy("node").agg(F.min("second").alias("x"), F.max("second").alias("y")).where("x <> y")
        if clash.isEmpty():
            break
        salt += 1
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(measured))
    shared = stored(_shared(_entries(docs, sketch, n, salt, num, den), num, den), "jaccard-shared")
    member = per.join(shared.select("node").distinct(), "node")
    first_row = F.min(F.struct("doc_id", "tkey", F.col("n_shingles").cast("int").alias("size"), *_ODD, "fine")).alias("r")
    nodes = member.groupBy("node").agg(first_row).select("node", F.col("r.doc_id").alias("w_doc_id"), F.col("r.tkey").alias("w_tkey"), "r.size", *(f"r.{o}" for o in _ODD), "r.fine")
    nodes = stored(nodes, "jaccard-nodes")
    coarse = nodes.select("node", "size", *_ODD)

    pivots = _pivots(shared, num, den)
    first = shared.join(pivots, "token").where("node <> pivot").select(*_pair("node", "pivot")).distinct()
    first = first.join(_side(coarse, "a"), "a").join(_side(coarse, "b"), "b").where(_may_be_similar("a_", "b_", num, den)).select("a", "b")
    near = stored(_verified(first, nodes, docs, n, salt, num, den), "jaccard-near")
    group = pin(components(near))

    # What shares a shingle with another component than its own.
    known = shared.select("token", "node", "place").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_tokens = known.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    rest = stored(known.join(open_tokens, "token").join(coarse, "node"), "jaccard-open")
    fields = ("node", "size", "place", "component", *_ODD)
    x, y = (rest.select("token", *[F.col(c).alias(f"{s}_{c}") for c in fields]) for s in "xy")
    size, other = F.col("x_size"), F.col("y_size")
    # The smaller set, or of equal ones the one of smaller number, is looked up by a shorter prefix.
    index = other - F.ceil(F.lit(2 * num) * other / F.lit(num + den)).cast("int") + 1
    can_reach = 1 + F.least(size - F.col("x_place") - 1, other - F.col("y_place") - 1) >= _need(size, other, num, den)
    ordered = (other < size) | ((other == size) & (F.col("y_node") < F.col("x_node")))
    second = x.join(
        y.where(F.col("y_place") < index),
        (x["token"] == y["token"]) & ordered & (F.col("x_component") != F.col("y_component")) & can_reach & _may_be_similar("x_", "y_", num, den),
    ).select(*_pair("x_node", "y_node")).distinct()
    links = near.union(_verified(second, nodes, docs, n, salt, num, den))
    of = components(stored(links, "jaccard-links"))

    named = per.select("doc_id", "tkey", "n_shingles", "node").join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "jaccard-named")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component", "left").select(
        "doc_id", "tkey", "n_shingles", "node", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def keep_one(docs: DataFrame, n: int = N, most: int = 500_000, num: int = NUM, den: int = DEN) -> DataFrame:
    """One document of each group, the one of smallest doc_id; all columns as they are. Wordless documents all stay.

    The dropped rows are told by doc_id and text; up to `most` of them are sent to all tasks, more are joined by shuffles.
    """
    rows = pin(jaccard_groups(docs, n, num, den))
    member = rows.where("component IS NOT NULL")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("tkey").alias("t"))
    best = member.groupBy("component").agg(F.min(place).alias("best"))
    out = pin(
        member.join(best, "component").where(~(F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("tkey") == F.col("best.t"))))
        .select(F.col("doc_id").alias("o_doc_id"), F.col("tkey").alias("o_tkey")).distinct()
    )
    gone = F.broadcast(out) if out.count() <= most else out
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("k_doc_id"), F.xxhash64("text").alias("k_tkey"))
    kept = keyed.join(gone, F.col("k_doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("k_tkey") == F.col("o_tkey")), "left_anti")
    # Rows that repeat both id and text are still all there; of such rows one stays.
    again = pin(member.groupBy("doc_id", "tkey").count().where("count > 1").select(F.col("doc_id").alias("r_doc_id"), F.col("tkey").alias("r_tkey")))
    if again.isEmpty():
        return kept.select("row.*")
    same = F.col("k_doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("k_tkey") == F.col("r_tkey"))
    sent = F.broadcast(again) if again.count() <= most else again
    single = kept.join(sent, same, "left_anti").select("row")
    once = kept.join(sent, same, "left_semi").groupBy("k_doc_id", "k_tkey").agg(F.first("row").alias("row")).select("row")
    return single.union(once).select("row.*")
