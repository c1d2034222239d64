"""Hard negatives: for every anchor and positive, the nearest rows of another label that score no more than the positive.

The positives of an anchor have scores p1 >= p2 >= ...; each is the upper limit of a window of negatives, and windows overlap. The
upper limits cut the scores into disjoint slots: slot i holds scores over the next limit and up to the i-th. Every task keeps the
best few negatives of each slot, tasks are merged, and the window of positive i is answered by merging slots i, i+1, ... downwards.
Anchors go to the tasks in blocks of bounded bytes; a block is two passes over the table, one for positives, one for negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postweave.llm.best import LARGEST, Best, ranked
from postweave.llm.common import small_batches, stored

# Bytes of anchor vectors that go to a task at once, and scores that a task computes at once.
BLOCK_BYTES = 16 << 20
CELLS = 1_000_000
POSITIVES = NEGATIVES = 5
# Share of a positive's score that a negative must reach, in hundredths.
LEAST = 80
_KEPT = pa.schema([("anchor", pa.int32()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])
_KEPT_DDL = "anchor int, slot int, score bigint, vec_id bigint"


def noisy_label(vec_id: Column, label: Column) -> Column:
    """The label, moved on by one of ten where the id is divisible by 7."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part: nothing null, nothing infinite or not a number."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vector = F.col("embedding").cast("array<double>")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector")).where(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", odd), F.lit(True))
    )


def whole(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """floor(256 x) of every component; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v[:width]
    return np.floor(out * 256)


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 64 bits the nearest number of 64 bits."""
    top = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(rows.shape[1], 1)
    if top < 2.0**53:
        return (rows @ anchors.T).astype(np.int64)
    as_int = lambda a: np.array([[int(x) for x in r] for r in a], object).reshape(a.shape)
    exact = as_int(rows) @ as_int(anchors).T
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


def _scan(rows: DataFrame, sent, groups: Callable[[dict], int], k: int, entries: Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]], slots: int) -> DataFrame:
    """The k best entries per group that each task finds among its rows: anchor, slot, score, vec_id.

    entries(block, scores, ids, labels) gives the groups (anchor * slots + slot), row numbers and columns of what may be kept.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        anchors, width = block["vectors"], block["vectors"].shape[1]
        best = Best(groups(block), k)
        step = max(1, CELLS // max(len(anchors), 1))
        for batch in batches:
            ids = batch.column(0).fill_null(LARGEST).to_numpy(zero_copy_only=False)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                vectors = whole([np.asarray(v.values) for v in lists[part]], width)
                scores = products(vectors, anchors)
                group, row, column = entries(block, scores, ids[part], labels[part])
                best.add(group, scores[row, column], ids[part][row])
        group, score, key = best.fold()
        if len(group):
            yield pa.RecordBatch.from_arrays(
                [pa.array(group // slots, pa.int32()), pa.array(group % slots, pa.int32()), pa.array(score, pa.int64()), pa.array(key, pa.int64(), mask=key == LARGEST)], schema=_KEPT
            )

    return rows.select("vec_id", "label", "vector").mapInArrow(run, _KEPT_DDL)


def _positive_entries(block, scores, ids, labels):
    same = (labels[:, None] == block["labels"][None, :]) & (ids[:, None] != block["ids"][None, :])
    k = block["k"]
    if len(scores) > k:
        # No row under the k-th best score of this part can be one of the k best.
        held = np.where(same, scores, -LARGEST)
        same &= held >= np.partition(held, len(held) - k, axis=0)[len(held) - k][None, :]
    row, column = np.nonzero(same)
    return column, row, column


def _negative_entries(block, scores, ids, labels):
    limits = block["limits"]
    # No window of the anchor reaches beyond these.
    able = (scores <= limits[:, 0][None, :]) & (scores >= block["lowest"][None, :]) & (labels[:, None] != block["labels"][None, :])
    row, column = np.nonzero(able)
    # Slot i: as many limits from the second on as are not below the score.
    slot = (limits[column, 1:] >= scores[row, column][:, None]).sum(axis=1)
    return column * limits.shape[1] + slot, row, column


def _ceil_share(p: int, least: int) -> int:
    return -((-least * p) // 100)


def _blocks(anchors: DataFrame, block_bytes: int) -> Iterator[DataFrame]:
    """The anchors with a number `anchor` from 0 in each block, in blocks of at most block_bytes of vectors (or one vector)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block, n, width = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            at, place = [], []
            for size in batch.column(2).value_lengths().to_pylist():
                # Vectors of a block are as wide as its widest.
                if n and (n + 1) * max(width, size) * 8 > block_bytes:
                    block, n, width = block + 1, 0, 0
                at.append(block)
                place.append(n)
                n, width = n + 1, max(width, size)
            numbers = [pa.array(x, pa.int64()) for x in ([task] * len(at), at, place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=[*batch.schema.names, "part", "block", "anchor"])

    one = stored(anchors.distinct(), "anchors")
    size = one.agg(F.coalesce(F.sum(F.size("vector") * 8), F.lit(0))).first()[0]
    dealt = one.repartition(1 + size // block_bytes).mapInArrow(packed, "vec_id bigint, label bigint, vector array<double>, part bigint, block bigint, anchor bigint")
    table = stored(dealt, "anchor-blocks")
    # One row per block.
    for part, block in [tuple(r) for r in table.select("part", "block").distinct().orderBy("part", "block").collect()]:
        yield table.where((F.col("part") == part) & (F.col("block") == block))


def hard_negatives(
    rows: DataFrame, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, embedding, label; other columns are not read. Anchors are the rows that `anchor` holds for (ids divisible by 100).
    An anchor's positives are its first `positives` rows of the same label and another id; negatives have another label and a score
    of at least `least` hundredths of the positive's and at most the positive's. Higher scores come first, then smaller ids, then
    rows without id, which are no anchors. Rows with a null label or vector or with a null, infinite or undefined component take no
    part. Anchors that are repeated whole count once; every other row counts as often as it is there, as positive and as negative.
    Anchors of one id and different vectors are answered each for itself. Shorter vectors end in zeros. An empty table gives no rows.
    """
    small_batches(rows)
    pool = usable(rows).withColumn("label", noisy_label(F.col("vec_id"), F.col("label")))
    is_anchor = F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)) if anchor is None else anchor
    spark, out = rows.sparkSession, None
    for anchors in _blocks(pool.where(is_anchor), block_bytes):
        # At most block_bytes.
        own = sorted(anchors.select("anchor", "vec_id", "label", "vector").collect(), key=lambda r: r["anchor"])
        width = max(len(r["vector"]) for r in own)
        block = {
            "vectors": whole([np.array(r["vector"], float) for r in own], width), "labels": np.array([r["label"] for r in own]),
            "ids": np.array([r["vec_id"] for r in own]), "k": positives,
        }
        sent = spark.sparkContext.broadcast(block)
        near = _scan(pool, sent, lambda b: len(b["ids"]), positives, _positive_entries, 1).drop("slot")
        found = stored(ranked(near, ["anchor"], "score", "vec_id", positives, "place"), "positives")
        # At most `positives` rows per anchor of the block.
        limits = np.full((len(own), positives), -LARGEST, np.int64)
        for r in found.select("anchor", "place", "score").collect():
            limits[r["anchor"], r["place"] - 1] = r["score"]
        # The window of a negative score is empty, so the least of the others tells how low scores may be.
        lowest = [min((_ceil_share(int(p), least) for p in row if p >= 0), default=LARGEST) for row in limits]
        sent2 = spark.sparkContext.broadcast(block | {"limits": limits, "lowest": np.array(lowest, np.int64)})
        kept = _scan(pool, sent2, lambda b: b["limits"].size, negatives, _negative_entries, positives)
        slots = ranked(kept, ["anchor", "slot"], "score", "vec_id", negatives, "of_slot")
        of = found.select("anchor", F.col("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        low = slots.select("anchor", "slot", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        # Slots at and under that of a positive, merged: at most slots x negatives rows for each.
        both = of.join(low, "anchor").where(F.col("slot") >= F.col("place") - 1).where("negative_score <= positive_score")
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
        first = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        first = first.where(F.lit(least).cast("decimal(20,0)") * F.col("positive_score") <= F.lit(100).cast("decimal(20,0)") * F.col("negative_score"))
        names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
        done = stored(first.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
        out = done if out is None else out.unionByName(done)
        sent.destroy()
        sent2.destroy()
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return out if out is not None else spark.createDataFrame([], empty)
