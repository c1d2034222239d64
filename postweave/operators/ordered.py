"""Running values in a per-group order when one group may hold a large share of all rows.

Rows are range-partitioned and sorted on (group, order), so a hot group spreads over many chunks and a
chunk is one partition. Python steps stream through a partition in Arrow batches and need no further
shuffle; chunk summaries are combined per group (at most one row per chunk), and what a chunk takes
over from earlier ones, for its first group only, is joined back as a small table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from postweave.session import pin

CHUNK = "_chunk"
# Rows of a chunk: what one task holds at a time where a chunk is worked on as a whole.
CHUNK_ROWS = 65_536


def in_chunks(df: DataFrame, group: Sequence[str], order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """df with its chunk number. The result is pinned: range bounds are sampled, and a second
    evaluation could draw them elsewhere. By default there are as many chunks as keep them at about
    CHUNK_ROWS rows, so a chunk stays as small when the table grows."""
    n = chunks or -(-df.count() // CHUNK_ROWS) or 1
    ranged = df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
    return pin(ranged.withColumn(CHUNK, F.spark_partition_id()))


def small(per_chunk: DataFrame, most: int = 200_000) -> tuple[DataFrame, bool]:
    """A table of a few rows per chunk, marked to be sent to all tasks if it has up to `most` rows; and whether it is."""
    kept = pin(per_chunk)
    sent = kept.count() <= most
    return (F.broadcast(kept) if sent else kept), sent


def groups_of(names: pa.Array, last: tuple) -> np.ndarray:
    """Number of each row's group within a sorted batch, from 0; -1 while the group of the batch before, `last`, goes on."""
    fresh = np.ones(len(names), bool)
    fresh[0] = last != (names[0].as_py(),)
    if len(names) > 1:
        same = pc.equal(names[1:], names[:-1]).fill_null(False)
        fresh[1:] = ~np.asarray(pc.or_(same, pc.and_(pc.is_null(names[1:]), pc.is_null(names[:-1]))))
    return np.cumsum(fresh) - 1


def sums_in(group: np.ndarray, values: np.ndarray, carried: int) -> np.ndarray:
    """Running sums per group of a batch; group -1 goes on from the sum carried over."""
    total = np.cumsum(values)
    starts = np.flatnonzero(np.diff(group, prepend=-1) > 0)
    return total - np.concatenate((total[starts] - values[starts], [-carried]))[group]


def running_sum(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Adds the running sum of a whole-number column within (group, chunk); streams through the sorted partitions."""
    at, value_at = rows.columns.index(group), rows.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = (), 0
        for batch in batches:
            n = batch.num_rows
            if n:
                names = batch.column(at)
                sums = sums_in(groups_of(names, last), np.asarray(batch.column(value_at)).astype(np.int64), carried)
                last, carried = (names[n - 1].as_py(),), int(sums[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, {name} bigint")


def earlier_chunks(group: Sequence[str]):
    return Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def total_before(c: Column | str, group: Sequence[str]) -> Column:
    return F.coalesce(F.sum(c).over(earlier_chunks(group)), F.lit(0))
