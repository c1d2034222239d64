"""The k best entries of every group: what a task keeps of its rows, and how the tasks' entries meet."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

LARGEST = np.iinfo(np.int64).max
# Pieces that the entries of one group are dealt to before they meet.
SALTS = 32


class Best:
    """The k best entries (highest score, then least key) of each numbered group, from entries given in any order."""

    def __init__(self, groups: int, k: int):
        self.k, self.floor = k, np.full(groups, -LARGEST, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, group: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        able = score >= self.floor[group]
        self.parts.append((group[able], score[able], key[able]))
        self.held += int(able.sum())
        if self.held > 4 * self.k * len(self.floor) + 100_000:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, score and key of the entries that are among the best so far."""
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        group, score, key = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((key, -score, group))
        group, score, key = group[order], score[order], key[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
        size = np.diff(np.r_[first, len(group)])
        keep = np.arange(len(group)) - np.repeat(first, size) < self.k
        full = size >= self.k
        self.floor[group[first[full]]] = score[first[full] + self.k - 1]
        self.parts = [(group[keep], score[keep], key[keep])]
        self.held = int(keep.sum())
        return self.parts[0]


def ranked(kept: DataFrame, by: Sequence[str], score: str, key: str, k: int, rank: str) -> DataFrame:
    """The k best rows per group, numbered from 1 in the column `rank`; rows without key come after those of the same score.

    Groups meet in pieces first, so that no task holds what all tasks kept for one group.
    """
    order = [F.desc(score), F.asc_nulls_last(key)]
    pieces = kept.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    first = pieces.withColumn("_place", F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(*order))).where(F.col("_place") <= k)
    whole = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return first.drop("_salt", "_place").withColumn(rank, whole).where(F.col(rank) <= k)
