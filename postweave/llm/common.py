"""What several of the operators share."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postweave.session import shared_dir

# Words between ASCII white space, as Java and Python patterns read them.
SPACED = r"[^\x20\x09-\x0D]+"
# Words of digits, ASCII letters and anything beyond ASCII.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows and bytes that go to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, after lowering the session's Arrow batch limits to the above where they are larger.

    Texts are long: at the usual 10,000 rows and 64 MB a batch, the copies of one batch in Spark's and Python's memory are what a
    task needs most memory for. The limits are read when a plan is made, so they stay lowered.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    size = re.fullmatch(r"(-?\d+)([kmg]?)b?", conf.get("spark.sql.execution.arrow.maxBytesPerBatch").strip().lower())
    if not size or not 0 < int(size[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[size[2]] <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Whether the shuffle files of a query are deleted when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: as pinning, but columnar and compressed, and without its shuffles."""
    path, conf = new_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Which bytes of UTF-8 stand in words of either kind.
ALNUM_BYTES = np.zeros(256, bool)
ALNUM_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SPACED_BYTES = np.ones(256, bool)
SPACED_BYTES[[32, *range(9, 14)]] = False
_MIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_MIX, -1, 1 << 64)


class _Powers:
    """Powers of a number mod 2^64, kept up to a length that most texts stay under."""

    def __init__(self, base: int):
        self.base, self.kept = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if n > len(self.kept):
            out = np.full(max(n, 1 << 16), self.base, np.uint64)
            out[0] = 1
            out = np.multiply.accumulate(out)
            if n > 1 << 20:
                return out
            self.kept = out
        return self.kept[:n]


_powers, _inverses = _Powers(_MIX), _Powers(_INVERSE)


class Words:
    """The words of one byte string, A-Z in lower case: bounds, a hash of each, and the bytes."""

    def __init__(self, data: bytes, inside: np.ndarray = ALNUM_BYTES):
        data = data.lower()
        self.lower = low = np.frombuffer(data, np.uint8)
        n = len(low)
        held = np.zeros(n + 2, np.uint8)
        held[1:-1] = np.frombuffer(data.translate(inside.tobytes()), np.uint8)
        edges = np.flatnonzero(held[1:] != held[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        # A word's hash is the polynomial of its bytes, taken out of the prefix sums of the text.
        sums = np.zeros(n + 1, np.uint64)
        terms = low.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _powers(n)
        np.cumsum(terms, out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * _inverses(n + 1)[self.start]
        raw = (raw ^ (raw >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        self.hash = raw ^ (raw >> np.uint64(32))

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on."""
        k = len(self.hash) - n + 1
        out = np.zeros(max(k, 0), np.uint64)
        for i in range(n if k > 0 else 0):
            out *= np.uint64(_MIX)
            out += self.hash[i : i + k]
        return (out ^ (out >> np.uint64(31))) + np.uint64(n)

    def words(self, at: int, n: int) -> list[bytes]:
        return [self.lower[s:e].tobytes() for s, e in zip(self.start[at : at + n], self.end[at : at + n])]
