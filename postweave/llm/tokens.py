"""Training-order materialisation of token ids as fixed-stride shards.

Texts are tokenised once into a pinned table of compressed blocks whose partitions and row order then stay fixed. One number per
partition (its tokens) gives every partition its place in the stream of all tokens, which is cut into sequences of equal length.
A keyed Feistel permutation with cycle-walking gives every sequence a global slot. Fragments travel once, packed per range of
slots, to the task that writes the range; a shard is a file of records of one stride, so a reader reaches slot k by a seek.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from postweave.llm.common import small_batches
from postweave.session import pin

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_TOKENS = 2_000_000
HELD_TOKENS = 16_000_000
RANGE = 1024
ROUNDS = 6


@dataclass(frozen=True)
class Layout:
    """Where sequences stand: record k of a shard begins at byte k x stride."""

    n_sequences: int
    seq_len: int
    shard_sequences: int
    seed: int
    end_id: int

    @property
    def stride(self) -> int:
        return 2 * self.seq_len + 1  # two bytes an id, and the line end that Spark's text writer adds

    def place(self, slot):
        return slot // self.shard_sequences, slot % self.shard_sequences * self.stride


def permute(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Slots of the given indexes: a keyed bijection of 0..n-1."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)
    keys = [np.uint64((seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD6E8FEB86659FD93) % (1 << 64)) for r in range(ROUNDS)]
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(bits), x & mask
        for key in keys:
            f = (right + key) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(bits)) | right
        # What falls outside 0..n-1 walks on along its cycle.
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def _encoder(ranks_file: bytes, pattern: str):
    import tiktoken

    # Built once per worker process; functions sent to it are made anew for every task.
    kept = tiktoken.__dict__.setdefault("_built", {})
    key = (hash(ranks_file), pattern)
    if key not in kept:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        kept[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return kept[key]


def _compress(tokens: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=6).compress(tokens.tobytes())


def _decompress(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint16)


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> tuple[DataFrame, int]:
    """Blocks of documents (doc_ids, lengths, compressed 16-bit ids) in the order of docs, pinned; and the end id.

    A document's ids end with the end id (the first number after the vocabulary). A null or empty text has no ids at all.
    """
    with open(tokenizer, "rb") as f:
        ranks_file = f.read()
    end_id = sum(1 for line in ranks_file.splitlines() if line.strip())
    if end_id >= 1 << 16:
        raise ValueError(f"{tokenizer}: ids of {end_id} tokens do not fit 16 bits")
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(ranks_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(sent.value, pattern).encode_to_numpy
        end = np.array([end_id], np.uint16)
        ids: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def block():
            return pa.RecordBatch.from_pydict(
                {"doc_ids": [ids], "lengths": [lengths], "ids": [_compress(np.concatenate(parts) if parts else np.zeros(0, np.uint16))]},
                schema=pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())]),
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                ids.append(doc_id.as_py())
                if not text:
                    lengths.append(0)
                    continue
                own = encode(text, disallowed_special=()).astype(np.uint16)
                parts += [own, end]
                lengths.append(len(own) + 1)
                held += len(own) + 1
                if held >= BLOCK_TOKENS:
                    yield block()
                    ids, lengths, parts, held = [], [], [], 0
        if ids:
            yield block()

    blocks = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_ids array<bigint>, lengths array<bigint>, ids binary")
    return pin(blocks), end_id


def _starts(blocks: DataFrame) -> tuple[dict[int, int], int]:
    """Stream position of every partition's first token, and the number of all tokens; one row per partition is read."""
    per = blocks.select(F.spark_partition_id().alias("p"), F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n")).groupBy("p").agg(F.sum("n"))
    starts, at = {}, 0
    for p, n in sorted(map(tuple, per.collect())):
        starts[p] = at
        at += n
    return starts, at


def _fragments(blocks: DataFrame, starts, layout: Layout) -> DataFrame:
    """Parts of sequences, packed per shard and range of slots: slots, places in the sequence, lengths, compressed ids."""
    schema = pa.schema([
        ("shard", pa.int64()), ("range", pa.int64()), ("slots", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts.value.get(TaskContext.get().partitionId(), 0)
        held: dict[tuple[int, int], list] = {}
        count = 0

        def flush():
            for (shard, part), own in sorted(held.items(), key=lambda x: x[0]):
                slots, places, pieces = zip(*own)
                yield pa.RecordBatch.from_pydict(
                    {"shard": [shard], "range": [part], "slots": [slots], "places": [places], "lengths": [[len(p) for p in pieces]], "ids": [_compress(np.concatenate(pieces))]},
                    schema=schema,
                )

        for batch in batches:
            for data in batch.column(batch.schema.get_field_index("ids")):
                tokens = _decompress(data.as_py())
                if not len(tokens):
                    continue
                first, last = at // layout.seq_len, (at + len(tokens) - 1) // layout.seq_len
                slots = permute(np.arange(first, last + 1), layout.n_sequences, layout.seed).tolist()
                for k, slot in enumerate(slots, first):
                    lo, hi = max(at, k * layout.seq_len), min(at + len(tokens), (k + 1) * layout.seq_len)
                    own = held.setdefault((slot // layout.shard_sequences, slot % layout.shard_sequences // RANGE), [])
                    own.append((slot, lo - k * layout.seq_len, tokens[lo - at : hi - at]))
                at += len(tokens)
                count += len(tokens)
                if count >= HELD_TOKENS:
                    yield from flush()
                    held, count = {}, 0
        yield from flush()

    return blocks.select("ids").mapInArrow(run, "shard bigint, range bigint, slots array<bigint>, places array<bigint>, lengths array<bigint>, ids binary")


def _records(fragments: DataFrame, layout: Layout) -> DataFrame:
    """Whole sequences (shard, bytes) in slot order, from fragments sorted by shard and range; one range is held at a time."""
    schema = pa.schema([("shard", pa.int64()), ("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, grid = None, None

        def emit():
            return pa.RecordBatch.from_pydict({"shard": [now[0]] * len(grid), "record": [r.tobytes() for r in grid]}, schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                shard, part, slots, places, lengths, ids = (c[i].as_py() for c in batch.columns)
                first = shard * layout.shard_sequences + part * RANGE
                if now != (shard, part):
                    if now is not None:
                        yield emit()
                    now = (shard, part)
                    rows = min(RANGE, layout.shard_sequences - part * RANGE, layout.n_sequences - first)
                    grid = np.full((rows, layout.seq_len), layout.end_id, "<u2")
                tokens, at = _decompress(ids), 0
                for slot, place, n in zip(slots, places, lengths):
                    grid[slot - first, place : place + n] = tokens[at : at + n]
                    at += n
        if now is not None:
            yield emit()

    return fragments.mapInArrow(run, "shard bigint, record binary")


def _documents(blocks: DataFrame, starts, layout: Layout) -> DataFrame:
    """One row per document: its ids' place in the stream, and where its first sequence stands."""
    names = ("doc_id", "n_tokens", "start", "n_sequences", "first_slot", "first_shard", "first_byte")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts.value.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            for ids, lengths in zip(batch.column(0), batch.column(1)):
                n = np.array(lengths.as_py(), np.int64)
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                some = n > 0
                first = start // layout.seq_len
                sequences = np.where(some, (start + n - 1) // layout.seq_len - first + 1, 0)
                slot = np.zeros(len(n), np.int64)
                slot[some] = permute(first[some], max(layout.n_sequences, 1), layout.seed)
                shard, byte = layout.place(slot)
                cols = [ids.as_py(), n, start, sequences, *(pa.array(x, pa.int64(), mask=~some) for x in (slot, shard, byte + 2 * (start % layout.seq_len)))]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols], schema=schema)

    return blocks.select("doc_ids", "lengths").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def materialise(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, seq_len: int = 1024, seed: int = 0,
    least_shard: int = 1024, most_shards: int = 100_000,
) -> tuple[DataFrame, Layout]:
    """Writes the shards under path and returns one row per document, and the layout.

    path/shards/shard=<k>/ holds one file of little-endian 16-bit ids, a record per slot; path/layout is the layout as JSON.
    There are at most most_shards shards, of at least least_shard sequences. The last sequence is filled up with the end id.
    Null or empty texts take no place: n_tokens 0, no slot. Repeated rows are documents of their own. A table without ids writes
    the layout only. Other columns are not read. A reader that stops after slot k goes on at slot k + 1: layout.place tells where.
    """
    spark = docs.sparkSession
    blocks, end_id = tokenised(docs, tokenizer)
    starts, n = _starts(blocks)
    n_sequences = -(-n // seq_len)
    layout = Layout(n_sequences, seq_len, max(least_shard, -(-n_sequences // most_shards)), seed, end_id)
    sent = spark.sparkContext.broadcast(starts)
    if n_sequences:
        shards = -(-n_sequences // layout.shard_sequences)
        packed = _fragments(blocks, sent, layout).repartition(max(1, shards), "shard").sortWithinPartitions("shard", "range")
        records = _records(packed, layout).select("shard", F.col("record").cast("string").alias("record"))
        records.write.partitionBy("shard").option("compression", "none").option("lineSep", "\n").text(f"{path}/shards")
    told = {**layout.__dict__, "stride": layout.stride, "tokenizer": tokenizer}
    spark.createDataFrame([(str(k), str(v)) for k, v in told.items()], "name string, value string").coalesce(1).write.json(f"{path}/layout")
    return _documents(blocks, sent, layout), layout
