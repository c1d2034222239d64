"""N-gram scores of texts by a whole-word trigram model with back-off.

Tokens are words and one end per text; two ends stand before a text. Every training trigram of words is counted. A state is a context
of one or two words seen in training; it has Witten-Bell weights for the words seen after it and a back-off weight to the shorter
context. Texts are packed once into chunks of a fixed number of tokens. A chunk sends its distinct pairs of words and the words after
them, with their training counts, to the parts that the pairs are hashed to; a part adds up what all chunks sent and answers each chunk
in the order in which it asked; a chunk takes its answers and walks its texts. So a context that stands in every text is one entry of each
chunk, not one of each text. Messages are columns of small numbers without their empty bytes, compressed: a word among the most
frequent is its rank, another one is listed by its hash in the message, which decides the bytes and never the score. Nothing is capped:
what a task holds at once is fixed, the number of chunks and parts grows with the corpus. Words in no training text are one unknown word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import SPACED_BYTES, Words, small_batches, stored

# Words that messages name by rank, and whose counts are sent to every task: the most frequent ones and the end.
ALPHABET = 262_146
FREQUENT = ALPHABET - 2
END = -0x61C8864680B583EB
# Tokens of a chunk, and tokens of the corpus per part.
HELD, PART = 750_000, 750_000


def held_out(doc_id: Column) -> Column:
    """Is the remainder of crc32 of the id as text by 5 one? A document without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def hashes(text: str | None) -> np.ndarray:
    """A number per word of the text, A-Z in lower case."""
    return Words((text or "").encode(), SPACED_BYTES).hash.view(np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on as planes of their lower bytes, compressed."""
    import zstandard

    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T
    width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 1
    return bytes([max(width, 1)]) + zstandard.compress(planes[: max(width, 1)].tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").reshape(-1)


def _chunks(docs: DataFrame) -> DataFrame:
    """Packed texts (chunk, ids, trains, sizes, words, tokens, held): tokens are places in words, the most frequent first."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("trains", pa.list_(pa.bool_())),
        ("sizes", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("held", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, ids, trains, parts = TaskContext.get().partitionId() << 32, 0, [], [], []

        def chunk() -> pa.RecordBatch:
            words, at, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            row = made, ids, trains, packed(np.array([len(p) for p in parts])), words[order].tobytes(), packed(place[at]), held
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc_id, train, text in zip(*batch.columns):
                ids.append(doc_id.as_py())
                trains.append(train.as_py())
                parts.append(np.append(hashes(text.as_py()), END))
                held += len(parts[-1])
                if held > HELD:
                    yield chunk()
                    made, held, ids, trains, parts = made + 1, 0, [], [], []
        if parts:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), "text")
    return stored(rows.mapInArrow(run, "chunk bigint, ids array<bigint>, trains array<boolean>, sizes binary, words binary, tokens binary, held bigint"), "lm-chunks")


def _words(chunks: DataFrame) -> DataFrame:
    """(word, n, last) of all words: their training tokens, and 1 if a training text has it before its end, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for trains, sizes, words, tokens in zip(*batch.columns):
                sizes, tokens, words = unpacked(sizes.as_py()), unpacked(tokens.as_py()), np.frombuffer(words.as_py(), np.int64)
                train, stop = np.array(trains.as_py(), bool), np.cumsum(sizes) - 1
                n = np.bincount(tokens[np.repeat(train, sizes)], minlength=len(words))
                last = np.zeros(len(words), np.int64)
                # Before the end of a text without words stands the end of the one before, or nothing.
                last[tokens[stop[train & (sizes > 1)] - 1]] = 1
                last[words == END] = int((train & (sizes == 1)).any())
                yield pa.RecordBatch.from_pydict({"word": words, "n": n, "last": last})

    counted = chunks.select("trains", "sizes", "words", "tokens").mapInArrow(run, "word bigint, n bigint, last bigint")
    return stored(counted.groupBy("word").agg(F.sum("n").alias("n"), F.max("last").alias("last")), "lm-words")


def _most(words: DataFrame, size: int) -> list[int]:
    """Hashes of the most frequent training words but the end, the most frequent first; `size` or fewer, none of those as rare as the next."""
    own = words.where("n > 0").where(F.col("word") != END)
    least, held = 1, 0
    for r in own.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        held += r["count"]
        if held > size:
            least = r["n"] + 1
            break
    got = own.where(F.col("n") >= least).select("word", "n").toArrow()
    word, n = (got.column(c).to_numpy() for c in ("word", "n"))
    return word[np.lexsort((word, -n))].tolist()


def frequent_words(docs: DataFrame, size: int = FREQUENT) -> list[int]:
    """Hashes of the most frequent training words, the most frequent first."""
    return _most(_words(_chunks(docs)), size)


def _ranks(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The place of each word in frequent, -1 of others."""
    order = np.argsort(frequent, kind="stable")
    at = order[np.minimum(np.searchsorted(frequent, words, sorter=order), len(frequent) - 1)]
    return np.where(frequent[at] == words, at, -1)


def _mixed(*words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words[0]), np.uint64)
    for x in words:
        out = (out ^ x.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@dataclass(frozen=True)
class Grams:
    """The distinct grams of a chunk, by part. Codes of words are ranks, and for the others len(frequent) and their place in rare."""

    rare: np.ndarray   # hashes
    token: np.ndarray  # codes of the text
    u: np.ndarray      # of the pairs: those of the text, and the two ends before it
    v: np.ndarray
    n: np.ndarray      # training counts
    part: np.ndarray
    pair: np.ndarray   # of the trigrams: place among pairs of the first two words
    last: np.ndarray   # of the last two
    w: np.ndarray
    m: np.ndarray
    at: np.ndarray     # of the tokens: place among trigrams


def grams(trains: list[bool], sizes: np.ndarray, words: np.ndarray, tokens: np.ndarray, frequent: np.ndarray, parts: int) -> Grams:
    ranks = _ranks(words, frequent)
    others = np.flatnonzero(ranks < 0)
    ranks[others] = len(frequent) + np.arange(len(others))
    hashed, end = np.concatenate((frequent, words[others])), _ranks(np.array([END]), frequent)[0]
    base, token = len(hashed), ranks[tokens]
    weight = np.repeat(np.array(trains, bool), sizes).astype(np.int64)
    # Before a text stands the end of the one before.
    before = np.concatenate(([end], token))
    pairs, place = np.unique(before * base + np.append(token, end), return_inverse=True)
    u, v = pairs // base, pairs % base
    part = (_mixed(hashed[u], hashed[v]) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    place = turn[place]
    context = np.append(place[-1], place[:-2])
    context[np.cumsum(sizes) - sizes] = place[-1]
    third, first, at = np.unique(context * base + token, return_index=True, return_inverse=True)
    n, m = (np.bincount(x, weight, size).astype(np.int64) for x, size in ((place[:-1], len(pairs)), (at, len(third))))
    return Grams(words[others], token, u[order], v[order], n, part[order], third // base, place[first], third % base, m, at)


def _of(row: dict, frequent: np.ndarray, parts: int) -> Grams:
    if row.get("ranks"):  # of a chunk without its frequent words
        ranks, words = unpacked(row["ranks"]) - 1, np.frombuffer(row["words"], np.int64)
        row["words"] = np.where(ranks < 0, 0, frequent[ranks])
        row["words"][ranks < 0] = words
        row["words"] = row["words"].tobytes()
    return grams(row["trains"], unpacked(row["sizes"]), np.frombuffer(row["words"], np.int64), unpacked(row["tokens"]), frequent, parts)


_SENT = ("rare", "u", "v", "n", "runs", "w", "m")


def _asked(chunks: DataFrame, frequent, parts: int) -> DataFrame:
    """(part, chunk, columns of _SENT): the distinct grams of each chunk, by part. u is sent as steps, runs are trigrams per pair."""
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in _SENT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = len(frequent.value)
        for batch in batches:
            for row in batch.to_pylist():
                g = _of(row, frequent.value, parts)
                runs = np.bincount(g.pair, minlength=len(g.u))
                edge = np.searchsorted(g.part, np.arange(parts + 1))
                edge_of_runs = np.append(0, np.cumsum(runs))[edge]
                out = []
                for p in np.unique(g.part).tolist():
                    c, t = slice(edge[p], edge[p + 1]), slice(edge_of_runs[p], edge_of_runs[p + 1])
                    named = [g.u[c], g.v[c], g.w[t]]
                    rare = np.unique(np.concatenate([x[x >= known] for x in named]))
                    u, v, w = (np.where(x < known, x, known + np.searchsorted(rare, x)) for x in named)
                    sent = np.diff(u, prepend=0), v, g.n[c], runs[c], w, g.m[t]
                    out.append((p, row["chunk"], g.rare[rare - known].tobytes(), *map(packed, sent)))
                    if len(out) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return chunks.select("chunk", "trains", "sizes", "words", "tokens").mapInArrow(run, "part bigint, chunk bigint, " + ", ".join(f"{c} binary" for c in _SENT))


def _answer(frequent) -> Callable[[pa.Table], pa.Table]:
    """Sums of a part: for each chunk, in the order it asked, and per word the number of distinct words after it, the end not included.

    The latter are rows of word and after, and for the frequent words one row of their ranks, as steps, in n and the numbers in m.
    """
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), *((c, pa.binary()) for c in ("n", "kinds", "m")), ("word", pa.int64()), ("after", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        known = len(frequent.value)
        rare = [np.frombuffer(x, np.int64) for x in table.column("rare").to_pylist()]
        others = np.unique(np.concatenate(rare))
        base = known + len(others)
        place = [np.searchsorted(others, r) for r in rare]

        def column(name: str) -> list[np.ndarray]:
            return [unpacked(x) for x in table.column(name).to_pylist()]

        def codes(name: str, steps: bool = False) -> np.ndarray:
            got = [np.cumsum(x) if steps else x for x in column(name)]
            for x, at in zip(got, place):
                far = x >= known
                x[far] = known + at[x[far] - known]
            return np.concatenate(got)

        def split(x: np.ndarray, sizes: list[int]) -> list[bytes]:
            return [packed(p) for p in np.split(x, np.cumsum(sizes)[:-1])]

        n, runs, m = column("n"), column("runs"), column("m")
        pairs, at = np.unique(codes("u", True) * base + codes("v"), return_inverse=True)
        third, of = np.unique(np.repeat(at, np.concatenate(runs)) * base + codes("w"), return_inverse=True)
        seen, sums = (np.bincount(x, np.concatenate(c), len(y)).astype(np.int64) for x, c, y in ((at, n, pairs), (of, m, third)))
        kinds = np.bincount((third // base)[sums > 0], minlength=len(pairs))
        end = _ranks(np.array([END]), frequent.value)[0]
        after = np.bincount((pairs // base)[(seen > 0) & (pairs % base != end)], minlength=base)
        near, far = np.flatnonzero(after[:known]), np.flatnonzero(after[known:])
        sizes = [len(x) for x in n]
        answers = [table.column("chunk").to_pylist(), table.column("part").to_pylist(), *(split(x[at], sizes) for x in (seen, kinds)), split(sums[of], [len(x) for x in m])]
        near = [None, None, packed(np.diff(near, prepend=0)), None, packed(after[near])]
        rows = [*(a + [x] + [None] * len(far) for a, x in zip(answers, near)), [None] * (len(n) + 1) + others[far].tolist(), [None] * (len(n) + 1) + after[known:][far].tolist()]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)

    return run


def _walk(frequent, counts, parts: int, norm: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores of a chunk's texts by the answers of all parts."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        g, sizes = _of(row, frequent.value, parts), unpacked(row["sizes"])
        of_part = answers.filter(pc.is_valid(answers.column("part"))).sort_by("part")
        n, kinds, m = (np.concatenate([unpacked(x) for x in of_part.column(c).to_pylist()]) for c in ("n", "kinds", "m"))
        words = np.concatenate((counts.value, np.zeros((2, len(g.rare)), np.int64)), axis=1)
        of_word = answers.filter(pc.is_valid(answers.column("word")))
        order = np.argsort(g.rare)
        at = len(frequent.value) + order[np.searchsorted(g.rare, of_word.column("word").to_numpy(), sorter=order)]
        words[:, at] = of_word.column("seen").to_numpy(), of_word.column("after").to_numpy()
        seen, follow = words

        def backed(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, lower: np.ndarray) -> np.ndarray:
            """Witten-Bell probability of a word seen n times in a context, that of the shorter context where the context is not known."""
            return np.where(total > 0, (n + kinds * lower) / np.maximum(total + kinds, 1), lower)

        end = _ranks(np.array([END]), frequent.value)[0]
        # A pair is followed as often as it is there, the two ends before a text as often as there are texts.
        total = np.where((g.u == end) & (g.v == end), seen[end], n)
        single = (seen + 0.5) / norm
        lower = backed(n, seen[g.u], follow[g.u], single[g.v])
        score = np.log10(backed(m, total[g.pair], kinds[g.pair], lower[g.last]))
        start = np.cumsum(sizes) - sizes
        per = [np.add.reduceat(x, start) for x in ((seen > 0).astype(np.int64)[g.token], np.log10(single)[g.token], score[g.at])]
        held = ~np.array(row["trains"], bool)
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "held_out": held, "n_tokens": sizes, "n_known": per[0], "base_score": per[1], "score": per[2]})

    return run


def lm_scores(docs: DataFrame, size: int = FREQUENT) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts are empty and have one token, the end. Documents without id are training text. Repeated rows count as often as they
    are there and score alike. Without training text all counts are 0 and every token has probability 1. Other columns are not read.
    The counts of `size` words are sent to all tasks; the number decides the work, not the result.
    """
    small_batches(docs)
    context = docs.sparkSession.sparkContext
    chunks = _chunks(docs)
    words = _words(chunks)
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    parts = -(-(chunks.agg(F.sum("held")).first()[0] or 1) // PART)
    frequent = context.broadcast(np.array([END, *_most(words, size)], np.int64))

    answered = "chunk bigint, part bigint, n binary, kinds binary, m binary, word bigint, after bigint"
    answers = stored(_asked(chunks, frequent, parts).groupBy("part").applyInArrow(_answer(frequent), answered), "lm-answers")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for steps, after in zip(*batch.columns):
                yield pa.RecordBatch.from_pydict({"word": frequent.value[np.cumsum(unpacked(steps.as_py()))], "after": unpacked(after.as_py())})

    near = answers.where("chunk IS NULL AND word IS NULL").select("n", "m").mapInArrow(ranked, "word bigint, after bigint")
    after = near.union(answers.where("word IS NOT NULL").select("word", "after")).groupBy("word").agg(F.sum("after").alias("after"))
    words = stored(words.join(after, "word", "left").select("word", F.col("n").alias("seen"), (F.coalesce("after", F.lit(0)) + F.col("last")).alias("after")), "lm-followed")
    named = docs.sparkSession.createDataFrame(pa.table({"word": frequent.value, "rank": np.arange(len(frequent.value))}))
    told = words.join(F.broadcast(named), "word").select("rank", "seen", "after").toArrow()
    counts = np.zeros((2, len(frequent.value)), np.int64)
    counts[:, told.column("rank").to_numpy()] = told.column("seen").to_numpy(), told.column("after").to_numpy()

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, own in zip(*batch.columns):
                own = np.frombuffer(own.as_py(), np.int64)
                own = own[_ranks(own, frequent.value) < 0]
                yield pa.RecordBatch.from_pydict({"chunk": np.full(len(own), chunk.as_py()), "word": own})

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The chunks with the ranks of their words, from 1 on and 0 for the others, and with the hashes of the others only."""
        for batch in batches:
            own = [np.frombuffer(w, np.int64) for w in batch.column("words").to_pylist()]
            ranks = [_ranks(w, frequent.value) for w in own]
            kept = pa.array([w[r < 0].tobytes() for w, r in zip(own, ranks)], pa.binary())
            batch = batch.set_column(batch.schema.get_field_index("words"), "words", kept)
            yield batch.append_column("ranks", pa.array([packed(r + 1) for r in ranks], pa.binary()))

    rare = chunks.select("chunk", "words").mapInArrow(others, "chunk bigint, word bigint").join(words, "word")
    none = F.lit(None).cast("long")
    told = answers.where("part IS NOT NULL").select("chunk", "part", "n", "kinds", "m", none.alias("word"), none.alias("seen"), none.alias("after"))
    told = told.unionByName(rare, allowMissingColumns=True)
    walk = _walk(frequent, context.broadcast(counts), parts, total + 0.5 * (kinds + 1))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    texts = chunks.select("chunk", "ids", "trains", "sizes", "words", "tokens")
    texts = texts.mapInArrow(stripped, "chunk bigint, ids array<bigint>, trains array<boolean>, sizes binary, words binary, tokens binary, ranks binary")
    scored = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(walk, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
