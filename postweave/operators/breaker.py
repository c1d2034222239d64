"""Breaker timeline: which attempts a per-source breaker would have let through.

A breaker is a state machine over the attempts of one source in order. Batch use splits every source
into chunks of bounded size: each chunk is reduced to a map from its entry state to its exit state,
the maps of a source are applied one after the other (a few rows per chunk), and with its entry
state known each chunk is replayed on its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from postweave.operators import ordered as O

THRESHOLD = 3
COOLDOWN = 60.0


class State(NamedTuple):
    """opened: time of the failure that opened it, in microseconds; -1 while closed."""

    opened: int = -1
    failures: int = 0


def replay(ts: np.ndarray, ok: np.ndarray, state: State, threshold: int, wait: int):
    """Per attempt: state seen, skipped or not, and the breaker after it (opened, failures)."""
    opened, failures = state
    seen, skipped, since, streak = [], [], [], []
    for t, good in zip(ts.tolist(), ok.tolist()):
        probing = opened >= 0 and t - opened >= wait
        skip = opened >= 0 and not probing
        seen.append("half_open" if probing else "open" if skip else "closed")
        if not skip:
            failures = 0 if good else failures + 1
            opened = -1 if good else t if probing or failures >= threshold else opened
        skipped.append(skip)
        since.append(opened)
        streak.append(failures)
    return seen, skipped, since, streak


class Exit(NamedTuple):
    """Exit state; with relative set, failures are added to those at entry."""

    opened: int
    failures: int
    relative: bool


def exits(ts: np.ndarray, ok: np.ndarray, threshold: int, wait: int) -> tuple[list[Exit], list[tuple[int, Exit]]]:
    """Exit per entry failure count while closed, and per reopening time while open.

    The second list is sorted by time: an open breaker that may probe from time x on leaves by the
    first entry whose time is at least x, and stays as it is if there is none.
    """
    n = len(ts)
    probe_at = np.maximum(np.searchsorted(ts, ts + wait, "left"), np.arange(1, n + 1)).tolist()
    times, good = ts.tolist(), ok.tolist()
    closed = [Exit(-1, c, False) for c in range(threshold)]
    probing: list[Exit] = [None] * n

    def opened(i: int, failures: int, relative: bool) -> Exit:
        if probe_at[i] == n:
            return Exit(times[i], failures, relative)
        out = probing[probe_at[i]]
        return Exit(out.opened, out.failures + failures, relative) if out.relative else out

    for i in range(n - 1, -1, -1):
        if good[i]:
            probing[i] = closed[0]
            closed = [closed[0]] * threshold
        else:
            probing[i] = opened(i, 1, True)
            closed = closed[1:] + [opened(i, threshold, False)]
    # An entry waits at most until ts[0] + wait; runs of equal exits shrink to their last time.
    reach = min(int(np.searchsorted(ts, ts[0] + wait, "left")) + 1, n)
    table = [(times[i], probing[i]) for i in range(reach) if i + 1 == reach or probing[i] != probing[i + 1]]
    return closed, table


def step(state: State, closed: list[Exit], table: list[tuple[int, Exit]], wait: int) -> State:
    if state.opened < 0:
        out = closed[state.failures]
    else:
        at = bisect_left(table, state.opened + wait, key=lambda row: row[0])
        if at == len(table):
            return state
        out = table[at][1]
    return State(out.opened, out.failures + (state.failures if out.relative else 0))


_MAP = "chunk int, closed boolean, at long, opened long, failures long, relative boolean"


def breaker_timeline(
    attempts: DataFrame, threshold: int = THRESHOLD, cooldown: float = COOLDOWN,
    source: str = "source", ts: str = "ts", seq: str = "seq", chunks: int | None = None,
) -> DataFrame:
    """attempts: source, ts, seq, ok. Adds state (seen by the attempt), skipped and consecutive."""
    named = attempts.select(F.col(source).alias("source"), F.unix_micros(ts).alias("us"), F.col(seq).alias("seq"), "ok")
    return walk(named, threshold, cooldown, chunks=chunks).select(
        F.col("source").alias(source), F.timestamp_micros("us").alias(ts), F.col("seq").alias(seq),
        "ok", "state", "skipped", F.col("failures").alias("consecutive"),
    )


def walk(
    attempts: DataFrame, threshold: int, cooldown: float, before: DataFrame | None = None, chunks: int | None = None,
) -> DataFrame:
    """attempts: source, us, seq, ok. Adds state, skipped, and the breaker after the attempt (opened, failures).

    before holds the breakers (source, opened, failures) with which the sources start; others start
    closed. Chunks are ranges of the order (source, time), so only the first and last source of a
    chunk can go on in another one: two maps per chunk are all that has to be carried.
    """
    wait = int(cooldown * 1_000_000)
    kinds = ", ".join(f"{c} {attempts.schema[c].dataType.simpleString()}" for c in ("source", "us", "seq", "ok"))
    kind = attempts.schema["source"].dataType.simpleString()
    if before is None:
        before = attempts.sparkSession.createDataFrame([], f"source {kind}, opened long, failures long")
    begin = before.select("source", F.col("opened").alias("opened0"), F.col("failures").alias("failures0"))
    rows = O.in_chunks(attempts, ["source"], ["us", "seq"], chunks)

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Maps of the partition's first and last source; a partition is a chunk of bounded size."""
        held = [f for f in frames if len(f)]
        if not held:
            return
        f = pd.concat(held, ignore_index=True)
        for name in dict.fromkeys((f["source"].iloc[0], f["source"].iloc[-1])):
            edge = f[f["source"] == name]
            closed, table = exits(edge["us"].to_numpy(), edge["ok"].to_numpy(), threshold, wait)
            out = [(True, c, *e) for c, e in enumerate(closed)] + [(False, t, *e) for t, e in table]
            out = pd.DataFrame(out, columns=["closed", "at", "opened", "failures", "relative"])
            yield out.assign(source=name, chunk=f[O.CHUNK].iloc[0])[["source", "chunk", "closed", "at", "opened", "failures", "relative"]]

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Entry states of the chunks of each source: the maps stream by in order, and one state is kept."""
        source, chunk, state, after = object(), None, State(), None
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                if r.source != source:
                    source, chunk, after = r.source, None, State(int(r.opened0), int(r.failures0))
                if r.chunk != chunk:
                    # What the chunk before has left, or the state that it could not change.
                    chunk, state, after = r.chunk, state if after is None else after, None
                    out.append((source, chunk, *state))
                if after is None and (r.at == state.failures if r.closed else r.at >= state.opened + wait) and r.closed == (state.opened < 0):
                    after = State(int(r.opened), int(r.failures) + (state.failures if r.relative else 0))
            yield pd.DataFrame(out, columns=["source", O.CHUNK, "opened", "failures"])

    def annotate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Streams through the partition; the breaker after a batch is all that the next one needs."""
        name, now = object(), State()
        for f in frames:
            us, ok = f["us"].to_numpy(), f["ok"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (f["source"] != f["source"].shift()).to_numpy()[1:]]) if len(f) else []
            columns = [[], [], [], []]
            for i, j in zip(starts, [*starts[1:], len(f)]):
                goes_on = not i and f["source"].iat[0] == name
                entry = now if goes_on else State(int(f["opened"].iat[i]), int(f["failures"].iat[i]))
                for all_rows, part in zip(columns, replay(us[i:j], ok[i:j], entry, threshold, wait)):
                    all_rows += part
            if len(f):
                name, now = f["source"].iat[-1], State(columns[2][-1], columns[3][-1])
            f = f.assign(state=columns[0], skipped=columns[1], opened=columns[2], failures=columns[3])
            yield f[["source", "us", "seq", "ok", "state", "skipped", "opened", "failures"]]

    closed = {"opened0": -1, "failures0": 0}
    maps = rows.mapInPandas(summarise, f"source {kind}, {_MAP}")
    lined = maps.join(begin, "source", "left").fillna(closed).repartition("source").sortWithinPartitions("source", "chunk", "closed", "at")
    entries = lined.mapInPandas(enter, f"source {kind}, {O.CHUNK} int, opened long, failures long")
    # At most two entries per chunk; sources that lie within a chunk begin as `before` says, one row per source.
    (entries, sent), (begin, also_sent) = O.small(entries), O.small(begin)
    ready = rows.join(entries, ["source", O.CHUNK], "left").join(begin, "source", "left").fillna(closed)
    start = [F.coalesce(n, f"{n}0").alias(n) for n in ("opened", "failures")]
    # Joins with a table too large to send lose the order; it is then made again within a chunk.
    ready = ready.select("source", "us", "seq", "ok", O.CHUNK, *start)
    if not (sent and also_sent):
        ready = ready.repartition(O.CHUNK).sortWithinPartitions("source", "us", "seq")
    return ready.mapInPandas(annotate, f"{kinds}, state string, skipped boolean, opened long, failures long")


def breakers_after(walked: DataFrame, before: DataFrame) -> DataFrame:
    """The breaker of every source after the last of its attempts."""
    last = walked.groupBy("source").agg(F.max_by(F.struct("opened", "failures"), F.struct("us", "seq")).alias("_s"))
    return before.join(last, "source", "full").select(
        "source", *(F.coalesce(f"_s.{n}", n).alias(n) for n in ("opened", "failures"))
    )
