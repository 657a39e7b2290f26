"""Periodic runs of words: maximal pairs from an LCP-interval tree.

A run is a stretch of words that repeats with a smallest period, at least three
times over, and that no neighbouring word extends. The occurrences of a run's
words one period apart are a maximal pair: equal stretches that differ in the
word before and in the word behind. The other way round, a maximal pair whose
distance is at most half its length is a run with that distance or a divisor of
it as period. So runs are read off the pairs, and nothing is extended.

Pairs come from the suffix array: the intervals of suffixes with a common prefix
form a tree, which is walked from the leaves up. Each interval holds its
positions in order, cut into stretches with one word on their left, so that
positions with the same left word are passed over in one step. Intervals of
fewer common words than a run can have are never opened, and a text in which no
stretch of so many words stands twice is not sorted at all.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import mix, slices, text_buffers

# A run has at least this many words, and its period at least this many times.
LEAST_WORDS = 24
LEAST_TIMES = 3

_CHAIN = np.uint64(0xD6E8FEB86659FD93)


class Run(NamedTuple):
    start: int
    length: int
    period: int


def word_ids(words: Sequence[bytes]) -> np.ndarray:
    """A number for each word; equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter(
        (seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)
    )


def repeats_within(ids: np.ndarray, size: int) -> bool:
    """Whether a stretch of ``size`` numbers may stand twice.

    Stretches are compared by hash: never a false no.
    """
    if len(ids) <= size:
        return False
    power = mix(ids.astype(np.uint64) + np.uint64(1))
    parts, done = None, 0
    # The stretch is put together from stretches of powers of two.
    width = 1
    while True:
        if size & width:
            if parts is None:
                parts = power
            else:
                n = len(power) - done
                parts = mix(parts[:n] * _CHAIN + power[done : done + n])
            done += width
        width *= 2
        if width > size:
            break
        half = width // 2
        power = mix(power[:-half] * _CHAIN + power[half:])
    hashes = np.sort(parts[: len(ids) - size + 1])
    return bool((hashes[1:] == hashes[:-1]).any())


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and how many words each shares with the one before.

    Ranks by 1, 2, 4, ... words; the same ranks, from the longest down, then
    give the common words of neighbours.
    """
    n = len(ids)
    ranks = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    width, order = 1, None
    while True:
        behind = np.zeros(n, np.int64)
        if width < n:
            behind[: n - width] = ranks[-1][width:] + 1
        key = ranks[-1] * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        placed = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(placed[1:] != placed[:-1])])
        width *= 2
        if rank[order[-1]] == n - 1:
            break
        ranks.append(rank)
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = inside.copy()
        same[inside] = ranks[level][left[inside]] == ranks[level][right[inside]]
        # Equal ranks of suffixes that end early are equal to the end only
        # if they are one suffix, so equal ranks mean 2 ** level words.
        step = same * (1 << level)
        shared[1:] += step
        left, right = left + step, right + step
    return order, shared


class _Interval:
    """Positions of one LCP interval, by place and by stretches of left word."""

    __slots__ = ("depth", "places", "opens")

    def __init__(self, place: int) -> None:
        self.depth = 0
        self.places = [place]
        # Places whose neighbour before them has another left word.
        self.opens = [place]


def maximal_pairs(
    ids: np.ndarray, least_words: int, least_times: int
) -> Iterator[tuple[int, int, int]]:
    """(i, j, length) of maximal pairs, i < j, that a run can have.

    Equal stretches at i and j with other words before and behind; the distance
    q = j - i fulfils q + length >= least_words and >= least_times * q.
    """
    n = len(ids)
    # length >= max(least_words - q, (least_times - 1) * q)
    least = -(-least_words * (least_times - 1) // least_times)
    if n < least_words or not repeats_within(ids, least):
        return
    order, shared = suffix_order(ids)
    left = [-1, *ids[:-1].tolist()]

    def partners(held: _Interval, place: int) -> Iterator[int]:
        """Held places with another left word, no farther than runs allow."""
        places, opens, word = held.places, held.opens, left[place]
        reach = held.depth // (least_times - 1)
        at = bisect_left(places, place)
        k = at - 1
        while k >= 0 and place - places[k] <= reach:
            if left[places[k]] != word:
                yield places[k]
                k -= 1
            else:
                start = opens[bisect_left(opens, places[k] + 1) - 1]
                k = bisect_left(places, start) - 1
        k = at
        while k < len(places) and places[k] - place <= reach:
            if left[places[k]] != word:
                yield places[k]
                k += 1
            else:
                behind = bisect_left(opens, places[k] + 1)
                if behind == len(opens):
                    break
                k = bisect_left(places, opens[behind])

    def add(held: _Interval, place: int) -> None:
        places, opens = held.places, held.opens
        at = bisect_left(places, place)
        before = places[at - 1] if at else None
        after = places[at] if at < len(places) else None
        first = before is None or left[before] != left[place]
        if after is not None:
            opened = before is None or left[before] != left[after]
            opens_now = left[place] != left[after]
            if opened and not opens_now:
                del opens[bisect_left(opens, after)]
            elif opens_now and not opened:
                insort(opens, after)
        if first:
            insort(opens, place)
        places.insert(at, place)

    def joined(one: _Interval, other: _Interval, depth: int):
        """Both as one interval, and the pairs between them."""
        small, large = sorted((one, other), key=lambda held: len(held.places))
        large.depth = depth
        found = [(p, q) for p in small.places for q in partners(large, p)]
        for place in small.places:
            add(large, place)
        return large, [(min(pair), max(pair), depth) for pair in found]

    # Open intervals, each with more common words than the one below it.
    stack: list[_Interval] = []
    behind = [*shared[1:].tolist(), 0]
    for place, depth in zip(order.tolist(), behind):
        held = _Interval(place)
        while stack and stack[-1].depth > depth:
            top = stack.pop()
            held, pairs = joined(top, held, top.depth)
            yield from pairs
        if depth < least:
            continue
        if stack and stack[-1].depth == depth:
            stack[-1], pairs = joined(stack[-1], held, depth)
            yield from pairs
        else:
            held.depth = depth
            stack.append(held)


def runs_of(
    ids: np.ndarray, least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES
) -> list[Run]:
    """All runs, by start, then period."""
    best: dict[tuple[int, int], int] = {}
    for i, j, length in maximal_pairs(ids, least_words, least_times):
        period = j - i
        words = length + period
        if words >= max(least_words, least_times * period):
            # The same stretch is also found at multiples of its period.
            best[i, words] = min(period, best.get((i, words), period))
    found = [Run(start, words, period) for (start, words), period in best.items()]
    return sorted(found, key=lambda run: (run.start, run.period))


def staying(n: int, runs: Sequence[Run]) -> np.ndarray:
    """Which of n words stay when each run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    for run in runs:
        change[run.start + run.period] += 1
        change[run.start + run.length] -= 1
    return np.cumsum(change[:n]) == 0


RESULT = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)
_RUNS = pa.list_(
    pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
)

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def find_runs(
    docs: DataFrame,
    prepare: Prepare | None = None,
    least_words: int = LEAST_WORDS,
    least_times: int = LEAST_TIMES,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    Words are runs of bytes between white space. ``runs`` has word numbers from
    0, by start, then period; ``collapsed`` is the words, joined by one space,
    without those that a run repeats. ``prepare(doc_id, words)`` may change the
    words before.

    A null or empty text has no words and collapses to the empty text. Rows
    without an id keep it null. Repeated rows get equal results, an empty table
    none. Other columns are ignored. A text is handled whole by one task, in
    time that grows with its words times the logarithm of their number.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for low, high, held, ends in slices(data, offsets):
                body = held.tobytes()
                ids = batch.column(0).slice(low, high - low)
                counts, found, texts = [], [], []
                for doc_id, start, end in zip(ids.to_pylist(), ends[:-1], ends[1:]):
                    words = body[start:end].split()
                    if prepare is not None:
                        words = prepare(doc_id, words)
                    runs = runs_of(word_ids(words), least_words, least_times)
                    if runs:
                        stays = staying(len(words), runs).tolist()
                        kept = [w for w, stay in zip(words, stays) if stay]
                    else:
                        kept = words
                    counts.append(len(words))
                    found.append([run._asdict() for run in runs])
                    texts.append(b" ".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(counts, pa.int64()),
                        pa.array(found, _RUNS),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(scan, RESULT)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: every tenth text, by checksum, ends in a run.

    Texts without an id stay as they are.
    """
    if doc_id is None or not words:
        return words
    check = zlib.crc32(str(doc_id).encode())
    if check % 10:
        return words
    size, rest = len(words), check // 10
    start = rest % size
    period = 1 + (size - start) // (3 + rest % 8)
    tail = words[start : start + period]
    times = -(-(size - start) // period)
    return words[:start] + (tail * times)[: size - start]


def run_digests(docs: DataFrame) -> DataFrame:
    """One row a document: its runs, the one of the highest exponent, digests."""
    found = find_runs(docs, planted)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")

    def higher(best: Column, run: Column) -> Column:
        # By start, then period already, so only a higher one takes its place.
        beats = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | beats, run).otherwise(best)

    best = F.col("best")
    lines = F.transform(
        "runs",
        lambda run: F.concat(
            F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")
        ),
    )
    return found.withColumn("best", F.reduce("runs", none, higher)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
