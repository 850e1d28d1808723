"""Periodic runs of words, found online.

A run is a stretch of words with a period that it holds several times, and
that no neighbour extends. While words are appended, every completed block of
2**k words becomes a catcher: it watches for its own recurrence at the shifts
(periods) of its size. A recurrence is a square or part of one; its suffix
comparison to the left is made at once, the one to the right advances with
every word appended until a word differs. Squares of one period that touch
have the same ends, so they merge into one run.

A stretch that holds period ``p`` at least ``times`` times agrees with itself,
``p`` words on, over ``(times - 1) * p`` words; these hold a whole aligned block
of 2**k words if they are ``2 * 2**k - 1`` or more. So each period has one block
size, a block watches a number of shifts in proportion to its size, and a text
of n words takes n log n comparisons of block hashes. Hashes only propose:
every run is confirmed by the words' own ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import HASHES, U64, text_bytes
from .repeated_passages import _POWERS as POWERS

MIN_LENGTH = 24
TIMES = 3
#: Words appended at a time, so that the tables of comparisons stay small.
CHUNK = 1 << 20


class RunCatcher:
    """Runs of a sequence of ids that is appended to.

    A run has a least period q, at least ``min_length`` ids and ``times * q``."""

    def __init__(self, min_length: int = MIN_LENGTH, times: int = TIMES):
        self.min_length, self.times = min_length, times
        self.least = 1
        while min_length - self._first(2 * self.least) + 1 >= 4 * self.least - 1:
            self.least *= 2
        self.n = 0
        self._ids = np.empty(0, U64)
        self._sums = np.zeros(1, U64)
        self._open: dict[int, int] = {}          # period -> start of the stretch that reaches the end
        self._last: dict[int, tuple[int, int]] = {}  # period -> its latest stretch
        self._found: list[tuple[int, int, int]] = []  # (start, end, period), ended

    def _first(self, size: int) -> int:
        """Least period watched by blocks of ``size``."""
        return -((1 - 2 * size) // (self.times - 1))

    def append(self, ids: np.ndarray) -> None:
        """Append ids and advance all comparisons to the new end."""
        old, self.n = self.n, self.n + len(ids)
        if self.n > len(self._ids):
            room = max(self.n, 2 * len(self._ids)) if old else self.n
            self._ids = np.concatenate([self._ids[:old], np.empty(room - old, U64)])
            self._sums = np.concatenate([self._sums[:old + 1], np.empty(room - old, U64)])
        self._ids[old:self.n] = ids
        POWERS.to(self.n + 1)
        np.cumsum(self._ids[old:self.n] * POWERS.up[old:self.n], out=self._sums[old + 1:self.n + 1])
        self._sums[old + 1:self.n + 1] += self._sums[old]
        for period in list(self._open):
            start = self._open.pop(period)
            self._extend(period, start, old - period)
        size = self.least
        while True:
            first = 1 if size == self.least else self._first(size)
            if first + size > self.n:
                break
            self._advance(size, first, self._first(2 * size), old)
            size *= 2

    def _windows(self, size: int, lo: int, hi: int) -> np.ndarray:
        """Hashes of the ``size`` ids from each place in [lo, hi) on."""
        return (self._sums[lo + size:hi + size] - self._sums[lo:hi]) * POWERS.down[lo:hi]

    def _advance(self, size: int, first: int, end: int, old: int) -> None:
        """Blocks of ``size`` compare themselves at the shifts [first, end) that
        the ids since ``old`` made possible."""
        # block at l sees shift p once l + p + size ids are there
        begin = max(0, -(-(old - size - end + 2) // size))
        last = (self.n - size - first) // size
        if last < begin:
            return
        fresh = min(max(begin, -(-(old - size - first + 1) // size)), last + 1)    # no shift seen yet
        whole = max(fresh - 1, (self.n - size - end + 1) // size)                  # up to here all shifts are there
        whole = min(whole, last)
        base = begin * size
        hashes = self._windows(size, base, self.n - size + 1)
        places, shifts = [], []
        for j in (*range(begin, fresh), *range(whole + 1, last + 1)):
            at = j * size
            lo, hi = max(first, old - size - at + 1), min(end, self.n - size - at + 1)
            row = hashes[at + lo - base:at + hi - base] == hashes[at - base]
            if row.any():
                self._known(row[None], at, size, lo)
                hit = np.flatnonzero(row)
                places.append(np.full(len(hit), at))
                shifts.append(hit + lo)
        if whole >= fresh:
            at = fresh * size - base
            own = hashes[at:(whole * size - base) + 1:size]
            table = np.lib.stride_tricks.sliding_window_view(hashes[at + first:], end - first)[::size][:len(own)] == own[:, None]
            if table.any():
                self._known(table, fresh * size, size, first)
                row, col = np.nonzero(table)
                places.append((row + fresh) * size)
                shifts.append(col + first)
        if places:
            found = np.stack([np.concatenate(places), np.concatenate(shifts)])
            for at, p in found[:, np.argsort(found[0], kind="stable")].T.tolist():
                self._catch(at, p, size)

    def _known(self, table: np.ndarray, begin: int, size: int, first: int) -> None:
        """Drop squares whose period is a multiple of that of a run around them:
        they add nothing to it."""
        stretches = [*self._found, *((s, self.n, q) for q, s in self._open.items())]
        for s, e, q in stretches:
            if e - s < size + first or q >= first or q > size:
                continue
            row = max(0, -(-(s - begin) // size))
            stop = min(len(table), (e - size - first - begin) // size + 1)
            if row >= stop:
                continue
            col = -first % q
            part = table[row:stop, col::q]
            at = begin + size * np.arange(row, stop)[:, None]
            part[at + (first + col + q * np.arange(part.shape[1])) + size <= e] = False

    def _catch(self, at: int, period: int, size: int) -> None:
        """A block recurs: find the stretch around it unless it is known."""
        got = self._last.get(period)
        if got and got[0] <= at and at + period + size <= got[1]:
            return
        ids, n = self._ids, self.n
        if not np.array_equal(ids[at:at + size], ids[at + period:at + period + size]):
            return
        start, step = at, 64
        while start:
            k = min(step, start)
            differ = np.flatnonzero(ids[start - k:start] != ids[start - k + period:start + period])
            if len(differ):
                start += int(differ[-1]) + 1 - k
                break
            start, step = start - k, min(2 * step, 1 << 16)
        self._extend(period, start, at + size)

    def _extend(self, period: int, start: int, at: int) -> None:
        """Advance the comparison with the ids ``period`` on, from ``at``."""
        ids, stop, step = self._ids, self.n - period, 64
        while at < stop:
            k = min(step, stop - at)
            differ = ids[at:at + k] != ids[at + period:at + period + k]
            j = int(differ.argmax())
            if differ[j]:
                at += j
                break
            at, step = at + k, min(2 * step, 1 << 16)
        self._last[period] = (start, at + period)
        if at == stop:
            self._open[period] = start
        else:
            self._found.append((start, at + period, period))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period."""
        best: dict[tuple[int, int], int] = {}
        for s, e, p in (*self._found, *((s, self.n, p) for p, s in self._open.items())):
            if e - s >= max(self.min_length, self.times * p):
                best[s, e] = min(p, best.get((s, e), p))
        return sorted((s, e - s, p) for (s, e), p in best.items())


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words."""
    if len(words) < min_length:
        return []
    catcher = RunCatcher(min_length, times)
    ids = HASHES.of(words)
    for at in range(0, len(ids), CHUNK):
        catcher.append(ids[at:at + CHUNK])
    return catcher.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, times: int = TIMES) -> DataFrame:
    """``docs`` without ``text``, with n_words, ``runs`` (array of start, length
    and period in words) and ``collapsed`` (kept words joined by one space).

    Each text is walked by itself, whole, in one Arrow pass without a shuffle.
    A null or empty text has no words and no runs. Nested runs and runs that
    overlap are all listed; equal rows give equal results; no rows give none.
    The three added columns take the place of columns of their names."""
    added = ("n_words", "runs", "collapsed")
    keep = [(c, t) for c, t in docs.dtypes if c != text and c not in added]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in keep), "n_words long",
                        "runs array<struct<start: bigint, length: bigint, period: bigint>>", "collapsed string"])
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def walk(batches):
        for batch in batches:
            counts, ends, flat, texts = [], [0], [], []
            for raw in text_bytes(batch.column(len(keep))):
                words = raw.split()
                runs = word_runs(words, min_length, times)
                counts.append(len(words))
                flat.extend(runs)
                ends.append(len(flat))
                texts.append(b" ".join(collapsed(words, runs)).decode())
            starts, lengths, periods = zip(*flat) if flat else ((), (), ())
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in (starts, lengths, periods)], fields=list(kind)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(counts, pa.int64()), runs, pa.array(texts, pa.string())],
                names=[*(c for c, _ in keep), *added])

    return docs.select(*(f"`{c}`" for c, _ in keep), f"`{text}`").mapInArrow(walk, schema)
