"""Periodic runs of words by recompression.

A *run* is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least max(24, 3 q) words that no neighbouring word extends.

Grammar: the words of a batch of documents, as numbers, form one sequence in which every
document stands between two separators of its own. Block compression replaces each maximal
repetition of one symbol by a new symbol (a run-length rule), pair compression splits the
symbols into a left and a right half and replaces every pair left-right; both alternate
until each document is one symbol. Whether a border between two symbols stays depends
on these two symbols alone, so equal stretches are parsed alike but for their ends. That
gives the longest common extension of two places in either direction by walking up the
levels while symbols agree and down again where they differ (:meth:`Grammar.extend`),
for many pairs at once.

Candidates: a run of period q holds at least max(24, 3 q) - q consecutive places whose word
equals the one q later, so one of them is a multiple of that number. These grids (their
sizes sum up harmonically over q) are tried for every q; a candidate whose two words
agree is extended both ways, exactly. Of equal stretches the smallest period counts.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import compress
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import map_batches, record, text_or_empty

#: A run has at least so many words, and so many periods.
MIN_WORDS = 24
MIN_PERIODS = 3
#: Candidates tried at once.
GRID_CHUNK = 1 << 20


class _Level(NamedTuple):
    symbols: np.ndarray  # of this level
    up: np.ndarray  # for each of them the symbol of the next level that holds it
    start: np.ndarray  # for each symbol of the next level its first one here; then the end
    block: bool  # are the next level's symbols blocks (else pairs)?


class Grammar:
    """Run-length grammar of ``symbols``; those below ``walls`` are separators (each stands
    once) and are never joined to a neighbour."""

    def __init__(self, symbols: np.ndarray, walls: int):
        self.levels: list[_Level] = []
        self._fresh = int(symbols.max(initial=walls)) + 1
        self.top = symbols.astype(np.int32)
        turn = 0
        while True:
            self._blocks()
            inner = self.top >= walls
            if not (inner[:-1] & inner[1:]).any():
                return
            self._pairs(inner, turn)
            turn += 1

    def _next(self, start: np.ndarray, joined: np.ndarray, keys: np.ndarray, block: bool) -> None:
        """Adds the level whose symbols begin at ``start``; ``joined`` ones are named by ``keys``."""
        old = self.top
        head = np.zeros(len(old), np.int32)
        head[start[1:]] = 1
        codes, names = pd.factorize(keys)
        self.top = old[start]
        self.top[joined] = self._fresh + codes
        self._fresh += len(names)
        self.levels.append(_Level(old, np.cumsum(head, dtype=np.int32),
                                  np.append(start, len(old)).astype(np.int32), block))

    def _blocks(self) -> None:
        old = self.top
        start = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]])) if len(old) else np.zeros(0, np.int64)
        if len(start) == len(old):
            return
        size = np.diff(np.append(start, len(old)))
        joined = np.flatnonzero(size > 1)
        self._next(start, joined, old[start[joined]].astype(np.int64) << 32 | size[joined], True)

    def _pairs(self, inner: np.ndarray, turn: int) -> None:
        old = self.top
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) % (1 << 64))
        side = (old.astype(np.uint64) * odd >> np.uint64(63)).astype(bool)
        one, other = inner & side, inner & ~side
        ways = [left[:-1] & right[1:] for left, right in ((one, other), (other, one))]
        first = max(ways, key=np.count_nonzero)
        if not first.any():
            return  # the next turn splits the symbols otherwise
        start = np.flatnonzero(~np.concatenate([[False], first]))
        joined = np.flatnonzero(np.append(first, False)[start])
        at = start[joined]
        self._next(start, joined, old[at].astype(np.int64) << 32 | old[at + 1], False)

    def extend(self, x: np.ndarray, y: np.ndarray, forward: bool = True) -> np.ndarray:
        """Longest common extensions of the places ``x`` and ``y`` (x != y): how many symbols
        from there on agree, or, if not ``forward``, how many before them."""
        back, sign = (0, 1) if forward else (1, -1)
        began, x, y = x, x.astype(np.int64), y.astype(np.int64)
        stop = np.full(len(x), len(self.levels))

        def agree(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
            return symbols[x[at] - back] == symbols[y[at] - back]

        def advance(level: _Level, at: np.ndarray) -> None:
            step = 1
            if level.block:  # to the nearer end of the two repetitions
                left = [level.up[z[at] - back] for z in (x, y)]
                step = np.minimum(*(level.start[u + 1] - z[at] if forward else z[at] - level.start[u]
                                    for u, z in zip(left, (x, y), strict=True)))
            x[at] += sign * step
            y[at] += sign * step

        climbing = np.arange(len(x))
        for k, level in enumerate(self.levels):
            ready, wait = [], climbing
            while len(wait):
                same = agree(level.symbols, wait)
                stop[wait[~same]] = k
                wait = wait[same]
                border = np.ones(len(wait), bool)
                for z in (x, y):
                    here = z[wait]
                    border &= level.start[level.up[here - back] + back] == here
                ready.append(wait[border])
                wait = wait[~border]
                advance(level, wait)
            climbing = np.concatenate(ready) if ready else wait
            for z in (x, y):
                z[climbing] = level.up[z[climbing] - back] + back
        while len(climbing := climbing[agree(self.top, climbing)]):
            x[climbing] += sign
            y[climbing] += sign
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            wait = np.flatnonzero(stop > k)
            for z in (x, y):
                z[wait] = level.start[z[wait]]
            while len(wait := wait[agree(level.symbols, wait)]):
                advance(level, wait)
        return np.abs(x - began)


def grid(n: int, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) that meet every run of a text of ``n`` words, in pieces."""
    periods = np.arange(1, n // min_periods + 1 if n >= min_words else 1)
    stride = np.maximum(min_words, min_periods * periods) - periods
    counts = (n - periods - 1) // stride + 1
    total = np.cumsum(counts)
    low = 0
    while low < len(periods):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + GRID_CHUNK, side="right")))
        number = counts[low:high]
        turn = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        yield turn * np.repeat(stride[low:high], number), np.repeat(periods[low:high], number)
        low = high


def find_runs(documents: Sequence[Sequence[bytes]], min_words: int = MIN_WORDS,
              min_periods: int = MIN_PERIODS) -> list[np.ndarray]:
    """For each document (a list of words) its runs as rows (start, length, period), by
    start, then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    count = len(documents)
    first = np.cumsum(sizes + 1) - sizes  # a separator stands before each document
    symbols = np.arange(sizes.sum() + count + 1, dtype=np.int64)
    inside = np.ones(len(symbols), bool)
    inside[np.append(first - 1, len(symbols) - 1)] = False
    words = pa.array([w for d in documents for w in d], pa.binary()).dictionary_encode()
    symbols[~inside] = np.arange(count + 1)
    symbols[inside] = words.indices.to_numpy() + count + 1
    grammar = Grammar(symbols, count + 1)

    found = []
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def extend() -> None:
        place, period = (np.concatenate(a) for a in zip(*hits, strict=True))
        after = grammar.extend(place, place + period)
        before = grammar.extend(place, place + period, forward=False)
        length = before + after + period
        long = length >= np.maximum(min_words, min_periods * period)
        found.append(np.stack([place - before, length, period], axis=1)[long])

    for n, base in zip(sizes.tolist(), first.tolist(), strict=True):
        for place, period in grid(n, min_words, min_periods):
            place = place + base
            meets = symbols[place] == symbols[place + period]
            hits.append((place[meets], period[meets]))
            waiting += len(place)
            if waiting >= GRID_CHUNK:
                extend()
                hits, waiting = [], 0
    if hits:
        extend()
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):  # a stretch with period q has its multiples, too
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cut = np.searchsorted(rows[:, 0], np.append(first, len(symbols)))
    rows[:, 0] -= np.repeat(first, np.diff(cut))
    return [rows[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def collapse(words: Sequence[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that stay: of each run only its first period."""
    if not len(runs):
        return list(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    rows = [tuple(map(int, row)) for row in runs]
    return min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def repeated_tail(words: list[bytes], number: int) -> list[bytes]:
    """``words`` with a periodic tail written over them where ``number`` is a multiple of 10
    (texts to test run detection with): from word a = g mod n on, where g = number // 10, every
    word is the one p = 1 + (n - a) // (3 + g mod 8) before it."""
    n, group = len(words), number // 10
    if number % 10 or not n:
        return words
    a = group % n
    p = 1 + (n - a) // (3 + group % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


_RUNS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                     ("collapsed_sha256", pa.string())])


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, period): all runs of all documents, in words numbered from 0.

    Words are what ASCII white space parts. A null text counts as empty and has no run; a
    null id stays null; repeated rows give repeated runs; an empty table no rows. A text is
    worked on whole, in memory proportional to its length. Other columns are not read.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        runs = find_runs([t.encode().split() for t in batch.column(1).to_pylist()])
        ids = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        rows = np.concatenate(runs)
        yield record(_RUNS, batch.column(0).take(pa.array(ids)), rows[:, 0], rows[:, 1], rows[:, 2])

    return map_batches(_rows(docs, doc_id, text), run, "doc_id long, start long, length long, period long")


def collapsed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): every document's words, joined by blanks, with each run cut to its first
    period. Rows as in :func:`periodic_runs`; a text without words is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [t.encode().split() for t in batch.column(1).to_pylist()]
        kept = [b" ".join(collapse(w, r)).decode() for w, r in zip(words, find_runs(words), strict=True)]
        yield record(schema, batch.column(0), kept)

    return map_batches(_rows(docs, doc_id, text), run, "doc_id long, text string")


def run_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document whose words went through :func:`repeated_tail` (number: the
    unsigned crc32 of the id in decimal): doc_id, n_runs, the strongest run's start, length,
    period and exponent_milli (nulls if there is none), runs_sha256 (of all runs as lines
    ``start,length,period``) and collapsed_sha256 (of the kept words joined by a blank).

    A null id counts as empty text under the crc32; other cases as in :func:`periodic_runs`,
    but a document without runs has a row, too.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_pylist()
        words = [repeated_tail(t.encode().split(), zlib.crc32(b"" if i is None else b"%d" % i))
                 for i, t in zip(ids, batch.column(1).to_pylist(), strict=True)]
        rows = []
        for own, runs in zip(words, find_runs(words), strict=True):
            best = strongest(runs)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            rows.append((len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                         hashlib.sha256(listed.encode()).hexdigest(),
                         hashlib.sha256(b" ".join(collapse(own, runs))).hexdigest()))
        yield record(_REPORT, batch.column(0), *zip(*rows, strict=True))

    return map_batches(_rows(docs, doc_id, text), run,
                       "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                       "runs_sha256 string, collapsed_sha256 string")
