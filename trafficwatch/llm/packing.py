"""Best-fit packing by linear grouping.

Documents become token pieces of at most ``capacity`` tokens. Only the histogram of
piece lengths (at most ``capacity`` rows, whatever the data) reaches the planner:

1. lengths above ``small`` are sorted and split into groups of equal cardinality;
   each is rounded up to the largest length of its group;
2. configurations (multisets of group sizes that fit one sequence) are optimised: the
   largest size left is completed by the subset-sum filling of least slack, and that
   configuration is repeated until one of its sizes runs out;
3. the slots of each configuration take the actual pieces of their group, so a
   sequence has what rounding left over in addition to its unused room;
4. small lengths, and the few large pieces that no configuration took, go longest first
   to the fullest sequence they fit, in bulk.

The plan is a table of runs: the pieces of one length with ranks [first, first + n)
go to sequences base, base + 1, ... at one offset. Pieces get their rank in Spark from
salted windows, so a length that a third of all pieces share is no single group.
"""
from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm.base import map_batches, persisted, record, text_or_empty
from trafficwatch.llm.tokenize import BLOCK_BYTES, encoder

CAPACITY = 1024
SMALL = 64
GROUPS = 512
END_ID = 2
#: Pieces that a rank window is meant to hold.
WINDOW_ROWS = 100_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id,
    cut from the end into ``capacity`` tokens, so that only the first may be shorter."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        docs_of, number, starts, lengths, crcs = [], [], [], [], []
        whole = (ids.values[a:b] for ids in encoder(tokenizer_path).documents(batch.column(1))
                 for a, b in zip(ids.start[:-1].tolist(), ids.start[1:].tolist(), strict=True))
        for doc, values in zip(batch.column(0).to_pylist(), whole, strict=True):
            own = np.append(values, end_id).astype("<u4")
            cuts = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
            for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                docs_of.append(doc)
                number.append(k)
                starts.append(x)
                lengths.append(y - x)
                crcs.append(zlib.crc32(own[x:y].tobytes()))
        yield record(_PIECES, docs_of, number, starts, lengths, crcs)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long", BLOCK_BYTES)


@dataclass
class Runs:
    """Pieces of ``length`` with ranks [first, first + count) -> sequence base + (rank - first), at offset."""

    length: np.ndarray
    first: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths with their counts, longest first, in groups of equal cardinality."""
    total = sum(counts.values())
    share = max(1, -(-total // groups))
    result: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                result.append([])
                room = share
            part = min(left, room)
            result[-1].append((length, part))
            left -= part
            room -= part
    return result


def _fillings(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """For each room the last size of its best filling, or -1: the filling with the
    largest sum, and among equal sums the one with the fewest pieces."""
    value = sizes - 1e-4
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    room = np.arange(capacity + 1)
    fits = room[None, :] >= sizes[:, None]
    source = np.maximum(room[None, :] - sizes[:, None], 0)
    while True:  # one more piece each time
        totals = np.where(fits, best[source] + value[:, None], 0)
        top = totals.max(axis=0)
        better = top > best + 1e-9
        if not better.any():
            return last
        last[better] = totals.argmax(axis=0)[better]
        best[better] = top[better]


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each size in a sequence, number of such sequences): the largest size
    left, with the filling of least slack, as often as pieces allow. Sizes with too few
    pieces for their configuration are left over for best fit."""
    left = dict(zip(sizes, demand, strict=True))
    result = []
    while left := {s: n for s, n in left.items() if n}:
        open_sizes = np.array(sorted(left, reverse=True))
        last = _fillings(open_sizes, capacity)
        while len(left) == len(open_sizes):  # until a size has run out
            column, room = {int(open_sizes[0]): 1}, capacity - int(open_sizes[0])
            while last[room] >= 0:
                size = int(open_sizes[last[room]])
                column[size] = column.get(size, 0) + 1
                room -= size
            times = min(left[s] // n for s, n in column.items())
            if times:
                result.append((column, times))
            for s, n in column.items():
                left[s] -= n * times
            left = {s: n for s, n in left.items() if n >= column.get(s, 1)}
    return result


def plan(histogram: dict[int, int], capacity: int = CAPACITY, small: int = SMALL,
         groups: int = GROUPS) -> Runs:
    """Runs that place every piece counted in ``histogram`` (length -> pieces)."""
    used: dict[int, int] = {}
    rows: list[tuple[int, int, int, int]] = []  # length, first, base, offset
    by_room: dict[int, list[tuple[int, int]]] = {}  # room -> (base, count) of sequences
    rest = {length: n for length, n in histogram.items() if length <= small and n}
    sequences = 0

    def place(length: int, count: int, base: int, offset: int) -> None:
        rows.append((length, used.get(length, 0), base, offset))
        used[length] = used.get(length, 0) + count

    def add(room: int, base: int, count: int) -> None:
        if count and room:
            heapq.heappush(by_room.setdefault(room, []), (base, count))

    large = {length: n for length, n in histogram.items() if small < length < capacity and n}
    if full := histogram.get(capacity, 0):
        place(capacity, full, 0, 0)
        sequences += full
    if large:
        grouped = linear_groups(large, groups)
        sizes = [g[0][0] for g in grouped]
        demand = [sum(n for _, n in g) for g in grouped]
        # Groups that round to the same size are one size.
        merged: dict[int, int] = {}
        for size, n in zip(sizes, demand, strict=True):
            merged[size] = merged.get(size, 0) + n
        distinct = sorted(merged, reverse=True)
        need = [merged[s] for s in distinct]
        chosen = configurations(distinct, need, capacity)
        # Actual pieces of each size, longest first, as (length, count) stacks.
        stock: dict[int, list[list[int]]] = {s: [] for s in distinct}
        for group in grouped:
            stock[group[0][0]] += [list(part) for part in group]
        for s in distinct:
            stock[s].reverse()
        for column, times in chosen:
            slots = [s for s in sorted(column, reverse=True) for _ in range(column[s])]
            done = 0
            while done < times:
                # As many sequences as all slots can fill with one length each.
                uses = {s: slots.count(s) for s in slots}
                part = times - done
                for s, n in uses.items():
                    top = stock[s][-1][1]
                    part = min(part, top // n if top >= n else 1)
                lengths = []
                for s in slots:
                    length = stock[s][-1][0]
                    lengths.append(length)
                    stock[s][-1][1] -= part
                    if not stock[s][-1][1]:
                        stock[s].pop()
                offset = 0
                for length in lengths:
                    place(length, part, sequences, offset)
                    offset += length
                add(capacity - offset, sequences, part)
                sequences += part
                done += part
        for length, n in (part for stack in stock.values() for part in stack):
            rest[length] = rest.get(length, 0) + n
    rooms = sorted(by_room)
    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                count = -(-left // each)
                insort(rooms, capacity)
                add(capacity, sequences, count)
                sequences += count
                continue
            room = rooms[at]
            base, count = heapq.heappop(by_room[room])
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            each = min(room // length, left)
            part = min(count, max(1, left // each))
            for k in range(each):
                place(length, part, base, capacity - room + k * length)
            left -= part * each
            for r, b, c in ((room - each * length, base, part), (room, base + part, count - part)):
                if r and c:
                    if r not in by_room:
                        insort(rooms, r)
                    add(r, b, c)
    table = np.array(rows, np.int64).reshape(-1, 4)
    order = np.lexsort((table[:, 1], table[:, 0]))
    table = table[order]
    return Runs(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequences)


_PLACES = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(pieces: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Adds (sequence_id, offset) to the rows of :func:`token_pieces`."""
    pieces = persisted(pieces, "pieces")
    # At most `capacity` rows, one per length.
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = plan(histogram, capacity, small, groups)
    salts = max(1, -(-max(histogram.values(), default=0) // WINDOW_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    # Pieces of the same length under smaller salts come first.
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    skipped = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("skipped"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("own_rank", F.row_number().over(own) - 1).join(skipped, ["length", "salt"]) \
        .withColumn("rank", F.col("skipped") + F.col("own_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = runs.length << 40 | runs.first
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << 40 | rank, side="right") - 1
            yield record(_PLACES, *(batch.column(f.name) for f in _PIECES),
                         runs.base[at] + rank - runs.first[at], runs.offset[at])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of one token, the end id. Rows that repeat an id
    are packed each on its own. An empty table gives no rows. Other columns are not read.
    """
    return pack(token_pieces(docs, tokenizer_path, doc_id, text, capacity, end_id), capacity)
