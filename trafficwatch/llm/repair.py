"""Token-id shards compressed by Re-Pair grammars, with random access.

Documents in ascending id order are cut into shards. In a shard, pairs of neighbouring
ids that occur more than once are replaced by new symbols (nonterminals), the frequent
ones first, again and again over the shorter sequence, until no pair occurs twice; the rules, each symbol's expansion
length and the remaining sequence are stored. A document is read by finding its first
token in the running expansion lengths and expanding only the symbols it covers.

Shard bytes (little-endian): ``RPG1``, then unsigned 32-bit counts of ids below the
first nonterminal, rules, sequence symbols and documents, then zstd frames of: left
and right symbols of the rules, expansion lengths of the nonterminals, the sequence,
and the documents' token counts (unsigned 32-bit each). A shard needs no other shard.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficwatch.llm.base import record, scratch_path, slices, text_or_empty
from trafficwatch.llm.pretokens import Ragged, ranges
from trafficwatch.llm.tokenize import BLOCK_BYTES, encoder

END_ID = 0
#: Text bytes per shard (a longer document is a shard of its own).
SHARD_BYTES = 4 << 20
#: A pair becomes a rule if it occurs at least so often in a shard: Re-Pair's own limit.
MIN_COUNT = 2
#: A reader keeps all symbols spelled out if they have at most so many ids together.
SPELLED_IDS = 16 << 20
_MAGIC = b"RPG1"
_HEAD = struct.Struct("<4s4I")


def _pairs_at(left: np.ndarray, right: np.ndarray, places: np.ndarray, after: np.ndarray,
              min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, members) of the symbols ``left`` at the ascending ``places`` and ``right`` at
    their neighbours ``after``: the distinct pairs (left << 32 | right) that come ``min_count`` times
    at least, and the ascending places of the first of them, then of the second and so on.
    A pair of equal symbols overlaps itself: in a row of them every other place counts."""
    if not len(places):
        return (np.zeros(0, np.int64),) * 3
    skipped = twin = np.flatnonzero(left == right)
    if len(twin):
        number, opens = np.arange(len(twin)), np.ones(len(twin), bool)
        opens[1:] = places[twin[1:]] != after[twin[:-1]]
        skipped = twin[(number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 1]
    place_bits, right_bits = int(places[-1]).bit_length(), int(right.max()).bit_length()
    if int(left.max()).bit_length() + right_bits + place_bits > 63:  # pair and place don't fit one number
        found, pairs = pd.factorize(np.delete(left.astype(np.int64) << 32 | right, skipped))
        counts = np.bincount(found, minlength=len(pairs))
        members = np.delete(places, skipped)[np.argsort(found, kind="stable")]
        frequent = counts >= min_count
        return pairs[frequent], counts[frequent], members[np.repeat(frequent, counts)]
    # Pairs with their places, sorted as plain numbers: faster than hashing them.
    ordered = np.left_shift(left, right_bits, dtype=np.int64)
    ordered |= right
    ordered <<= place_bits
    ordered |= places
    ordered[skipped] = np.iinfo(np.int64).max  # to the end
    ordered.sort()
    ordered = ordered[:len(ordered) - len(skipped)]
    repeats = np.zeros(len(ordered) + 1, bool)  # the same pair as the one before
    np.less(ordered[1:] ^ ordered[:-1], 1 << place_bits, out=repeats[1:-1])
    if min_count > 1:  # without pairs that come once
        several = np.flatnonzero(repeats[1:] | repeats[:-1])
        ordered, repeats = ordered.take(several), repeats.take(several)
    first = np.flatnonzero(~repeats[:len(ordered)])
    counts = np.diff(first, append=len(ordered))
    if min_count > 2:
        frequent = counts >= min_count
        ordered = ordered[np.repeat(frequent, counts)]
        counts = counts[frequent]
        first = np.cumsum(counts) - counts
    pairs = ordered.take(first) >> place_bits
    ordered &= (1 << place_bits) - 1
    return pairs >> right_bits << 32 | pairs & ((1 << right_bits) - 1), counts, ordered


class _Sequence:
    """Linked symbols with the pair that stands at each place, and the count and the places of
    every pair.

    Replacing a pair touches its own places and their neighbours only: their old pairs are
    counted down, the new ones contain the new symbol, so they are counted on their own.
    A place stays in the list of a pair that it no longer holds.
    What is kept for each place are 32-bit numbers where they suffice: half the memory to go through."""

    def __init__(self, symbols: np.ndarray, min_count: int):
        n = len(symbols)
        # Each rule uses up a place at least.
        number = np.int32 if n + int(symbols.max(initial=0)) < 1 << 31 else np.int64
        self.symbols, self.min_count = symbols.astype(number), min_count
        self.next = np.arange(1, n + 2, dtype=number)  # place n is the end, place -1 (the same) the start
        self.before = np.arange(-1, n, dtype=number)
        self.alive = np.ones(n, bool)
        self.code = np.zeros(n + 1, number)  # 0: no pair is counted here
        self.pairs, self.counts, self.first = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(2, np.int64)
        # A place is listed at first and for each symbol that goes beside it or at it. The places
        # of code c are members[first[c]:first[c + 1]].
        self.members = np.empty(3 * n, number)
        places = np.arange(max(0, n - 1), dtype=number)
        self._count(self.symbols[:-1], self.symbols[1:], places, self.next)

    def _count(self, left: np.ndarray, right: np.ndarray, places: np.ndarray, after: np.ndarray) -> None:
        """Counts and lists the pairs at ``places``, none of which was seen elsewhere."""
        pairs, counts, members = _pairs_at(left, right, places, after, self.min_count)
        own = np.arange(len(self.pairs), len(self.pairs) + len(pairs), dtype=self.code.dtype)
        self.code[members] = np.repeat(own, counts)
        used = self.first[-1]
        self.members[used:used + len(members)] = members
        self.first = np.concatenate([self.first, used + np.cumsum(counts)])
        self.pairs, self.counts = np.concatenate([self.pairs, pairs]), np.concatenate([self.counts, counts])

    def places_of(self, codes: np.ndarray) -> np.ndarray:
        """The places that hold a pair of ``codes``, ascending."""
        return self._ranked_places(codes) >> len(codes).bit_length()

    def _ranked_places(self, codes: np.ndarray) -> np.ndarray:
        """The places that hold a pair of ``codes``, ascending, each followed by the number of its
        pair in ``codes``, from 1, in the lowest bits (as many as the greatest number has)."""
        low = self.first.take(codes)
        size = self.first.take(codes + 1) - low
        at = self.members.take(ranges(low, size))
        ranked = np.left_shift(at, len(codes).bit_length(), dtype=np.int64)
        ranked |= np.repeat(np.arange(1, len(codes) + 1), size)
        # Places of a pair that they no longer hold are left out.
        ranked = ranked.compress(self.code.take(at) == np.repeat(codes.astype(self.code.dtype), size))
        ranked.sort()
        return ranked

    def near_top(self) -> np.ndarray:
        """Codes of the pairs whose count is near the top. Replacing them changes the counts
        of the others: those wait for a later round."""
        top = int(self.counts.max())
        return np.flatnonzero(self.counts >= max(self.min_count, top // 8))

    def chosen(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, codes) of the pairs ``near`` to replace in this round: of overlapping ones the
        more frequent, whatever is left ``min_count`` times."""
        # The same pair wins in every copy of a passage; ties in no order along the text.
        order = near[np.argsort(self.pairs.take(near).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))]
        counts = self.counts.take(order)
        order = order[np.argsort(counts.astype(np.min_scalar_type(counts.max(initial=0))), kind="stable")]
        bits = len(order).bit_length()
        at = self._ranked_places(order)
        place, rank = at >> bits, at & ((1 << bits) - 1)
        overlaps = self.next.take(place[:-1]) == place[1:]  # the next one stands at this one's right symbol
        won, rest = np.zeros(len(at), bool), np.arange(len(at))
        while len(rest):
            left, right = rank[:-1], rank[1:]
            wins = np.ones(len(rest), bool)
            wins[:-1] &= ~overlaps | (left > right)
            wins[1:] &= ~overlaps | (right > left)
            won[rest.compress(wins)] = True
            done = wins.copy()
            done[:-1] |= overlaps & wins[1:]
            done[1:] |= overlaps & wins[:-1]
            stay = np.flatnonzero(~done)  # beside a stronger one that lost itself
            overlaps = overlaps.take(stay[:-1]) & (np.diff(stay) == 1)
            rest, rank = rest.take(stay), rank.take(stay)
        at = at.compress(won)
        rank = at & ((1 << bits) - 1)
        enough = np.bincount(rank, minlength=len(near) + 1) >= self.min_count
        return at.compress(enough.take(rank)) >> bits, order[np.flatnonzero(enough) - 1]

    def replace(self, at: np.ndarray, symbols: np.ndarray) -> None:
        """Writes ``symbols`` for the pairs at ``at``. The counts of these pairs themselves are not kept."""
        self.symbols[at] = symbols
        eaten = self.next.take(at)
        after = self.next.take(eaten)
        self.next[at], self.before[after] = after, at
        self.alive[eaten] = False
        left = self.before.take(at)
        old = np.bincount(self.code.take(left), minlength=len(self.counts))
        old += np.bincount(self.code.take(eaten), minlength=len(self.counts))
        self.counts -= old
        # The places themselves and those before them, ascending; -1 (the start) has no pair.
        new = left >= 0
        new[1:] &= left[1:] != at[:-1]
        touched = np.stack([left, at], axis=1).ravel().compress(np.stack([new, np.ones(len(at), bool)], axis=1).ravel())
        self.code[eaten] = self.code[touched] = 0
        after = self.next.take(touched)
        if len(after) and after[-1] == len(self.symbols):  # the last place is followed by no symbol
            touched, after = touched[:-1], after[:-1]
        self._count(self.symbols.take(touched), self.symbols.take(after), touched, after)
        self.counts[0] = 0


def compress(ids: np.ndarray, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Re-Pair grammar of ``ids``: (rules as pairs, expansion lengths of the rules,
    sequence, first nonterminal). Each round makes rules of the most frequent pairs of
    neighbours and replaces them, until no pair stands ``min_count`` times without overlap.
    Counts are kept up to date place by place; in rows of one symbol a count can fall one
    short, so the end is checked by counting anew."""
    symbols = ids.astype(np.int64)
    terminals = int(symbols.max()) + 1 if len(symbols) else 0
    rules = [np.zeros(0, np.int64)]
    first = terminals
    while len(symbols) > 1:
        work = _Sequence(symbols, min_count)
        # Pairs that have a symbol already: some were left over beside stronger pairs.
        known = pd.Index(np.concatenate(rules)).get_indexer(work.pairs[1:])
        left = 1 + np.flatnonzero(known >= 0)
        if again := len(left) > 0:
            at, _ = work.chosen(left)
            work.replace(at, terminals + known[work.code[at] - 1])
        else:
            while len(near := work.near_top()):
                at, codes = work.chosen(near)
                symbol = np.zeros(len(work.counts), np.int64)
                symbol[codes] = first + np.arange(len(codes))
                rules.append(work.pairs[codes])
                first += len(codes)
                again = True
                work.replace(at, symbol[work.code[at]])
                work.counts[codes] = 0  # what is left of them waits for the next count
        symbols = work.symbols.compress(work.alive)
        if not again:
            break
    keys = np.concatenate(rules)
    table = np.stack([keys >> 32, keys & 0xFFFFFFFF], axis=1)
    lengths = np.ones(terminals + len(table), np.int64)
    at = terminals
    for part in rules:  # a round's rules use symbols of earlier rounds only
        own = table[at - terminals:at - terminals + len(part)]
        lengths[at:at + len(part)] = lengths[own[:, 0]] + lengths[own[:, 1]]
        at += len(part)
    return table, lengths[terminals:], symbols, terminals


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    while len(symbols) and (inner := symbols >= terminals).any():
        size = 1 + inner
        result = np.zeros(int(size.sum()), np.int64)
        place = np.cumsum(size) - size
        result[place[~inner]] = symbols[~inner]
        pairs = rules[symbols[inner] - terminals]
        result[place[inner]] = pairs[:, 0]
        result[place[inner] + 1] = pairs[:, 1]
        symbols = result
    return symbols


def _spell(rules: np.ndarray, length: np.ndarray, terminals: int) -> Ragged:
    """The ids of every symbol, by its number; a rule's after those of its two symbols."""
    start = np.concatenate([[0], np.cumsum(length)])
    spelled = Ragged(np.zeros(int(start[-1]), np.int64), start)
    spelled.values[:terminals] = np.arange(terminals)
    known = np.arange(len(length)) < terminals
    wait = np.arange(len(rules))
    while len(wait):
        ready = known[rules[wait]].all(axis=1)
        now, wait = wait[ready], wait[~ready]
        if not len(now):
            raise ValueError("damaged Re-Pair rules")
        spelled.values[ranges(start[terminals + now], length[terminals + now])] = spelled.take(rules[now].ravel()).values
        known[terminals + now] = True
    return spelled


def write_shard(documents: list[np.ndarray], min_count: int = MIN_COUNT) -> bytes:
    """Bytes of one shard from the ids of its documents."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.int64)
    rules, lengths, sequence, terminals = compress(ids, min_count)
    pack = zstandard.ZstdCompressor(level=3)
    frames = [pack.compress(a.astype("<u4").tobytes()) for a in (
        rules[:, 0], rules[:, 1], lengths, sequence, np.array([len(d) for d in documents], np.int64))]
    return b"".join([_HEAD.pack(_MAGIC, terminals, len(rules), len(sequence), len(documents)),
                     *(struct.pack("<I", len(f)) + f for f in frames)])


class Shard:
    """Random-access reader of one shard's bytes."""

    def __init__(self, data: bytes):
        magic, self.terminals, rules, symbols, documents = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a Re-Pair shard")
        at, arrays = _HEAD.size, []
        unpack = zstandard.ZstdDecompressor()
        for count in (rules, rules, rules, symbols, documents):
            (size,) = struct.unpack_from("<I", data, at)
            raw = unpack.decompress(data[at + 4:at + 4 + size], max_output_size=max(1, 4 * count))
            arrays.append(np.frombuffer(raw, "<u4").astype(np.int64))
            at += 4 + size
        left, right, lengths, self.sequence, counts = arrays
        if len(self.sequence) != symbols or len(counts) != documents:
            raise ValueError("truncated Re-Pair shard")
        length = np.concatenate([np.ones(self.terminals, np.int64), lengths])
        self._rules = np.stack([left, right], axis=1)
        self._spelled = _spell(self._rules, length, self.terminals) if length.sum() <= SPELLED_IDS else None
        #: Tokens before each symbol of the sequence, and before each document.
        self.before = np.concatenate([[0], np.cumsum(length[self.sequence])])
        self.doc_start = np.concatenate([[0], np.cumsum(counts)])

    def __len__(self) -> int:
        return len(self.doc_start) - 1

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the shard; only the symbols that cover them are expanded."""
        if start >= stop:
            return np.zeros(0, np.int64)
        low = int(np.searchsorted(self.before, start, side="right")) - 1
        high = int(np.searchsorted(self.before, stop, side="left"))
        symbols = self.sequence[low:high]
        ids = expand(symbols, self._rules, self.terminals) if self._spelled is None else self._spelled.take(symbols).values
        return ids[start - self.before[low]:stop - self.before[low]]

    def document(self, number: int) -> np.ndarray:
        return self.tokens(int(self.doc_start[number]), int(self.doc_start[number + 1]))

    def documents(self) -> list[np.ndarray]:
        """Ids of all documents, each from the symbols that cover it."""
        if self._spelled is None:
            return [self.document(k) for k in range(len(self))]
        start, stop = self.doc_start[:-1], self.doc_start[1:]
        low = np.searchsorted(self.before, start, side="right") - 1
        size = np.where(start < stop, np.searchsorted(self.before, stop, side="left") - low, 0)
        ids = self._spelled.take(self.sequence.take(ranges(low, size)))
        at = ids.start.take(np.cumsum(size) - size) + np.where(start < stop, start - self.before.take(low), 0)
        return [ids.values[a:b] for a, b in zip(at.tolist(), (at + stop - start).tolist(), strict=True)]


_SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                     ("n_tokens", pa.int64()), ("shard", pa.binary())])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, doc_id: str = "doc_id",
                      text: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
                      min_count: int = MIN_COUNT) -> None:
    """Writes all documents, ids then ``end_id``, in ascending id order as a Parquet
    table of shards (part, seq, doc_ids, n_tokens, shard) under ``path``.

    A null text counts as empty (just the end id). A null id comes first; rows that
    repeat an id stand next to each other, ordered by text. An empty table gives a
    table without shards. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for block in slices(batch, "text", BLOCK_BYTES):
                part, at = block.column(2)[0].as_py(), 0
                for ids in encoder(tokenizer_path).documents(block.column(1), shard_bytes):
                    documents = [np.append(ids.values[a:b], end_id)
                                 for a, b in zip(ids.start[:-1], ids.start[1:], strict=True)]
                    own = block.column(0).slice(at, len(documents))
                    at += len(documents)
                    yield record(_SHARDS, [part], [number], [own.to_pylist()],
                                 [sum(map(len, documents))], [write_shard(documents, min_count)])
                    number += 1

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id")) \
        .withColumn("part", F.spark_partition_id()).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    ordered.mapInArrow(run, "part int, seq int, doc_ids array<long>, n_tokens long, shard binary") \
        .write.parquet(path)


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Shards of :func:`write_token_files` with ``start``: tokens of all shards before."""
    shards = spark.read.parquet(path)
    # Running totals in two levels: over parts (one small row each), then inside a part.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    before = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("within")) \
        .join(before, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("start"))
    return shards.join(starts, ["part", "seq"])


def document_checksums(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the symbols of its shard that cover it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column(2)[row].as_py())
                ids = [i.astype("<u4") for i in shard.documents()]
                start = batch.column(1)[row].as_py()
                yield record(_READ, batch.column(0)[row].values, shard.doc_start[:-1] + start,
                             [len(i) for i in ids], [zlib.crc32(i) for i in ids])

    return shards.select("doc_ids", "start", "shard").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Writes ``docs`` to token files (by default in the shared scratch folder), reads
    them back and returns :func:`document_checksums`."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_path)
    return document_checksums(read_token_files(spark, path))
