"""Line dedup through a sharded minimal perfect hash.

A line's key is its 128-bit XXH3 hash after stripping ASCII white space and lower-casing
A-Z. Keys are counted per document (each document counts once), then the distinct
keys of a shard are put into a minimal perfect hash: levels of bitmaps in which a key
has a bit that no other key of the level wants, so that the bit's rank is the key's
index. The index points into two compact arrays, a 32-bit fingerprint and a saturated
8-bit count; no key or line is stored.

Documents probe the arrays: the (document, key) rows of a shard meet its arrays in one
task and leave a row only where the count reaches the threshold. All keys that are
probed are indexed, so each finds its own entry. A shard that a frequent line makes
large is probed in several tasks (salts), each with a copy of the arrays.
"""
from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import map_batches, persisted, record, text_or_empty

MIN_DOCUMENTS = 10
#: Keys in a shard's arrays, and probes in a task, are about this many at most.
SHARD_KEYS = 500_000
PROBE_ROWS = 500_000
_WHITE = b" \t\n\x0b\x0c\r"
_SATURATED = 255


def line_key(line: bytes) -> bytes | None:
    """16 bytes that stand for the line's key; None for an empty key."""
    key = line.strip(_WHITE).lower()
    return xxhash.xxh3_128_digest(key) if key else None


def _mixed(low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = low + high * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys with fingerprints and counts."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int], fingerprints: np.ndarray, counts: np.ndarray):
        self.levels, self.sizes = levels, sizes  # bitmaps in 64-bit words; bits of each level
        self.fingerprints, self.counts = fingerprints, counts
        ones, self._ranks = 0, []
        for words in levels:
            own = np.bitwise_count(words).astype(np.int64)
            self._ranks.append(ones + np.cumsum(own) - own)
            ones += int(own.sum())

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, gamma: float = 1.5) -> "PerfectHash":
        """``keys``: n x 2 unsigned 64-bit numbers, all different."""
        levels, sizes = [], []
        low, high = keys[:, 0].copy(), keys[:, 1].copy()
        while len(low):
            size = max(64, int(gamma * len(low)) // 64 * 64)
            place = (_mixed(low, high, len(levels)) % np.uint64(size)).astype(np.int64)
            wanted = np.bincount(place, minlength=size)
            bits = np.packbits((wanted == 1).astype(np.uint8), bitorder="little")
            levels.append(bits.view("<u8"))
            sizes.append(size)
            again = wanted[place] > 1
            low, high = low[again], high[again]
        found = cls(levels, sizes, np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint8))
        index = found._index(keys)
        found.fingerprints[index] = keys[:, 1] >> np.uint64(32)
        found.counts[index] = np.minimum(counts, _SATURATED)
        return found

    def _index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for a key that surely is not a member."""
        index = np.full(len(keys), -1, np.int64)
        open_rows = np.arange(len(keys))
        for level, (words, size, ranks) in enumerate(zip(self.levels, self.sizes, self._ranks, strict=True)):
            place = (_mixed(keys[open_rows, 0], keys[open_rows, 1], level) % np.uint64(size)).astype(np.int64)
            word, bit = words[place >> 6], (place & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            index[open_rows[here]] = (ranks[place >> 6] + below)[here]
            open_rows = open_rows[~here]
        return index

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Saturated count of each key; 0 where the fingerprint differs."""
        if not len(self.counts):
            return np.zeros(len(keys), np.uint8)
        index = self._index(keys)
        match = (index >= 0) & (self.fingerprints[index] == (keys[:, 1] >> np.uint64(32)).astype(np.uint32))
        return np.where(match, self.counts[index], 0)

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<II{len(self.sizes)}Q", len(self.counts), len(self.sizes), *self.sizes)
        return b"".join([head, *(w.tobytes() for w in self.levels),
                         self.fingerprints.astype("<u4").tobytes(), self.counts.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        count, levels = struct.unpack_from("<II", data)
        sizes = list(struct.unpack_from(f"<{levels}Q", data, 8))
        at, bitmaps = 8 + 8 * levels, []
        for size in sizes:
            bitmaps.append(np.frombuffer(data, "<u8", size // 64, at))
            at += size // 8
        return cls(bitmaps, sizes, np.frombuffer(data, "<u4", count, at),
                   np.frombuffer(data, np.uint8, count, at + 4 * count))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column of 16-byte keys as an n x 2 array."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


def document_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key): the different nonempty line keys of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys = [], []
        for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = {line_key(line) for line in content.encode().split(b"\n")} - {None}
            ids += [doc] * len(own)
            keys += own
        yield record(schema, ids, keys)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, key binary")


def count_shards(keys: DataFrame) -> DataFrame:
    """(shard, arrays): the perfect hash of each shard of the distinct ``keys``."""
    schema = pa.schema([("shard", pa.int32()), ("arrays", pa.binary())])

    def build(group: pa.Table) -> pa.Table:
        arrays = PerfectHash.build(_numbers(group.column("key")), group.column("documents").to_numpy())
        return pa.Table.from_batches([record(schema, [group.column("shard")[0].as_py()], [arrays.to_bytes()])])

    counted = keys.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("documents"))
    return counted.groupBy("shard").applyInArrow(build, "shard int, arrays binary")


def frequent_keys(keys: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The rows of ``keys`` (doc_id, key, shard) whose key at least ``min_documents``
    rows have, found by probing the shards' arrays."""
    if not 1 <= min_documents <= _SATURATED:
        raise ValueError(f"min_documents must be 1 to {_SATURATED}")
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def probe(group: pa.Table, shard: pa.Table) -> pa.Table:
        if not group.num_rows:
            return schema.empty_table()
        arrays = PerfectHash.from_bytes(shard.column("arrays")[0].as_py())
        hit = pa.array(arrays.lookup(_numbers(group.column("key"))) >= min_documents)
        return group.select(["doc_id", "key"]).filter(hit).cast(schema)

    # One small row per shard.
    sizes = keys.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PROBE_ROWS).cast("int").alias("salts"))
    probes = keys.join(sizes, "shard").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).drop("salts")
    copies = count_shards(keys).join(sizes, "shard").select(
        "shard", "arrays", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(
        probe, "doc_id long, key binary")


def drop_frequent_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped): each row's text without the lines whose
    key at least ``min_documents`` rows have.

    A null or empty text is one empty line, which is never dropped, like any line of
    white space. Each row counts as a document, also if it repeats an id; rows without
    an id count and lose lines like any other. A document whose lines are all dropped
    has the text ''. An empty table gives no rows. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()),
                        ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept_texts, lines_of, dropped_of = [], [], []
        for content, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines, gone = content.encode().split(b"\n"), set(drop or ())
            kept = [x for x in lines if line_key(x) not in gone] if gone else lines
            kept_texts.append(b"\n".join(kept).decode())
            lines_of.append(len(lines))
            dropped_of.append(len(lines) - len(kept))
        yield record(schema, batch.column(0), kept_texts, lines_of, dropped_of)

    keys = persisted(document_keys(docs, doc_id, text), "line-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    keys = keys.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    drops = frequent_keys(keys, min_documents).groupBy(F.col("doc_id").alias("of")).agg(
        F.collect_set("key").alias("drops"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    joined = rows.join(drops.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return map_batches(joined.select("doc_id", "text", "drops"), run,
                       "doc_id long, kept_text string, n_lines long, n_dropped long")


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """:func:`drop_frequent_lines` with the SHA-256 of the kept text in its place."""
    return drop_frequent_lines(docs, doc_id, text, min_documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
