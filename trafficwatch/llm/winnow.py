"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; in every window of ``window``
consecutive k-grams the smallest is chosen, of equal ones the rightmost; a k-gram that
several windows choose is kept once, with its position. Two texts that share a passage
of ``window + k - 1`` code points share a chosen hash (the match guarantee); hashes
shorter than ``k`` code points never cause a match.

Short texts have narrower windows, an eighth of their length (:func:`window_for`), so they
keep several hashes. What a window chooses, every narrower window inside it that holds
it chooses too, so for two texts the guarantee is that of the wider of their windows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import map_batches, record, text_or_empty

K = 16
_BEFORE_ALL = -(2**63)
WINDOW = 48
#: Odd multiplier of the polynomial hash and finishing constants (splitmix64): fixed values.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams of ``points``, each from its predecessor's sums: the
    polynomial hash of a gram is built by doubling, so every step is one array pass."""
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # done: hash of the grams of length `length`; power: BASE ** length.
    values = points.astype(np.uint64) + np.uint64(1)
    total, covered = None, 0
    part, length, power = values, 1, _BASE
    with np.errstate(over="ignore"):
        while True:
            if k & length:
                total = part[:n].copy() if total is None else total * power + part[covered:covered + n]
                covered += length
            if length * 2 > k:
                break
            part = part[:-length] * power + part[length:]
            power, length = power * power, length * 2
        total ^= total >> np.uint64(30)
        total *= _MIX_1
        total ^= total >> np.uint64(27)
        total *= _MIX_2
        total ^= total >> np.uint64(31)
    return total >> np.uint64(32)


def window_for(text: str, window: int = WINDOW) -> int:
    """The window of a text: an eighth of its code points, from 1 to ``window``."""
    return max(1, min(window, len(text) // 8))


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the chosen k-grams in text order. A text of fewer than k
    code points is one gram; an empty text has none."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = gram_hashes(points, min(k, len(points)))
    n = len(hashes)
    width = min(window, n)
    # Smallest hash first, then the largest position.
    key = hashes << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    # Sliding minimum: running minima forwards and backwards inside blocks of the width.
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(backward[:n - width + 1], forward[width - 1:n])
    place = (np.uint64(0xFFFFFFFF) - (lowest & np.uint64(0xFFFFFFFF))).astype(np.int64)
    chosen = place[np.concatenate([[True], place[1:] != place[:-1]])]
    return hashes[chosen], chosen


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of the distinct hashes of either text that both have; 1 if both have none."""
    one, other = np.unique(one), np.unique(other)
    both = len(np.intersect1d(one, other, assume_unique=True))
    either = len(one) + len(other) - both
    return both / either if either else 1.0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions): one row per document, both lists in text order. A
    null text counts as empty and has empty lists; rows repeat as in ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("hashes", pa.list_(pa.int64())),
                        ("positions", pa.list_(pa.int64()))])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [winnow(t, k, window_for(t, window)) for t in batch.column(1).to_pylist()]
        yield record(schema, batch.column(0), [h.astype(np.int64) for h, _ in found], [p for _, p in found])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, hashes array<long>, positions array<long>")


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of
    ``following`` (all, if it has fewer)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _hex(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def in_order_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, own, doc_id, text): documents ranged by id over partitions and sorted in
    each; ``own`` is false for a copy of the first document of the next partition (of
    the first one after the last), which ends each partition.

    Only ids are looked at to find the partitions' first documents; texts move once.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id")
    # The boundaries of the ranges; at most one per partition reaches the driver.
    bounds = ids.where("doc_id is not null").stat.approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    bounds = sorted({int(b) for b in bounds})

    @F.pandas_udf("int")
    def part_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, numbers.to_numpy(np.int64), side="right").astype(np.int32))

    def ranged(frame: DataFrame) -> DataFrame:
        # Never null: pandas would make the ids floats, which are not exact beyond 2^53.
        return frame.withColumn("part", part_of(F.coalesce("doc_id", F.lit(_BEFORE_ALL))))

    # One row per partition: where it starts, and where a copy of that document goes.
    firsts = sorted((r["part"], r["known"], r["first"]) for r in ranged(ids).groupBy("part").agg(
        F.min(F.col("doc_id").isNotNull()).alias("known"), F.min("doc_id").alias("first")).collect())
    halo = [(firsts[i - 1][0], first if known else None) for i, (_, known, first) in enumerate(firsts)]
    targets = spark.createDataFrame(halo, "part int, first long")
    own = ranged(rows).withColumn("own", F.lit(True))
    copies = rows.join(F.broadcast(targets), F.col("doc_id").eqNullSafe(F.col("first"))) \
        .withColumn("own", F.lit(False))
    columns = ["part", "own", "doc_id", "text"]
    return own.select(columns).unionByName(copies.select(columns)) \
        .repartitionById(len(bounds) + 1, F.col("part")) \
        .sortWithinPartitions("part", F.desc("own"), F.asc_nulls_first("doc_id"), "text")


_EDITS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edit_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document beside its edited text (see :func:`edited`; the next document is
    the one with the next id, after the last comes the first): doc_id, n_chars,
    edited_sha256, fingerprint and edited_fingerprint (8 hex digits per chosen hash, in
    text order), near_edited, near_next.

    A null text counts as empty (empty fingerprint); a null id comes first; rows that
    repeat an id follow each other by text. One document is its own next one. An empty
    table gives no rows. Other columns are not read.
    """
    def chosen(content: str) -> np.ndarray:
        return winnow(content, k, window_for(content, window))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, doc_id, text, hashes) that waits for its next document
        rows: list[tuple] = []
        for batch in batches:
            for part, own, doc, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == part:
                    mixed = edited(held[2], content)
                    now = chosen(content)
                    other = chosen(mixed)
                    rows.append((held[1], len(held[2]), hashlib.sha256(mixed.encode()).hexdigest(),
                                 _hex(held[3]), _hex(other), likeness(held[3], other), likeness(held[3], now)))
                    held = (part, doc, content, now) if own else None
                elif own:
                    held = (part, doc, content, chosen(content))
                if len(rows) >= 1000:
                    yield record(_EDITS, *zip(*rows, strict=True))
                    rows = []
        if rows:
            yield record(_EDITS, *zip(*rows, strict=True))

    return in_order_with_next(docs, doc_id, text).select("part", "own", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
