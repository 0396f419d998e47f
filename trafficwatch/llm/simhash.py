"""SimHash near-dedup with deletion-variant signatures.

Fingerprint: a document's words (A-Z lower-cased, split on ASCII white space) give
3-word shingles, repeats included; a bit is 1 if it is set in more than half of the
shingles' XXH64 values.

Candidates: to find all pairs within ``distance`` bits, the 64 bits are cut into
``distance // 2 + 1`` segments, so that at least one segment of a linked pair differs
in at most one bit. Each segment is indexed under its one-wildcard variants (that bit
deleted); an equality join on (segment, wildcard, remaining bits) meets every such pair and
the join condition verifies the whole distance. A pair is accepted at one place only:
in its first segment with at most one differing bit, at that bit (at wildcard 0 when
the segments are equal).

Copies share a fingerprint and enter the index once, so a group of copies costs one
row there; a fingerprint has at most C(64,1) + C(64,2) others within 2 bits.

Tables with a row for each document or fingerprint are joined by sorting whatever their
size: Spark takes a compressed file for its rows and would broadcast them through the driver.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import fresh_name, map_batches, one_per_key, persisted, record, text_or_empty
from trafficwatch.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
#: Shingle hashes whose bits are counted at once.
_BLOCK = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text (0 for a text without words)."""
    words = text.encode().lower().split()  # bytes: A-Z only, and \\x20 \\x09-\\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    count = len(words) - shingle + 1
    values = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, _BLOCK):
        block = values[start:start + _BLOCK].astype("<u8").view(np.uint8)
        bits = np.unpackbits(block.reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(((ones * 2 > count).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed 64-bit number."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
        yield record(_FINGERPRINTS, batch.column(0), values.view(np.int64))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return map_batches(rows, run, "doc_id long, fp long")


def fingerprint_links(distinct_fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): all pairs of different fingerprints within ``distance`` bits, once each."""
    segments = distance // 2 + 1
    bounds = [64 * s // segments for s in range(segments + 1)]
    variants = F.array(*[
        F.struct(F.lit(s).alias("seg"), F.lit(bit).alias("bit"),
                 F.col("fp").bitwiseAND(F.lit(_signed(_mask(bounds[s], bounds[s + 1]) & ~(1 << bit)))).alias("rest"))
        for s in range(segments) for bit in range(bounds[s], bounds[s + 1])])
    index = distinct_fps.select("fp", F.inline(variants))
    left, right = index.alias("l"), index.alias("r")
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    here = F.lit(False)
    earlier = F.lit(True)  # all earlier segments differ in two bits or more
    for s in range(segments):
        mask, first = _mask(bounds[s], bounds[s + 1]), bounds[s]
        inside = F.bit_count(differ.bitwiseAND(F.lit(_signed(mask))))
        at = F.expr(f"shiftleft(1L, l.bit)") == differ.bitwiseAND(F.lit(_signed(mask)))
        here = here | ((F.col("l.seg") == s) & earlier
                       & (((inside == 1) & at) | ((inside == 0) & (F.col("l.bit") == first))))
        earlier = earlier & (inside >= 2)
    condition = ((F.col("l.seg") == F.col("r.seg")) & (F.col("l.bit") == F.col("r.bit"))
                 & (F.col("l.rest") == F.col("r.rest")) & (F.col("l.fp") < F.col("r.fp"))
                 & (F.bit_count(differ) <= distance) & here)
    # Spark sizes the index as the fingerprints that it is made of, a row of each, and would broadcast it.
    return left.hint("merge").join(right, condition).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def _mask(low: int, high: int) -> int:
    return ((1 << (high - low)) - 1) << low


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the
    smallest id reachable over links of at most ``distance`` bits).

    A null text counts as empty; a text without words has fingerprint zero and links
    like any other; a text with fewer words than a shingle is one shingle. A null id
    never becomes a component_id unless all ids of its component are null. Repeated
    rows give repeated rows. Empty table: no rows. Other columns are not read.
    """
    prints, rooted = _rooted(docs, doc_id, text, shingle, distance)
    # Components hold fingerprints, not documents; their minimum is combined map-side.
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(of_root, "root").select("fp", "component_id")
    return prints.hint("merge").join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE,
            distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every document, and (fp, least id, root of its component) of every fingerprint."""
    prints = persisted(fingerprints(docs, doc_id, text, shingle), "simhash")
    by_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(by_fp.select("fp"), distance))
    return prints, by_fp.hint("merge").join(roots, by_fp.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly one row of each component, with all its columns: the one with the smallest id; if
    no row of it has an id, or several rows have that one, of these the one with the
    smallest fingerprint and then the greatest in its columns."""
    own_id, own_fp, count = (fresh_name(docs, n) for n in ("kept_id", "kept_fp", "copies"))
    prints, rooted = _rooted(docs, doc_id, text)
    # By id, nulls last, then fingerprint; one small row per component.
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("first"))
    rows_of_id = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias(count))
    kept = persisted(first.select(F.col("first.least").alias(own_id), F.col("first.fp").alias(own_fp))
                     .hint("merge").join(rows_of_id, F.col(own_id).eqNullSafe(F.col("doc_id"))).select(own_id, own_fp, count), "kept-first")
    same_id = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(own_id))
    plain = kept.where(F.col(own_id).isNotNull() & (F.col(count) == 1))
    single = docs.hint("merge").join(plain, same_id, "left_semi")
    # Rows that their id does not name are told apart by their fingerprint.
    shared = kept.where(F.col(own_id).isNull() | (F.col(count) > 1)).drop(count)
    if shared.isEmpty():
        return single
    unnamed = docs.join(shared.select(own_id).distinct(), same_id, "left_semi")
    quoted = fresh_name(docs, "all_of_it")
    packed = unnamed.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(quoted),
                            F.col(f"`{doc_id}`").cast("long").alias("of_id"), text_or_empty(f"`{text}`").alias("of_text"))
    marked = packed.withColumn("of_fp", _fingerprint_of("of_text"))
    found = marked.join(shared, F.col("of_id").eqNullSafe(F.col(own_id)) & (F.col("of_fp") == F.col(own_fp)))
    again = found.select(*[F.col(f"{quoted}.`{c}`").alias(c) for c in docs.columns], own_id, own_fp)
    return single.unionByName(one_per_key(again, own_id, own_fp))


def _fingerprint_of(text: str):
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return prints(text)
