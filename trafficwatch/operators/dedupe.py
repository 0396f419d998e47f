"""De-duplication by key: first occurrence, keyed upsert, snapshot merge.

All three are one ``groupBy(key)`` with ``min_by``/``max_by`` over a struct of
the row. These aggregates are partial, so copies of a key are reduced map-side
before the shuffle and a key holding many copies never sends them all to one
task, unlike ``row_number``. A struct buffer is not fixed-width, so Spark aggregates by
sorting rows on the key (before and after the shuffle), as for ``dropDuplicates``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upsert order of the violation store: the copy written last wins. Later windows
# are emitted later, so the greatest window end wins; the rest breaks ties.
UPSERT_ORDER = ("window_end", "recorded_speed_kph", "detected_at", "window_start",
                "reading_count", "evidence")


def _pick(df: DataFrame, key: str | Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in payload])
    rank = F.struct(*[F.col(f"`{c}`") for c in order])
    pick = F.max_by(row, rank) if latest else F.min_by(row, rank)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in payload])
            .select(*df.columns))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key (first occurrence)."""
    return _pick(df, key, order, latest=False)


def upsert(df: DataFrame, key: str | Sequence[str] = "violation_id",
           order: Sequence[str] = UPSERT_ORDER) -> DataFrame:
    """Keyed upsert, last write wins: the row with the greatest ``order`` per key."""
    return _pick(df, key, order, latest=True)


def merge_snapshot(snapshot: DataFrame, fetched: DataFrame, key: str = "id") -> DataFrame:
    """Merge fetched records into a snapshot: a fetched copy replaces the stored
    one with the same key, other stored records stay."""
    ranked = (snapshot.withColumn("_gen", F.lit(0))
              .unionByName(fetched.withColumn("_gen", F.lit(1))))
    return upsert(ranked, key, order=("_gen",)).drop("_gen")
