"""Event-time rebasing and replay passes over a bounded telemetry table."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.config import REPLAY_GAP_SECONDS


def _time_bounds(readings: DataFrame) -> tuple[int | None, int | None]:
    """(min, max) of ``event_time`` in epoch microseconds: one partial aggregate,
    one row back to the driver."""
    row = readings.agg(F.min(F.unix_micros("event_time")).alias("lo"),
                       F.max(F.unix_micros("event_time")).alias("hi")).first()
    return row["lo"], row["hi"]


def _shift(readings: DataFrame, micros) -> DataFrame:
    return readings.withColumn("event_time",
                               F.timestamp_micros(F.unix_micros("event_time") + micros))


def require_rows(df: DataFrame, what: str = "data set") -> DataFrame:
    """Raise ``ValueError`` when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def rebase_time(readings: DataFrame, start: dt.datetime) -> DataFrame:
    """Shift every reading by the same amount so the earliest one is at ``start``
    (an aware datetime). Empty input stays empty."""
    if start.tzinfo is None:
        raise ValueError("start must be an aware datetime")
    lo, _ = _time_bounds(readings)
    if lo is None:
        return readings
    target = round(start.timestamp() * 1_000_000)
    return _shift(readings, F.lit(target - lo))


def replay_passes(readings: DataFrame, passes: int,
                  gap_seconds: int = REPLAY_GAP_SECONDS) -> DataFrame:
    """The data set repeated ``passes`` times; pass ``k`` is moved forward by
    ``k * (span + gap)`` so passes follow one another without overlap. Each row
    is expanded locally (``explode``), so no shuffle and no join is involved."""
    if passes < 1:
        raise ValueError("passes must be at least 1")
    lo, hi = _time_bounds(readings)
    if lo is None:
        return readings.withColumn("replay_pass", F.lit(0))
    span = hi - lo + gap_seconds * 1_000_000
    expanded = readings.withColumn("replay_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    return _shift(expanded, F.col("replay_pass").cast("long") * F.lit(span))


def in_time_order(readings: DataFrame) -> DataFrame:
    """Readings sorted by event time, ties by event id (a total, stable order)."""
    return readings.orderBy("event_time", "event_id")


def first_events(readings: DataFrame, n: int) -> DataFrame:
    """The first ``n`` readings in time order (top-k, no full sort)."""
    return in_time_order(readings).limit(n)


def by_vehicle(readings: DataFrame, partitions: int | None = None) -> DataFrame:
    """Readings laid out by vehicle, in event-time order: the order a
    plate-keyed topic gives a consumer. Range partitioning on (plate, time)
    keeps each vehicle's readings contiguous and ordered across consecutive
    partitions; a vehicle with a large share of the data spans several
    partitions instead of loading one task (hash partitioning by plate would)."""
    order = ["plate_number", "event_time", "event_id"]
    parts = (readings.repartitionByRange(partitions, *order) if partitions
             else readings.repartitionByRange(*order))
    return parts.sortWithinPartitions(*order)
