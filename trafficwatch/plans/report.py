"""Reports over a day's violations and the health counters.

Each report is a grouped aggregate followed by a one-row aggregate over the
groups, never a join of partial results: the per-key step is partial
(map-side), the final step sees one row per key.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficwatch.config import DEFAULT, Settings
from trafficwatch.functions.numbers import round_half_even
from trafficwatch.functions.timeutil import iso_text
from trafficwatch.plans.lookup import instant


def rounded_mean(total: Column, count: Column, places: int) -> Column:
    """Mean rounded to ``places`` like Python's ``round`` (the exact binary value, an exact tie to
    the even digit); 0.0 when there is nothing to average."""
    return F.coalesce(round_half_even(total / count, places), F.lit(0.0))


def counts_by(records: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Number of records per value of ``key``."""
    return records.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_key(records: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Most frequent value of ``key`` (ties: smallest value); empty input, no row."""
    return counts_by(records, key, name).orderBy(F.col(name).desc(), F.col(key).asc()).limit(1)


def counts_by_location(records: DataFrame) -> DataFrame:
    """Records per location, most first (ties by name)."""
    return counts_by(records, "location_name").orderBy(F.col("n").desc(), F.col("location_name").asc())


def _leader(value: Column, n: Column, key: Column) -> Column:
    """``value`` of the group with the greatest ``n`` (ties: smallest ``key``)."""
    return F.min_by(value, F.struct((-n).alias("m"), key.alias("k")))


def day_stats(records: DataFrame, now: dt.datetime, settings: Settings = DEFAULT) -> DataFrame:
    """Headline numbers: total, detections per minute over the last span,
    average speed (2 decimals, 0.0 when empty) and the busiest camera's location."""
    since = instant(now) - F.expr(f"INTERVAL {settings.per_minute_span_minutes} MINUTES")
    per_camera = records.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("detected_at") >= since).alias("recent"),
        F.sum("recorded_speed_kph").alias("speed_sum"),
        F.count("recorded_speed_kph").alias("speed_n"),
        # The location shown for a camera is the one on its newest record.
        F.max_by("location_name", F.struct("violation_time", "violation_id")).alias("location_name"),
    )
    return per_camera.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.round(F.coalesce(F.sum("recent"), F.lit(0)) / F.lit(float(settings.per_minute_span_minutes)),
                1).alias("per_minute"),
        rounded_mean(F.sum("speed_sum"), F.sum("speed_n"), 2).alias("avg_speed"),
        _leader(F.col("location_name"), F.col("n"), F.col("camera_id")).alias("busiest"),
    )


def day_summary(records: DataFrame, day: dt.date | str, settings: Settings = DEFAULT) -> DataFrame:
    """Printable summary: date, first and last violation time (ISO), total,
    average speed, the plate with most violations and its count."""
    day = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    per_plate = records.groupBy("plate_number").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("violation_time").alias("first"),
        F.max("violation_time").alias("last"),
        F.sum("recorded_speed_kph").alias("speed_sum"),
        F.count("recorded_speed_kph").alias("speed_n"),
    )
    return per_plate.agg(
        F.lit(day.isoformat()).alias("date"),
        iso_text(F.min("first"), settings.timezone).alias("first"),
        iso_text(F.max("last"), settings.timezone).alias("last"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        rounded_mean(F.sum("speed_sum"), F.sum("speed_n"), 2).alias("avg_speed"),
        _leader(F.col("plate_number"), F.col("n"), F.col("plate_number")).alias("top_plate"),
        F.max("n").alias("top_plate_count"),
    )


def latest_detection_age(records: DataFrame, now: dt.datetime) -> DataFrame:
    """Seconds since the newest detection, at least 0; null when there is none."""
    newest = F.max("detected_at")
    age = (F.unix_micros(instant(now)) - F.unix_micros(newest)) / F.lit(1_000_000.0)
    return records.agg(F.when(newest.isNotNull(), F.greatest(F.lit(0.0), age)).alias("age_seconds"))


def event_rate(readings: DataFrame, poll_seconds: int = 300) -> DataFrame:
    """Running total and rate of readings on event time, one row per poll (the end of
    each time bucket that has readings): ``poll_time, total, events_per_sec``. The rate
    is the change of the total over the seconds since the previous poll; 0 at the first.

    Readings are counted per bucket with partial aggregation. Running totals then go in
    two levels, inside each day and over one row per day, so no task holds all polls."""
    us, step, day_us = F.unix_micros("event_time"), poll_seconds * 1_000_000, 86_400_000_000
    polls = readings.groupBy((us - F.pmod(us, F.lit(step)) + F.lit(step)).alias("at")) \
        .agg(F.count(F.lit(1)).alias("n")).withColumn("day", F.floor(F.col("at") / F.lit(day_us)))
    days = polls.groupBy("day").agg(F.sum("n").alias("of_day"), F.max("at").alias("last_poll"))
    in_order = Window.orderBy("day")
    before = days.select("day", (F.sum("of_day").over(in_order) - F.col("of_day")).alias("earlier"),
                         F.lag("last_poll").over(in_order).alias("day_before"))
    inside = Window.partitionBy("day").orderBy("at")
    known = polls.withColumns({"so_far": F.sum("n").over(inside), "in_day": F.lag("at").over(inside)}).join(before, "day")
    previous = F.coalesce("in_day", "day_before")
    rate = F.when(previous.isNull(), F.lit(0.0)).otherwise(F.col("n") / ((F.col("at") - previous) / F.lit(1e6)))
    return known.select(F.timestamp_micros("at").alias("poll_time"),
                        (F.col("so_far") + F.col("earlier")).cast("long").alias("total"),
                        rate.alias("events_per_sec"))


def health_counters(readings: DataFrame, records: DataFrame, day: dt.date | str, now: dt.datetime) -> DataFrame:
    """Health counters as ``(metric, value)`` rows: readings in total and per second at
    the latest poll, age of the newest detection, violations of the day. Each source is
    aggregated once to one row, which is then stacked into metrics."""
    day = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    latest = event_rate(readings).agg(F.max_by(F.struct("total", "events_per_sec"), "poll_time").alias("p"))
    newest = F.max("detected_at")
    age = F.greatest(F.lit(0.0), (F.unix_micros(instant(now)) - F.unix_micros(newest)) / F.lit(1_000_000.0))
    detected = records.agg(F.when(newest.isNotNull(), age).alias("age"),
                           F.count_if(F.col("violation_date") == F.lit(day)).cast("double").alias("today"))

    def stacked(row: DataFrame, **metrics) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
                          for name, value in metrics.items()])
        return row.select(F.inline(pairs))

    return stacked(latest, topic_total=F.col("p.total"), events_per_sec=F.col("p.events_per_sec")).unionByName(
        stacked(detected, latest_violation_age=F.col("age"), violations_today=F.col("today")))
