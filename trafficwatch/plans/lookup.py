"""Retrieval over the stored violations and camera statistics.

Every lookup is a filter on a key, followed by the stored order and a limit (a
``TakeOrderedAndProject`` instead of a full sort). The keys (:func:`plate_is`,
:func:`camera_day_is`, :func:`type_day_is`) follow from the violation id, so callers that
upsert first pass them to the reader, below the upsert; on a compacted store they prune
partitions (date, type) and row groups (plate).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.config import DEFAULT, VIOLATION_TYPES, Settings
from trafficwatch.functions.text import lookup_key, normalize_plate
from trafficwatch.functions.timeutil import iso_text

def stored_order() -> tuple[Column, Column]:
    """Clustering order of the violation tables: newest first, then id."""
    return F.col("violation_time").desc(), F.col("violation_id").asc()

def _check_limit(limit: int, maximum: int | None = None) -> int:
    if limit < 1 or (maximum is not None and limit > maximum):
        bound = f"1..{maximum}" if maximum else "at least 1"
        raise ValueError(f"limit must be {bound}, not {limit}")
    return limit


def _day(day: dt.date | str) -> Column:
    return F.lit(day if isinstance(day, dt.date) else dt.date.fromisoformat(day))

def instant(value: dt.datetime) -> Column:
    """An aware ``datetime`` as a ``TIMESTAMP`` literal, zone-free."""
    if value.tzinfo is None:
        raise ValueError("pass an aware datetime (with tzinfo) for instants")
    micros = round(value.timestamp() * 1_000_000)
    return F.timestamp_micros(F.lit(micros))

def api_record(violations: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The 12-field record the clients read; instants as ISO text in the zone."""
    return violations.select(
        F.col("violation_id").alias("id"),
        iso_text("violation_time", settings.timezone).alias("time"),
        F.col("violation_type").alias("type"),
        F.col("plate_number").alias("plate"),
        F.col("vehicle_type").alias("vehicle"),
        F.col("camera_id").alias("camera"),
        F.col("location_name").alias("location"),
        F.col("recorded_speed_kph").alias("speed"),
        F.col("speed_limit_kph").alias("limit"),
        F.col("evidence").alias("evidence"),
        F.col("ticket_status").alias("status"),
        iso_text("detected_at", settings.timezone).alias("detected"),
    )

def plate_key(plate: str, strict_key: bool = False) -> Column:
    """The plate as a constant, normalised like the HTTP API (case, whitespace runs) or only
    stripped and upper-cased (``strict_key``)."""
    return (lookup_key if strict_key else normalize_plate)(F.lit(plate))

def plate_is(plate: str, strict_key: bool = False) -> Column:
    """Rows of the plate, see :func:`plate_key`."""
    return F.col("plate_number") == plate_key(plate, strict_key)

def camera_day_is(camera_id: str, day: dt.date | str, date_column: str = "violation_date") -> Column:
    return (F.col(date_column) == _day(day)) & (F.col("camera_id") == lookup_key(F.lit(camera_id)))

def type_day_is(violation_type: str, day: dt.date | str) -> Column:
    return (F.col("violation_date") == _day(day)) & (F.col("violation_type") == lookup_key(F.lit(violation_type)))

def violations_by_plate(violations: DataFrame, plate: str, limit: int = DEFAULT.plate_limit,
                        strict_key: bool = False) -> DataFrame:
    """All violations of one vehicle, any day, newest first. The plate is
    normalised like the HTTP API (case, whitespace runs, limit 1..1000), or only
    stripped and upper-cased like the command line (``strict_key``, any positive
    limit)."""
    _check_limit(limit, None if strict_key else 1000)
    return (violations.filter(plate_is(plate, strict_key))
            .orderBy(*stored_order()).limit(limit))

def violations_by_camera(violations: DataFrame, camera_id: str, day: dt.date | str,
                         limit: int = DEFAULT.cli_limit) -> DataFrame:
    """Violations at one camera on one local day, newest first."""
    _check_limit(limit)
    return (violations.filter(camera_day_is(camera_id, day))
            .orderBy(*stored_order()).limit(limit))

def violations_by_type(violations: DataFrame, violation_type: str, day: dt.date | str,
                       limit: int = DEFAULT.cli_limit) -> DataFrame:
    """Violations of one type on one local day, newest first."""
    _check_limit(limit)
    return (violations.filter(type_day_is(violation_type, day))
            .orderBy(*stored_order()).limit(limit))

def stats_by_camera(stats: DataFrame, camera_id: str, day: dt.date | str,
                    limit: int = DEFAULT.cli_limit) -> DataFrame:
    """Sliding-window statistics of one camera on one local day, newest window first."""
    _check_limit(limit)
    return (stats.filter(camera_day_is(camera_id, day, "stat_date"))
            .orderBy(F.col("window_start").desc()).limit(limit))

def day_violations(violations: DataFrame, day: dt.date | str,
                   types: Sequence[str] = VIOLATION_TYPES) -> DataFrame:
    """All violations of the known types on one local day (the per-type reads
    of the reference, as one partition-pruned filter)."""
    return violations.filter((F.col("violation_date") == _day(day))
                             & F.col("violation_type").isin(*types))

def newest_first(records: DataFrame, limit: int = DEFAULT.violations_limit) -> DataFrame:
    """API records newest first (ISO text descending, missing times last), ties
    by id; ``limit`` is 1..2000."""
    _check_limit(limit, 2000)
    return records.orderBy(F.col("time").desc_nulls_last(), F.col("id").asc()).limit(limit)

def violations_of_day(violations: DataFrame, day: dt.date | str,
                      limit: int = DEFAULT.violations_limit,
                      settings: Settings = DEFAULT) -> DataFrame:
    """Today's list of the dashboard: the day's records, newest first."""
    return newest_first(api_record(day_violations(violations, day), settings), limit)

def as_of(detections: DataFrame, moment: dt.datetime) -> DataFrame:
    """What the store held at ``moment``: rows detected by then, upserted by id."""
    from trafficwatch.operators.dedupe import upsert

    return upsert(detections.filter(F.col("detected_at") <= instant(moment)))

def lookback(violations: DataFrame, day: dt.date | str, now: dt.datetime,
             settings: Settings = DEFAULT, on: str = "violation_time") -> DataFrame:
    """The day's records whose ``on`` time is within the lookback before ``now``."""
    since = instant(now) - F.expr(f"INTERVAL {settings.api_lookback_minutes} MINUTES")
    return day_violations(violations, day).filter(F.col(on) >= since)

def poll_step(snapshot: DataFrame | None, fetched: DataFrame, day: dt.date | str,
              settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """One step of the client's snapshot: (next snapshot, news), from what it holds and
    the API records fetched now.

    ``snapshot`` is None before the first load, which is silent: the fetched records become
    the snapshot and nothing is news. Held records of another day are dropped (a day change
    resets the snapshot), fetched copies replace held ones with their id, the others
    stay, and unknown ids are the news, also when nothing was held. A full reload is a
    step with all of the day's records. :func:`trafficwatch.plans.poll.poll` keeps the
    snapshot across restarts."""
    from trafficwatch.operators.dedupe import merge_snapshot

    if snapshot is None:
        return fetched, news(fetched, fetched)
    day = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    held = snapshot.where(F.substring("time", 1, 10) == day.isoformat())
    return merge_snapshot(held, fetched), news(held, fetched)

def news(seen: DataFrame, fetched: DataFrame, initial: bool = False) -> DataFrame:
    """Fetched API records whose id is not yet known, oldest first. The first
    load of a day is history, not news (``initial``)."""
    fresh = fetched.join(seen.select("id"), on="id", how="left_anti")
    if initial:
        fresh = fresh.limit(0)
    return fresh.orderBy(F.col("time").asc_nulls_first(), F.col("id").asc())

def new_violations(detections: DataFrame, day: dt.date | str, previous_poll: dt.datetime,
                   now: dt.datetime, settings: Settings = DEFAULT) -> DataFrame:
    """News of one poll over the detection log: the day's records that the store
    holds at ``now`` within the lookback, but held nothing of at ``previous_poll``
    (the snapshot), oldest first, each in its latest version.

    Equal to ``news(snapshot at previous_poll, lookback read at now)``, but an id
    was already known exactly when its earliest copy was detected by the previous
    poll, so one ``groupBy(id)`` (partial ``max_by``/``min``) replaces two upserts
    and an anti join: one shuffle instead of three. Date and type are functions of
    the id, so their filter runs before the shuffle."""
    from trafficwatch.operators.dedupe import UPSERT_ORDER

    known = day_violations(detections, day).filter(F.col("detected_at") <= instant(now))
    payload = [c for c in known.columns if c != "violation_id"]
    per_id = known.groupBy("violation_id").agg(
        F.max_by(F.struct(*payload), F.struct(*UPSERT_ORDER)).alias("_row"),
        F.min("detected_at").alias("_first_detected"),
    )
    since = instant(now) - F.expr(f"INTERVAL {settings.api_lookback_minutes} MINUTES")
    fresh = per_id.filter((F.col("_first_detected") > instant(previous_poll))
                          & (F.col("_row.violation_time") >= since))
    records = api_record(fresh.select("violation_id", "_row.*"), settings)
    return records.orderBy(F.col("time").asc_nulls_first(), F.col("id").asc())
