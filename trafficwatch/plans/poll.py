"""The client's poll: the day's records it has seen, kept across restarts.

A poll fetches the day's records, all of them (*full*) on the first load, on a day change and
when the last full read is older than a setting, else those within the lookback. Records
whose id it has not seen are its news, oldest first; the very first load is silent. A new
day starts with nothing seen, so its first records are news.

Folder layout under one root, one writer at a time::

    records/generation=G/    what poll G fetched; after a full read all that is held
    news/generation=G/       the news of poll G
    state/G.json             one row, created last: day, time of the last full read, and the
                             oldest generation that counts

A poll that dies before its state exists has not happened: the next one writes the same
generation again. What a poll holds is the newest copy of each id in the generations
that its state names, at most as many as there are polls between two full reads.
"""
from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.config import DEFAULT, Settings
from trafficwatch.operators.dedupe import upsert
from trafficwatch.plans.lookup import api_record, instant, news
from trafficwatch.sources import commitlog
from trafficwatch.sources.sinks import read_violations

#: (day, since) -> the store's violations of that day, from ``since`` on if it is not None.
Fetch = Callable[[dt.date, dt.datetime | None], DataFrame]

_RECORD = """id string, time string, type string, plate string, vehicle string, camera string, location string,
    speed double, limit int, evidence string, status string, detected string"""
_HELD = _RECORD + ", generation long"
_STATE = "generation long, day string, full_us long, base long"


@dataclass(frozen=True)
class State:
    """``generation``: number of the poll; ``day``: what it holds the records of; ``full``: the last
    full read; ``base``: the oldest generation that counts."""

    generation: int
    day: dt.date
    full: dt.datetime
    base: int


@dataclass(frozen=True)
class Poll:
    """What a poll found: its ``state``, whether it read the whole day, whether it was the first
    ever, and its ``news``."""

    state: State
    full: bool
    initial: bool
    news: DataFrame


def store_fetch(spark: SparkSession, store: str) -> Fetch:
    """Reads from a violation store. The time of a violation follows from its id, so the
    lookback runs below the upsert, too."""
    def fetch(day: dt.date, since: dt.datetime | None) -> DataFrame:
        return read_violations(spark, store, day=day, where=since and F.col("violation_time") >= instant(since))

    return fetch


def load_state(spark: SparkSession, root: str) -> State | None:
    """The state after the newest complete poll; None if there was none."""
    found = [n for n in commitlog.names(spark, os.path.join(root, "state")) if n.endswith(".json") and n[0] != "."]
    if not found:
        return None
    row = spark.read.schema(_STATE).json(os.path.join(root, "state", max(found))).first()
    full = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=row.full_us)
    return State(row.generation, dt.date.fromisoformat(row.day), full, row.base)


def _generation(root: str, kind: str, number: int) -> str:
    return os.path.join(root, kind, f"generation={number}")


def held_records(spark: SparkSession, root: str, state: State | None = None) -> DataFrame:
    """The API records that the client holds, each in its newest copy."""
    return upsert(_held(spark, root, state or load_state(spark, root)), "id", ("generation",)).drop("generation")


def _held(spark: SparkSession, root: str, state: State | None) -> DataFrame:
    """All copies of the held records, with their generation."""
    if state is None:
        return spark.createDataFrame([], _HELD)
    return spark.read.schema(_HELD).parquet(
        *(_generation(root, "records", g) for g in range(state.base, state.generation + 1)))


def poll(spark: SparkSession, root: str, fetch: Fetch, now: dt.datetime, settings: Settings = DEFAULT) -> Poll:
    """One poll at ``now`` (with a zone). Its records and news are stored before its state."""
    before = load_state(spark, root)
    day = now.astimezone(ZoneInfo(settings.timezone)).date()
    same_day = before is not None and before.day == day
    full = not same_day or (now - before.full).total_seconds() > settings.api_full_reload_seconds
    since = None if full else now - dt.timedelta(minutes=settings.api_lookback_minutes)
    generation = before.generation + 1 if before else 0

    held = _held(spark, root, before if same_day else None)
    fetched = api_record(fetch(day, since), settings).withColumn("generation", F.lit(generation).cast("long"))
    # A full read ends the chain of generations: what is held is written as one.
    kept = upsert(held.unionByName(fetched), "id", ("generation",)) if full and same_day else fetched
    kept.select(*held.columns).write.mode("overwrite").parquet(_generation(root, "records", generation))
    written = spark.read.schema(_HELD).parquet(_generation(root, "records", generation))
    fresh = written.where(F.col("generation") == generation).drop("generation")
    if before is None:
        fresh = fresh.limit(0)
    news(held, fresh).write.mode("overwrite").parquet(_generation(root, "news", generation))

    state = State(generation, day, now if full else before.full, generation if full else before.base)
    micros = round((state.full - dt.datetime.fromtimestamp(0, dt.timezone.utc)).total_seconds() * 1_000_000)
    commitlog.write_text(spark, os.path.join(root, "state", f"{generation:015d}.json"), json.dumps(
        {"generation": generation, "day": day.isoformat(), "full_us": micros, "base": state.base}) + "\n")
    if before is not None and full:
        _forget(spark, root, before.base)
    return Poll(state, full, before is None, news_of(spark, root, generation))


def news_of(spark: SparkSession, root: str, generation: int) -> DataFrame:
    """The news of one poll, oldest first: what a client that missed the answer reads again."""
    stored = spark.read.schema(_RECORD).parquet(_generation(root, "news", generation))
    return stored.orderBy(F.col("time").asc_nulls_first(), F.col("id").asc())


def _forget(spark: SparkSession, root: str, base: int) -> None:
    """Deletes records and states from before generation ``base``. A reader of the state
    that was newest until now still finds all it names."""
    for name in commitlog.names(spark, os.path.join(root, "records")):
        if name.startswith("generation=") and int(name.partition("=")[2]) < base:
            commitlog.delete(spark, os.path.join(root, "records", name))
    for name in commitlog.names(spark, os.path.join(root, "state")):
        if name.endswith(".json") and name[0] != "." and int(name.partition(".")[0]) < base:
            commitlog.delete(spark, os.path.join(root, "state", name))
