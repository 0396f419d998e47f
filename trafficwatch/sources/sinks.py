"""Sinks: telemetry CSV, the violation and statistics store.

Store layout under one root::

    log/                               commits: which folders hold the store's rows (commitlog)
    <query>/run=<id>/batch_id=N/       micro-batches; <id> is the identity that the
                                       query's checkpoint keeps
    merged/<table>/<id>/by_day/        merged folders by date (and type), sorted by plate
    merged/<table>/<id>/by_plate/      the same violations by a hash of the plate

Rows count once their folder is committed, whatever its files' times say. A micro-batch
that was committed is not written again when it is replayed; another job, or a fresh
checkpoint whose batch numbers start again, has another identity and writes beside the
earlier rows. Readers take the live folders of one snapshot of the log, push their key filter
into all of them and apply the keyed upsert to what is left.

Compaction is size-tiered: it merges the micro-batches committed since into a folder of tier
1, and whenever a tier holds ``fanout`` folders, these into one of the next. So a row is rewritten
once per tier, the number of live folders grows with the logarithm of the rows, and what
was merged is deleted after a grace time.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from trafficwatch import schemas
from trafficwatch.operators.dedupe import upsert
from trafficwatch.sources import commitlog
from trafficwatch.sources.commitlog import Folder, Snapshot, snapshot

#: The violation queries and the type that each writes.
VIOLATION_TYPE_OF = {"speeding_violations": "SPEEDING", "red_light_violations": "BEATING_RED_LIGHT",
                     "illegal_parking_violations": "ILLEGAL_PARKING"}
VIOLATION_QUERIES = tuple(VIOLATION_TYPE_OF)
VIOLATIONS, STATS = "violations", "camera_speed_stats"
#: Folders of a tier that compaction merges into one of the next.
FANOUT = 8
#: Rows that a bucket of the layout by plate is to hold.
BUCKET_ROWS = 1_000_000


def write_csv(readings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Telemetry as CSV with a header; nulls as empty fields, ISO times, quotes doubled."""
    from trafficwatch.functions.timeutil import iso_text

    out = readings.withColumn("event_time", iso_text("event_time"))
    (out.write.mode(mode).option("header", True).option("nullValue", "").option("emptyValue", "")
     .option("escape", '"').csv(path))


def write_batch(batch: DataFrame, root: str, query: str, run: str, batch_id: int, known: Snapshot | None = None) -> bool:
    """Write one micro-batch to its own directory and commit it; False if the log (``known``, by
    default as it is now) has it already. What an earlier attempt left uncommitted is replaced."""
    spark = batch.sparkSession
    if (known or snapshot(spark, root)).has_batch(query, run, batch_id):
        return False
    path = os.path.join(query, f"run={run}", f"batch_id={batch_id}")
    where = os.path.join(root, path)
    batch.write.mode("overwrite").parquet(where)
    folder = Folder(path, VIOLATIONS if query in VIOLATION_QUERIES else STATS, rows=spark.read.schema(batch.schema).parquet(where).count(),
                    bytes=commitlog.size(spark, where))
    commitlog.commit(spark, root, "batch", add=[folder], query=query, run=run, batch=batch_id)
    return True


def require_store(spark: SparkSession, root: str) -> None:
    """Raise ``FileNotFoundError`` unless ``root`` is a store: a mistyped path is not an empty
    one, nor is a folder of batches that no log names."""
    if not commitlog.exists(spark, root):
        raise FileNotFoundError(f"no violation store at {root}")
    if not commitlog.exists(spark, os.path.join(root, commitlog.LOG)) and any(
            commitlog.exists(spark, os.path.join(root, q)) for q in (*VIOLATION_QUERIES, STATS)):
        raise FileNotFoundError(f"batches without a commit log at {root}")


def plate_bucket(plate: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(plate), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, root: str, folders: Iterable[Folder], schema: StructType, where: Column | None = None,
          plate: Column | None = None) -> DataFrame:
    """Rows of the folders, filtered. With a ``plate``, folders that are laid out by plate are
    read in that layout, of which only the plate's bucket is opened."""
    columns = schema.fieldNames()
    if plate is not None:
        of_plate = F.col("plate_number") == plate
        where = of_plate if where is None else where & of_plate
    by_place: dict[int | None, list[str]] = {}
    for f in folders:
        by_place.setdefault(f.buckets if plate is not None and f.buckets else None if f.tier else 0, []).append(f.path)
    parts = [spark.createDataFrame([], schema)]
    for buckets, paths in by_place.items():
        if buckets == 0:  # micro-batches
            found = spark.read.schema(schema).parquet(*[os.path.join(root, p) for p in paths])
        elif buckets is None:
            # One read for each folder: partition columns are found below its own root.
            for p in paths:
                parts.append(spark.read.schema(schema).parquet(os.path.join(root, p, "by_day")).select(*columns))
            continue
        else:
            wide = StructType([*schema.fields, StructField("plate_bucket", IntegerType())])
            for p in paths:
                one = spark.read.schema(wide).parquet(os.path.join(root, p, "by_plate"))
                parts.append(one.where(F.col("plate_bucket") == plate_bucket(plate, buckets)).select(*columns))
            continue
        parts.append(found.select(*columns))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found if where is None else found.where(where)


def read_violations(spark: SparkSession, root: str, queries=VIOLATION_QUERIES, day=None, where: Column | None = None,
                    plate: Column | None = None, at: Snapshot | None = None) -> DataFrame:
    """The store's violations, upserted by id (last write wins): all, those of one local
    ``day``, of a ``plate`` (a normalised constant), or of a ``where`` on columns that follow
    from the id (date, type, plate, camera), so it may run before the upsert. ``at``: the snapshot
    to read, by default the present one."""
    require_store(spark, root)
    if day is not None:
        of_day = F.col("violation_date") == F.lit(day)
        where = of_day if where is None else where & of_day
    if set(queries) != set(VIOLATION_QUERIES):
        of_type = F.col("violation_type").isin(*(VIOLATION_TYPE_OF[q] for q in queries))
        where = of_type if where is None else where & of_type
    folders = (at or snapshot(spark, root)).of(VIOLATIONS)
    return upsert(_rows(spark, root, folders, schemas.VIOLATION, where, plate))


#: The key of the statistics and which copy of a row wins.
STATS_KEY = ("camera_id", "window_start")
STATS_ORDER = ("window_end", "reading_count", "avg_speed_kph")


def read_stats(spark: SparkSession, root: str, query: str = STATS, where: Column | None = None,
               at: Snapshot | None = None) -> DataFrame:
    """Camera statistics, one row per (camera, window) (upsert on the table key, last
    write wins); ``where`` may filter on camera, window and date."""
    require_store(spark, root)
    folders = (at or snapshot(spark, root)).of(query)
    return upsert(_rows(spark, root, folders, schemas.CAMERA_STATS, where), key=STATS_KEY, order=STATS_ORDER)


def compact_violations(violations: DataFrame, path: str) -> None:
    """Rewrite violations partitioned by (violation_date, violation_type),
    clustered by plate then newest first inside each file. The shuffle is a
    range partitioning on (date, type, plate, time): a busy day, type or even a
    single plate is cut into several tasks and files, each covering a contiguous
    plate range (tight row-group statistics for plate lookups)."""
    (violations.repartitionByRange("violation_date", "violation_type", "plate_number",
                                   "violation_time")
     .sortWithinPartitions("plate_number", F.col("violation_time").desc(), "violation_id")
     .write.mode("overwrite")
     .partitionBy("violation_date", "violation_type")
     .parquet(path))


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """A compacted table; filters on date and type prune partitions."""
    return spark.read.schema(schemas.VIOLATION).parquet(path).select(*schemas.VIOLATION.fieldNames())


def _layout_by_plate(violations: DataFrame, path: str, buckets: int) -> None:
    """The violations by a hash of their plate, sorted by plate, newest first, with a Bloom
    filter on the plate in each row group. Range partitioning cuts a busy plate into tasks."""
    bucketed = violations.withColumn("plate_bucket", plate_bucket(F.col("plate_number"), buckets))
    (bucketed.repartitionByRange("plate_bucket", "plate_number", "violation_time")
     .sortWithinPartitions("plate_bucket", "plate_number", F.col("violation_time").desc(), "violation_id")
     .write.option("parquet.bloom.filter.enabled#plate_number", "true")
     .partitionBy("plate_bucket").parquet(path))


def _merge(spark: SparkSession, root: str, data: str, folders: list[Folder], tier: int, generation: int,
           bucket_rows: int) -> Folder:
    """Merges folders into one of ``tier`` and commits that: one row per key, in each layout."""
    path = os.path.join("merged", data, uuid.uuid4().hex)
    by_day = os.path.join(root, path, "by_day")
    if data == VIOLATIONS:
        compact_violations(upsert(_rows(spark, root, folders, schemas.VIOLATION)), by_day)
        stored = read_compacted(spark, by_day)
    else:
        rows = upsert(_rows(spark, root, folders, schemas.CAMERA_STATS), key=STATS_KEY, order=STATS_ORDER)
        (rows.repartitionByRange("stat_date", "camera_id", "window_start")
         .sortWithinPartitions("camera_id", F.col("window_start").desc())
         .write.partitionBy("stat_date").parquet(by_day))
        stored = spark.read.schema(schemas.CAMERA_STATS).parquet(by_day)
    count, buckets = stored.count(), 0
    if data == VIOLATIONS:
        buckets = 1 << (max(1, -(-count // bucket_rows)) - 1).bit_length()
        _layout_by_plate(stored, os.path.join(root, path, "by_plate"), buckets)
    merged = Folder(path, data, tier, count, commitlog.size(spark, by_day), buckets, generation)
    commitlog.commit(spark, root, "merge", add=[merged], remove=[f.path for f in folders])
    return merged


def compact_store(spark: SparkSession, root: str, fanout: int = FANOUT, bucket_rows: int = BUCKET_ROWS,
                  grace_seconds: float = commitlog.GRACE_SECONDS) -> int:
    """One round of size-tiered compaction of both tables; returns the number of the newest
    merge. Batches that are committed meanwhile are left for the next round, an interrupted merge is
    not committed, and readers keep their snapshot for ``grace_seconds``."""
    require_store(spark, root)
    state = snapshot(spark, root)
    generation = state.generation
    for data in (VIOLATIONS, STATS):
        tiers: dict[int, list[Folder]] = {}
        for f in state.of(data):
            tiers.setdefault(f.tier, []).append(f)
        tier, least = 0, 1  # whatever is young; later tiers when they are full
        while len(tiers.get(tier, ())) >= least:
            merged = _merge(spark, root, data, tiers.pop(tier), tier + 1, generation + 1, bucket_rows)
            tier, least = tier + 1, fanout
            tiers.setdefault(tier, []).append(merged)
    commitlog.expire(spark, root, grace_seconds)
    return snapshot(spark, root).generation
