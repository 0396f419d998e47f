"""Structured Streaming job: messages -> readings -> four append-mode queries.

    source (Kafka topic or JSON-lines files)
      -> decode + validate -> watermark on event_time
      -> join with the registry
      -> speeding / red light / illegal parking / camera stats
      -> foreachBatch: one idempotent Parquet directory per micro-batch

By default staged (``start_ingest`` + ``staged_stream``): one query decodes and
validates into a date-partitioned Parquet readings table, and the four detection
queries stream from that table, so each message is parsed once, not four times.
``enriched_stream`` is the direct form, in which each query parses the source.

Each query has its own checkpoint under ``spark.checkpoint.dir`` and restarts
from it; a micro-batch has its own ``batch_id`` directory in the checkpoint's run folder and
counts once it is in the store's commit log, so delivery is at-least-once and the stored effect
exactly-once, and another job or a fresh checkpoint never overwrites stored rows. Windows are
emitted in append mode only once the watermark has passed them, so every
written row is final. For many live plates use the RocksDB state store
(:data:`STREAMING_CONF`) and size ``spark.sql.shuffle.partitions`` before the
first start: a stateful query keeps that width for the life of its checkpoint.
"""
from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trafficwatch.config import DEFAULT, Settings
from trafficwatch.operators import detect
from trafficwatch.operators.enrich import enrich
from trafficwatch.session import checkpoint_root
from trafficwatch.sources.commitlog import Snapshot, snapshot
from trafficwatch.sources.sinks import VIOLATION_QUERIES, write_batch
from trafficwatch.sources.telemetry import read_message_stream, telemetry

# Session settings for long-running detection: state in RocksDB (spills to
# local disk, checkpointed to the shared folder) instead of the JVM heap, and
# session windows pre-merged inside each input partition before the shuffle, so
# a busy vehicle/camera sends merged sessions rather than every reading.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure_streaming(spark: SparkSession) -> None:
    """Apply :data:`STREAMING_CONF` where the session has no value of its own.
    The state store provider must stay the same for the life of a checkpoint, so
    a value set by the cluster always wins."""
    for key, value in STREAMING_CONF.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)

STATS_QUERY = "camera_speed_stats"
QUERIES = (*VIOLATION_QUERIES, STATS_QUERY)


def enriched_stream(spark: SparkSession, cameras: DataFrame, settings: Settings = DEFAULT,
                    source: str = "files", normalize_plates: bool = False,
                    dedupe: bool = False, **source_options) -> DataFrame:
    """Decoded, valid, watermarked readings joined with the registry; optionally
    with plates normalised and repeated event ids dropped within the watermark."""
    raw = read_message_stream(spark, source, **source_options)
    readings = telemetry(raw, settings, normalize_plates=normalize_plates, dedupe=dedupe)
    return enrich(readings, cameras)


def detections(enriched: DataFrame, settings: Settings = DEFAULT,
               detected_at: str = "clock") -> dict[str, DataFrame]:
    """The four queries of the job, by name."""
    return {
        "speeding_violations": detect.detect_speeding(enriched, settings, detected_at),
        "red_light_violations": detect.detect_red_light(enriched, settings, detected_at),
        "illegal_parking_violations": detect.detect_illegal_parking(enriched, settings, detected_at),
        STATS_QUERY: detect.camera_speed_stats(enriched, settings, distinct="approx"),
    }


def run_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint: the same after every restart,
    another one for a fresh checkpoint."""
    return json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()[0])["id"]


def batch_writer(root: str, name: str, checkpoint: str, debug: bool = False,
                 log: Callable[[str], None] | None = print) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: skip an empty batch, else write it to its own folder
    of this checkpoint's run and commit it. The first batch after a start may be a replay: if
    the log has it, its rows are stored already. The batch is persisted before the emptiness check so
    it is computed once."""
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            state = Snapshot()
            if not known:
                known.append(run_identity(batch.sparkSession, checkpoint))
                state = snapshot(batch.sparkSession, root)
            written = write_batch(batch, root, name, known[0], batch_id, state)
            if log:
                log(f"[{name}] batch {batch_id}: {f'wrote {batch.count()} rows' if written else 'was stored before'}")
            if debug:
                batch.show(10, truncate=False)
        finally:
            batch.unpersist()

    return write


def start_query(df: DataFrame, name: str, store_root: str, checkpoints: str,
                settings: Settings = DEFAULT, available_now: bool = False,
                debug: bool = False, log: Callable[[str], None] | None = print) -> StreamingQuery:
    """Start one append-mode query with its own checkpoint. ``available_now``
    processes what is there and stops (bounded runs, tests, backfills);
    otherwise a processing-time trigger of ``settings.trigger_interval``."""
    checkpoint = os.path.join(checkpoints, name)
    writer = (df.writeStream.queryName(name)
              .outputMode("append")
              .foreachBatch(batch_writer(store_root, name, checkpoint, debug, log))
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=settings.trigger_interval))
    return writer.start()


def start_detection(spark: SparkSession, enriched: DataFrame, store_root: str,
                    settings: Settings = DEFAULT, available_now: bool = False,
                    detected_at: str = "clock", debug: bool = False,
                    log: Callable[[str], None] | None = print,
                    job: str = "detector") -> list[StreamingQuery]:
    """Start the four independent queries on one enriched stream. Checkpoints
    go to ``<spark.checkpoint.dir>/trafficwatch/<job>/<query>``; restarting with
    the same ``job`` resumes from them."""
    configure_streaming(spark)
    checkpoints = os.path.join(checkpoint_root(spark), "trafficwatch", job)
    return [start_query(df, name, store_root, checkpoints, settings, available_now, debug, log)
            for name, df in detections(enriched, settings, detected_at).items()]


def start_ingest(spark: SparkSession, raw: DataFrame, readings_path: str,
                 settings: Settings = DEFAULT, available_now: bool = False,
                 job: str = "detector", normalize_plates: bool = False,
                 dedupe: bool = False) -> StreamingQuery:
    """Decode and validate messages once into a Parquet readings table
    partitioned by local date (the file sink is exactly-once through its own
    log). Detection queries then stream from the table
    (:func:`staged_stream`) instead of each parsing the source again."""
    from trafficwatch.functions.timeutil import local_date

    configure_streaming(spark)
    readings = telemetry(raw, settings, watermark=False, normalize_plates=normalize_plates,
                         dedupe=False)
    if dedupe:
        readings = readings.withWatermark("event_time", settings.watermark_delay) \
            .dropDuplicatesWithinWatermark(["event_id"])
    out = readings.withColumn("event_date", local_date("event_time", settings.timezone))
    checkpoints = os.path.join(checkpoint_root(spark), "trafficwatch", job, "ingest")
    writer = (out.writeStream.queryName("ingest_readings").outputMode("append")
              .format("parquet").option("path", readings_path)
              .option("checkpointLocation", checkpoints).partitionBy("event_date"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=settings.trigger_interval))
    return writer.start()


def staged_stream(spark: SparkSession, readings_path: str, cameras: DataFrame,
                  settings: Settings = DEFAULT, max_files_per_trigger: int | None = None) -> DataFrame:
    """Readings streamed from the table :func:`start_ingest` writes, watermarked
    and joined with the registry."""
    from trafficwatch import schemas
    from pyspark.sql.types import DateType, StructField, StructType

    schema = StructType([*schemas.TELEMETRY.fields, StructField("event_date", DateType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    readings = (reader.parquet(readings_path).drop("event_date")
                .withWatermark("event_time", settings.watermark_delay))
    return enrich(readings, cameras)


def run_to_the_end(spark: SparkSession, cameras: DataFrame, store_root: str, readings_path: str,
                   settings: Settings = DEFAULT, detected_at: str = "watermark", job: str = "detector",
                   source: str = "files", **source_options) -> None:
    """The staged job over what the source holds now: ingest, then the four queries."""
    ingest = start_ingest(spark, read_message_stream(spark, source, **source_options), readings_path, settings,
                          available_now=True, job=job)
    ingest.awaitTermination()
    staged = staged_stream(spark, readings_path, cameras, settings)
    for query in start_detection(spark, staged, store_root, settings, available_now=True,
                                 detected_at=detected_at, log=None, job=job):
        query.awaitTermination()


def run_until_any_ends(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until one query stops (with its error, if any). Queries that ended
    before are counted until ``spark.streams.resetTerminated()``."""
    return spark.streams.awaitAnyTermination(timeout)


def end_of_stream_message(at: dt.datetime, settings: Settings = DEFAULT) -> str:
    """A message that closes every open window of a bounded replay.

    Append mode writes a window only after the watermark passes it, so the last
    windows of a finite input stay open. This reading lies far in the future
    (advancing every query's watermark), is stationary (so it also passes the
    filters Catalyst pushes below the watermark of the parking query) and names
    no registered camera (so the registry join drops it)."""
    return json.dumps({
        "event_id": "end-of-stream", "camera_id": "__END__", "plate_number": "__END__",
        "vehicle_type": None, "latitude": None, "longitude": None, "speed_kph": 0.0,
        "traffic_light_state": None, "stop_line_crossed": None,
        "event_time": at.isoformat(timespec="milliseconds"),
    })
