"""Command line: the streaming detector, the store lookups, ingestion and compaction.

    python -m trafficwatch detect  --registry cameras.csv --input DIR --store DIR [--stage DIR | --direct] [--available-now]
    python -m trafficwatch publish --csv telemetry.csv --out DIR [--start ISO] [--passes N] [--limit N]
    python -m trafficwatch lookup --store DIR (--plate P | --camera C [--stats] | --type T) [--day D] [--limit N]
    python -m trafficwatch compact --store DIR

The session comes from ``spark-submit`` (master, ``spark.checkpoint.dir``); run
locally it defaults to ``local[*]``.
"""
from __future__ import annotations

import argparse
import datetime as dt

from trafficwatch.config import DEFAULT, TIMEZONE, VIOLATION_TYPES


def _today() -> dt.date:
    from zoneinfo import ZoneInfo

    return dt.datetime.now(ZoneInfo(TIMEZONE)).date()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trafficwatch")
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("detect", help="run the four streaming queries")
    p.add_argument("--registry", required=True, help="camera registry CSV")
    p.add_argument("--input", help="directory of JSON-lines messages (file source)")
    p.add_argument("--kafka-servers", help="bootstrap servers (Kafka source instead of files)")
    p.add_argument("--topic", default="traffic-telemetry")
    p.add_argument("--store", required=True, help="root folder of the violation store")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--debug", action="store_true", help="show every written micro-batch")
    p.add_argument("--stage", help="Parquet readings table that messages are decoded into once "
                   "(default: STORE/readings)")
    p.add_argument("--direct", action="store_true", help="no readings table: each query parses the source")
    p.add_argument("--normalize-plates", action="store_true", help="upper-case and collapse plate whitespace")
    p.add_argument("--dedupe", action="store_true", help="drop repeated event ids within the watermark")
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE",
                   help="override a setting (after environment variables), e.g. speed_tolerance_kph=5")
    p.add_argument("--job", default="detector",
                   help="checkpoint name under spark.checkpoint.dir; a restart with the same name resumes")

    p = sub.add_parser("publish", help="telemetry CSV -> JSON-lines messages")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--start", help="rebase event times to start here (ISO with offset)")
    p.add_argument("--passes", type=int, default=1, help="replay the data this many times")
    p.add_argument("--limit", type=int, help="stop after this many events (time order)")

    p = sub.add_parser("lookup", help="newest rows of the store for one key")
    p.add_argument("--store", required=True)
    key = p.add_mutually_exclusive_group(required=True)
    key.add_argument("--plate", help="a vehicle, over all days")
    key.add_argument("--camera", help="a camera, on --day")
    key.add_argument("--type", help=f"one of {', '.join(VIOLATION_TYPES)}, on --day")
    p.add_argument("--stats", action="store_true", help="with --camera: its window statistics instead")
    p.add_argument("--day", type=dt.date.fromisoformat, help="local date as YYYY-MM-DD; today if left out")
    p.add_argument("--limit", type=int, default=DEFAULT.cli_limit)

    p = sub.add_parser("compact", help="write the store's next compacted version")
    p.add_argument("--store", required=True)

    args = parser.parse_args(argv)

    from trafficwatch.session import get_session

    spark = get_session(conf={"spark.sql.session.timeZone": TIMEZONE})
    if args.command == "detect":
        from trafficwatch.config import Settings
        from trafficwatch.sources.registry import load_cameras
        from trafficwatch.streaming import detector

        settings = Settings.from_env().with_values(dict(kv.split("=", 1) for kv in args.set))

        cameras = load_cameras(spark, args.registry)
        if args.kafka_servers:
            source = dict(source="kafka", options={"kafka.bootstrap.servers": args.kafka_servers,
                                                   "subscribe": args.topic})
        else:
            source = dict(source="files", path=args.input)
        if not args.direct:
            stage = args.stage or f"{args.store.rstrip('/')}/readings"
            raw = detector.read_message_stream(spark, **source)
            ingest = detector.start_ingest(spark, raw, stage, settings,
                                           available_now=args.available_now, job=args.job,
                                           normalize_plates=args.normalize_plates,
                                           dedupe=args.dedupe)
            if args.available_now:
                ingest.awaitTermination()
            enriched = detector.staged_stream(spark, stage, cameras, settings)
        else:
            enriched = detector.enriched_stream(spark, cameras, settings,
                                                normalize_plates=args.normalize_plates,
                                                dedupe=args.dedupe, **source)
        detector.start_detection(spark, enriched, args.store, settings,
                                 available_now=args.available_now, debug=args.debug, job=args.job)
        if args.available_now:
            for q in spark.streams.active:
                q.awaitTermination()
        else:
            detector.run_until_any_ends(spark)
        return

    if args.command == "publish":
        from trafficwatch.operators import replay
        from trafficwatch.sources.telemetry import load_events, telemetry_messages

        events = replay.require_rows(load_events(spark, args.csv, sort=False), args.csv)
        if args.start:
            events = replay.rebase_time(events, dt.datetime.fromisoformat(args.start))
        if args.passes > 1:
            events = replay.replay_passes(events, args.passes)
        if args.limit is not None:
            events = replay.first_events(events, args.limit)
        messages = telemetry_messages(replay.by_vehicle(events))
        messages.select("value").write.mode("overwrite").text(args.out)
        return

    from trafficwatch.plans import lookup
    from trafficwatch.sources import sinks

    if args.command == "compact":
        print(f"version {sinks.compact_store(spark, args.store)}")
        return
    if args.stats and not args.camera:
        parser.error("--stats needs --camera")
    _lookup(spark, lookup, sinks, args).show(args.limit, truncate=False)


def _lookup(spark, lookup, sinks, args):
    """The rows of one key; the key's filter goes to the reader, below the upsert."""
    day = args.day or _today()
    if args.plate:
        key = lookup.plate_key(args.plate, strict_key=True)
        return lookup.violations_by_plate(sinks.read_violations(spark, args.store, plate=key), args.plate,
                                          args.limit, strict_key=True)
    if args.type:
        key = lookup.type_day_is(args.type, day)
        return lookup.violations_by_type(sinks.read_violations(spark, args.store, where=key), args.type, day, args.limit)
    if args.stats:
        key = lookup.camera_day_is(args.camera, day, "stat_date")
        return lookup.stats_by_camera(sinks.read_stats(spark, args.store, where=key), args.camera, day, args.limit)
    key = lookup.camera_day_is(args.camera, day)
    return lookup.violations_by_camera(sinks.read_violations(spark, args.store, where=key), args.camera, day, args.limit)


if __name__ == "__main__":
    main()
