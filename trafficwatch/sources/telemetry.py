"""Telemetry sources: JSON message decoding, CSV normalisation, streams."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch import schemas
from trafficwatch.sources import csvlines
from trafficwatch.config import DEFAULT, REQUIRED_FIELDS, TELEMETRY_FIELDS, Settings
from trafficwatch.functions.text import parse_bool, parse_number, strip
from trafficwatch.functions.timeutil import parse_iso_time, parse_time, require_parsed

# telemetry field -> source column; edit a copy to read a file with other names.
COLUMN_MAPPING: dict[str, str] = {field: field for field in TELEMETRY_FIELDS}


# --- JSON messages (stream or batch) -------------------------------------------------

def decode_messages(raw: DataFrame, settings: Settings = DEFAULT, value_col: str = "value") -> DataFrame:
    """Parse the JSON ``value`` of each message into typed telemetry.

    Malformed JSON, arrays and null values give all-null rows, and a field of
    the wrong type is null; such rows are removed by :func:`valid_readings`.
    ``event_time`` text is parsed with the declared zone for naive values;
    unparseable text becomes null instead of failing the stream.

    The parsed struct is unpacked by a generator (``inline``) rather than a
    projection: Catalyst then cannot push the validity filter below the parse
    and substitute ``from_json`` into every field it tests, so each message is
    parsed exactly once (measured 2x faster on materialised messages)."""
    parsed = F.from_json(F.col(value_col).cast("string"), schemas.TELEMETRY_WIRE)
    return raw.select(F.inline(F.array(parsed))).withColumn(
        "event_time", parse_time(F.col("event_time"), settings.timezone, strict=False)
    )


def validity() -> Column:
    """Camera, plate and time present and a real non-negative speed."""
    speed = F.col("speed_kph")
    return (
        F.col("camera_id").isNotNull()
        & F.col("plate_number").isNotNull()
        & F.col("event_time").isNotNull()
        & (speed >= 0)
        & ~F.isnan(speed)
    )


def valid_readings(df: DataFrame) -> DataFrame:
    """Keep valid readings; drop the others silently."""
    return df.filter(validity())


def telemetry(raw: DataFrame, settings: Settings = DEFAULT, value_col: str = "value",
              watermark: bool = True, normalize_plates: bool = False,
              dedupe: bool = False) -> DataFrame:
    """Messages -> decoded, valid readings, with the event-time watermark set.
    The watermark is a no-op on batch input.

    ``normalize_plates`` applies the lookup normalisation (case, whitespace) to
    plates on the way in; ``dedupe`` drops a repeated event id that arrives within
    the watermark delay of its first copy (state kept only that long). Both are
    off by default, like the reference stream."""
    readings = valid_readings(decode_messages(raw, settings, value_col))
    if normalize_plates:
        from trafficwatch.functions.text import normalize_plate

        readings = readings.withColumn("plate_number", normalize_plate("plate_number"))
    if watermark:
        readings = readings.withWatermark("event_time", settings.watermark_delay)
    if dedupe:
        readings = (readings.dropDuplicatesWithinWatermark(["event_id"])
                    if readings.isStreaming and watermark
                    else readings.dropDuplicates(["event_id"]))
    return readings


def read_message_stream(spark: SparkSession, source: str = "files", *, path: str | None = None,
                        options: Mapping[str, str] | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame with a ``value`` column of JSON messages.

    ``files``: a directory of JSON-lines files (one message per line).
    ``kafka``: the production source; pass ``kafka.bootstrap.servers`` and
    ``subscribe`` in ``options`` (needs the Kafka connector on the classpath).
    Offsets start at ``earliest`` and lost offsets are tolerated."""
    opts = dict(options or {})
    if source == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("startingOffsets", "earliest")
                  .option("failOnDataLoss", "false"))
        for key, value in opts.items():
            reader = reader.option(key, value)
        return reader.load().select(F.col("key").cast("string").alias("key"),
                                    F.col("value").cast("string").alias("value"))
    if source == "files":
        if path is None:
            raise ValueError("a file stream needs a path")
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        for key, value in opts.items():
            reader = reader.option(key, value)
        return reader.load(path)
    raise ValueError(f"unknown source {source!r}")


# --- CSV files (batch) -----------------------------------------------------------

def check_columns(columns: list[str], mapping: Mapping[str, str] = COLUMN_MAPPING,
                  where: str = "input") -> None:
    """Raise ``ValueError`` naming the required source columns that are missing."""
    missing = [mapping.get(f) or f for f in REQUIRED_FIELDS if mapping.get(f) not in columns]
    if missing:
        raise ValueError(f"{where} is missing required columns: {', '.join(missing)}")


def _source(raw: DataFrame, mapping: Mapping[str, str], field: str) -> Column:
    name = mapping.get(field)
    if name and name in raw.columns:
        return F.col(f"`{name}`").cast("string")
    return F.lit(None).cast("string")


def normalize_rows(raw: DataFrame, mapping: Mapping[str, str] = COLUMN_MAPPING,
                   settings: Settings = DEFAULT, mode: str = "fail",
                   event_id_default: str = "hash", keep: tuple[str, ...] = ()) -> DataFrame:
    """All-text rows (mapped column names) -> typed telemetry.

    Camera stripped; plate stripped and upper-cased; optional text blank -> null;
    numbers parsed; light upper-cased; loose booleans; ISO time in any form with ``Z``, offsets,
    or naive = declared zone. Coordinates, speed and time are required:
    ``mode="fail"`` raises on one that is missing, blank or unreadable (whatever the
    session's ANSI setting), ``"drop"`` drops such rows. A missing event id defaults to
    a SHA-256 of the row (``event_id_default="hash"``, reproducible) or a random UUID.
    Columns named in ``keep`` are passed through unchanged."""
    if mode not in ("fail", "drop"):
        raise ValueError("mode must be 'fail' or 'drop'")
    check_columns(raw.columns, mapping)
    strict = mode == "fail"
    sources = {f: _source(raw, mapping, f) for f in TELEMETRY_FIELDS}
    row_hash = F.sha2(F.concat_ws("\u0001", *[F.coalesce(c, F.lit("")) for c in sources.values()]), 256)
    # Each field is stripped once, in a projection of its own.
    texts = raw.select(*[strip(c).alias(f) for f, c in sources.items()], row_hash.alias("_row_hash"), *keep)

    def number(field: str) -> Column:
        parsed = parse_number(field)
        return require_parsed(F.col(field), parsed, field) if strict else parsed

    def optional(field: str) -> Column:
        return F.nullif(F.col(field), F.lit(""))

    default_id = F.col("_row_hash") if event_id_default == "hash" else F.expr("uuid()")
    typed = texts.select(
        F.coalesce(optional("event_id"), default_id).alias("event_id"),
        F.col("camera_id"),
        F.upper("plate_number").alias("plate_number"),
        optional("vehicle_type").alias("vehicle_type"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        number("speed_kph").alias("speed_kph"),
        F.upper(optional("traffic_light_state")).alias("traffic_light_state"),
        parse_bool("stop_line_crossed").alias("stop_line_crossed"),
        parse_iso_time("event_time", settings.timezone, strict=strict).alias("event_time"),
        *keep,
    )
    return typed if strict else typed.dropna(subset=["latitude", "longitude", "speed_kph", "event_time"])


def csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file with a header in the RFC 4180 dialect (a quote in a quoted field is
    doubled), every column as text, by Spark's own reader. With ``multi_line`` it takes line
    breaks inside quotes, but each file is read by one task."""
    return (spark.read.option("header", True).option("inferSchema", False).option("quote", '"')
            .option("escape", '"').option("multiLine", multi_line).csv(path))


def read_csv_text(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """CSV rows as text with the file position of each row in ``_file``, ``_block`` and
    ``_pos``, so "first in the file" stays defined. By default line breaks inside quotes are
    looked for, and a file that has some is read in parallel all the same
    (:mod:`trafficwatch.sources.csvlines`); True or False say at once that :func:`csv_text` is to read
    it with or without them."""
    if multi_line is None:
        multi_line = False
        if csvlines.quoted_breaks(spark, path):
            columns = csv_text(spark, path, multi_line=True).columns
            return csvlines.parsed(csvlines.csv_records(spark, path), columns)
    return csv_text(spark, path, multi_line).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def load_events(spark: SparkSession, path: str, mapping: Mapping[str, str] = COLUMN_MAPPING,
                settings: Settings = DEFAULT, mode: str = "fail", sort: bool = True,
                multi_line: bool | None = None) -> DataFrame:
    """Telemetry CSV -> typed readings, first row of each event id, time order."""
    from trafficwatch.operators.dedupe import first_per_key

    raw = read_csv_text(spark, path, multi_line)
    check_columns([c for c in raw.columns if c not in _POSITION], mapping, where=path)
    typed = normalize_rows(raw, mapping, settings, mode, keep=_POSITION)
    events = first_per_key(typed, "event_id", order=list(_POSITION)).drop(*_POSITION)
    return events.orderBy("event_time", "event_id") if sort else events


_POSITION = csvlines.POSITION


def telemetry_messages(readings: DataFrame, settings: Settings = DEFAULT,
                       offset_seconds: Column | int = 0) -> DataFrame:
    """Encode readings as messages: key = plate, value = JSON of exactly the ten
    telemetry fields in order, nulls written as ``null``, event time shifted by
    ``offset_seconds`` and printed as ISO-8601 with milliseconds and offset."""
    from trafficwatch.functions.timeutil import iso_text

    shift = offset_seconds if isinstance(offset_seconds, Column) else F.lit(offset_seconds)
    shifted = F.timestamp_micros(F.unix_micros("event_time") + shift.cast("long") * F.lit(1_000_000))
    fields = [F.col(f) for f in TELEMETRY_FIELDS[:-1]] + [iso_text(shifted, settings.timezone).alias("event_time")]
    return readings.select(
        F.col("plate_number").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )
