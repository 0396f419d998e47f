"""Fixed schemas of the telemetry, the registry and the two fact tables."""
from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Wire format of one reading (JSON message or CSV row); event_time is text.
TELEMETRY_WIRE = StructType([
    StructField("event_id", StringType()),
    StructField("camera_id", StringType()),
    StructField("plate_number", StringType()),
    StructField("vehicle_type", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("speed_kph", DoubleType()),
    StructField("traffic_light_state", StringType()),
    StructField("stop_line_crossed", BooleanType()),
    StructField("event_time", StringType()),
])

# Typed reading after decoding.
TELEMETRY = StructType([
    *TELEMETRY_WIRE.fields[:-1],
    StructField("event_time", TimestampType()),
])

# Full registry as kept in a file.
CAMERA = StructType([
    StructField("camera_id", StringType(), False),
    StructField("location_name", StringType()),
    StructField("road_name", StringType()),
    StructField("city", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("speed_limit_kph", IntegerType()),
    StructField("camera_type", StringType()),
])

# Columns of the registry the detection job joins (telemetry keeps its own coordinates).
REGISTRY_COLUMNS = ("camera_id", "location_name", "road_name", "camera_type", "speed_limit_kph")

VIOLATION = StructType([
    StructField("violation_id", StringType()),
    StructField("violation_type", StringType()),
    StructField("plate_number", StringType()),
    StructField("vehicle_type", StringType()),
    StructField("camera_id", StringType()),
    StructField("location_name", StringType()),
    StructField("road_name", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("violation_time", TimestampType()),
    StructField("violation_date", DateType()),
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("recorded_speed_kph", DoubleType()),
    StructField("speed_limit_kph", IntegerType()),
    StructField("reading_count", IntegerType()),
    StructField("evidence", StringType()),
    StructField("ticket_status", StringType()),
    StructField("detected_at", TimestampType()),
])
VIOLATION_COLUMNS = tuple(f.name for f in VIOLATION.fields)

CAMERA_STATS = StructType([
    StructField("camera_id", StringType()),
    StructField("stat_date", DateType()),
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("avg_speed_kph", DoubleType()),
    StructField("max_speed_kph", DoubleType()),
    StructField("reading_count", IntegerType()),
    StructField("vehicle_count", IntegerType()),
    StructField("pct_over_limit", DoubleType()),
    StructField("speed_limit_kph", IntegerType()),
])
