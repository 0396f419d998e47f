"""Adapter from the driver's parquet tables to telemetry and a camera registry.

``events`` becomes one reading per row, ``nation`` x ``region`` the registry of
25 cameras (FIXTURES.md section 1). The 30 days of ``events`` are compressed
360x into two hours so that the default windows and thresholds find violations.
Two of the 27 camera keys have no registry row, so enrichment drops them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from trafficwatch.functions.timeutil import ntz_micros

# Fixed parameters of the adapter.
CAMERA_KEYS = 27
BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 360


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _camera_id(key: Column) -> Column:
    return F.concat(F.lit("CAM-"), F.lpad(key.cast("string"), 2, "0"))


def _camera_type(key: Column) -> Column:
    k = F.pmod(key, F.lit(3))
    return (F.when(k == 0, F.lit("SPEED"))
            .when(k == 1, F.lit("INTERSECTION"))
            .otherwise(F.lit("NO_PARKING")))


def fixture_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full registry (8 columns) from nation x region."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    ctype = _camera_type(k)
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
        .select(
            _camera_id(k).alias("camera_id"),
            F.col("n_name").alias("location_name"),
            F.col("r_name").alias("road_name"),
            F.col("r_name").alias("city"),
            (F.lit(14.4) + k * F.lit(0.01)).alias("latitude"),
            (F.lit(121.0) + k * F.lit(0.005)).alias("longitude"),
            F.when(ctype == "NO_PARKING", F.lit(40)).otherwise(F.lit(60)).cast("int").alias("speed_limit_kph"),
            ctype.alias("camera_type"),
        )
    )


def _event_micros(events: DataFrame) -> Column:
    ts = F.col("ts")
    if isinstance(events.schema["ts"].dataType, TimestampNTZType):
        micros = ntz_micros(ts)
    else:
        micros = F.unix_micros(ts)
    # Integer division keeps the compressed times exact.
    return F.lit(BASE_MICROS) + _int_div(micros - F.lit(BASE_MICROS), TIME_COMPRESSION)


def _int_div(x: Column, d: int) -> Column:
    """Floor division of a long by a positive constant, exact in integers."""
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def fixture_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed telemetry (event_time as ``TIMESTAMP``) from ``events``."""
    events = read_table(spark, sf_dir, "events")
    c = F.pmod(F.col("user_id"), F.lit(CAMERA_KEYS))
    kind = F.pmod(c, F.lit(3))
    intersection = kind == 1
    light = (F.when(F.col("event_type") == "error", F.lit("RED"))
             .when(F.col("event_type") == "view", F.lit("YELLOW"))
             .otherwise(F.lit("GREEN")))
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        _camera_id(c).alias("camera_id"),
        F.concat(F.lit("P "), F.col("user_id").cast("string")).alias("plate_number"),
        F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None).cast("string"))
        .otherwise(F.upper("event_type")).alias("vehicle_type"),
        (F.lit(14.4) + c * F.lit(0.01)).alias("latitude"),
        (F.lit(121.0) + c * F.lit(0.005)).alias("longitude"),
        F.when(kind == 2, F.col("value") / F.lit(20)).otherwise(F.col("value")).alias("speed_kph"),
        F.when(intersection, light).alias("traffic_light_state"),
        F.when(intersection, F.pmod(k, F.lit(2)) == 0).alias("stop_line_crossed"),
        F.timestamp_micros(_event_micros(events)).alias("event_time"),
    )


def fixture_scenarios(enriched: DataFrame) -> DataFrame:
    """Enriched readings labelled with the scenario a generator would have
    planted, derived from the reading itself: above the limit at a SPEED camera
    is SPEEDING, RED with the line crossed is RED_LIGHT (whatever the speed), slow
    at a NO_PARKING camera is ILLEGAL_PARKING, anything else NORMAL."""
    t = F.col("camera_type")
    label = (
        F.when((t == "SPEED") & (F.col("speed_kph") > F.col("speed_limit_kph")), F.lit("SPEEDING"))
        .when((t == "INTERSECTION") & (F.col("traffic_light_state") == "RED")
              & F.coalesce(F.col("stop_line_crossed"), F.lit(False)), F.lit("RED_LIGHT"))
        .when((t == "NO_PARKING") & (F.col("speed_kph") <= F.lit(3.0)), F.lit("ILLEGAL_PARKING"))
        .otherwise(F.lit("NORMAL"))
    )
    return enriched.withColumn("simulated_scenario", label)
