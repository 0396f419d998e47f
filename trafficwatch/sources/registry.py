"""Camera registry: file source, the job's projection, the client listing."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch import schemas
from trafficwatch.config import CAMERA_FIELDS
from trafficwatch.functions.text import parse_number, strip
from trafficwatch.functions.timeutil import require_parsed
from trafficwatch.sources.telemetry import csv_text


def load_cameras(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Registry CSV with a header: text stripped, numbers typed, type upper-cased. A
    missing or unreadable number fails the read, whatever the session's ANSI setting."""
    raw = csv_text(spark, path, multi_line)
    missing = [c for c in CAMERA_FIELDS if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} is missing required columns: {', '.join(missing)}")
    return typed_cameras(raw)


def typed_cameras(raw: DataFrame) -> DataFrame:
    """Typed registry rows from all-text columns."""
    texts = raw.select(*[strip(c).alias(c) for c in CAMERA_FIELDS])

    def number(name: str) -> Column:
        return require_parsed(F.col(name), parse_number(name), name)

    limit = F.when(F.col("speed_limit_kph").rlike(r"^[+-]?\d+$"), F.col("speed_limit_kph").try_cast("int"))
    return texts.select(
        "camera_id", "location_name", "road_name", "city",
        number("latitude").alias("latitude"), number("longitude").alias("longitude"),
        require_parsed(F.col("speed_limit_kph"), limit, "speed_limit_kph").alias("speed_limit_kph"),
        F.upper("camera_type").alias("camera_type"),
    )


def registry_projection(cameras: DataFrame) -> DataFrame:
    """The five registry columns the detection job joins on and carries."""
    return cameras.select(*schemas.REGISTRY_COLUMNS).filter(F.col("camera_id").isNotNull())


def camera_listing(cameras: DataFrame) -> DataFrame:
    """Registry as the clients see it: seven renamed fields."""
    return cameras.select(
        F.col("camera_id").alias("id"),
        F.col("location_name").alias("location"),
        F.col("road_name").alias("road"),
        F.col("camera_type").alias("type"),
        F.col("speed_limit_kph").alias("limit"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )
