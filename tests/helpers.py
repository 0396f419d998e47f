"""Hand-made readings and registry rows for unit tests."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch import schemas

MANILA = dt.timezone(dt.timedelta(hours=8))
T0 = dt.datetime(2026, 9, 1, 7, 0, 0, tzinfo=MANILA)  # epoch-aligned to 20 s and 30 s

CAMERAS = [
    ("CAM-SPD", "Speed Road - North", "Speed Road", "City", 14.56, 121.04, 60, "SPEED"),
    ("CAM-INT", "Cross Road - East", "Cross Road", "City", 14.58, 121.05, 60, "INTERSECTION"),
    ("CAM-NOP", "Quiet Street - West", "Quiet Street", "City", 14.61, 120.99, 40, "NO_PARKING"),
]


def cameras(spark: SparkSession, rows=CAMERAS) -> DataFrame:
    return spark.createDataFrame(rows, schemas.CAMERA)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def readings(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Typed readings; ``t`` is seconds after T0 (or an aware datetime)."""
    data = []
    for i, r in enumerate(rows):
        t = r.get("t", 0)
        when = t if isinstance(t, dt.datetime) else at(t)
        data.append((
            r.get("event_id", f"e{i}"), r.get("camera_id", "CAM-SPD"), r.get("plate", "ABC 1234"),
            r.get("vehicle_type", "CAR"), r.get("lat", 14.5), r.get("lon", 121.0),
            float(r["speed"]) if r.get("speed") is not None else None,
            r.get("light"), r.get("crossed"), round(when.timestamp() * 1_000_000),
        ))
    ddl = ("event_id string, camera_id string, plate_number string, vehicle_type string, "
           "latitude double, longitude double, speed_kph double, traffic_light_state string, "
           "stop_line_crossed boolean, us long")
    df = spark.createDataFrame(data, ddl)
    return df.withColumn("event_time", F.timestamp_micros("us")).drop("us")


def enriched(spark: SparkSession, rows: list[dict]) -> DataFrame:
    from trafficwatch.operators.enrich import enrich

    return enrich(readings(spark, rows), cameras(spark))
