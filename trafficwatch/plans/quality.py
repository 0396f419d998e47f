"""Data-quality checks and detection quality against planted scenario labels."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.config import (
    BEATING_RED_LIGHT,
    CAMERA_TYPES,
    DEFAULT,
    ILLEGAL_PARKING,
    LAT_BOUNDS,
    LON_BOUNDS,
    SPEEDING,
    Settings,
)

# Planted scenario -> the violation type that should detect it.
SCENARIO_TYPE = {"SPEEDING": SPEEDING, "RED_LIGHT": BEATING_RED_LIGHT, "ILLEGAL_PARKING": ILLEGAL_PARKING}


def registry_checks(cameras: DataFrame) -> DataFrame:
    """One row per registry rule with the number of offending rows (ids for
    uniqueness, types for coverage) and whether the rule passes."""
    lat, lon = F.col("latitude"), F.col("longitude")
    outside = lambda c, lo, hi: F.count_if(c.isNull() | (c <= lo) | (c >= hi))
    per_id = cameras.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(F.col("camera_type").isin(*CAMERA_TYPES), F.lit(False))).alias("bad_type"),
        outside(lat, *LAT_BOUNDS).alias("bad_lat"),
        outside(lon, *LON_BOUNDS).alias("bad_lon"),
        *[F.max(F.col("camera_type") == t).alias(f"has_{t}") for t in CAMERA_TYPES],
    )
    present = sum(F.coalesce(F.max(f"has_{t}").cast("int"), F.lit(0)) for t in CAMERA_TYPES)
    totals = per_id.agg(
        F.count_if(F.col("n") > 1).alias("unique_camera_id"),
        F.coalesce(F.sum("bad_type"), F.lit(0)).alias("known_camera_type"),
        (F.lit(len(CAMERA_TYPES)) - present).alias("all_camera_types_present"),
        F.coalesce(F.sum("bad_lat"), F.lit(0)).alias("latitude_in_bounds"),
        F.coalesce(F.sum("bad_lon"), F.lit(0)).alias("longitude_in_bounds"),
    )
    rules = ["unique_camera_id", "known_camera_type", "all_camera_types_present",
             "latitude_in_bounds", "longitude_in_bounds"]
    long_form = totals.select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot(
        [], rules, "rule", "failed")
    return long_form.withColumn("passed", F.col("failed") == 0)


def planted_rule_checks(labelled: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Planted readings that break the rule their label promises: a RED_LIGHT
    reading must be RED, cross the line and go at least the minimum speed; an
    ILLEGAL_PARKING reading must be at a NO_PARKING camera and at most the
    stationary speed. Empty result = every planted reading is detectable."""
    scenario = F.col("simulated_scenario")
    red_ok = ((F.col("traffic_light_state") == "RED")
              & F.coalesce(F.col("stop_line_crossed"), F.lit(False))
              & (F.col("speed_kph") >= settings.red_light_min_speed_kph))
    park_ok = ((F.col("camera_type") == "NO_PARKING")
               & (F.col("speed_kph") <= settings.parking_max_speed_kph))
    broken = (((scenario == "RED_LIGHT") & ~F.coalesce(red_ok, F.lit(False)))
              | ((scenario == "ILLEGAL_PARKING") & ~F.coalesce(park_ok, F.lit(False))))
    return labelled.filter(broken).select(
        "event_id", "plate_number", "camera_id", "simulated_scenario", "speed_kph",
        "traffic_light_state", "stop_line_crossed",
    )


def scenario_counts(labelled: DataFrame) -> DataFrame:
    """Per scenario: distinct (plate, camera) pairs and readings."""
    return labelled.groupBy("simulated_scenario").agg(
        F.count_distinct("plate_number", "camera_id").alias("vehicles"),
        F.count(F.lit(1)).alias("events"),
    )


def detection_quality(violations: DataFrame, labelled: DataFrame) -> DataFrame:
    """Detections against planted labels, per violation type, keyed by (plate,
    camera, type): true/false positives, misses, precision and recall (null
    when undefined). Both sides are reduced to distinct keys before the full
    outer join, so its size is bounded by vehicles, not readings."""
    mapping = F.create_map(*[x for kv in SCENARIO_TYPE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    planted = (labelled.select("plate_number", "camera_id",
                               mapping[F.col("simulated_scenario")].alias("violation_type"))
               .filter(F.col("violation_type").isNotNull()).distinct()
               .withColumn("_planted", F.lit(True)))
    found = (violations.select("plate_number", "camera_id", "violation_type").distinct()
             .withColumn("_found", F.lit(True)))
    both = planted.join(found, ["plate_number", "camera_id", "violation_type"], "full_outer")
    p, d = F.coalesce(F.col("_planted"), F.lit(False)), F.coalesce(F.col("_found"), F.lit(False))
    counts = both.groupBy("violation_type").agg(
        F.count_if(p & d).alias("tp"), F.count_if(~p & d).alias("fp"), F.count_if(p & ~d).alias("fn"))
    ratio = lambda a, b: F.when(b > 0, F.col(a) / b)
    return counts.select(
        "violation_type", "tp", "fp", "fn",
        ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ratio("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )
