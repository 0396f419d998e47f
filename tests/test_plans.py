"""Plan guards for every registered query: the shapes that break at scale."""
import pytest

from conftest import SF_SMALL
from trafficwatch.catalog import QUERIES


# One-row final merges of partial aggregates may use a single partition; the running
# totals of the event rate order one row per day there.
SINGLE_PARTITION_OK = {"day_stats", "day_summary", "latest_detection_age", "registry_checks",
                       "offset_rate", "health_counters"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_bounded_single_partition(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in SINGLE_PARTITION_OK:
        assert "SinglePartition" not in plan, plan


@pytest.mark.parametrize("name", ["detect_speeding", "detect_red_light", "detect_illegal_parking",
                                  "camera_speed_stats", "enriched_telemetry"])
def test_registry_join_is_broadcast(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["detect_speeding", "detect_illegal_parking", "camera_speed_stats",
                                  "violations_upserted", "day_stats"])
def test_aggregations_are_partial_before_the_shuffle(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "partial_" in plan or "merge_" in plan


def test_speeding_scan_prunes_unused_columns(spark):
    plan = physical(QUERIES["detect_speeding"](spark, SF_SMALL))
    events_scan = [line for line in plan.splitlines() if "events.parquet" in line]
    assert events_scan and all("props" not in line for line in events_scan)


def test_enrich_falls_back_to_shuffled_join_above_the_bound(spark):
    from dataclasses import replace

    from trafficwatch.operators.enrich import enrich
    from trafficwatch.sources.fixtures import fixture_cameras, fixture_readings

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = enrich(fixture_readings(spark, SF_SMALL), fixture_cameras(spark, SF_SMALL))
        plan = physical(df)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert df.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_telemetry_is_pruned_by_camera_type(spark, tmp_path):
    """Telemetry at rest partitioned by camera: each detection's camera-type filter
    on the broadcast registry prunes the other cameras' files (dynamic partition
    pruning), so the three detections together read the data about once."""
    from trafficwatch.operators import detect
    from trafficwatch.operators.enrich import enrich
    from trafficwatch.sources.fixtures import fixture_cameras, fixture_readings
    from trafficwatch.sources.registry import load_cameras

    fixture_readings(spark, SF_SMALL).write.partitionBy("camera_id").parquet(str(tmp_path / "t"))
    fixture_cameras(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    enriched = enrich(spark.read.parquet(str(tmp_path / "t")), load_cameras(spark, str(tmp_path / "c")), broadcast=True)
    for fn in (detect.detect_speeding, detect.detect_red_light, detect.detect_illegal_parking):
        df = fn(enriched)
        df.write.format("noop").mode("overwrite").save()
        assert "dynamicpruning" in physical(df).lower(), fn.__name__
