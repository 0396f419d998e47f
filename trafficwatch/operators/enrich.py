"""Telemetry x registry enrichment (stream-static or batch inner equi-join)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.sources.registry import registry_projection


def enrich(telemetry: DataFrame, cameras: DataFrame, broadcast: bool = False) -> DataFrame:
    """Inner join of readings with the registry on ``camera_id``; readings of unknown
    cameras are dropped.

    The join strategy is Spark's: a registry below ``autoBroadcastJoinThreshold`` bytes (by
    file statistics, or by its real size under AQE) is broadcast, a larger one is shuffled
    and AQE splits a hot camera. ``broadcast=True`` is for a caller who knows the size."""
    registry = registry_projection(cameras)
    return telemetry.join(F.broadcast(registry) if broadcast else registry, on="camera_id", how="inner")
