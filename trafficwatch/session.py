"""Session construction and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, app: str = "trafficwatch",
                shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    """A session with the settings the job relies on: AQE (coalescing and skew
    splitting), UI off, Arrow on. On a cluster pass ``master=None`` and let
    spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read here
    (Spark already uses it for ``DataFrame.checkpoint()``). When it is unset
    (local runs and tests) a fresh local folder is created once per Spark
    context and registered with ``setCheckpointDir``; the setting itself is a
    startup option and is not written. On any other master that is an error: executors
    and a restarted driver would not see the driver's own disk."""
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder on shared storage")
    key = id(spark.sparkContext)
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="trafficwatch-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOTS[key])
    return _LOCAL_ROOTS[key]
