"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE splits skewed join partitions and coalesces small ones; the zone is pinned
# because epoch <-> date conversions depend on it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tagloom", master: str | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configured_dir(spark: SparkSession) -> str | None:
    """The folder all executors share, or None when the cluster names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A session that names none works below its warehouse, which all
    executors must reach: on a cluster, a warehouse on the driver's own disk is an error."""
    named = configured_dir(spark) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if reaches_one_machine_only(spark.sparkContext.master, warehouse):
        raise ValueError(f"{warehouse} is on one machine: name a shared folder in spark.checkpoint.dir")
    return f"{warehouse}/work"


def reaches_one_machine_only(master: str, path: str) -> bool:
    return not master.startswith("local") and path.startswith(("file:", "/"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Point RDD checkpoints (used by the iterative solvers) at the shared folder."""
    path = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
