"""The folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own under the warehouse if the session runs in one process on one
    machine; on a cluster that has no such setting there is no folder that all executors are known to share, and this fails."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
