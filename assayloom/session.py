"""Session builder with the settings the plans are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from assayloom.common import ship


def get_session(app: str = "assayloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, Arrow and UTC. ``master`` is only set when given: on a cluster, spark-submit decides.

    ``spark.checkpoint.dir`` is left alone when the cluster names one.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if master and master.startswith("local"):
        base["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8)
        base["spark.driver.memory"] = "8g"
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark
