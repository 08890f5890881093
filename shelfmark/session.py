"""Spark session with the settings the engine relies on."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def attach(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package, wherever the driver was started. On a cluster whose
    machines do not have it at this path it goes with --py-files."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, *paths) if p)


def get_spark(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution; cluster settings are left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    attach(spark)
    return spark
