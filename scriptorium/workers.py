"""Lets Python workers find this package where it is not installed but shares the driver's paths."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def reach(spark: SparkSession) -> SparkSession:
    """Put the package's folder on the path of workers started from now on; gives the session back."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark
