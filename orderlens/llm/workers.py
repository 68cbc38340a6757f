"""Lets Python workers find this package where the driver found it."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """For local runs that put the package on the driver's path only; a cluster gets it by --py-files or installation."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))


#: Memory that a worker frees goes back to the system at once: numpy's from arrays of 4 MB on, and Arrow's by the same allocator.
LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20)}


def prepare_lean(spark: SparkSession) -> None:
    """The same, with workers that keep little between tasks, for jobs of many stages; settings of the session's own stay."""
    prepare(spark)
    environment = spark.sparkContext.environment
    environment.update({name: value for name, value in LEAN.items() if name not in environment})
