"""A folder that driver and executors share, for what a query writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir. Only a local master has a folder of its own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir isn't set; executors of {master} need a folder that all share")
        found = "file:///tmp/checkpoints/rowkin"
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"
