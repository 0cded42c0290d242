"""Folders for what a query or job writes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temp folder stands in where the master is local and none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/tessella-scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
