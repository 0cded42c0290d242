"""What the jobs share: settings, mapped columns, folders, logs."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.manifest import read_csv

log = logging.getLogger("tessella.jobs")


def settings_of(spark: SparkSession, path: str | None, shipped: str) -> dict[str, str]:
    """The ``parameter,value`` rows of a settings file, over those of the file ``shipped`` beside the jobs."""
    here = Path(__file__).with_name(shipped)
    lines = [line.split(",", 1) for line in here.read_text().splitlines()[1:] if line]
    out = {name: value.strip().strip('"') for name, value in lines}
    if path:
        own = {r.parameter: r.value or "" for r in read_csv(spark, path).select("parameter", "value").collect()}  # a few dozen
        unknown = sorted(set(own) - set(out))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        out |= own
    return out


def mapped(table: DataFrame, settings: Mapping[str, str], prefix: str) -> DataFrame:
    """The columns that the settings ``prefix.name = SQL expression`` make of a table."""
    return table.select(*(F.expr(e).alias(n.removeprefix(f"{prefix}.")) for n, e in settings.items() if n.startswith(f"{prefix}.")))


def session(name: str) -> SparkSession:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    logging.getLogger("py4j").setLevel(logging.WARNING)
    return spark
