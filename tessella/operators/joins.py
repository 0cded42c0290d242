"""Joins on keys of any distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A key is hot if it has this share of all rows and at least so many rows; so there are 1000 hot keys at most.
HOT_SHARE, HOT_ROWS = 0.001, 1000


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The hot values of ``key`` as ``hot_key``: 1000 rows at most, held by the driver."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows_of_key"))
    found = counts.where(F.col("n_rows_of_key") >= max(HOT_ROWS, HOT_SHARE * rows.count())).select(F.col(key).alias("hot_key")).collect()
    return rows.sparkSession.createDataFrame(found, StructType([StructField("hot_key", rows.schema[key].dataType)]))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` joined to ``right``, which has one row for each ``key`` at most, with no task that gets all rows of a key.

    Hot keys meet a broadcast of their own rows, a thousand at most; all others are
    joined by shuffling. ``how`` is inner or left; a null key meets nothing.
    """
    hot = hot_keys(left, key)
    if hot.isEmpty():
        return left.join(right, key, how)
    few, met = F.broadcast(hot), F.col(key) == F.col("hot_key")
    warm = left.join(few, met, "left_semi").join(F.broadcast(right.join(few, met, "left_semi")), key, how)
    cold = left.join(few, met, "left_anti")
    # rows without a key all have one hash: they don't go through the shuffle of a left join
    out = cold.where(F.col(key).isNotNull()).join(right, key, how).unionByName(warm)
    return out.unionByName(cold.where(F.col(key).isNull()), allowMissingColumns=True) if how == "left" else out
