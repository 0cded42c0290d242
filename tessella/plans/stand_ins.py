"""Frames of the microscopy model made from the driver's tables, and the same frames in SQL.

An embedding of 64 numbers stands for an image plane of 8 x 8 pixels, its label
for the condition; a line item for a cell or, grouped, a region; a customer for a
biological unit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUC = "CASE WHEN x IN (2, 3) AND y IN (2, 3) THEN 1 WHEN x = 5 AND y IN (4, 5) THEN 2 ELSE 0 END"
CELL = "CASE WHEN x BETWEEN 1 AND 4 AND y BETWEEN 1 AND 4 THEN 1 WHEN x IN (5, 6) AND y BETWEEN 3 AND 6 THEN 2 ELSE 0 END"
TISSUE = "x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6"

#: Pixel frame: image_id, condition, x, y, v, tissue, nuc_label, cell_label.
PX = f"""px AS (SELECT image_id, condition, x, y, v, {TISSUE} AS tissue, {NUC} AS nuc_label, {CELL} AS cell_label FROM (
  SELECT vec_id AS image_id, label AS condition, (i - 1) % 8 AS x, (i - 1) // 8 AS y, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS t(i)))"""

#: Region frame: a row for each order and return flag, as the unit summary wants it.
RG = """rg AS (SELECT l_orderkey AS image_id, l_returnflag AS roi_id, min(o_custkey % 40) AS biological_unit_id, l_linestatus AS condition,
  CASE WHEN l_returnflag = 'A' THEN 'tumor' WHEN l_returnflag = 'R' THEN 'stroma' ELSE 'global' END AS compartment,
  count(*) AS n_cells, sum(l_quantity) AS area_px, sum(CASE WHEN l_discount >= 0.05 THEN l_quantity ELSE 0 END) AS positive_area_px,
  avg(l_discount) AS mean_od, sum(l_discount * l_quantity) AS integrated_od, avg(l_tax) AS cell_od, quantile_cont(l_tax, 0.5) AS median_cell_od
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_returnflag, l_linestatus)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("condition"), F.posexplode("embedding").alias("pos", "f"))
    p = e.select("image_id", "condition", (F.col("pos") % 8).alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"), F.col("f").cast("double").alias("v"))
    return p.withColumns({"tissue": F.expr(TISSUE), "nuc_label": F.expr(NUC), "cell_label": F.expr(CELL)})


#: Line items of a task that sorts them by region or image; more have more tasks.
TASK_LINES = 1 << 19
#: To more tasks than this Spark's shuffle sorts what it writes in memory (fixed value: the default of spark.shuffle.sort.bypassMergeThreshold).
UNSORTED_TASKS = 200
#: Line items of a task for which that is accepted.
MOST_TASK_LINES = 1 << 22


def line_tasks(spark: SparkSession, lines: DataFrame) -> int:
    """So many tasks that a task's sorts of line items don't grow with the table."""
    n = lines.count()  # from the files' footers
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(math.ceil(n / TASK_LINES), UNSORTED_TASKS), math.ceil(n / MOST_TASK_LINES))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region rows. Lines and orders are dealt by order once, to so many tasks that a task's sorts don't grow with the table."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = line_tasks(spark, lines)
    lines = lines.repartition(tasks, "l_orderkey").join(orders.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    part = F.when(F.col("l_returnflag") == "A", "tumor").when(F.col("l_returnflag") == "R", "stroma").otherwise("global")
    return (
        lines.groupBy(F.col("l_orderkey").alias("image_id"), F.col("l_returnflag").alias("roi_id"), F.col("l_linestatus").alias("condition"))
        .agg(
            F.min(F.col("o_custkey") % 40).alias("biological_unit_id"),
            F.count(F.lit(1)).alias("n_cells"),
            F.sum("l_quantity").alias("area_px"),
            F.sum(F.when(F.col("l_discount") >= 0.05, F.col("l_quantity")).otherwise(0.0)).alias("positive_area_px"),
            F.avg("l_discount").alias("mean_od"),
            F.sum(F.col("l_discount") * F.col("l_quantity")).alias("integrated_od"),
            F.avg("l_tax").alias("cell_od"),
            F.percentile("l_tax", F.lit(0.5)).alias("median_cell_od"),
        )
        .withColumn("l_returnflag", F.col("roi_id"))
        .withColumn("compartment", part)
        .drop("l_returnflag")
    )
