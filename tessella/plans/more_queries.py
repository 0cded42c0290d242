"""Queries of label tables, clamped bars, words as booleans and masks of positive pixels, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import finite, parse_bool
from tessella.operators import geometry, statistics as st
from tessella.plans.queries import query, rounded
from tessella.plans.stand_ins import PX, pixels, table


@query(f"WITH {PX}, a AS (SELECT image_id, cell_label, avg(v) AS m FROM px WHERE cell_label > 0 GROUP BY 1, 2), n AS (SELECT image_id, cell_label, dense_rank() OVER (PARTITION BY image_id ORDER BY cell_label) AS new_label FROM a WHERE m > 0) SELECT px.image_id, coalesce(new_label, 0) AS new_label, count(*) AS n_px FROM px LEFT JOIN n USING (image_id, cell_label) GROUP BY 1, 2")
def relabelled_pixels(spark, d):
    p = pixels(spark, d)
    objects = p.where("cell_label > 0").groupBy("image_id", "cell_label").agg(F.avg("v").alias("mean_value"))
    kept = geometry.renumber(objects, "cell_label", "mean_value > 0")
    return rounded(geometry.relabel(p, kept, "cell_label").groupBy("image_id", "new_label").agg(F.count(F.lit(1)).alias("n_px")))


@query("SELECT l_linenumber, l_returnflag, round(avg(l_discount) * 5, 5) AS summary_value, round(least(greatest(avg(l_discount) * 5 - stddev_samp(l_discount * 5), 0), 0.4), 5) AS lower, round(least(greatest(avg(l_discount) * 5 + stddev_samp(l_discount * 5), 0), 0.4), 5) AS upper, count(*) AS n_units FROM lineitem GROUP BY 1, 2")
def clamped_bars(spark, d):
    rows = table(spark, d, "lineitem").select("l_linenumber", "l_returnflag", (F.col("l_discount") * 5).alias("v"))
    return rounded(st.clamped_bars(st.bar_table(rows, ["l_linenumber", "l_returnflag"], "v", "mean", "sd"), 0.4), 5)


@query("SELECT o_orderpriority, count(*) FILTER (o_orderkey % 4 IN (0, 1)) AS n_true, count(*) FILTER (o_orderkey % 4 = 2) AS n_false, count(*) FILTER (o_orderkey % 4 = 3) AS n_missing FROM orders GROUP BY 1")
def boolean_words(spark, d):
    k = F.col("o_orderkey") % 4
    said = F.when(k == 0, " Yes ").when(k == 1, "TRUE").when(k == 2, "0")
    b = table(spark, d, "orders").select("o_orderpriority", parse_bool(said).alias("b"))
    return b.groupBy("o_orderpriority").agg(F.count_if("b").alias("n_true"), F.count_if(~F.col("b")).alias("n_false"), F.count_if(F.col("b").isNull()).alias("n_missing"))


@query(f"WITH {PX} SELECT image_id, x, y, v >= 0.05 AS positive FROM px WHERE tissue")
def positive_mask(spark, d):
    return rounded(pixels(spark, d).where("tissue").select("image_id", "x", "y", (finite("v") >= 0.05).alias("positive")))
