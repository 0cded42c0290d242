"""Aggregates over pixels, cells and regions.

A pixel frame has a row for each pixel: ``image_id, x, y``, values and masks.
Everything here is a single hash aggregate over such rows; the group index and
the partial sums are Spark's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import class_weight, finite, intensity_class, median, ratio


def metric_columns(value: Column, threshold: Column | float, mask: Column | None = None, prefix: str = "") -> list[Column]:
    """Area, positive area, fraction, mean, mean of positives and sum of the finite values under a mask.

    Without pixels the area is 0 and the rest null; with pixels but no positive
    one the mean of positives is a measured 0.
    """
    v = finite(value) if mask is None else F.when(mask, finite(value))
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    n, hit = F.count(v), F.count(F.when(v >= t, 1))
    return [
        n.alias(f"{prefix}area_px"),
        F.when(n > 0, hit).alias(f"{prefix}positive_area_px"),
        ratio(hit, n).alias(f"{prefix}positive_area_fraction"),
        F.avg(v).alias(f"{prefix}mean_od"),
        F.when(n > 0, F.coalesce(F.avg(F.when(v >= t, v)), F.lit(0.0))).alias(f"{prefix}positive_mean_od"),
        F.sum(v).alias(f"{prefix}integrated_od"),
    ]


def pixel_metrics(pixels: DataFrame, keys: Sequence[str], value: str, threshold: float) -> DataFrame:
    return pixels.groupBy(*keys).agg(*metric_columns(F.col(value), threshold))


def four_domains(pixels: DataFrame, keys: Sequence[str], value: str, threshold: float, tissue: str = "tissue", nucleus: str = "nuc_label", cell: str = "cell_label") -> DataFrame:
    """Metrics of tissue, nuclei, cytoplasm (cell without nucleus) and the tissue outside cells, in one pass."""
    inside, nuclear, cellular = F.col(tissue), F.col(nucleus) > 0, F.col(cell) > 0
    masks = {"tissue_": inside, "nuclear_": nuclear, "cytoplasm_": cellular & ~nuclear, "extracellular_": inside & ~cellular}
    return pixels.groupBy(*keys).agg(*(c for name, mask in masks.items() for c in metric_columns(F.col(value), threshold, mask, name)))


def domain_stats(pixels: DataFrame, keys: Sequence[str], value: str, background: str, threshold: float) -> DataFrame:
    """Per cell and domain: background-subtracted mean, median, 90 % quantile, positive share and mean, and the raw mean and share."""
    v = F.greatest(F.col(value) - F.coalesce(F.col(background), F.lit(0.0)), F.lit(0.0))
    n, hit = F.count(v), F.count(F.when(v >= threshold, 1))
    return pixels.groupBy(*keys).agg(
        n.alias("n_px"),
        F.avg(v).alias("mean_od"),
        median(v).alias("median_od"),
        F.percentile(v, F.lit(0.9)).alias("q90_od"),
        ratio(hit, n).alias("positive_fraction"),
        F.coalesce(F.avg(F.when(v >= threshold, v)), F.lit(0.0)).alias("positive_mean_od"),
        F.avg(value).alias("raw_mean_od"),
        ratio(F.count(F.when(F.col(value) >= threshold, 1)), n).alias("raw_positive_fraction"),
    )


def field_background(pixels: DataFrame, keys: Sequence[str], value: str, tissue: str = "tissue", cell: str = "cell_label") -> DataFrame:
    """Median of the tissue outside all cells, 0 if there is none."""
    return pixels.groupBy(*keys).agg(F.coalesce(median(F.when(F.col(tissue) & (F.col(cell) == 0), finite(value))), F.lit(0.0)).alias("field_background"))


def annulus_background(cells: DataFrame, pixels: DataFrame, field: DataFrame, value: str, inner: float, outer: float, least: int, tissue: str = "tissue") -> DataFrame:
    """Median of the tissue pixels around each cell centre (cx, cy) at a distance from ``inner`` to ``outer``, of no cell.

    Pixels out of analysis are no tissue. A centre is rounded half to even, counted from 1.

    Offsets of the ring are enumerated, so that the distance condition becomes an
    equi-join on pixel coordinates. A ring of fewer than ``least`` pixels takes
    the field background.
    """
    r = int(outer)
    ring = [(dx, dy) for dx in range(-r, r + 1) for dy in range(-r, r + 1) if inner * inner <= dx * dx + dy * dy <= outer * outer]
    offset = F.explode(F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ring)))
    around = cells.select("image_id", "cell_id", *((F.bround(F.col(c).cast("double") + 1, 0) - 1).cast("int").alias(c) for c in ("cx", "cy")), offset.alias("o")).select("image_id", "cell_id", (F.col("cx") + F.col("o.dx")).alias("x"), (F.col("cy") + F.col("o.dy")).alias("y"))
    free = pixels.where((F.col("cell_label") == 0) & F.col(tissue)).select("image_id", "x", "y", finite(value).alias("v"))
    ringed = around.join(free, ["image_id", "x", "y"]).groupBy("image_id", "cell_id").agg(F.count("v").alias("n_ring"), median("v").alias("ring"))
    return (
        cells.select("image_id", "cell_id")
        .join(ringed, ["image_id", "cell_id"], "left")
        .join(field, "image_id", "left")
        .select("image_id", "cell_id", F.coalesce("n_ring", F.lit(0)).alias("n_ring"), F.when(F.col("n_ring") >= least, F.col("ring")).otherwise(F.coalesce("field_background", F.lit(0.0))).alias("local_background"))
    )


def compartment_stats(pixels: DataFrame, keys: Sequence[str], value: str, masks: Mapping[str, Column], threshold: float, um_per_pixel: float = 1.0) -> DataFrame:
    """A row for each group and compartment: count, area, mean, median, sum, max, sd and positives.

    A compartment without pixels has count, area and sum 0 and the rest null.
    """
    v = finite(value)
    named = F.explode(F.array(*(F.struct(F.lit(name).alias("compartment"), mask.alias("inside")) for name, mask in masks.items())))
    long = pixels.select(*keys, v.alias("v"), named.alias("c")).select(*keys, "c.compartment", F.when(F.col("c.inside"), F.col("v")).alias("v"))
    n, hit = F.count("v"), F.count(F.when(F.col("v") >= threshold, 1))
    return long.groupBy(*keys, "compartment").agg(
        n.alias("pixel_count"),
        (n * um_per_pixel**2).cast("double").alias("area_um2"),
        F.avg("v").alias("mean_intensity"),
        median("v").alias("median_intensity"),
        F.coalesce(F.sum("v"), F.lit(0.0)).alias("integrated_intensity"),
        F.max("v").alias("max_intensity"),
        F.stddev_samp("v").alias("sd_intensity"),
        F.when(n > 0, hit).alias("positive_count"),
        ratio(hit, n).alias("positive_fraction"),
    )


def single_cells(pixels: DataFrame, keys: Sequence[str], value: str, threshold: float, cell: str = "cell_label", nucleus: str = "nuc_label") -> DataFrame:
    """Nucleus, cytoplasm and whole-cell statistics of each cell, the nucleus to cytoplasm ratio and positivity."""
    v, nuclear = finite(value), F.col(nucleus) > 0
    parts = {"nuclear": nuclear, "cytoplasm": ~nuclear, "cell": F.lit(True)}
    stats = [f(F.when(mask, v)).alias(f"{name}_{stat}") for name, mask in parts.items() for stat, f in (("px", F.count), ("mean", F.avg), ("median", median), ("sum", F.sum))]
    out = pixels.where(F.col(cell) > 0).groupBy(*keys, F.col(cell).alias("cell_id")).agg(*stats)
    return out.withColumns({"nc_ratio": F.when(F.col("cytoplasm_mean") > 1e-6, F.col("nuclear_mean") / F.col("cytoplasm_mean")), "is_positive_cell": F.col("cell_mean") >= threshold})


def cell_scores(cells: DataFrame, keys: Sequence[str], od: str, cuts: Sequence[float]) -> DataFrame:
    """Cells, positive share, H-score, mean and median of the finite cell values; positive is the first class above 0."""
    label = intensity_class(od, cuts)
    v = finite(od)
    return cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.avg(F.when(v.isNotNull(), (v >= cuts[0]).cast("int"))).alias("positive_cell_fraction"),
        (F.lit(100.0) * F.avg(class_weight(label))).alias("h_score"),
        F.avg(v).alias("mean_cell_od"),
        median(v).alias("median_cell_od"),
    )


def class_counts(cells: DataFrame, keys: Sequence[str], od: str, cuts: Sequence[float]) -> DataFrame:
    return cells.withColumn("intensity_class", intensity_class(od, cuts)).groupBy(*keys, "intensity_class").agg(F.count(F.lit(1)).alias("n_cells"))


def moments(pixels: DataFrame, keys: Sequence[str], label: str, value: str) -> DataFrame:
    """Area, centroid, eccentricity (from second moments) and mean of each object, by sums alone."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    sums = pixels.where(F.col(label) > 0).groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("area"), F.avg(x).alias("cx"), F.avg(y).alias("cy"),
        F.avg(x * x).alias("xx"), F.avg(y * y).alias("yy"), F.avg(x * y).alias("xy"), F.avg(finite(value)).alias("mean_value"),
    )
    a, b, c = F.col("xx") - F.col("cx") ** 2, F.col("yy") - F.col("cy") ** 2, F.col("xy") - F.col("cx") * F.col("cy")
    half, root = (a + b) / 2, F.sqrt(F.greatest(((a - b) / 2) ** 2 + c * c, F.lit(0.0)))
    ecc = F.when(half + root > 1e-12, F.sqrt(F.greatest(F.lit(1.0) - (half - root) / F.nullif(half + root, F.lit(0.0)), F.lit(0.0)))).otherwise(F.lit(0.0))
    return sums.select(*keys, label, "area", "cx", "cy", ecc.alias("eccentricity"), "mean_value")


def focus_score(pixels: DataFrame, value: str) -> DataFrame:
    """Mean squared forward difference along x plus that along y."""
    along_x, along_y = Window.partitionBy("image_id", "y").orderBy("x"), Window.partitionBy("image_id", "x").orderBy("y")
    d = pixels.select("image_id", (F.lead(value).over(along_x) - F.col(value)).alias("dx"), (F.lead(value).over(along_y) - F.col(value)).alias("dy"))
    return d.groupBy("image_id").agg((F.avg(F.col("dx") * F.col("dx")) + F.avg(F.col("dy") * F.col("dy"))).alias("focus_score"))


def puncta_summary(pixels: DataFrame, keys: Sequence[str], value: str, masks: Mapping[str, Column], puncta: str = "puncta_label", cell: str = "cell_label", um_per_pixel: float = 1.0) -> DataFrame:
    """Distinct puncta that touch each compartment, per cell, area, density, mean (0 if none) and sum."""
    named = F.explode(F.array(*(F.struct(F.lit(name).alias("compartment"), mask.alias("inside")) for name, mask in masks.items())))
    cells = pixels.groupBy(*keys).agg(F.count_distinct(F.when(F.col(cell) > 0, F.col(cell))).alias("n_cells"))
    long = pixels.withColumn("c", named).where("c.inside").select(*keys, "c.compartment", puncta, finite(value).alias("v"))
    spot = F.col(puncta) > 0
    out = long.groupBy(*keys, "compartment").agg(
        F.count_distinct(F.when(spot, F.col(puncta))).alias("puncta_count"), (F.count(F.lit(1)) * um_per_pixel**2).cast("double").alias("area_um2"),
        F.coalesce(F.avg(F.when(spot, F.col("v"))), F.lit(0.0)).alias("puncta_mean"), F.coalesce(F.sum(F.when(spot, F.col("v"))), F.lit(0.0)).alias("puncta_sum"),
    )
    per_cell = F.when(F.col("compartment") != "extracellular", F.col("puncta_count") / F.greatest(F.lit(1), F.col("n_cells")))
    return out.join(cells, list(keys)).withColumns({"puncta_per_cell": per_cell, "puncta_density": F.col("puncta_count") / F.col("area_um2")})


def puncta_per_cell(pixels: DataFrame, keys: Sequence[str], puncta: str = "puncta_label", cell: str = "cell_label", nucleus: str = "nuc_label") -> DataFrame:
    spot = F.when(F.col(puncta) > 0, F.col(puncta))
    nuclear = F.col(nucleus) > 0
    return pixels.where(F.col(cell) > 0).groupBy(*keys, F.col(cell).alias("cell_id")).agg(
        F.count_distinct(spot).alias("cell_puncta"), F.count_distinct(F.when(nuclear, spot)).alias("nuclear_puncta"), F.count_distinct(F.when(~nuclear, spot)).alias("cytoplasm_puncta")
    )


def pearson(pixels: DataFrame, keys: Sequence[str], a: str, b: str, least: int = 30) -> DataFrame:
    """Correlation over pairs of finite values; null below ``least`` pairs or without spread."""
    x, y = finite(a), finite(b)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    sa, sb = F.stddev_samp(x), F.stddev_samp(y)
    r = F.when((F.count(x) >= least) & (sa > 1e-8) & (sb > 1e-8), F.try_divide(F.covar_samp(x, y), sa * sb))
    return pixels.groupBy(*keys).agg(F.count(x).alias("n_pairs"), r.alias("pearson_r"))


def manders(pixels: DataFrame, keys: Sequence[str], a: str, b: str, ta: str | float, tb: str | float) -> DataFrame:
    """Share of one channel's sum where the other is at its threshold or above; null for a sum of 1e-8 or less."""
    x, y = finite(a), finite(b)
    t = [F.col(v) if isinstance(v, str) else F.lit(v) for v in (ta, tb)]

    def share(own, other, cut):
        total = F.sum(own)
        return F.when(total > 1e-8, F.coalesce(F.sum(F.when(other >= cut, own)), F.lit(0.0)) / total)

    return pixels.groupBy(*keys).agg(share(x, y, t[1]).alias("manders_m1"), share(y, x, t[0]).alias("manders_m2"))
