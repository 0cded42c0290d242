"""Pixel-wise maths and image thresholds as column expressions and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import as_column, clamp, finite, median

#: Stain vectors of haematoxylin and DAB in optical density of red, green, blue (fixed values).
HAEMATOXYLIN, DAB = (0.650, 0.704, 0.286), (0.268, 0.570, 0.776)


def optical_density(v: str | Column) -> Column:
    """-ln of the intensity, which counts as 1/255 at least."""
    return -F.ln(F.greatest(as_column(v), F.lit(1 / 255)))


def stain_matrix() -> np.ndarray:
    """Rows: haematoxylin, DAB and their unit normal, which takes up the residual."""
    normal = np.cross(HAEMATOXYLIN, DAB)
    return np.array([HAEMATOXYLIN, DAB, normal / np.linalg.norm(normal)])


def unmix(r: str, g: str, b: str) -> list[Column]:
    """Haematoxylin, DAB and residual concentrations (0 at least) from intensities of 0 to 1."""
    inverse = np.linalg.inv(stain_matrix())
    od = [optical_density(c) for c in (r, g, b)]
    out = []
    for j, name in enumerate(("hematoxylin", "dab", "residual")):
        c = od[0] * float(inverse[0, j]) + od[1] * float(inverse[1, j]) + od[2] * float(inverse[2, j])
        out.append(F.greatest(F.coalesce(finite(c), F.lit(0.0)), F.lit(0.0)).alias(name))
    return out


def reconstruct(h: str, d: str) -> list[Column]:
    """Red, green and blue from the two stains."""
    return [clamp(F.exp(-(F.col(h) * HAEMATOXYLIN[i] + F.col(d) * DAB[i]))).alias(name) for i, name in enumerate("rgb")]


def white_balance(pixels: DataFrame, keys: Sequence[str], channels: Sequence[str] = ("r", "g", "b"), eligible: str | None = None) -> DataFrame:
    """Divide each channel by its median over the brightest 2 %, so that the background is 1.

    A reference that is not finite or under 0.5 leaves its channel as it is.
    """
    keys = list(keys)
    bright = sum((F.col(c) for c in channels[1:]), F.col(channels[0])) / len(channels)
    base = pixels.where(eligible) if eligible else pixels
    cut = base.groupBy(*keys).agg(F.percentile(bright, F.lit(0.98)).alias("cut"))
    ref = base.join(cut, keys).where(bright >= F.col("cut")).groupBy(*keys).agg(*(median(c).alias(f"{c}_ref") for c in channels))
    out = pixels.join(ref, keys, "left")
    use = {c: F.when(finite(f"{c}_ref") >= 0.5, F.col(f"{c}_ref")).otherwise(F.lit(1.0)) for c in channels}
    return out.withColumns({c: clamp(F.col(c) / use[c]) for c in channels}).drop(*(f"{c}_ref" for c in channels))


def robust_scale(pixels: DataFrame, keys: Sequence[str], value: str, low: float = 0.02, high: float = 0.995) -> DataFrame:
    """Scale between two quantiles to 0..1; between the extremes where the quantiles are equal; 0 where those are too."""
    keys = list(keys)
    v = finite(value)
    span = pixels.groupBy(*keys).agg(F.percentile(v, F.lit(low)).alias("lo"), F.percentile(v, F.lit(high)).alias("hi"), F.min(v).alias("mn"), F.max(v).alias("mx"))
    span = span.withColumn("narrow", F.col("hi") <= F.col("lo")).select(*keys, F.when(F.col("narrow"), F.col("mn")).otherwise(F.col("lo")).alias("lo"), F.when(F.col("narrow"), F.col("mx")).otherwise(F.col("hi")).alias("hi"))
    scaled = clamp(F.try_divide(v - F.col("lo"), F.col("hi") - F.col("lo")))
    return pixels.join(span, keys).withColumn("scaled", F.when(v.isNotNull(), F.coalesce(scaled, F.lit(0.0)))).drop("lo", "hi")


def otsu(pixels: DataFrame, keys: Sequence[str], value: str, bins: int = 256, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """The threshold with the largest variance between classes: middle of its bin; the lowest of equal ones.

    A histogram of ``bins`` rows a group replaces the pixels before any window runs.
    """
    keys = list(keys)
    width = (high - low) / bins
    v = finite(value)
    binned = pixels.where(v.isNotNull()).select(*keys, F.least(F.greatest(F.floor((v - low) / width), F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin"))
    hist = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    up, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    c = hist.withColumns({"n0": F.sum("n").over(up), "s0": F.sum(F.col("n") * F.col("bin")).over(up), "nt": F.sum("n").over(whole), "st": F.sum(F.col("n") * F.col("bin")).over(whole)})
    n0, n1 = F.col("n0").cast("double"), (F.col("nt") - F.col("n0")).cast("double")
    gap = F.col("s0") / n0 - F.try_divide((F.col("st") - F.col("s0")).cast("double"), n1)
    c = c.withColumn("between", F.round(F.coalesce(n0 * n1 * gap * gap, F.lit(0.0)) / (F.col("nt").cast("double") * F.col("nt")), 9))
    best = c.groupBy(*keys).agg(F.max_by("bin", F.struct("between", -F.col("bin"))).alias("bin"))
    return best.select(*keys, (F.lit(low) + (F.col("bin") + 0.5) * width).alias("threshold"))


def positivity_threshold(pixels: DataFrame, keys: Sequence[str], value: str, method: str, manual: float | None = None, percentile: float = 0.9) -> DataFrame:
    """A threshold for each group: ``manual``, ``otsu``, ``percentile`` (of values above 0), ``background`` (median + 3 MAD) or ``triangle``.

    A group without finite values has none; a method without an answer takes the percentile.
    """
    keys = list(keys)
    v = finite(value)
    groups = pixels.groupBy(*keys).agg(F.count(v).alias("n"), F.percentile(F.when(v > 0, v), F.lit(percentile)).alias("q"))
    if method == "manual":
        if manual is None:
            raise ValueError("a manual threshold needs a value")
        t = groups.withColumn("t", F.lit(float(manual)))
    elif method == "percentile":
        t = groups.withColumn("t", F.col("q"))
    elif method == "otsu":
        t = groups.join(otsu(pixels, keys, value).withColumnRenamed("threshold", "t"), keys, "left")
    elif method == "background":
        centre = pixels.groupBy(*keys).agg(median(v).alias("centre"))
        spread = pixels.join(centre, keys).groupBy(*keys).agg((F.first("centre") + 3 * 1.4826 * median(F.abs(v - F.col("centre")))).alias("t"))
        t = groups.join(spread, keys, "left")
    elif method == "triangle":
        t = groups.join(triangle(pixels, keys, value).withColumnRenamed("threshold", "t"), keys, "left")
    else:
        raise ValueError(f"unknown threshold method: {method}")
    return t.select(*keys, F.when(F.col("n") > 0, F.coalesce("t", "q")).alias("threshold"))


def triangle(pixels: DataFrame, keys: Sequence[str], value: str, bins: int = 256) -> DataFrame:
    """The bin farthest below the line from the histogram's peak to its last bin (values of 0 to 1)."""
    keys = list(keys)
    v = finite(value)
    hist = pixels.where(v.isNotNull()).groupBy(*keys, F.least(F.greatest(F.floor(v * bins), F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ends = hist.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("bin")).alias("lead"))).alias("peak"), F.max("bin").alias("last"), F.max_by("n", "bin").alias("tail"))
    ends = ends.select(*keys, F.col("peak.n").alias("top"), (-F.col("peak.lead")).alias("at"), "last", "tail")
    d = hist.join(ends, keys).where("bin between at and last").withColumn("line", F.col("top") + (F.col("tail") - F.col("top")) * F.try_divide(F.col("bin") - F.col("at"), F.col("last") - F.col("at")))
    best = d.groupBy(*keys).agg(F.max_by("bin", F.struct(F.coalesce(F.col("line") - F.col("n"), F.lit(0.0)), -F.col("bin"))).alias("bin"))
    return best.select(*keys, ((F.col("bin") + 0.5) / bins).alias("threshold"))


def project(planes: DataFrame, mode: str) -> DataFrame:
    """One value for each image, channel and pixel from its z planes: max, mean, sum or the middle plane."""
    keys = ["image_id", "channel_index", "x", "y"]
    if mode in ("max", "mean", "sum"):
        f = {"max": F.max, "mean": F.avg, "sum": F.sum}[mode]
        return planes.groupBy(*keys).agg(f("value").alias("value"))
    if mode == "middle":
        depth = planes.groupBy("image_id", "channel_index").agg(F.ceil(F.max("z") / 2).alias("z"))
        return planes.join(depth, ["image_id", "channel_index", "z"]).select(*keys, "value")
    raise ValueError(f"unknown projection: {mode}")


def page_to_plane(page: str | Column, channels: str | Column) -> list[Column]:
    """Channel and z (from 1) of a page (from 1) of a stack that runs through the channels first."""
    p, c = as_column(page) - 1, as_column(channels)
    return [(F.pmod(p, c) + 1).cast("long").alias("channel_index"), (F.floor(p / c) + 1).cast("long").alias("z")]


def colour_code(r: str, g: str, b: str) -> Column:
    return F.col(r) + 256 * F.col(g) + 65536 * F.col(b)


def background_code(pixels: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """The most frequent code of each image; the lowest of equal ones."""
    count = pixels.groupBy(*keys, code).agg(F.count(F.lit(1)).alias("n"))
    return count.groupBy(*keys).agg(F.max_by(code, F.struct("n", -F.col(code))).alias("background"), F.max("n").alias("n_px"))


#: Cut for saturation by the range of the channel: 16 bit, 8 bit, scaled to 1 (fixed values).
SATURATION_CUTS = (65500.0, 254.0, 0.999)


def channel_qc(pixels: DataFrame, keys: Sequence[str], raw: str, corrected: str | None = None, saturated: float = 0.005) -> DataFrame:
    """Range, signal, saturated and near-zero shares, dynamic range and flags of each channel.

    Two passes over the pixels: the range decides the cuts that the second
    counts with. ``corrected`` is the channel after background correction.
    """
    keys = list(keys)
    v, c = finite(raw), finite(corrected or raw)
    first = pixels.groupBy(*keys).agg(
        F.min(v).alias("raw_min"), F.max(v).alias("raw_max"), F.min(c).alias("corr_min"), F.max(c).alias("corr_max"),
        F.avg(c).alias("mean_signal"), F.avg(v).alias("mean_raw"), F.percentile(v, F.lit(0.001)).alias("lo"), F.percentile(v, F.lit(0.999)).alias("hi"),
    )
    high = F.col("raw_max")
    cut = F.when(high > 255, SATURATION_CUTS[0]).when(high > 1, SATURATION_CUTS[1]).otherwise(SATURATION_CUTS[2])
    shares = pixels.join(first.select(*keys, cut.alias("cut"), "raw_min"), keys).groupBy(*keys).agg(
        F.avg((v >= F.col("cut")).cast("int")).alias("saturated_pixel_fraction"), F.avg((v <= F.col("raw_min") + 1e-5).cast("int")).alias("near_zero_pixel_fraction")
    )
    span = F.col("raw_max") - F.col("raw_min")
    out = first.join(shares, keys).withColumn("dynamic_range_used", F.when(span > 0, F.try_divide(F.col("hi") - F.col("lo"), span)).otherwise(0.0))
    flags = F.array_compact(
        F.array(
            F.when(F.col("raw_max").isNull(), "EMPTY_CHANNEL"),
            F.when(F.col("saturated_pixel_fraction") > saturated, "HIGH_SATURATION"),
            F.when((F.col("dynamic_range_used") < 0.05) & (high > 0), "LOW_DYNAMIC_RANGE"),
            F.when((high == 0) | (F.col("mean_signal") < 1e-6), "NO_SIGNAL"),
            F.when(F.col("mean_raw") - F.col("mean_signal") > 0.6 * F.greatest(F.lit(1e-5), F.col("mean_signal")), "HIGH_BACKGROUND"),
        )
    )
    joined = F.when(F.size(flags) > 0, F.concat_ws(";", flags)).otherwise("PASS")
    return out.select(*keys, "raw_min", "raw_max", "corr_min", "corr_max", "mean_signal", "saturated_pixel_fraction", "near_zero_pixel_fraction", "dynamic_range_used", joined.alias("channel_qc_flags"))
