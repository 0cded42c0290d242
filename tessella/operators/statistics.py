"""Aggregation to biological units, paired effects and the tables behind figures."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessella.functions import finite, median, weighted_mean

UNIT_KEYS = ("marker", "tissue_type", "batch_id", "biological_unit_id", "condition", "compartment", "cell_scoring_domain")
DOMAINS = ("tissue", "nuclear", "cytoplasm", "extracellular")
SCORES = ("", "nuclear_", "cytoplasm_", "whole_cell_")
#: Metrics of paired effects and their labels (fixed values).
METRIC_LABELS = {
    "tissue_positive_area_fraction": "Tissue DAB-positive area fraction",
    "tissue_mean_dab_od": "Mean tissue DAB optical density",
    "nuclear_positive_area_fraction": "Nuclear DAB-positive area fraction",
    "nuclear_h_score": "Nuclear H-score",
    "cytoplasm_positive_area_fraction": "Cytoplasmic DAB-positive area fraction",
    "cytoplasm_h_score": "Cytoplasmic H-score",
    "extracellular_positive_area_fraction": "Extracellular DAB-positive area fraction",
    "extracellular_mean_dab_od": "Mean extracellular DAB optical density",
    "positive_cell_fraction": "Configured-domain positive-cell fraction",
    "h_score": "Configured-domain cell H-score",
    "mean_cell_dab_od": "Configured-domain mean cell DAB optical density",
}


def total(c: str) -> Column:
    return F.coalesce(F.sum(finite(c)), F.lit(0.0))


def area_columns(domain: str) -> list[Column]:
    """Sums, the ratio of sums and area-weighted means of one measurement domain."""
    d = domain
    out = [
        total(f"{d}_area_px").alias(f"{d}_area_px"),
        total(f"{d}_positive_area_px").alias(f"{d}_positive_area_px"),
        (total(f"{d}_positive_area_px") / F.greatest(F.lit(1.0), total(f"{d}_area_px"))).alias(f"{d}_positive_area_fraction"),
        weighted_mean(f"{d}_mean_dab_od", f"{d}_area_px").alias(f"{d}_mean_dab_od"),
        weighted_mean(f"{d}_positive_mean_dab_od", f"{d}_positive_area_px").alias(f"{d}_positive_mean_dab_od"),
        total(f"{d}_integrated_dab_od").alias(f"{d}_integrated_dab_od"),
    ]
    return [out[0], *out[2:]] if d == "tissue" else out


def score_columns(prefix: str) -> list[Column]:
    """Cell-weighted means of one scoring domain and the median of its regions' medians."""
    p = prefix
    out = [weighted_mean(f"{p}{m}", "n_cells").alias(f"{p}{m}") for m in ("positive_cell_fraction", "h_score", "mean_cell_dab_od")]
    if p != "whole_cell_":
        out.append(median(finite(f"{p}median_cell_dab_od")).alias(f"{p}median_of_region_medians_cell_dab_od"))
    return out


def unit_summary(regions: DataFrame, keys: Sequence[str] = UNIT_KEYS) -> DataFrame:
    """One row for each biological unit from its region rows, in one aggregation."""
    return regions.groupBy(*keys).agg(
        F.count_distinct("image_id").alias("n_images"),
        F.count(F.lit(1)).alias("n_regions"),
        *(c for d in DOMAINS for c in area_columns(d)),
        total("n_cells").alias("n_cells"),
        weighted_mean("mean_local_background_od", "n_cells").alias("mean_local_background_od"),
        *(c for p in SCORES for c in score_columns(p)),
    )


def unit_means(compartments: DataFrame, keys: Sequence[str] = ("biological_unit_id", "condition", "marker", "compartment")) -> DataFrame:
    """Unweighted means of image means and medians of image medians; areas and sums add up."""
    return compartments.groupBy(*keys).agg(
        F.count_distinct("image_id").alias("n_images"),
        total("area_um2").alias("total_area_um2"),
        F.avg(finite("mean_intensity")).alias("mean_intensity"),
        median(finite("median_intensity")).alias("median_intensity"),
        total("integrated_intensity").alias("integrated_intensity"),
        F.avg(finite("positive_area_fraction")).alias("positive_area_fraction"),
    )


def design_summary(regions: DataFrame, keys: Sequence[str] = ("marker", "tissue_type", "batch_id", "condition")) -> DataFrame:
    return regions.where("compartment = 'global'").groupBy(*keys).agg(F.count_distinct("image_id").alias("n_images"), F.count_distinct("biological_unit_id").alias("n_biological_units"))


#: Measurement domain, its default metric and what that means (fixed values).
PRIMARY_METRICS = (
    ("global", "tissue_positive_area_fraction", "pixel_based_global_tissue_dab_positive_area_fraction"),
    ("nucleus", "nuclear_h_score", "cell_based_nuclear_h_score_0_to_300"),
    ("cytoplasm", "cytoplasm_h_score", "cell_based_cytoplasmic_h_score_0_to_300"),
    ("extracellular", "extracellular_positive_area_fraction", "pixel_based_extracellular_dab_positive_area_fraction"),
)


def primary_long(units: DataFrame, keys: Sequence[str] = UNIT_KEYS, metrics: Sequence[tuple[str, str, str]] = PRIMARY_METRICS) -> DataFrame:
    """A row for each unit and measurement domain with its default metric."""
    rows = F.array(*(F.struct(F.lit(d).alias("measurement_domain"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(s).alias("metric_semantics")) for d, m, s in metrics))
    return units.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


@F.pandas_udf(DoubleType())
def exact_signflip(differences: pd.Series) -> pd.Series:
    """Share of all sign vectors whose mean is as far from 0 as the observed one; null unless 2 to 20 values.

    The sums over all sign vectors build up by doubling; 20 values take 8 MB.
    """

    def p(values) -> float | None:
        values = np.asarray([v for v in values if v is not None and np.isfinite(v)], dtype=float) if values is not None else np.zeros(0)
        if not 2 <= len(values) <= 20:
            return None
        sums = np.zeros(1)
        for v in values:
            sums = np.concatenate([sums - v, sums + v])
        return float(np.mean(np.abs(sums / len(values)) >= abs(values.mean()) - np.sqrt(np.finfo(float).eps)))

    return differences.map(p)


def paired_differences(units: DataFrame, groups: Sequence[str], metrics: Sequence[str], reference: str, comparison: str, unit: str = "biological_unit_id", condition: str = "condition") -> DataFrame:
    """(group, metric, unit, difference) where both conditions have a finite value."""
    long = units.where(F.col(condition).isin(reference, comparison)).select(*groups, unit, condition, F.explode(F.create_map(*(x for m in metrics for x in (F.lit(m), finite(m))))).alias("metric", "v"))
    sides = long.groupBy(*groups, "metric", unit).agg(F.max(F.when(F.col(condition) == reference, F.col("v"))).alias("a"), F.max(F.when(F.col(condition) == comparison, F.col("v"))).alias("b"))
    return sides.select(*groups, "metric", unit, (F.col("b") - F.col("a")).alias("difference")).where("difference is not null")


def paired_effects(units: DataFrame, groups: Sequence[str], metrics: Sequence[str], reference: str, comparison: str, unit: str = "biological_unit_id", condition: str = "condition", p_values: bool = True) -> DataFrame:
    """Differences between two conditions within units: count, direction, mean, median, status and exact sign-flip p."""
    d = paired_differences(units, groups, metrics, reference, comparison, unit, condition)
    # at most 21 differences are carried to the exact test; more have no p value
    n = F.count("difference")
    out = d.groupBy(*groups, "metric").agg(
        n.alias("n_paired_units"),
        F.count(F.when(F.col("difference") > 0, 1)).alias("n_higher_in_comparison"),
        F.avg("difference").alias("mean_paired_difference"),
        median("difference").alias("median_paired_difference"),
        F.when(n < 2, "NOT_EVALUABLE_N_LT_2").otherwise("DESCRIPTIVE_EXACT_SIGNFLIP").alias("inferential_status"),
    )
    if p_values:
        few = d.join(out.where("n_paired_units between 2 and 20").select(*groups, "metric"), [*groups, "metric"])
        p = few.groupBy(*groups, "metric").agg(F.sort_array(F.collect_list("difference")).alias("d")).select(*groups, "metric", exact_signflip("d").alias("exact_signflip_p_mean_difference"))
        out = out.join(p, [*groups, "metric"], "left")
    return out.withColumns({"reference_condition": F.lit(reference), "comparison_condition": F.lit(comparison)})


def bar_table(rows: DataFrame, keys: Sequence[str], value: str, stat: str = "mean", errorbar: str = "se") -> DataFrame:
    """Centre and error bounds of each bar; bounds need two values."""
    if stat not in ("mean", "median") or errorbar not in ("se", "sd", "iqr", "none"):
        raise ValueError(f"unknown statistic or error bar: {stat}, {errorbar}")
    v = finite(value)
    n, sd = F.count(v), F.stddev_samp(v)
    centre = F.avg(v) if stat == "mean" else median(v)
    if errorbar == "iqr":
        low, high = F.percentile(v, F.lit(0.25)), F.percentile(v, F.lit(0.75))
    elif errorbar == "none":
        low = high = F.lit(None).cast("double")
    else:
        spread = sd / F.sqrt(n) if errorbar == "se" else sd
        low, high = centre - spread, centre + spread
    return rows.groupBy(*keys).agg(centre.alias("summary_value"), F.when(n >= 2, low).alias("lower"), F.when(n >= 2, high).alias("upper"), n.alias("n_units"))


def clamped_bars(bars: DataFrame, high: float) -> DataFrame:
    return bars.withColumns({c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(high)) for c in ("lower", "upper")})


def plot_limits(rows: DataFrame, keys: Sequence[str], value: str, kind: str, axis: str = "fixed") -> DataFrame:
    """Axis limits: 0..1 or 0..300 if fixed, else 1.12 times the largest value within the floor and cap of the kind."""
    top = F.coalesce(F.max(finite(value)), F.lit(0.0)) * 1.12
    if kind == "fraction":
        high = F.lit(1.0) if axis == "fixed" else F.least(F.lit(1.0), F.greatest(F.lit(0.05), top))
    elif kind == "h_score":
        high = F.lit(300.0) if axis == "fixed" else F.least(F.lit(300.0), F.greatest(F.lit(5.0), top))
    else:
        high = F.greatest(F.lit(1.0), top)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), high.alias("axis_max")).withColumn("axis_min", F.lit(0.0)).drop("n_rows")


def sample_metadata(rows: DataFrame, keys: Sequence[str] = (), unit: str = "biological_unit_id", condition: str = "condition") -> DataFrame:
    """Units, those in more than one condition, and the fewest and most units of a condition."""
    keys = list(keys)
    pairs = rows.select(*keys, unit, condition).distinct()
    units = pairs.groupBy(*keys, unit).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unique_units"), F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated_units"))
    sizes = pairs.groupBy(*keys, condition).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.min("n").alias("min_per_condition_n"), F.max("n").alias("max_per_condition_n"))
    return units.join(sizes, keys) if keys else units.crossJoin(sizes)  # a row each


def caption(meta: DataFrame) -> DataFrame:
    """A sentence on what the bars are, by the number of units a condition has."""
    single = F.col("max_per_condition_n") <= 1
    text = F.when(single, F.lit("One biological unit per condition: bars show single values without error bars.")).otherwise(
        F.concat(F.lit("Bars show biological units, n = "), F.col("min_per_condition_n"), F.when(F.col("min_per_condition_n") != F.col("max_per_condition_n"), F.concat(F.lit(" to "), F.col("max_per_condition_n"))).otherwise(F.lit("")), F.lit(" per condition."))
    )
    paired = F.when(F.col("n_repeated_units") > 0, F.concat(F.lit(" "), F.col("n_repeated_units"), F.lit(" units occur in more than one condition."))).otherwise(F.lit(""))
    return meta.withColumn("caption", F.concat(text, paired))
