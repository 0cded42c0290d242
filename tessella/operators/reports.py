"""Dictionaries, review templates, figure manifests, figures and table sinks of a run."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import finite
from tessella.operators import statistics as st

#: Measurement domain, metric, type, range, figure and meaning (fixed values).
METRIC_DICTIONARY = (
    ("global", "tissue_positive_area_fraction", "pixel_based", "0_to_1", "01_global_dab_burden", "DAB-positive fraction of analyzed tissue pixels"),
    ("nucleus", "nuclear_h_score", "cell_based", "0_to_300", "02_nuclear_h_score", "Nuclear cell intensity-class H-score"),
    ("cytoplasm", "cytoplasm_h_score", "cell_based", "0_to_300", "03_cytoplasmic_h_score", "Cytoplasmic cell intensity-class H-score"),
    ("extracellular", "extracellular_positive_area_fraction", "pixel_based", "0_to_1", "04_extracellular_dab_burden", "DAB-positive fraction of tissue pixels outside propagated cells"),
)
DICTIONARY_COLUMNS = ("measurement_domain", "default_metric", "metric_type", "valid_range", "default_figure", "interpretation")


def metric_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRIC_DICTIONARY, ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS))


def review_template(images: DataFrame, copied: Mapping[str, str], pending: Sequence[str], empty: Sequence[str], word: str = "pending") -> DataFrame:
    """A row for each image with columns to fill in: ``copied`` (name: source), pending ones and empty ones."""
    return images.select(*(F.col(s).alias(n) for n, s in copied.items()), *(F.lit(word).alias(c) for c in pending), *(F.lit("").alias(c) for c in empty))


def figure_manifest(long: DataFrame, groups: Sequence[str], axis: str = "fixed", errorbar: str = "se") -> DataFrame:
    """A row for each group and domain: finite values, status, axis, sample numbers and file names."""
    keys = [*groups, "measurement_domain", "metric"]
    value = finite("value")
    shown = long.withColumn("value", value)
    counts = shown.groupBy(*keys).agg(F.count("value").alias("finite_value_count"), F.coalesce(F.max("value"), F.lit(0.0)).alias("top"))
    meta = st.sample_metadata(shown.where("value is not null"), keys)
    d = counts.join(meta, keys, "left").fillna(0, ["n_unique_units", "n_repeated_units", "min_per_condition_n", "max_per_condition_n"])
    h_score = F.col("metric").contains("h_score")
    scaled = F.when(h_score, F.least(F.lit(300.0), F.greatest(F.lit(5.0), F.col("top") * 1.12))).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.05), F.col("top") * 1.12)))
    high = F.when(h_score, 300.0).otherwise(1.0) if axis == "fixed" else scaled
    bars = F.lit("DISABLED") if errorbar == "none" else F.when(F.col("max_per_condition_n") >= 2, "SHOWN_WHERE_N_GE_2").otherwise("NOT_SHOWN_N_LT_2")
    stem = F.concat(F.lit("main_"), F.element_at(F.create_map(*(F.lit(x) for m in METRIC_DICTIONARY for x in (m[0], m[4]))), F.col("measurement_domain")))
    return d.select(
        *keys, "finite_value_count", F.when(F.col("finite_value_count") > 0, "PLOTTED").otherwise("NO_FINITE_VALUES_PLACEHOLDER").alias("plot_status"), F.lit(axis).alias("axis_mode"), F.lit(0.0).alias("y_axis_min"), high.alias("y_axis_max"),
        "n_unique_units", "n_repeated_units", "min_per_condition_n", "max_per_condition_n", bars.alias("errorbar_status"), *(F.concat(stem, F.lit(f".{e}")).alias(e) for e in ("png", "svg", "pdf")), F.concat(stem, F.lit("_source_data.csv")).alias("source_data"),
    )


#: Bars of a figure; more are an error, as none is left out.
MOST_BARS = 500


def bar_svg(bars: DataFrame, title: str, high: float, condition: str = "condition", width: int = 480, height: int = 320) -> str:
    """An SVG bar chart with error bars of an aggregated table of MOST_BARS rows at most."""
    rows = bars.orderBy(condition).limit(MOST_BARS + 1).collect()
    if len(rows) > MOST_BARS:
        raise ValueError(f"a figure of over {MOST_BARS} bars")
    step, base = (width - 80) / max(len(rows), 1), height - 50

    def y(v: float) -> float:
        return base - (base - 40) * max(0.0, min(v, high)) / high

    parts = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" font-family="sans-serif" font-size="12">', f'<text x="{width / 2}" y="20" text-anchor="middle">{html.escape(title)}</text>', f'<path d="M60 40V{base}H{width - 20}" fill="none" stroke="black"/>', f'<text x="55" y="44" text-anchor="end">{high:g}</text><text x="55" y="{base}" text-anchor="end">0</text>']
    for i, r in enumerate(rows):
        x = 60 + step * (i + 0.5)
        if r.summary_value is not None:
            parts.append(f'<rect x="{x - step * 0.3:.1f}" y="{y(r.summary_value):.1f}" width="{step * 0.6:.1f}" height="{base - y(r.summary_value):.1f}" fill="#8aa"/>')
        if r.lower is not None:
            parts.append(f'<path d="M{x:.1f} {y(r.lower):.1f}V{y(r.upper):.1f}" stroke="black"/>')
        parts.append(f'<text x="{x:.1f}" y="{base + 18}" text-anchor="middle">{html.escape(str(r[condition]))} (n={r.n_units})</text>')
    return "".join([*parts, "</svg>"])


def write_table(df: DataFrame, path: str, kind: str = "parquet", order: Sequence[str] = ()) -> None:
    """Write a result table as Parquet, CSV (gzip) or TSV; ordered only here."""
    out = df.orderBy(*order) if order else df
    if kind == "parquet":
        out.write.mode("overwrite").parquet(path)
    elif kind in ("csv", "tsv"):
        out.write.mode("overwrite").option("header", True).option("sep", "," if kind == "csv" else "\t").option("compression", "gzip").csv(path)
    else:
        raise ValueError(f"unknown kind of table: {kind}")
