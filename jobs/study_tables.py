"""Study tables from measured cells: images, biological units and paired effects, by batch.

    python -m jobs.study_tables --cells=PATH --images=PATH --out=FOLDER [--batch=NAME] [--config=FILE]

Reads a table of cells and a manifest of images (Parquet), keeps the included images,
scores their cells, flags those with few, weights images by cells into units, and
compares two conditions within units. Writes three tables partitioned by batch:
``images``, ``units`` and ``effects``. A run for one batch replaces its partitions
only; a run without ``--batch`` replaces all. Both give the same again when repeated.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, mapped, session, settings_of
from tessella.functions import weighted_mean
from tessella.operators import measure, statistics as st, validation as va

SHIPPED = "study_tables.csv"
METRICS = ("positive_cell_fraction", "h_score", "mean_cell_od")


def image_table(cells: DataFrame, images: DataFrame, cuts: tuple[float, ...], least: int) -> DataFrame:
    """Every included image with its cell scores and flags; an image without cells stays, with none."""
    scores = measure.cell_scores(cells, ["image_id"], "mean_od", cuts).drop("median_cell_od")
    area = cells.groupBy("image_id").agg(F.sum("area_px").alias("cell_area_px"))
    out = images.join(scores, "image_id", "left").join(area, "image_id", "left").fillna(0, ["n_cells", "cell_area_px"])
    flags = F.when(F.col("n_cells") == 0, "NO_CELLS").when(F.col("n_cells") < least, "LOW_CELL_COUNT").otherwise("PASS")
    return out.withColumn("qc_flags", flags)


def unit_table(images: DataFrame) -> DataFrame:
    """Units by batch and condition: images with cells count by their number of cells."""
    return images.where("n_cells > 0").groupBy("batch_id", "biological_unit_id", "condition").agg(
        F.count(F.lit(1)).alias("n_images"), F.sum("n_cells").alias("n_cells"), F.sum("cell_area_px").alias("cell_area_px"), *(weighted_mean(m, "n_cells").alias(m) for m in METRICS)
    )


def run(spark: SparkSession, cells_path: str, images_path: str, out: str, settings: Mapping[str, str], batch: str | None = None) -> None:
    """The whole job. Raises if an image_id occurs twice among the included images."""
    cuts = tuple(float(x) for x in settings["dab_thresholds"].split(";"))
    read, listed = Observation("cells"), Observation("images")
    cells = mapped(spark.read.parquet(cells_path).observe(read, F.count(F.lit(1)).alias("rows")), settings, "cells")
    images = mapped(spark.read.parquet(images_path).observe(listed, F.count(F.lit(1)).alias("rows")), settings, "images")
    images = va.included(va.fill_defaults(images, {"batch_id": "batch_1", "analysis_status": "include"})).drop("analysis_status")
    if batch:
        images = images.where(F.col("batch_id") == batch)
    again = va.duplicate_keys(images, ["image_id"]).head(1)
    if again:
        raise ValueError(f"image_id occurs more than once: {again[0].image_id}")

    def write(table: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}"
        table.repartition("batch_id", F.pmod(F.xxhash64(*table.columns), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if batch else "static").partitionBy("batch_id").parquet(path)
        written = read_table(spark, out, name, table)
        log.info("wrote %d rows to %s", written.where(F.col("batch_id") == batch).count() if batch else written.count(), path)
        return written.where(F.col("batch_id") == batch) if batch else written

    per_image = write(image_table(cells, images, cuts, int(settings["minimum_cells"])), "images")
    log.info("read %d cells from %s, %d images from %s", read.get["rows"], cells_path, listed.get["rows"], images_path)
    units = write(unit_table(per_image), "units")
    effects = st.paired_effects(units, ["batch_id"], METRICS, settings["reference_condition"], settings["comparison_condition"], p_values=False)
    write(effects, "effects")


def read_table(spark: SparkSession, out: str, name: str, like: DataFrame) -> DataFrame:
    """A table read back with its own types (a batch may look like a number)."""
    return spark.read.schema(like.schema).parquet(f"{out}/{name}").select(like.columns)


def whole_output(spark: SparkSession, out: str) -> DataFrame:
    """All three tables as one: level, batch_id, condition, subject, metric, value, status."""
    def tall(name: str, level: str, condition: str, subject: str, metrics: tuple[str, ...], metric: str, status: str) -> DataFrame:
        df = spark.read.option("mergeSchema", False).parquet(f"{out}/{name}")
        each = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v")) for m in metrics)))
        return df.withColumn("e", each).select(F.lit(level).alias("level"), F.col("batch_id").cast("string").alias("batch_id"), F.expr(condition).alias("condition"), F.expr(subject).alias("subject"), F.expr(metric).alias("metric"), F.col("e.v").alias("value"), F.expr(status).alias("status"))

    images = tall("images", "image", "condition", "image_id", ("n_cells", "cell_area_px", *METRICS), "e.m", "qc_flags")
    units = tall("units", "unit", "condition", "biological_unit_id", ("n_images", "n_cells", "cell_area_px", *METRICS), "e.m", "'PASS'")
    effects = tall("effects", "effect", "comparison_condition || '-' || reference_condition", "metric", ("n_paired_units", "n_higher_in_comparison", "mean_paired_difference", "median_paired_difference"), "e.m", "inferential_status")
    return images.unionByName(units).unionByName(effects)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.study_tables", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("cells", "images", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--batch")
    parser.add_argument("--config")
    a = parser.parse_args(arguments)
    spark = session("study_tables")
    try:
        run(spark, a.cells, a.images, a.out, settings_of(spark, a.config, SHIPPED), a.batch)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
