"""Whole runs: from image planes to cells, regions, units and quality rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import finite, intensity_class, kernels
from tessella.operators import geometry, measure, pixels as px, segment, statistics as st, validation as va
from tessella.sources.manifest import Options


def with_exclusions(images: DataFrame, vertices: DataFrame | None) -> DataFrame:
    """Images with ``exclusions``: the polygons (arrays of x and y) that take pixels out of analysis. An image has few of them."""
    if vertices is None:
        return images.withColumn("exclusions", F.lit(None).cast("array<struct<x:array<double>,y:array<double>>>"))
    outline = vertices.where("action = 'exclude'").groupBy("image_id", "roi_id").agg(F.array_sort(F.collect_list(F.struct("vertex_order", "x", "y"))).alias("v"))
    polygons = outline.groupBy("image_id").agg(F.collect_list(F.struct(F.col("v.x").cast("array<double>").alias("x"), F.col("v.y").cast("array<double>").alias("y"))).alias("exclusions"))
    return images.join(polygons, "image_id", "left")


def stain_planes(images: DataFrame) -> DataFrame:
    """Planes haematoxylin, dab, od_sum and analysis of RGB planes (image_id, h, w, r, g, b, exclusions).

    Excluded pixels have no part in the white reference. An image of which nothing
    is left gives no row.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                rgb = np.stack([segment.plane(r, c) for c in "rgb"], axis=-1)
                analysis = np.ones(rgb.shape[:2], dtype=bool)
                for polygon in r.exclusions if r.exclusions is not None else []:
                    analysis &= ~kernels.polygon_mask(r.w, r.h, np.asarray(polygon["x"], float), np.asarray(polygon["y"], float))
                if not analysis.any():
                    continue
                haematoxylin, dab, total = segment.unmixed(rgb, analysis)
                planes = (("haematoxylin", haematoxylin), ("dab", dab), ("od_sum", total))
                rows.append({"image_id": r.image_id, "h": r.h, "w": r.w, **{n: np.ascontiguousarray(p).astype("<f4").tobytes() for n, p in planes}, "analysis": analysis.astype("u1").tobytes()})
            if rows:
                yield pd.DataFrame(rows)

    return images.select("image_id", "h", "w", "r", "g", "b", "exclusions").mapInPandas(run, f"image_id {segment.id_type(images)}, h int, w int, haematoxylin binary, dab binary, od_sum binary, analysis binary")


@dataclass
class Brightfield:
    """Tables of a brightfield run."""

    labels: DataFrame
    pixels: DataFrame
    cells: DataFrame
    regions: DataFrame
    quality: DataFrame


def brightfield(images: DataFrame, manifest: DataFrame, vertices: DataFrame | None = None, options: Options | None = None, stain: segment.StainOptions | None = None) -> Brightfield:
    """Segment, measure cells and summarise the whole image (GLOBAL) and every include ROI.

    ``vertices`` (image_id, roi_id, action, compartment, vertex_order, x, y) count
    pixels from 1. What they exclude is taken out before anything else, from the
    white reference on. Images may differ in size. Regions use raw optical
    densities; cells the ones less the field's background. These tables come from
    pixel rows; ``runs.stain_run`` makes the tables of a manifest in one pass.
    """
    o = options or Options()
    planes = stain_planes(with_exclusions(images, vertices))
    labels = segment.segment_stained(planes, stain)
    p = segment.label_pixels(labels).join(segment.plane_pixels(planes, "dab"), ["image_id", "x", "y"])
    inside = None
    if vertices is not None:
        inside = geometry.pixels_in_polygons(vertices.join(images.select("image_id", "w", "h"), "image_id"), "w", "h")
    field = measure.field_background(p, ["image_id"], "v")
    nuclear = p.where("cell_label > 0").join(field, "image_id")
    cells = measure.domain_stats(nuclear.where("nuc_label > 0"), ["image_id", "cell_label"], "v", "field_background", o.positive_threshold)
    shape = measure.moments(p.withColumn("cell_label", F.when(F.col("nuc_label") > 0, F.col("cell_label")).otherwise(0)), ["image_id"], "cell_label", "v").select("image_id", "cell_label", "area", "cx", "cy", "eccentricity")
    cells = shape.join(cells, ["image_id", "cell_label"], "left").withColumn("intensity_class", intensity_class("mean_od", o.dab_thresholds)).withColumnRenamed("cell_label", "cell_id")
    member = cells.select("image_id", F.lit("GLOBAL").alias("roi_id"), "cell_id")
    in_roi = p.withColumn("roi_id", F.lit("GLOBAL"))
    if inside is not None:
        chosen = inside.join(vertices.where("action = 'include'").select("image_id", "roi_id").distinct(), ["image_id", "roi_id"])
        in_roi = in_roi.unionByName(p.join(chosen, ["image_id", "x", "y"]).select(in_roi.columns))
        member = member.unionByName(geometry.cell_membership(cells.join(images.select("image_id", "w", "h"), "image_id"), chosen, "w", "h", p.where("tissue")))
    area = measure.four_domains(in_roi, ["image_id", "roi_id"], "v", o.positive_threshold)
    scores = measure.cell_scores(member.join(cells, ["image_id", "cell_id"]), ["image_id", "roi_id"], "mean_od", o.dab_thresholds)
    regions = area.join(scores, ["image_id", "roi_id"], "left").fillna(0, ["n_cells"]).join(manifest, "image_id")
    tissue = p.groupBy("image_id").agg(F.avg(F.col("tissue").cast("int")).alias("tissue_fraction"))
    overlaps = geometry.roi_overlaps(chosen).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_overlaps")) if inside is not None else field.select("image_id", F.lit(0).alias("n_overlaps"))
    counted = cells.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_cells"))
    q = tissue.join(field.withColumnRenamed("field_background", "background_od"), "image_id").join(counted, "image_id", "left").join(overlaps, "image_id", "left").fillna(0, ["n_cells", "n_overlaps"]).join(manifest.select("image_id", "pixel_size_um"), "image_id")
    q = q.withColumn("scale_mode", F.when(finite("pixel_size_um") > 0, "physical_um").otherwise("pixel_fallback"))
    quality = va.image_flags(q, o.minimum_tissue_fraction_for_qc, o.minimum_cells_for_qc, o.high_background_od_for_qc)
    return Brightfield(labels, p, cells, regions, quality)


@dataclass
class Fluorescence:
    """Tables of a fluorescence run."""

    labels: DataFrame
    compartments: DataFrame
    cells: DataFrame
    units: DataFrame


def fluorescence(planes: DataFrame, manifest: DataFrame, target: str = "target", options: Options | None = None, cuts: segment.FluorescenceOptions | None = None) -> Fluorescence:
    """Segment, threshold, and measure compartments and cells of one target channel; then unweighted unit means."""
    o = options or Options()
    labels = segment.segment_fluorescent(planes, cuts)
    p = segment.label_pixels(labels).join(segment.plane_pixels(planes, target), ["image_id", "x", "y"])
    level = px.positivity_threshold(p, ["image_id"], "v", o.pos_threshold_method, o.positive_threshold)
    scaled = p.join(level, "image_id").withColumn("over", F.when(finite("v") >= F.col("threshold"), 1.0).otherwise(0.0))
    nuclear, cell = F.col("nuc_label") > 0, F.col("cell_label") > 0
    masks = {"global": F.lit(True), "nucleus": nuclear, "cytoplasm": cell & ~nuclear, "cell": cell, "extracellular": F.col("tissue") & ~cell}
    stats = measure.compartment_stats(scaled, ["image_id"], "v", masks, float("inf"))
    share = measure.compartment_stats(scaled, ["image_id"], "over", masks, 0.5).select("image_id", "compartment", F.col("positive_fraction").alias("positive_area_fraction"))
    compartments = stats.drop("positive_count", "positive_fraction").join(share, ["image_id", "compartment"]).join(manifest, "image_id")
    cells = measure.single_cells(scaled, ["image_id", "threshold"], "v", 0.0).withColumn("is_positive_cell", F.col("cell_mean") >= F.col("threshold"))
    return Fluorescence(labels, compartments, cells, st.unit_means(compartments))
