"""Whole runs of a manifest: files and annotations to result tables.

Every image is read, segmented and measured in one pass; its rows, tagged by kind,
are written once, and all tables are made from them. Images that fail give rows of
the table of errors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import class_weight, finite, intensity_class, median
from tessella.operators import inputs, quantify, reports, segment, statistics as st, validation as va
from tessella.sources import images as im
from tessella.sources.manifest import ChannelRunOptions, StainRunOptions

#: Columns of a manifest that result tables carry, and the keys of compared groups (fixed values).
META = ("biological_unit_id", "condition", "field_id", "batch_id", "marker", "tissue_type")
EFFECT_KEYS = ("marker", "tissue_type", "batch_id", "compartment", "cell_scoring_domain")
#: Columns of a cell by scoring domain (fixed values).
SCORED = {"nucleus": "nuclear", "cytoplasm": "cytoplasm", "whole_cell": "whole_cell"}
JPEG = r"(?i)\.jpe?g$"
#: A manifest of more rows meets its files by shuffling, not by broadcast.
BROADCAST_IMAGES = 100_000


def is_file(spark: SparkSession, name: str) -> bool:
    """Whether a path, also one that ends as a folder's, is a file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name) if name else None
    files = path and path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(files) and files.exists(path) and files.getFileStatus(path).isFile()


def files_of(spark: SparkSession, manifest: DataFrame, base: str, column: str = "source_file") -> DataFrame:
    """The manifest with ``path`` and ``content`` of its files; ``content`` is null where a file wasn't found.

    Folders of the manifest are listed by Spark, which reads only files that meet a row.
    A ZIP archive stands for a folder: ``tiles.zip/a.png`` names a TIFF or PNG file at its top.
    """
    plain = F.regexp_replace("path", "^file:/+", "/").alias("path")
    named = manifest.withColumn("path", inputs.path_in(column, base)).withColumn("path", plain)
    folders = sorted(r.f for r in named.select(F.regexp_replace("path", r"[^/\\]*$", "").alias("f")).distinct().collect())  # folders, not files
    archives = [f for f in folders if is_file(spark, f)]
    folders = [f for f in folders if f not in set(archives)]
    read = spark.read.format("binaryFile").option("ignoreMissingFiles", True)
    found = read.load(folders).select(plain, "content") if folders or not archives else None
    if folders and not named.where(F.col("path").rlike(JPEG)).isEmpty():  # decoded by Spark's own source
        decoded = spark.read.format("image").load(folders).select(F.regexp_replace("image.origin", "^file:/+", "/").alias("path"), im.jpeg_content().alias("content"))
        found = found.where(~F.col("path").rlike(JPEG)).unionByName(decoded.where(F.col("path").rlike(JPEG) & F.col("content").isNotNull()))
    if archives:
        packed = im.image_files(spark, archives).select(plain, "content")
        found = packed if found is None else found.unionByName(packed)
    rows = named.count()
    if rows <= BROADCAST_IMAGES:
        found = found.join(F.broadcast(named.select("path").distinct()), "path", "left_semi")
        met = found.join(F.broadcast(named), "path")
    else:
        met = found.join(named, "path")
    lost = named.join(found.select("path"), "path", "left_anti").withColumn("content", F.lit(None).cast("binary"))
    return met.unionByName(lost)


def with_polygons(images: DataFrame, vertices: DataFrame | None) -> DataFrame:
    """Images with ``polygons``: an array of ``quantify.POLYGON``, null without annotations. An image has few of them."""
    if vertices is None:
        return images.withColumn("polygons", F.lit(None).cast(f"array<{quantify.POLYGON}>"))
    names = ("compartment", "action", "selection_source", "selection_method", "reviewer", "annotation_status")
    outline = vertices.groupBy("image_id", "roi_id").agg(F.array_sort(F.collect_list(F.struct("vertex_order", "x", "y"))).alias("v"), *(F.first(c).alias(c) for c in names))
    polygon = F.struct("roi_id", *names, F.col("v.x").alias("x"), F.col("v.y").alias("y"))
    return images.join(outline.groupBy("image_id").agg(F.collect_list(polygon).alias("polygons")), "image_id", "left")


def tag_stained(images: DataFrame, o: StainRunOptions) -> DataFrame:
    """Tagged rows of brightfield images: image_id, path, content, pixel_size_um, polygons."""

    def measured(row) -> list[dict]:
        if row.content is None:
            raise FileNotFoundError(row.path)
        rgb = im.rgb_image(row.content, o.max_image_pixels)
        h, w = rgb.shape[:2]
        e = o.effective(row.pixel_size_um)
        rois = quantify.roi_masks(w, h, row.polygons if row.polygons is not None else [])
        stain, dab, total = segment.unmixed(rgb, rois.analysis, o.white_quantile)
        s = segment.StainOptions(
            blur=e["nucleus_blur"], min_area=e["nucleus_min_area"], max_area=e["nucleus_max_area"], min_circularity=o.nucleus_min_circularity, max_eccentricity=o.nucleus_max_eccentricity,
            min_mean=o.nucleus_min_h_mean, margin=e["border_margin"], reach=e["cell_reach"], tissue_od=o.tissue_od_min, tissue_closing=o.tissue_close_radius_px,
        )
        tissue = segment.stain_tissue(total, rois.analysis, s)
        nuclei = segment.stain_nuclei(stain, tissue, s)
        cells = segment.stain_cells(total, nuclei, tissue, rois.analysis, s)
        cuts = quantify.CellOptions(o.dab_threshold_negative, o.use_local_background, e["background_inner"], e["background_outer"], o.local_background_min_pixels)
        named = {"GLOBAL": {"compartment": "global", "selection_source": "automatic", "selection_method": "whole_tissue"}} | {r["roi_id"]: r for r in rois.rows if r["action"] == "include"}
        masks = {"GLOBAL": rois.analysis} | rois.regions
        regions = [{"roi_id": n, **{c: named[n][c] for c in ("compartment", "selection_source", "selection_method")}, **quantify.measure_region(dab, nuclei, cells, masks[n] & tissue, cuts.threshold)} for n in masks]
        whole = {"roi_id": "GLOBAL", **named["GLOBAL"], "action": "include", "reviewer": None, "annotation_status": "selected", "n_vertices": 0, "x_min": 1.0, "x_max": float(w), "y_min": 1.0, "y_max": float(h), "selected_area_px": int(tissue.sum())}
        image = {"width_px": w, "height_px": h, "tissue_fraction": float(tissue.mean()), "background_od": quantify.number(quantify.field_background(dab, tissue, cells)), "focus_score": quantify.focus(rgb.mean(-1)), "nucleus_threshold": segment.stain_threshold(stain, tissue, s), "n_overlaps": len(rois.overlaps), **e}
        found = quantify.measure_cells(dab, nuclei, cells, tissue, masks, cuts, stain)
        return quantify.tagged_rows(row.image_id, cell=found, region=regions, roi=[whole, *rois.rows], overlap=rois.overlaps, image=[image])

    return quantify.each_image(images.select(F.col("image_id").cast("string").alias("image_id"), "path", "content", F.col("pixel_size_um").cast("double").alias("pixel_size_um"), "polygons"), measured)


def domain_scores(prefix: str, od: str, cuts: tuple[float, ...]) -> list[Column]:
    """Of the cells of a group: the share at the first cut or above (a cell without a value is below), H-score, mean and median."""
    v = finite(od)
    return [
        F.avg(F.coalesce(v >= cuts[0], F.lit(False)).cast("int")).alias(f"{prefix}positive_cell_fraction"),
        (F.lit(100.0) * F.avg(class_weight(intensity_class(od, cuts)))).alias(f"{prefix}h_score"),
        F.avg(v).alias(f"{prefix}mean_cell_dab_od"),
        median(v).alias(f"{prefix}median_cell_dab_od"),
    ]


def comparison(manifest: DataFrame, given: str | None) -> tuple[str, str] | None:
    """Reference and comparison condition: as ``given`` ("a,b", both of the manifest), else those of a manifest with two, in the order they come in; None with more or fewer."""
    first = manifest.select("condition", F.monotonically_increasing_id().alias("at")).groupBy("condition").agg(F.min("at").alias("at"))
    if given is not None:
        names = [c.strip() for c in given.split(",")]
        if len(names) != 2 or not all(names):
            raise ValueError("the condition order must name exactly two conditions")
        if first.where(F.col("condition").isin(*names)).count() != len(set(names)) or names[0] == names[1]:
            raise ValueError(f"the condition order names conditions that the manifest lacks: {given}")
        return names[0], names[1]
    few = first.orderBy("at").limit(3).collect()
    return (few[0].condition, few[1].condition) if len(few) == 2 else None


@dataclass
class StainRun:
    """The result tables of a brightfield run, by name."""

    tables: dict[str, DataFrame]
    n_images: int
    n_failed: int


def stain_tables(tagged: DataFrame, manifest: DataFrame, o: StainRunOptions, compared: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """All tables of a run from its tagged rows and manifest (image_id, ``META``, pixel_size_um, source_file)."""
    meta = manifest.select("image_id", *META)
    cuts, domain = o.dab_thresholds, SCORED[o.cell_scoring_domain]
    image = quantify.rows_of(tagged, "image")
    cells = quantify.rows_of(tagged, "cell")
    classes = {f"{d}_intensity_class": intensity_class(f"{d}_dab_mean_od", cuts) for d in quantify.CELL_DOMAINS} | {f"{d}_cell_positive": F.coalesce(finite(f"{d}_dab_mean_od") >= cuts[0], F.lit(False)) for d in quantify.CELL_DOMAINS}
    chosen = {s: F.col(f"{domain}_{s}") for s in ("dab_mean_od", "dab_median_od", "dab_q90_od", "dab_positive_area_fraction", "dab_positive_mean_od")} | {"intensity_class": F.col(f"{domain}_intensity_class"), "cell_positive": F.col(f"{domain}_cell_positive")}
    cells = cells.withColumns(classes).withColumns(chosen).withColumns({"cell_scoring_domain": F.lit(o.cell_scoring_domain), "cytoplasm_to_nucleus": F.col("cytoplasm_area_px") / F.greatest("nucleus_area_px", F.lit(1.0))})
    scores = cells.select("*", F.explode("rois").alias("roi_id")).groupBy("image_id", "roi_id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.avg("local_background_od").alias("mean_local_background_od"),
        *(c for p, d in (("", domain), *((f"{d}_", d) for d in quantify.CELL_DOMAINS)) for c in domain_scores(p, f"{d}_dab_mean_od", cuts)),
    )
    regions = quantify.rows_of(tagged, "region").join(scores, ["image_id", "roi_id"], "left").fillna(0, ["n_cells"]).join(meta, "image_id").withColumn("cell_scoring_domain", F.lit(o.cell_scoring_domain))
    units = st.unit_summary(regions)
    counted = regions.where("roi_id = 'GLOBAL'").select("image_id", "n_cells")
    flagged = va.image_flags(image.join(counted, "image_id").join(manifest.select("image_id", "pixel_size_um"), "image_id"), o.minimum_tissue_fraction_for_qc, o.minimum_cells_for_qc, o.high_background_od_for_qc)
    quality = flagged.select(
        "image_id", "width_px", "height_px", (F.col("width_px").cast("long") * F.col("height_px")).alias("image_pixels"), "tissue_fraction", F.col("n_cells").alias("n_segmented_cells"), F.col("n_overlaps").alias("n_overlapping_include_roi_pairs"),
        F.col("background_od").alias("median_extracellular_background_od"), "focus_score", "scale_mode", F.when(F.col("scale_mode") == "physical_um", F.col("pixel_size_um")).alias("pixel_size_um"), "qc_flags", "manual_review_required",
    ).join(meta, "image_id")
    pending = ("segmentation_review", "threshold_review", "compartment_overlay_review", "background_review", "final_decision", "review_status")
    review = reports.review_template(quality, {c: c for c in ("image_id", "biological_unit_id", "condition", "batch_id", "marker", "tissue_type")} | {"automatic_qc_flags": "qc_flags"}, pending, ("reviewer", "comments"))
    roi = quantify.rows_of(tagged, "roi").withColumn("coordinate_space", F.lit("source_image_pixels"))
    membership = cells.select("image_id", "cell_id", F.explode(F.array_union(F.array(F.lit("GLOBAL")), "rois")).alias("roi_id")).join(roi.select("image_id", "roi_id", "compartment"), ["image_id", "roi_id"]).withColumn("inside_region", F.lit(True))
    tables = {
        "cell_measurements": cells.drop("rois").join(meta, "image_id"),
        "region_summary": regions,
        "image_qc": quality,
        "roi_registry": roi,
        "roi_overlap_audit": quantify.rows_of(tagged, "overlap"),
        "effective_image_parameters": image.select("image_id", "scale_mode", "nucleus_blur", "nucleus_min_area", "nucleus_max_area", "border_margin", "cell_reach", "background_inner", "background_outer", "nucleus_threshold"),
        "cell_region_membership": membership,
        "biological_unit_summary": units,
        "primary_domain_summary_long": st.primary_long(units),
        "design_summary": st.design_summary(regions),
        "manual_qc_template": review,
        "image_errors": tagged.where("kind = 'error'").select("image_id", "error").join(manifest.select("image_id", "source_file"), "image_id"),
    }
    if compared:
        effects = st.paired_effects(units, EFFECT_KEYS, list(st.METRIC_LABELS), *compared)
        label = F.create_map(*(F.lit(x) for item in st.METRIC_LABELS.items() for x in item))
        tables["paired_effects"] = effects.withColumn("metric_label", label[F.col("metric")])
    return tables


#: Order of rows in the written tables (fixed values).
ORDER = {
    "cell_measurements": ("biological_unit_id", "condition", "field_id", "image_id", "cell_id"),
    "region_summary": ("biological_unit_id", "condition", "field_id", "image_id", "compartment", "roi_id"),
    "biological_unit_summary": ("biological_unit_id", "condition", "compartment"),
    "primary_domain_summary_long": ("marker", "tissue_type", "batch_id", "biological_unit_id", "condition", "compartment", "measurement_domain"),
    "image_qc": ("image_id",),
}


def stain_run(spark: SparkSession, manifest: DataFrame, base: str, out: str, vertices: DataFrame | None = None, options: StainRunOptions | None = None, condition_order: str | None = None, kind: str = "csv") -> StainRun:
    """Run a manifest (as ``manifest.stain_manifest`` gives it) and write all tables below ``out``.

    The tagged rows go to ``work/tagged``, partitioned by kind, so that images are
    read and segmented once whatever is made of them. Raises if all images failed.
    """
    o = options or StainRunOptions()
    compared = comparison(manifest, condition_order)
    images = with_polygons(files_of(spark, manifest.select("image_id", "source_file", "pixel_size_um"), base), vertices)
    tag_stained(images, o).write.mode("overwrite").partitionBy("kind").parquet(f"{out}/work/tagged")
    tagged = spark.read.schema(quantify.TAGGED).parquet(f"{out}/work/tagged")
    count = {r.kind: r["count"] for r in tagged.where("kind in ('image', 'error')").groupBy("kind").count().collect()}
    if not count.get("image"):
        reports.write_table(tagged.where("kind = 'error'").select("image_id", "error"), f"{out}/work/image_errors", "tsv")
        raise RuntimeError(f"all images failed; see {out}/work/image_errors")
    tables = stain_tables(tagged, manifest, o, compared)
    for name, table in tables.items():
        flat = table.select(*(F.array_join(c, ";").alias(c) if t.startswith("array") else c for c, t in table.dtypes))
        reports.write_table(flat, f"{out}/{'work' if name == 'image_errors' else 'source_data'}/{name}", kind, [c for c in ORDER.get(name, ()) if c in flat.columns])
    reports.write_table(reports.metric_dictionary(spark), f"{out}/source_data/metric_dictionary", kind)
    used = spark.createDataFrame([(n, ";".join(map(str, v)) if isinstance(v, tuple) else str(v)) for n, v in vars(o).items()], "parameter string, value string")
    reports.write_table(used, f"{out}/config/analysis_parameters_used", kind)
    reports.write_table(manifest, f"{out}/config/image_manifest_used", kind)
    if vertices is not None:
        reports.write_table(vertices, f"{out}/config/roi_annotations_used", kind)
    return StainRun(tables, count["image"], count.get("error", 0))


# fluorescence


class BlockedByQuality(RuntimeError):
    """Images failed quality control: their tables are written, the run counts as blocked."""


def channel_images(spark: SparkSession, channels: DataFrame, base: str, vertices: DataFrame | None) -> DataFrame:
    """A row for each image: path, content, its channels by index, polygons."""
    one = F.struct(*(F.col(c).alias(c) for c in ("channel_index", "channel_name", "channel_role", "marker", "pixel_size_um")))
    images = channels.groupBy("image_id").agg(F.array_sort(F.collect_list(one)).alias("channels"), F.min_by("file_path", "channel_index").alias("file_path"))
    return with_polygons(files_of(spark, images, base, "file_path"), vertices)


def tag_channels(images: DataFrame, o: ChannelRunOptions) -> DataFrame:
    """Tagged rows of fluorescence images: the first nucleus channel segments, every target is measured."""
    cuts = segment.FluorescenceOptions(
        nucleus_threshold="otsu" if o.nuc_threshold_method == "otsu" else o.value("nuc_threshold_value"), min_area=o.nuc_min_area, max_area=o.nuc_max_area, tolerance=o.nuc_watershed_tolerance,
        watershed_reach=o.nuc_watershed_ext, radius=o.cell_propagation_radius, radius_cap=o.max_cytoplasm_expansion_radius, gap=o.cytoplasm_boundary_gap_px,
    )
    spotted, spotted_channel = (re.compile(p.removeprefix("(?i)"), re.I) for p in (va.PUNCTA_MARKER, va.PUNCTA_CHANNEL))

    def measured(row) -> list[dict]:
        if row.content is None:
            raise FileNotFoundError(row.path)
        planes, depth = im.channel_planes(row.content, len(row.channels), o.z_mode, o.max_image_pixels)
        h, w = planes.shape[1:]
        rois = quantify.roi_masks(w, h, row.polygons if row.polygons is not None else [])
        include = np.any(list(rois.regions.values()), axis=0) if rois.regions else np.ones((h, w), dtype=bool)
        analysis = include & rois.analysis
        planes = np.where(analysis, planes, 0.0)
        named = {a: ";".join(sorted(r["roi_id"] for r in rois.rows if r["action"] == a)) or "NONE" for a in ("include", "exclude")}
        audit = {"included_roi_ids": named["include"], "excluded_roi_ids": named["exclude"], "roi_mask_status": "REVIEWED_ROI_APPLIED" if rois.rows else "NO_REVIEWED_ROI", "included_pixel_count": int(analysis.sum()), "excluded_pixel_count": int((~rois.analysis).sum()), "included_fraction": float(analysis.mean())}
        by_role = {}
        for i, c in enumerate(row.channels):
            by_role.setdefault(c["channel_role"], []).append((i, c))
        nuclear = quantify.corrected(planes[by_role["nucleus"][0][0]], o.bg_method, o.bg_radius, o.value("bg_value"))[0]
        guide = sorted((i for role in ("cytoplasm_reference", "structural_reference") for i, _ in by_role.get(role, [])))
        reference = planes[guide[0]] if guide else None
        nuclei = segment.fluorescence_nuclei(nuclear, cuts)
        cells = segment.fluorescence_cells(nuclear, nuclei, cuts, reference)
        tissue = segment.tissue_proxy(nuclear, reference, cuts.tissue_share)
        masks, n = quantify.compartment_masks(nuclei, cells, tissue), int(nuclei.max(initial=0))
        found = segment.segmentation_flags(n, float(tissue.mean()), reference is None)
        flags = (["REVIEWED_ROI_APPLIED"] if rois.rows else []) + ([] if found == "PASS" else found.split(";"))
        out: dict[str, list[dict]] = {"channel": [], "compartment": [], "cell": [], "puncta": [], "coloc": [], "roi": [audit]}
        for i, c in by_role["target"]:
            own = {"channel_name": c["channel_name"], "marker": c["marker"]}
            um = c["pixel_size_um"] if c["pixel_size_um"] is not None else 1.0
            less, back, method = quantify.corrected(planes[i], o.bg_method, o.bg_radius, o.value("bg_value"))
            quality = quantify.channel_quality(planes[i], less)
            cut = quantify.positivity(less, o.pos_threshold_method, o.value("pos_threshold_value"))
            flags += [f for f in (*quality["channel_qc_flags"].split(";"), "EMPTY_CHANNEL" if cut["threshold_value"] is None else "PASS") if f != "PASS"]
            out["channel"].append(own | quality | {"channel_role": "target", "channel_index": c["channel_index"], "n_planes": depth, "background_method": method, "background_estimated": back})
            out["compartment"] += [own | r for r in quantify.compartment_rows(less, masks, cut, um)]
            out["cell"] += [own | r for r in quantify.cell_rows(less, nuclei, cells, cut["threshold_value"], um)]
            if o.puncta_enabled or spotted.search(c["marker"] or "") or spotted_channel.search(c["channel_name"] or ""):
                out["puncta"] += [own | r for r in quantify.puncta_rows(less, masks, n, o.puncta_sigma1, o.puncta_sigma2, o.puncta_threshold_sd, um)]
        if len(by_role["target"]) >= 2:
            (i, a), (j, b) = by_role["target"][:2]
            out["coloc"].append(quantify.colocalisation_row(planes[i], planes[j], tissue, a["marker"], b["marker"]))
        shares = {f"{name}_area_fraction": float(masks[m].mean()) for name, m in (("nuclear", "nucleus"), ("cytoplasmic", "cytoplasm"), ("extracellular", "extracellular"))}
        image = {"n_cells": n, "effective_cell_propagation_radius": segment.guarded_radius(nuclei, cuts) if n else 0, **shares, "qc_flags": ";".join(dict.fromkeys(flags)) or "PASS"}
        return quantify.tagged_rows(row.image_id, image=[image], **out)

    return quantify.each_image(images.select(F.col("image_id").cast("string").alias("image_id"), "path", "content", "channels", "polygons"), measured, quantify.CHANNEL_KINDS)


def channel_tables(tagged: DataFrame, channels: DataFrame) -> dict[str, DataFrame]:
    """All tables of a fluorescence run from its tagged rows and its manifest of channels."""
    meta = channels.groupBy("image_id").agg(F.min_by("biological_unit_id", "channel_index").alias("biological_unit_id"), F.min_by("condition", "channel_index").alias("condition"), F.min_by("file_path", "channel_index").alias("file_path"))
    keys = meta.drop("file_path")
    part = {kind: quantify.rows_of(tagged, kind).join(keys, "image_id") for kind in quantify.CHANNEL_KINDS}
    failing = F.col("qc_flags").rlike(va.FAILING)
    quality = part["image"].withColumn("qc_status", F.when(failing, "FAIL_REVIEW_REQUIRED").otherwise("PASS"))
    long = part["compartment"].select("image_id", "biological_unit_id", "condition", "marker", F.col("compartment").alias("measurement_domain"), "mean_intensity", "median_intensity", "integrated_intensity", "positive_area_fraction")
    pending = ("HUMAN_APPROVED", "channel_mapping_approved", "segmentation_approved", "threshold_approved")
    return {
        "channel_summary": part["channel"],
        "compartment_summary": part["compartment"],
        "cell_summary": part["cell"],
        "image_qc": quality,
        "roi_exclusion_summary": part["roi"],
        "channel_metadata": channels.drop("file_path").join(quantify.rows_of(tagged, "roi").select("image_id", "roi_mask_status", "included_pixel_count", "excluded_pixel_count"), "image_id"),
        "biological_unit_summary": st.unit_means(part["compartment"]),
        "primary_domain_summary_long": long,
        "colocalization_summary": part["coloc"],
        "puncta_summary": part["puncta"],
        "manual_qc_template": reports.review_template(quality, {"image_id": "image_id"}, pending, ("reviewer", "review_date", "comments"), "PENDING"),
        "run_status": va.run_status(quality),
        "image_errors": tagged.where("kind = 'error'").select("image_id", "error").join(meta.select("image_id", "file_path"), "image_id"),
    }


def channel_run(spark: SparkSession, channels: DataFrame, base: str, out: str, vertices: DataFrame | None = None, options: ChannelRunOptions | None = None, condition_order: str | None = None, kind: str = "csv") -> StainRun:
    """Run a manifest of channels (as ``manifest.channel_manifest`` gives it) and write all tables below ``out``.

    Raises ``BlockedByQuality`` after writing if an image fails quality control, and
    an error if all images failed.
    """
    o = options or ChannelRunOptions()
    compared = comparison(channels, condition_order)
    tag_channels(channel_images(spark, channels, base, vertices), o).write.mode("overwrite").partitionBy("kind").parquet(f"{out}/work/tagged")
    tagged = spark.read.schema(quantify.tagged_schema(quantify.CHANNEL_KINDS)).parquet(f"{out}/work/tagged")
    count = {r.kind: r["count"] for r in tagged.where("kind in ('image', 'error')").groupBy("kind").count().collect()}
    if not count.get("image"):
        reports.write_table(tagged.where("kind = 'error'").select("image_id", "error"), f"{out}/work/image_errors", "tsv")
        raise RuntimeError(f"all images failed; see {out}/work/image_errors")
    tables = channel_tables(tagged, channels)
    if compared:
        tables["paired_effects"] = st.paired_effects(tables["biological_unit_summary"], ["marker", "compartment"], ["mean_intensity", "median_intensity", "positive_area_fraction"], *compared)
    for name, table in tables.items():
        reports.write_table(table, f"{out}/{'work' if name == 'image_errors' else 'source_data'}/{name}", kind, [c for c in ("image_id", "marker", "compartment", "cell_id") if c in table.columns])
    used = spark.createDataFrame([(n, str(v)) for n, v in vars(o).items()], "parameter string, value string")
    reports.write_table(used, f"{out}/config/analysis_parameters_used", kind)
    reports.write_table(channels, f"{out}/config/image_manifest_used", kind)
    try:
        va.require_pass(tables["run_status"])
    except RuntimeError as e:
        raise BlockedByQuality(str(e)) from e
    return StainRun(tables, count["image"], count.get("error", 0))
