"""Queries of the sources: Spark writes files made from the tables into a new folder, and the sources read them back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators import segment
from tessella.plans import runs
from tessella.plans.queries import OUTLINE_SQL, outlines, query, rounded
from tessella.plans.stand_ins import PX, table
from tessella.sources import images as im, manifest as mf
from tessella.sources.scratch import fresh_folder


def as_csv(df: DataFrame, name: str) -> str:
    path = fresh_folder(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path


def files(spark, d, encode, name: str) -> str:
    """A file for each embedding (``encode``: plane of 0 to 1 and its id to bytes), in ZIP archives in a folder of their own."""

    def run(frames):
        rows = (r for frame in frames for r in zip(frame["vec_id"], frame["embedding"], strict=True))
        made = ((f"image_id={i or ''}", encode((np.asarray(e, dtype="<f4").astype(float).reshape(8, 8) + 0.5).clip(0, 1), i and int(i))) for i, e in rows)
        for archive in im.zipped_files(made):
            yield pd.DataFrame({"content": [archive]})

    path = fresh_folder(spark, name)
    planes = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("vec_id"), "embedding").repartition(spark.sparkContext.defaultParallelism)
    # the text writer puts down the bytes of a row unchanged, and a line feed
    planes.mapInPandas(run, "content binary").select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def image_of_path() -> Column:
    return F.regexp_extract("path", r"image_id=(-?\d+)$", 1).try_cast("long")


@query("""SELECT 'S' || o_orderkey AS image_id, CAST(o_custkey AS VARCHAR) AS biological_unit_id, o_orderstatus AS condition, o_orderpriority AS field_id, 'img/' || o_orderkey || '.png' AS source_file, CASE WHEN o_orderkey % 3 = 0 THEN 'batch_1' ELSE 'b' || o_orderkey % 3 END AS batch_id, 'unspecified_marker' AS marker,
'unspecified_tissue' AS tissue_type, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 5) / 8.0::DOUBLE END AS pixel_size_um, o_orderkey % 7 = 0 AS is_negative_control FROM orders WHERE o_orderstatus <> 'P'""")
def source_stain_manifest(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("S"), k).alias("image_id"), F.col("o_custkey").alias("patient_id"), F.col("o_orderstatus").alias("condition"), F.col("o_orderpriority").alias("field"), F.concat(F.lit("img/"), k, F.lit(".png")).alias("source_file"),
        F.when(k % 3 > 0, F.concat(F.lit("b"), k % 3)).alias("batch_id"), F.when(F.col("o_orderstatus") == "P", "Exclude").when(k % 2 == 0, "INCLUDED").alias("analysis_status"), F.when(k % 5 > 0, (k % 5 / 8).cast("string")).otherwise("unknown").alias("pixel_size_um"),
        F.when(k % 7 == 0, "Yes").otherwise("no").alias("is_negative_control"),
    )
    return mf.stain_manifest(spark, as_csv(rows, "stain-manifest")).select("image_id", "biological_unit_id", "condition", "field_id", "source_file", "batch_id", "marker", "tissue_type", "pixel_size_um", "is_negative_control")


@query("""WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice))
SELECT 'F' || l_orderkey AS image_id, CAST(i AS INTEGER) AS channel_index, CASE i WHEN 1 THEN 'nucleus' WHEN 2 THEN 'target' ELSE 'other' END AS channel_role, 'm' || l_partkey AS marker, CASE WHEN l_partkey % 2 = 0 THEN 0.5::DOUBLE END AS pixel_size_um FROM l WHERE n >= 2""")
def source_channel_manifest(spark, d):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    rows = table(spark, d, "lineitem").withColumns({"i": F.row_number().over(order), "n": F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))}).where("n >= 2")
    role = F.when(F.col("i") == 1, "Nucleus").when(F.col("i") == 2, " target").otherwise("OTHER")
    rows = rows.select(
        F.concat(F.lit("F"), "l_orderkey").alias("image_id"), F.col("l_suppkey").alias("biological_unit_id"), F.col("l_linestatus").alias("condition"), F.lit("IF").alias("modality"), F.concat(F.lit("m"), "l_partkey").alias("marker"), F.concat(F.lit("ch"), "i").alias("channel_name"),
        F.col("i").alias("channel_index"), role.alias("channel_role"), F.lit("x.tif").alias("file_path"), F.when(F.col("l_partkey") % 2 == 0, "0.5").alias("pixel_size_um"),
    )
    return mf.channel_manifest(spark, as_csv(rows, "channel-manifest")).select("image_id", "channel_index", "channel_role", "marker", "pixel_size_um")


@query(f"WITH {OUTLINE_SQL} SELECT CAST(image_id AS VARCHAR) AS image_id, roi_id, CAST(vertex_order AS INTEGER) AS vertex_order, round(x, 6) AS x, y, 'include' AS action, CASE WHEN roi_id = 'A' THEN 'tumor' ELSE 'custom' END AS compartment, 'manual' AS selection_source, CASE WHEN roi_id = 'A' THEN 'r1' ELSE '' END AS reviewer FROM vy WHERE roi_id <> 'R'")
def source_roi_vertices(spark, d):
    named = F.col("roi_id") == "A"
    rows = outlines(spark, d).select("image_id", "roi_id", "vertex_order", "x", "y", F.lit("Include").alias("action"), F.when(named, "Tumor").alias("compartment"), F.when(named, "r1").alias("reviewer"), F.when(F.col("roi_id") == "R", "draft").otherwise("Approved").alias("annotation_status"))
    found = mf.roi_vertices(spark, as_csv(rows, "roi-vertices"))
    return rounded(found.withColumn("vertex_order", F.col("vertex_order").cast("long"))).select("image_id", "roi_id", F.col("vertex_order").cast("int").alias("vertex_order"), "x", "y", "action", "compartment", "selection_source", "reviewer")


@query("""SELECT 'stain' AS run, * FROM (SELECT unnest(['nucleus_min_area_px', 'minimum_cells_for_qc', 'use_local_background', 'cell_scoring_domain', 'white_quantile', 'dab_threshold_negative']) AS parameter, unnest([CAST(count(*) / 2.0::DOUBLE AS VARCHAR), CAST(count(*) AS VARCHAR), 'False', 'whole_cell', '0.98', '0.08']) AS value FROM region)
UNION ALL SELECT 'channel', * FROM (SELECT unnest(['bg_radius', 'puncta_enabled', 'z_mode', 'puncta_sigma1', 'pos_threshold_value']) AS parameter, unnest([CAST(count(*) AS VARCHAR), 'True', 'max_projection', '1.0', '']) AS value FROM nation)""")
def source_options(spark, d):
    regions, nations = (table(spark, d, n).agg(F.count(F.lit(1)).alias("n")) for n in ("region", "nation"))

    def rows(counted: DataFrame, values: dict) -> DataFrame:
        return counted.select(F.explode(F.array(*(F.struct(F.lit(p).alias("parameter"), v.cast("string").alias("value")) for p, v in values.items()))).alias("o")).select("o.*")

    n = F.col("n")
    stain = mf.read_options(spark, as_csv(rows(regions, {"nucleus_min_area_px": n / 2, "minimum_cells_for_qc": n, "use_local_background": F.lit("NO"), "cell_scoring_domain": F.lit("whole_cell"), "not_an_option": n, "white_quantile": F.lit(None)}), "options"), mf.StainRunOptions())
    channel = mf.read_options(spark, as_csv(rows(nations, {"bg_radius": n, "puncta_enabled": F.lit("true")}), "options"), mf.ChannelRunOptions())
    named = (("stain", stain, ("nucleus_min_area_px", "minimum_cells_for_qc", "use_local_background", "cell_scoring_domain", "white_quantile", "dab_threshold_negative")), ("channel", channel, ("bg_radius", "puncta_enabled", "z_mode", "puncta_sigma1", "pos_threshold_value")))
    return spark.createDataFrame([(run, p, str(getattr(o, p))) for run, o, names in named for p in names], "run string, parameter string, value string")


#: Pixel rows that a task passes on together, if no single plane has more (fixed value).
FRAME_PIXELS = 1 << 15


def pixel_frames(planes, columns: list[str]):
    """Frames of pixel rows of ``planes``: (values of ``columns``, height, width, {name: value of each pixel})."""
    held, n = [], 0

    def frame():
        sizes = [h * w for _, h, w, _ in held]
        yx = [np.divmod(np.arange(h * w), w) for _, h, w, _ in held]
        named = {c: pd.Series([ids[k] for ids, *_ in held]).repeat(sizes).to_numpy() for k, c in enumerate(columns)}
        return pd.DataFrame({**named, "x": np.concatenate([x for _, x in yx]), "y": np.concatenate([y for y, _ in yx]), **{c: np.concatenate([v[c] for *_, v in held]) for c in held[0][3]}})

    for plane in planes:
        held.append(plane)
        n += plane[1] * plane[2]
        if n >= FRAME_PIXELS:
            yield frame()
            held, n = [], 0
    if held:
        yield frame()


def level_rows(frame: DataFrame, columns: str) -> DataFrame:
    """Pixel rows of planes (``data``, float32 of 0 to 1) as whole levels of 16 bits."""
    names = columns.split()

    def run(frames):
        rows = (r for f in frames for r in f.astype({c: "Int64" for c in names}).itertuples(index=False))
        return pixel_frames((([getattr(r, c) for c in names], r.h, r.w, {"level": np.round(np.frombuffer(r.data, "<f4").astype(float) * 65535).astype("i8")}) for r in rows), names)

    kinds = ", ".join(f"{c} long" for c in names)
    return frame.select(*names, "h", "w", "data").mapInPandas(run, f"{kinds}, x long, y long, level long")


def quadrants(plane: np.ndarray) -> list[np.ndarray]:
    return [plane[y : y + 4, x : x + 4] for y in (0, 4) for x in (0, 4)]


@query(f"WITH {PX} SELECT image_id, (x // 4) + 1 AS channel_index, (y // 4) + 1 AS z, x % 4 AS x, y % 4 AS y, CAST(round_even(greatest(0, least(1, v + 0.5)) * 65535, 0) AS BIGINT) AS level FROM px")
def source_tiff_stack(spark, d):
    """ImageJ stacks of 2 channels and 2 planes, every second one deflated."""
    path = files(spark, d, lambda p, i: im.write_tiff(quadrants(p), description="ImageJ=1.53\nimages=4\nchannels=2\nslices=2\n", deflate=i is not None and i % 2 == 1), "tiff")
    stacks = im.stack_planes(im.read_pages(spark, path), im.image_files(spark, path).select("path", F.lit(2).alias("n_channels")))
    return level_rows(stacks.where("error is null").withColumns({"image_id": image_of_path(), "channel_index": F.col("channel_index").cast("long"), "z": F.col("z").cast("long")}), "image_id channel_index z")


@query(f"WITH {PX} SELECT image_id, (x // 4) + 1 AS channel_index, x % 4 AS x, y % 4 AS y, CAST(max(round_even(greatest(0, least(1, v + 0.5)) * 65535, 0)) AS BIGINT) AS level FROM px GROUP BY image_id, x // 4, x % 4, y % 4")
def source_channel_planes(spark, d):
    """The same stacks by a manifest's files, each channel's planes projected to their maximum."""
    path = files(spark, d, lambda p, i: im.write_tiff(quadrants(p), description="ImageJ=1.53\nimages=4\nchannels=2\nslices=2\n"), "tiff")
    found = im.image_files(spark, path).select(image_of_path().cast("string").alias("image_id"), "content")

    def run(frames):
        stacks = ((i, im.channel_planes(content, 2, "max_projection")[0]) for f in frames for i, content in zip(f["image_id"], f["content"], strict=True))
        return im.in_frames(((i, c, *p.shape, p.astype("<f4").tobytes()) for i, planes in stacks for c, p in enumerate(planes, 1)), ["image_id", "channel_index", "h", "w", "data"], "data")

    planes = found.mapInPandas(run, "image_id string, channel_index long, h int, w int, data binary")
    return level_rows(planes.withColumn("image_id", F.col("image_id").cast("long")), "image_id channel_index")


@query(f"WITH {PX}, c AS (SELECT image_id, x % 4 AS x, y % 4 AS y, 2 * (y // 4) + x // 4 AS q, CAST(round_even(greatest(0, least(1, v + 0.5)) * 255, 0) AS BIGINT) AS l FROM px) SELECT 'P' || image_id AS image_id, x, y, max(l) FILTER (q = 0) AS r, max(l) FILTER (q = 1) AS g, max(l) FILTER (q = 2) AS b FROM c GROUP BY 1, 2, 3")
def source_png(spark, d):
    """Colour files that a manifest names."""
    path = files(spark, d, lambda p, i: im.write_png(np.stack(quadrants(p)[:3], axis=-1)), "png")
    names = im.image_files(spark, path).select(F.concat(F.lit("P"), image_of_path()).alias("image_id"), F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("source_file"))
    manifest = spark.read.schema("image_id string, source_file string").option("header", True).csv(as_csv(names, "png-manifest"))
    found = runs.files_of(spark, manifest, path)

    def run(frames):
        images = ((i, np.round(im.rgb_image(content) * 255).astype("i8")) for f in frames for i, content in zip(f["image_id"], f["content"], strict=True))
        return pixel_frames((([i], *a.shape[:2], {c: a[..., k].ravel() for k, c in enumerate("rgb")}) for i, a in images), ["image_id"])

    return found.select("image_id", "content").mapInPandas(run, "image_id string, x long, y long, r long, g long, b long")


@query(f"WITH {PX}, m AS (SELECT image_id, x, y, v >= 0 AS f FROM px) SELECT image_id, x, y, f AS inside FROM m")
def source_external_mask(spark, d):
    """Masks as files, read as labels of their regions."""
    path = files(spark, d, lambda p, i: im.write_png((p >= 0.5).astype(float)), "mask")
    found = im.image_files(spark, path).select(image_of_path().cast("string").alias("image_id"), "content")

    def run(frames):
        masks = ((i, segment.external_mask(im.first_image(content)[..., 0], (8, 8)) > 0) for f in frames for i, content in zip(f["image_id"], f["content"], strict=True))
        return pixel_frames((([i], *m.shape, {"inside": m.ravel()}) for i, m in masks), ["image_id"])

    return found.mapInPandas(run, "image_id string, x long, y long, inside boolean").withColumn("image_id", F.col("image_id").cast("long"))
