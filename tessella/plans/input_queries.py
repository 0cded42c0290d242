"""Queries of the input checks: orders stand for images, line items for annotation vertices or channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import inputs
from tessella.plans.queries import query
from tessella.plans.stand_ins import table

MANIFEST_SQL = """m AS (SELECT CAST(o_orderkey - CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS image_id, CASE WHEN o_custkey % 211 <> 0 THEN o_custkey END AS unit, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS state,
'/data/slides/' || o_orderkey || CASE WHEN o_orderkey % 31 = 0 THEN '.SVS' ELSE '.tif' END AS f, o_orderkey AS k FROM orders)"""
ROI_SQL = """r AS (SELECT CAST(l_orderkey + CASE WHEN l_orderkey % 101 = 0 THEN 10000000 ELSE 0 END AS VARCHAR) AS image_id, l_returnflag AS roi_id, l_partkey % 997 = 0 AS bad, CASE WHEN l_linestatus = 'F' THEN ' Include' WHEN l_tax > 0.07 THEN 'drop' ELSE 'EXCLUDE' END AS a,
CASE WHEN l_linenumber = 7 THEN 'draft' WHEN l_suppkey % 50 = 49 THEN 'maybe' ELSE 'approved' END AS st, l_returnflag = 'A' AS named, CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_suppkey % 9 = 1 THEN 'automatic' ELSE 'manual' END AS src, CASE WHEN l_suppkey % 4 = 0 THEN ' ' ELSE 'r' END AS rev FROM lineitem),
g AS (SELECT image_id || '/' || roi_id AS id, count(*) AS n, bool_or(named AND coalesce(src, 'automatic') = 'automatic') AS no_src, bool_or(named AND rev = ' ') AS no_rev,
count(DISTINCT a) > 1 OR count(DISTINCT st) > 1 OR count(DISTINCT coalesce(src, '?')) > 1 OR count(DISTINCT rev) > 1 AS varies FROM r GROUP BY 1)"""


def stain_rows(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        (k - F.when(k % 50 == 1, 1).otherwise(0)).cast("string").alias("image_id"),
        F.when(F.col("o_custkey") % 211 != 0, F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("condition"),
        F.col("o_orderpriority").alias("field"),
        F.concat(F.lit("slides/"), k, F.when(k % 31 == 0, ".SVS").otherwise(".tif")).alias("source_file"),
        F.when(k % 13 == 0, "-1").when(k % 17 == 0, "n/a").otherwise("0.5").alias("pixel_size_um"),
    )


def roi_rows(spark, d):
    k, s = F.col("l_orderkey"), F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        (k + F.when(k % 101 == 0, 10000000).otherwise(0)).cast("string").alias("image_id"),
        F.col("l_returnflag").alias("roi_id"),
        F.col("l_linenumber").alias("vertex_order"),
        F.when(F.col("l_partkey") % 997 == 0, "x").otherwise(F.col("l_quantity").cast("string")).alias("x"),
        F.col("l_discount").cast("string").alias("y"),
        F.when(F.col("l_linestatus") == "F", " Include").when(F.col("l_tax") > 0.07, "drop").otherwise("EXCLUDE").alias("action"),
        F.when(F.col("l_linenumber") == 7, "draft").when(s % 50 == 49, "maybe").otherwise("approved").alias("annotation_status"),
        F.when(F.col("l_returnflag") == "A", "Tumor").otherwise("custom").alias("compartment"),
        F.when(s % 9 == 0, None).when(s % 9 == 1, "automatic").otherwise("manual").alias("selection_source"),
        F.when(s % 4 == 0, " ").otherwise("r").alias("reviewer"),
    )


@query(f"""WITH {MANIFEST_SQL}, {ROI_SQL}
SELECT 'WARNING' AS level, 'image' AS scope, image_id AS id, 'MISSING_PIXEL_SIZE' AS issue, 'Physical calibration unavailable.' AS detail FROM m WHERE k % 13 = 0 OR k % 17 = 0
UNION ALL SELECT 'ERROR', 'image', image_id, 'NATIVE_WSI_NOT_SUPPORTED', 'Export tiles or regions first.' FROM m WHERE k % 31 = 0
UNION ALL SELECT 'ERROR', 'image', image_id, 'SOURCE_FILE_NOT_FOUND', f FROM m WHERE k % 7 = 0
UNION ALL SELECT 'ERROR', 'image', image_id, 'DUPLICATE_IMAGE_ID', '' FROM m GROUP BY image_id HAVING count(*) > 1
UNION ALL SELECT 'ERROR', 'manifest', 'ALL', 'MISSING_BIOLOGICAL_UNIT_ID', '' FROM m HAVING count(*) > count(unit)
UNION ALL SELECT 'ERROR', 'manifest', 'ALL', 'MISSING_CONDITION', '' FROM m HAVING bool_or(state = '')
UNION ALL SELECT 'ERROR', 'roi', image_id, 'ROI_IMAGE_ID_NOT_IN_MANIFEST', '' FROM r WHERE image_id NOT IN (SELECT image_id FROM m) GROUP BY image_id
UNION ALL SELECT 'ERROR', 'roi', 'ALL', 'NON_NUMERIC_ROI_COORDINATE', '' FROM r HAVING bool_or(bad)
UNION ALL SELECT 'WARNING', 'roi', 'ALL', 'DRAFT_OR_REJECTED_ROIS_WILL_BE_IGNORED', CAST(count(*) AS VARCHAR) FROM r WHERE st = 'draft' HAVING count(*) > 0
UNION ALL SELECT DISTINCT 'ERROR', 'roi', 'ALL', 'INVALID_ROI_ACTION', a FROM r WHERE a = 'drop'
UNION ALL SELECT DISTINCT 'ERROR', 'roi', 'ALL', 'INVALID_ANNOTATION_STATUS', st FROM r WHERE st = 'maybe'
UNION ALL SELECT 'ERROR', 'roi', id, 'ROI_HAS_FEWER_THAN_3_VERTICES', '' FROM g WHERE n < 3
UNION ALL SELECT 'ERROR', 'roi', id, 'NAMED_COMPARTMENT_INVALID_SOURCE', '' FROM g WHERE no_src
UNION ALL SELECT 'ERROR', 'roi', id, 'NAMED_COMPARTMENT_WITHOUT_REVIEWER', '' FROM g WHERE no_rev
UNION ALL SELECT 'ERROR', 'roi', id, 'INCONSISTENT_ROI_METADATA', '' FROM g WHERE varies""")
def input_validation(spark, d):
    k = F.col("o_orderkey")
    files = table(spark, d, "orders").where(k % 7 != 0).select(F.concat(F.lit("/data/slides/"), k, F.when(k % 31 == 0, ".SVS").otherwise(".tif")).alias("path"))
    return inputs.validate(stain_rows(spark, d), roi_rows(spark, d), "/data", files)


@query("""WITH c AS (SELECT l_orderkey AS image_id, CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber + 1 ELSE l_linenumber END AS i, CASE WHEN l_linenumber = 1 THEN 'nucleus' WHEN l_returnflag = 'R' THEN 'target' WHEN l_linenumber = 7 THEN 'blob' ELSE 'other' END AS role FROM lineitem),
g AS (SELECT CAST(image_id AS VARCHAR) AS id, count(*) AS n, count(DISTINCT i) AS k, min(i) AS lo, max(i) AS hi, bool_or(role = 'nucleus') AS nucleus, bool_or(role = 'target') AS target FROM c GROUP BY 1)
SELECT DISTINCT 'ERROR' AS level, 'manifest' AS scope, 'ALL' AS id, 'INVALID_CHANNEL_ROLE' AS issue, role AS detail FROM c WHERE role = 'blob'
UNION ALL SELECT 'ERROR', 'image', id, 'NO_NUCLEAR_CHANNEL', '' FROM g WHERE NOT nucleus
UNION ALL SELECT 'ERROR', 'image', id, 'NO_TARGET_SIGNAL', '' FROM g WHERE NOT target
UNION ALL SELECT 'ERROR', 'image', id, 'INVALID_CHANNEL_INDEX_MAPPING', 'Expected unique 1..' || n || ' channel_index values.' FROM g WHERE n <> k OR lo <> 1 OR hi <> n""")
def channel_validation(spark, d):
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    role = F.when(n == 1, " Nucleus").when(F.col("l_returnflag") == "R", "target").when(n == 7, "blob").otherwise("other")
    rows = table(spark, d, "lineitem").select(
        k.alias("image_id"), k.alias("animal_id"), F.lit("c").alias("condition"), F.lit("IF").alias("modality"), F.lit("m").alias("marker"), F.lit("n").alias("channel_name"),
        F.when(k % 5 == 0, n + 1).otherwise(n).cast("string").alias("channel_index"), role.alias("channel_role"), F.lit("a.tif").alias("file_path"),
    )
    return inputs.validate(rows)
