"""All checks of a manifest and its annotations as one table of issues.

Checks of rows share one scan: each row gives an array of its issues, which is
exploded. Checks of a whole table are one aggregate, those of groups one
aggregate for each key. Nothing is collected.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators import validation as va

#: Other names of columns (fixed values).
ALIASES = {"biological_unit_id": ["patient_id", "animal_id", "sample_id"], "field_id": ["field", "image_field"], "file_path": ["source_file"]}
#: Columns that a manifest must have, by modality, and an annotation table (fixed values).
STAIN_COLUMNS = ("image_id", "biological_unit_id", "condition", "field_id", "file_path")
CHANNEL_COLUMNS = ("image_id", "biological_unit_id", "condition", "marker", "channel_name", "channel_role", "file_path", "channel_index")
ROI_COLUMNS = ("image_id", "roi_id", "vertex_order", "x", "y")
#: Columns that have one value in an ROI, words for its use and state, and compartments that need a source (fixed values).
ROI_METADATA = ("compartment", "action", "selection_source", "selection_method", "reviewer", "annotation_status")
ACTIONS, IGNORED_STATES = ("include", "exclude"), ("draft", "rejected")
NAMED, NO_SOURCE = ("tumor", "stroma", "interface"), ("", "automatic", "unknown")

SCHEMA = "level string, scope string, id string, issue string, detail string"


class Check(NamedTuple):
    """An issue that a row has where ``when`` holds."""

    when: Column
    scope: str
    id: Column
    code: str
    detail: Column | str = ""
    level: str = "ERROR"


def issues(rows: DataFrame, *checks: Check) -> DataFrame:
    """The issues (``SCHEMA``) of all rows."""
    each = []
    for c in checks:
        detail = F.lit(c.detail) if isinstance(c.detail, str) else c.detail
        each.append(F.when(c.when, F.struct(F.lit(c.level).alias("level"), F.lit(c.scope).alias("scope"), c.id.cast("string").alias("id"), F.lit(c.code).alias("issue"), detail.cast("string").alias("detail"))))
    return rows.select(F.explode(F.array_compact(F.array(*each))).alias("i")).select("i.*")


def word(column: str) -> Column:
    """Trimmed lower case; a missing word is empty."""
    return F.lower(F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))))


def number(column: str) -> Column:
    """The number that a text says, null for others and for what isn't finite."""
    v = F.expr(f"try_cast({column} as double)")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def missing(df: DataFrame, columns: tuple[str, ...], scope: str, code: str) -> DataFrame | None:
    spark = df.sparkSession
    rows = [("ERROR", scope, "ALL", code, c) for c in columns if c not in df.columns]
    return spark.createDataFrame(rows, SCHEMA) if rows else None


def path_in(column: str, base: str) -> Column:
    """A path of the manifest; a relative one starts in its folder ``base``."""
    path = F.col(column)
    own = path.rlike(r"^([A-Za-z]:[\\/]|\\\\|~|/|[A-Za-z][A-Za-z0-9+.-]*://)")
    return F.when(own | F.lit(not base), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def unfound(manifest: DataFrame, files: DataFrame | None) -> DataFrame | None:
    """Images whose file isn't among ``files`` (path)."""
    if files is None:
        return None
    lost = manifest.join(files.select(F.col("path").alias("full_path")).distinct(), "full_path", "left_anti")
    return issues(lost, Check(F.lit(True), "image", F.col("image_id"), "SOURCE_FILE_NOT_FOUND", F.col("full_path")))


def channel_issues(manifest: DataFrame) -> list[DataFrame]:
    """Of a fluorescence manifest: unknown roles, and images without a nucleus, a target or indices 1..N."""
    m = manifest.withColumns({"role": word("channel_role"), "index": number("channel_index").cast("long")})
    roles = issues(m.select("role").distinct(), Check(~F.col("role").isin(*va.CHANNEL_ROLES), "manifest", F.lit("ALL"), "INVALID_CHANNEL_ROLE", F.col("role")))
    n = F.count(F.lit(1))
    image = m.groupBy("image_id").agg(
        F.bool_or(F.col("role") == "nucleus").alias("nucleus"),
        F.bool_or(F.col("role") == "target").alias("target"),
        n.alias("n"),
        (F.count_distinct("index") == n).alias("once"),
        (F.min("index") == 1).alias("first"),
        (F.max("index") == n).alias("last"),
    )
    key = F.col("image_id")
    whole = F.coalesce(F.col("once") & F.col("first") & F.col("last"), F.lit(False))
    return [
        roles,
        issues(
            image,
            Check(~F.col("nucleus"), "image", key, "NO_NUCLEAR_CHANNEL"),
            Check(~F.col("target"), "image", key, "NO_TARGET_SIGNAL"),
            Check(~whole, "image", key, "INVALID_CHANNEL_INDEX_MAPPING", F.concat(F.lit("Expected unique 1.."), "n", F.lit(" channel_index values."))),
        ),
    ]


def stain_issues(manifest: DataFrame) -> list[DataFrame]:
    """Of a brightfield manifest: repeated ids, missing scale, slide formats, missing units and conditions."""
    key, checks, parts = F.col("image_id"), [], []
    if "pixel_size_um" in manifest.columns:
        checks.append(Check(~F.coalesce(number("pixel_size_um") > 0, F.lit(False)), "image", key, "MISSING_PIXEL_SIZE", "Physical calibration unavailable.", "WARNING"))
    else:
        parts.append(manifest.sparkSession.createDataFrame([("WARNING", "manifest", "ALL", "PIXEL_SIZE_COLUMN_MISSING", "Cross-magnification analysis will use pixel fallback parameters.")], SCHEMA))
    checks.append(Check(F.coalesce(F.col("full_path").rlike(va.SLIDE_PATTERN), F.lit(False)), "image", key, "NATIVE_WSI_NOT_SUPPORTED", "Export tiles or regions first."))
    again = va.duplicate_keys(manifest, ["image_id"])

    def empty(c: str) -> Column:
        return F.bool_or(F.coalesce(F.col(c).cast("string"), F.lit("")) == "")

    whole = manifest.agg(empty("biological_unit_id").alias("unit"), empty("condition").alias("state"))
    return [
        *parts,
        issues(manifest, *checks),
        issues(again, Check(F.lit(True), "image", key, "DUPLICATE_IMAGE_ID")),
        issues(whole, Check(F.col("unit"), "manifest", F.lit("ALL"), "MISSING_BIOLOGICAL_UNIT_ID"), Check(F.col("state"), "manifest", F.lit("ALL"), "MISSING_CONDITION")),
    ]


def roi_issues(roi: DataFrame, manifest: DataFrame) -> list[DataFrame]:
    """Of annotations: missing columns, unknown images, short outlines, unknown words, named compartments without provenance, metadata that varies."""
    lacking = missing(roi, ROI_COLUMNS, "roi", "MISSING_ROI_COLUMN")
    if lacking is not None:
        return [lacking]
    has = {c for c in ROI_METADATA if c in roi.columns}
    every, name = F.lit("ALL"), F.concat_ws("/", F.coalesce(F.col("image_id").cast("string"), F.lit("NA")), F.coalesce(F.col("roi_id").cast("string"), F.lit("NA")))
    parts = [issues(va.orphans(roi, manifest, "image_id"), Check(F.lit(True), "roi", F.col("image_id"), "ROI_IMAGE_ID_NOT_IN_MANIFEST"))]
    # one aggregate over the table
    bad_number = F.bool_or(number("x").isNull() | number("y").isNull())
    named = word("compartment").isin(*NAMED) if "compartment" in has else F.lit(False)
    ignored = F.count(F.when(word("annotation_status").isin(*IGNORED_STATES), 1)) if "annotation_status" in has else F.lit(0)
    whole = roi.agg(bad_number.alias("number"), F.bool_or(named).alias("named"), ignored.alias("ignored"))
    checks = [Check(F.col("number"), "roi", every, "NON_NUMERIC_ROI_COORDINATE"), Check(F.col("ignored") > 0, "roi", every, "DRAFT_OR_REJECTED_ROIS_WILL_BE_IGNORED", F.col("ignored"), "WARNING")]
    if "selection_source" not in has:
        checks.append(Check(F.col("named"), "roi", every, "NAMED_COMPARTMENT_WITHOUT_SOURCE", "Add manual/external_model provenance."))
    if "reviewer" not in has:
        checks.append(Check(F.col("named"), "roi", every, "NAMED_COMPARTMENT_WITHOUT_REVIEWER"))
    parts.append(issues(whole, *checks))
    for column, allowed, code in (("action", ACTIONS, "INVALID_ROI_ACTION"), ("annotation_status", (*va.USABLE_STATES, *IGNORED_STATES), "INVALID_ANNOTATION_STATUS")):
        if column in has:
            parts.append(issues(roi.select(word(column).alias("w")).distinct(), Check(~F.col("w").isin(*allowed), "roi", every, code, F.col("w"))))
    # one aggregate by ROI
    varies = F.lit(False)
    for c in sorted(has):
        # a missing value is a value, and differs from an empty one
        value = F.struct(F.col(c).cast("string").alias("v"))
        varies = varies | ~F.min(value).eqNullSafe(F.max(value))
    no_source = F.bool_or(named & word("selection_source").isin(*NO_SOURCE)) if "selection_source" in has else F.lit(False)
    no_reviewer = F.bool_or(named & (word("reviewer") == "")) if "reviewer" in has else F.lit(False)
    each = roi.groupBy("image_id", "roi_id").agg(F.count(F.lit(1)).alias("n"), varies.alias("varies"), no_source.alias("no_source"), no_reviewer.alias("no_reviewer"))
    parts.append(
        issues(
            each,
            Check(F.col("n") < 3, "roi", name, "ROI_HAS_FEWER_THAN_3_VERTICES"),
            Check(F.col("no_source"), "roi", name, "NAMED_COMPARTMENT_INVALID_SOURCE"),
            Check(F.col("no_reviewer"), "roi", name, "NAMED_COMPARTMENT_WITHOUT_REVIEWER"),
            Check(F.col("varies"), "roi", name, "INCONSISTENT_ROI_METADATA"),
        )
    )
    return parts


def fluorescent(manifest: DataFrame) -> bool:
    """Whether any row says that its images are fluorescence."""
    return "modality" in manifest.columns and not manifest.where(word("modality").isin("immunofluorescence", "if")).isEmpty()


def validate(manifest: DataFrame, roi: DataFrame | None = None, base: str = "", files: DataFrame | None = None) -> DataFrame:
    """Issues (level, scope, id, issue, detail) of a manifest and its annotations; one PASS row if there are none.

    ``base`` is the manifest's folder, ``files`` (path) the files that exist, null to
    leave that check out. A manifest that lacks required columns gets no other
    checks; annotations belong to brightfield manifests only.
    """
    m = va.resolve_aliases(manifest, ALIASES)
    is_channel = fluorescent(m)
    lacking = missing(m, CHANNEL_COLUMNS if is_channel else STAIN_COLUMNS, "manifest", "MISSING_REQUIRED_COLUMN")
    if lacking is not None:
        return lacking
    m = m.withColumns({"image_id": F.col("image_id").cast("string"), "full_path": path_in("file_path", base)})
    parts = channel_issues(m) if is_channel else stain_issues(m)
    lost = unfound(m, files)
    if lost is not None:
        parts.append(lost)
    if roi is not None and not is_channel:
        parts += roi_issues(roi.withColumn("image_id", F.col("image_id").cast("string")) if "image_id" in roi.columns else roi, m)
    log = reduce(DataFrame.unionByName, parts)
    none = log.agg(F.count(F.lit(1)).alias("n"))
    return log.unionByName(issues(none, Check(F.col("n") == 0, "all", F.lit("ALL"), "INPUT_VALIDATION_PASS", "", "PASS")))
