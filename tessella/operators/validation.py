"""Checks of manifests and annotations, quality flags and the run gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import or_default, pixels_of

#: Roles of a channel and states of an annotation (fixed values).
CHANNEL_ROLES = ("nucleus", "target", "cytoplasm_reference", "membrane_reference", "structural_reference", "background_reference", "other")
USABLE_STATES = ("selected", "reviewed", "approved")
#: Slide formats that are not read (fixed values).
SLIDE_PATTERN = r"(?i)\.(svs|ndpi|mrxs|scn)$"
#: Flags that fail an image (fixed values).
FAILING = "HIGH_SATURATION|NO_SIGNAL|EMPTY_CHANNEL|NO_CELLS|NO_TISSUE|SEGMENTATION_SUSPECT"
#: Markers and channels whose spots are counted (fixed values).
PUNCTA_MARKER, PUNCTA_CHANNEL = "(?i)gamma|h2ax|foci|puncta|lc3|fish", "(?i)foci|puncta"


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first existing alias of each missing column."""
    for name, others in aliases.items():
        if name not in df.columns:
            found = next((o for o in others if o in df.columns), None)
            if found:
                df = df.withColumnRenamed(found, name)
    return df


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Add missing columns and replace missing or empty values."""
    return df.withColumns({c: or_default(c, d) if c in df.columns else F.lit(d) for c, d in defaults.items()})


def included(df: DataFrame, status: str = "analysis_status") -> DataFrame:
    return df.where(F.lower(F.trim(status)).isin("include", "included"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def issue(rows: DataFrame, scope: str, id_column: str | Column, code: str, detail: Column, level: str = "ERROR") -> DataFrame:
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    return rows.select(F.lit(level).alias("level"), F.lit(scope).alias("scope"), key.cast("string").alias("id"), F.lit(code).alias("issue"), detail.cast("string").alias("detail"))


def issue_log(parts: Sequence[DataFrame]) -> DataFrame:
    """All issues, or one PASS row if there is none."""
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    none = log.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return log.unionByName(issue(none, "all", F.lit("all"), "NO_ISSUES", F.lit("validation passed"), "PASS"))


def channel_contiguity(channels: DataFrame, key: str = "image_id", index: str = "channel_index") -> DataFrame:
    """Images whose channel indices are not exactly 1..N."""
    s = channels.groupBy(key).agg(F.count(index).alias("n_rows"), F.count_distinct(index).alias("n_distinct"), F.min(index).alias("lowest"), F.max(index).alias("highest"))
    return s.where("n_rows <> n_distinct or lowest <> 1 or highest <> n_rows")


def role_presence(channels: DataFrame, key: str = "image_id", role: str = "channel_role") -> DataFrame:
    """Images without a nucleus or a target channel."""
    has = channels.groupBy(key).agg(*(F.bool_or(F.coalesce(F.col(role) == r, F.lit(False))).alias(f"has_{r}") for r in ("nucleus", "target")))
    return has.where("not (has_nucleus and has_target)")


def first_of_role(channels: DataFrame, channel: str, key: str = "image_id", role: str = "channel_role", index: str = "channel_index") -> DataFrame:
    """The channel with the least index (of equal ones: the least channel) of each role of an image, and how many the role has."""
    return channels.groupBy(key, role).agg(F.min_by(channel, F.struct(index, channel)).alias(channel), F.count(F.lit(1)).alias("n_channels"))


def orphans(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the manifest does not have."""
    return rows.select(key).distinct().join(manifest.select(key), key, "left_anti")


def too_few_vertices(vertices: DataFrame, keys: Sequence[str], least: int = 3) -> DataFrame:
    return vertices.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_vertices")).where(F.col("n_vertices") < least)


def inconsistent(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups in which a column has more than one value; a missing value is a value."""
    counts = rows.groupBy(*keys).agg(*(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("∅"))).alias(f"n_{c}") for c in columns))
    any_many = F.lit(False)
    for c in columns:
        any_many = any_many | (F.col(f"n_{c}") > 1)
    return counts.where(any_many)


def out_of_bounds(vertices: DataFrame, sizes: DataFrame) -> DataFrame:
    """Vertices outside [1, width] x [1, height] of their image."""
    return vertices.join(sizes, "image_id").where("x < 1 or y < 1 or x > width or y > height")


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table with the rows in place of those with the same keys."""
    return table.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(table.columns).unionByName(rows.select(table.columns))


def usable_rois(vertices: DataFrame) -> DataFrame:
    """Finite vertices of usable state, with trimmed lower-case enums."""
    t = {c: F.lower(F.trim(c)) for c in ("compartment", "action", "annotation_status", "selection_source")}
    return vertices.withColumns(t).where(F.col("annotation_status").isin(*USABLE_STATES) & F.col("action").isin("include", "exclude") & F.col("x").isNotNull() & F.col("y").isNotNull())


def unreviewed_compartments(rois: DataFrame) -> DataFrame:
    """Named compartments chosen automatically or without a reviewer."""
    return rois.where("compartment in ('tumor', 'stroma', 'interface')").where("selection_source = 'automatic' or coalesce(trim(reviewer), '') = ''")


def scale_resolution(images: DataFrame, lengths: Mapping[str, tuple[float, float, float]], scale: str = "pixel_size_um") -> DataFrame:
    """Lengths in pixels (name: micrometres, fallback pixels, least) and how the scale was found."""
    known = F.coalesce(F.col(scale) > 0, F.lit(False))
    return images.withColumns({name: F.when(known, pixels_of(F.lit(um), scale, px, least)).otherwise(F.lit(float(px))) for name, (um, px, least) in lengths.items()}).withColumn("scale_mode", F.when(known, "physical_um").otherwise("pixel_fallback"))


def image_flags(images: DataFrame, least_tissue: float, least_cells: int, high_background: float) -> DataFrame:
    """Flags of each image, PASS if none, and whether it needs a review."""
    flags = F.array_compact(
        F.array(
            F.when(F.col("tissue_fraction") < least_tissue, "LOW_TISSUE_COVERAGE"),
            F.when(F.col("n_cells") < least_cells, "LOW_CELL_COUNT"),
            F.when(F.col("background_od") > high_background, "HIGH_EXTRACELLULAR_DAB_BACKGROUND"),
            F.when(F.col("n_overlaps") > 0, "OVERLAPPING_INCLUDE_ROIS"),
            F.when(F.col("scale_mode") == "pixel_fallback", "MISSING_PIXEL_SIZE_CALIBRATION"),
        )
    )
    out = images.withColumn("qc_flags", F.when(F.size(flags) > 0, F.concat_ws(";", flags)).otherwise("PASS"))
    return out.withColumn("manual_review_required", F.col("qc_flags") != "PASS")


def flag_union(rows: DataFrame, keys: Sequence[str], flags: str) -> DataFrame:
    """All flags of a group, sorted, and its status: PASS unless one of them fails."""
    each = rows.select(*keys, F.explode(F.split(F.coalesce(F.col(flags), F.lit("PASS")), ";")).alias("f"))
    joined = each.groupBy(*keys).agg(F.concat_ws(";", F.sort_array(F.collect_set(F.when(F.col("f") != "PASS", F.col("f"))))).alias("qc_flags"))
    return joined.withColumn("qc_status", F.when(F.col("qc_flags").rlike(FAILING), "FAIL_REVIEW_REQUIRED").otherwise("PASS"))


def run_status(images: DataFrame) -> DataFrame:
    """One row: BLOCKED_QC if any image fails, else PASS."""
    n = F.count(F.when(F.col("qc_status") != "PASS", 1))
    return images.agg(F.count(F.lit(1)).alias("n_images"), n.alias("n_failed"), F.when(n > 0, "BLOCKED_QC").otherwise("PASS").alias("run_status"))


def require_pass(status: DataFrame) -> None:
    row = status.head()
    if row.run_status != "PASS":
        raise RuntimeError(f"{row.n_failed} of {row.n_images} images failed quality control")


def modality(manifest: DataFrame) -> str:
    """``if`` or ``dab`` from all rows of the manifest; mixtures and unknown words raise."""
    if "modality" not in manifest.columns:
        return "dab"
    words = {r[0] for r in manifest.select(F.lower(F.trim("modality"))).distinct().limit(10).collect()}
    kinds = {"if" if w in ("if", "immunofluorescence") else "dab" if w in ("dab", "ihc", "brightfield", "", None) else f"unknown: {w}" for w in words}
    if len(kinds) != 1 or next(iter(kinds)).startswith("unknown"):
        raise ValueError(f"modality must be one of if and dab: {sorted(kinds)}")
    return kinds.pop()


def counts_puncta(marker: str, channel: str) -> Column:
    return F.coalesce(F.col(marker).rlike(PUNCTA_MARKER), F.lit(False)) | F.coalesce(F.col(channel).rlike(PUNCTA_CHANNEL), F.lit(False))
