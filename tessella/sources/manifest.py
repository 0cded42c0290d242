"""Manifests, annotations and options from CSV files."""

from __future__ import annotations

import dataclasses
import os
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import inputs, validation as va

#: Other names of manifest columns: those that the input checks know, with the file under the name that runs read.
ALIASES = {c: others for c, others in inputs.ALIASES.items() if c != "file_path"} | {"source_file": ["file_path"]}
STAIN_REQUIRED = ("image_id", "biological_unit_id", "condition", "field_id", "source_file")
STAIN_DEFAULTS = {"analysis_status": "include", "batch_id": "batch_1", "marker": "unspecified_marker", "tissue_type": "unspecified_tissue", "is_negative_control": "false", "magnification": ""}
CHANNEL_REQUIRED = ("image_id", "biological_unit_id", "condition", "modality", "marker", "channel_name", "channel_index", "channel_role", "file_path")


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text; casts come later, where the type is known."""
    return spark.read.csv(path, header=True, sep=sep, enforceSchema=False)


def require(df: DataFrame, columns: tuple[str, ...]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def stain_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Included images of a brightfield manifest: aliases, defaults, types, unique ids, no slide formats."""
    df = va.resolve_aliases(read_csv(spark, path), ALIASES)
    require(df, STAIN_REQUIRED)
    df = va.included(va.fill_defaults(df, STAIN_DEFAULTS))
    scale = F.expr("try_cast(pixel_size_um as double)") if "pixel_size_um" in df.columns else F.lit(None).cast("double")
    df = df.withColumns({"pixel_size_um": scale, **{c: F.col(c).cast("string") for c in STAIN_REQUIRED}, "is_negative_control": F.lower(F.trim("is_negative_control")).isin("true", "t", "1", "yes", "y")})
    again = va.duplicate_keys(df, ["image_id"]).head(1)
    if again:
        raise ValueError(f"image_id occurs more than once: {again[0].image_id}")
    if df.isEmpty():
        raise ValueError("no included images")
    if not df.where(F.col("source_file").rlike(va.SLIDE_PATTERN)).isEmpty():
        raise ValueError("whole-slide formats are not read: export regions first")
    return df


def channel_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Channels of a fluorescence manifest, checked for roles, contiguous indices, a nucleus and a target."""
    df = read_csv(spark, path)
    require(df, CHANNEL_REQUIRED)
    df = df.withColumns({"channel_index": F.expr("try_cast(channel_index as int)"), "channel_role": F.lower(F.trim("channel_role")), "pixel_size_um": F.expr("try_cast(pixel_size_um as double)") if "pixel_size_um" in df.columns else F.lit(None).cast("double")})
    if not df.where(~F.coalesce(F.col("channel_role").isin(*va.CHANNEL_ROLES), F.lit(False))).isEmpty():
        raise ValueError("unknown channel role")
    for bad, what in ((va.channel_contiguity(df), "channel indices are not 1..N"), (va.role_presence(df), "nucleus or target channel missing")):
        row = bad.head(1)
        if row:
            raise ValueError(f"{what}: {row[0].image_id}")
    return df


def roi_vertices(spark: SparkSession, path: str) -> DataFrame:
    """Usable ROI vertices. What would change a polygon or its use unseen raises.

    That is: an empty image_id or roi_id, coordinates that aren't finite numbers,
    unknown actions or states, metadata that differs within an ROI, and named
    compartments without review.
    """
    df = va.fill_defaults(read_csv(spark, path), {"compartment": "custom", "action": "include", "selection_source": "manual", "selection_method": "polygon", "reviewer": "", "annotation_status": "selected"})
    require(df, inputs.ROI_COLUMNS)
    words = {c: inputs.word(c) for c in ("compartment", "action", "selection_source", "selection_method", "annotation_status")}
    df = df.withColumns(words | {"reviewer": F.trim("reviewer"), "x": inputs.number("x"), "y": inputs.number("y"), "vertex_order": F.expr("try_cast(vertex_order as int)")})
    states = (*va.USABLE_STATES, *inputs.IGNORED_STATES)
    wrong = (
        F.when((inputs.word("image_id") == "") | (inputs.word("roi_id") == ""), "an annotation without image_id or roi_id")
        .when(F.col("x").isNull() | F.col("y").isNull(), "annotation coordinates must be finite numbers")
        .when(~F.col("action").isin(*inputs.ACTIONS), "annotation action must be include or exclude")
        .when(~F.col("annotation_status").isin(*states), "unknown annotation status")
    )
    bad = df.select(wrong.alias("wrong"), "image_id", "roi_id").where("wrong is not null").head(1)
    if bad:
        raise ValueError(f"{bad[0].wrong}: {bad[0].image_id}/{bad[0].roi_id}")
    df = df.where(F.col("annotation_status").isin(*va.USABLE_STATES))
    if va.inconsistent(df, ["image_id", "roi_id"], inputs.ROI_METADATA).head(1):
        raise ValueError("annotation metadata differs within an ROI")
    if va.unreviewed_compartments(df).head(1):
        raise ValueError("a named compartment needs a reviewed, non-automatic selection")
    return df


def absolute(path: str) -> bool:
    """POSIX, home, drive and UNC paths, and URIs."""
    return re.match(r"^([A-Za-z]:[\\/]|\\\\|~|/|[A-Za-z][A-Za-z0-9+.-]*://)", path) is not None


def resolve(path: str, base: str) -> str:
    """A path of the manifest, relative to its folder."""
    return path if absolute(path) else os.path.join(base, path)


@dataclass
class Options:
    """Options of a run; a ``parameter,value`` file overlays them, the field's type deciding the cast."""

    nucleus_blur_sigma_um: float = 0.5
    nucleus_blur_sigma_px: float = 1.5
    cell_expansion_radius_um: float = 4.0
    cell_expansion_radius_px: float = 8.0
    positive_threshold: float = 0.2
    dab_thresholds: tuple[float, ...] = (0.2, 0.4, 0.6)
    cell_scoring_domain: str = "nucleus"
    z_mode: str = "max"
    bg_method: str = "none"
    pos_threshold_method: str = "otsu"
    minimum_tissue_fraction_for_qc: float = 0.05
    minimum_cells_for_qc: int = 10
    high_background_od_for_qc: float = 0.25
    local_background: bool = True

    CHOICES = {"cell_scoring_domain": ("nucleus", "cytoplasm", "whole_cell"), "z_mode": ("max", "mean", "sum", "middle"), "bg_method": ("none", "top_hat", "rolling_ball", "local", "constant"), "pos_threshold_method": ("manual", "otsu", "percentile", "background", "triangle")}

    def overlay(self, rows: dict[str, str]) -> Options:
        new = dataclasses.replace(self)
        for name, text in rows.items():
            field = next((f for f in dataclasses.fields(self) if f.name == name), None)
            if field is None or text is None or not str(text).strip():
                continue
            setattr(new, name, cast_like(getattr(self, name), str(text).strip()))
        new.check()
        return new

    def check(self) -> None:
        for name, allowed in self.CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")
        if any(b <= a for a, b in zip(self.dab_thresholds, self.dab_thresholds[1:], strict=False)):
            raise ValueError("dab_thresholds must increase")


@dataclass
class StainRunOptions(Options):
    """Options of a brightfield run and their defaults (fixed values); lengths in micrometres hold where the scale is known."""

    max_image_pixels: float = 80_000_000.0
    white_quantile: float = 0.98
    tissue_od_min: float = 0.10
    tissue_close_radius_px: int = 2
    nucleus_blur_sigma_um: float = 0.8
    nucleus_blur_sigma_px: float = 1.2
    nucleus_min_area_um2: float = 20.0
    nucleus_max_area_um2: float = 400.0
    nucleus_min_area_px: float = 80.0
    nucleus_max_area_px: float = 5000.0
    nucleus_min_circularity: float = 0.20
    nucleus_max_eccentricity: float = 0.98
    nucleus_min_h_mean: float = 0.035
    border_margin_um: float = 1.0
    border_margin_px: int = 3
    cell_expansion_radius_um: float = 6.0
    cell_expansion_radius_px: float = 18.0
    local_background_inner_radius_um: float = 7.0
    local_background_outer_radius_um: float = 12.0
    local_background_inner_radius_px: int = 22
    local_background_outer_radius_px: int = 36
    local_background_min_pixels: int = 60
    use_local_background: bool = True
    cell_scoring_domain: str = "cytoplasm"
    minimum_cells_for_qc: int = 20
    minimum_tissue_fraction_for_qc: float = 0.05
    high_background_od_for_qc: float = 0.10
    dab_threshold_negative: float = 0.08
    dab_threshold_weak: float = 0.18
    dab_threshold_moderate: float = 0.35

    def __post_init__(self) -> None:
        self.check()

    def check(self) -> None:
        self.dab_thresholds = (self.dab_threshold_negative, self.dab_threshold_weak, self.dab_threshold_moderate)
        super().check()
        if not self.max_image_pixels > 0:
            raise ValueError("max_image_pixels must be above zero")

    def effective(self, pixel_size_um: float | None) -> dict[str, float | str]:
        """Lengths and areas in pixels at a scale, or the fallbacks without one."""
        s = pixel_size_um
        if s is None or not 0 < s < float("inf"):
            return {
                "scale_mode": "pixel_fallback", "nucleus_blur": self.nucleus_blur_sigma_px, "nucleus_min_area": self.nucleus_min_area_px, "nucleus_max_area": self.nucleus_max_area_px, "border_margin": self.border_margin_px,
                "cell_reach": int(self.cell_expansion_radius_px), "background_inner": self.local_background_inner_radius_px, "background_outer": self.local_background_outer_radius_px,
            }
        least = max(5.0, self.nucleus_min_area_um2 / s**2)
        inner = max(2, round(self.local_background_inner_radius_um / s))
        return {
            "scale_mode": "physical_um", "nucleus_blur": max(0.5, self.nucleus_blur_sigma_um / s), "nucleus_min_area": least, "nucleus_max_area": max(least + 1, self.nucleus_max_area_um2 / s**2), "border_margin": max(1, round(self.border_margin_um / s)),
            "cell_reach": max(2, round(self.cell_expansion_radius_um / s)), "background_inner": inner, "background_outer": max(inner + 2, round(self.local_background_outer_radius_um / s)),
        }


@dataclass
class ChannelRunOptions(Options):
    """Options of a fluorescence run and their defaults (fixed values)."""

    z_mode: str = "max_projection"
    bg_method: str = "top_hat"
    bg_radius: int = 25
    bg_value: str = ""
    nuc_threshold_method: str = "otsu"
    nuc_threshold_value: str = ""
    nuc_min_area: float = 20.0
    nuc_max_area: float = 5000.0
    cell_propagation_radius: int = 15
    max_cytoplasm_expansion_radius: int = 10
    cytoplasm_boundary_gap_px: float = 1.0
    nuc_watershed_tolerance: float = 1.0
    nuc_watershed_ext: int = 1
    pos_threshold_method: str = "otsu"
    pos_threshold_value: str = ""
    colocalization_enabled: bool = False
    puncta_enabled: bool = False
    puncta_sigma1: float = 1.0
    puncta_sigma2: float = 2.5
    puncta_threshold_sd: float = 3.0
    max_image_pixels: float = 80_000_000.0

    CHOICES = {
        "z_mode": ("max_projection", "mean_projection", "sum_projection", "middle_slice", "max", "mean", "sum", "middle"),
        "bg_method": ("none", "top_hat", "rolling_ball", "morphological_opening", "local_background", "user_defined_background_roi"),
        "nuc_threshold_method": ("otsu", "manual"),
    }

    def check(self) -> None:
        super().check()
        for name in ("bg_value", "nuc_threshold_value", "pos_threshold_value"):
            self.value(name)
        if self.nuc_threshold_method == "manual" and self.value("nuc_threshold_value") is None:
            raise ValueError("a manual nuclear threshold needs nuc_threshold_value")

    def value(self, name: str) -> float | None:
        """An optional number: None where it is empty."""
        text = getattr(self, name).strip()
        return float(text) if text else None


def cast_like(value: Any, text: str) -> Any:
    if isinstance(value, bool):
        if text.lower() in ("true", "t", "1", "yes", "y"):
            return True
        if text.lower() in ("false", "f", "0", "no", "n"):
            return False
        raise ValueError(f"not a boolean: {text}")
    if isinstance(value, tuple):
        return tuple(float(x) for x in text.split(";"))
    return int(float(text)) if isinstance(value, int) else type(value)(text)


def read_options(spark: SparkSession, path: str, defaults: Options | None = None) -> Options:
    rows = read_csv(spark, path).select("parameter", "value").collect()  # a few dozen
    return (defaults or Options()).overlay({r.parameter: r.value for r in rows})
