"""Measurement of a whole image in one pass, inside the task that holds it.

Labels, masks and optical densities of an image meet as arrays; what leaves the task
is a row for each cell, region, annotation and overlap, never a row for each pixel. All
rows of a run are one tagged table (``TAGGED``): it is written once, and every result
table reads its own part of it. A failing image gives an error row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import kernels as k

#: Statistics of a cell's domain and of a region's domain, and the domains (fixed values).
CELL_STATS = ("area_px", "dab_mean_od", "dab_median_od", "dab_q90_od", "dab_positive_area_fraction", "dab_positive_mean_od", "dab_raw_mean_od", "dab_raw_positive_area_fraction", "dab_raw_positive_mean_od")
CELL_DOMAINS = ("nuclear", "cytoplasm", "whole_cell")
AREA_STATS = ("area_px", "positive_area_px", "positive_area_fraction", "mean_dab_od", "positive_mean_dab_od", "integrated_dab_od")
AREA_DOMAINS = ("tissue", "nuclear", "cytoplasm", "extracellular")

CELL = ", ".join(["cell_id: int", "cx: double", "cy: double", "nucleus_area_px: double", "eccentricity: double", "circularity: double", "haematoxylin_mean: double", "local_background_od: double", "rois: array<string>", *(f"{d}_{s}: double" for d in CELL_DOMAINS for s in CELL_STATS)])
REGION = ", ".join(["roi_id: string", "compartment: string", "selection_source: string", "selection_method: string", *(f"{d}_{s}: double" for d in AREA_DOMAINS for s in AREA_STATS)])
ROI = "roi_id: string, compartment: string, action: string, selection_source: string, selection_method: string, reviewer: string, annotation_status: string, n_vertices: int, x_min: double, x_max: double, y_min: double, y_max: double, selected_area_px: long"
OVERLAP = "roi_id_1: string, compartment_1: string, roi_id_2: string, compartment_2: string, overlap_area_px: long, overlap_fraction_roi_1: double, overlap_fraction_roi_2: double, same_compartment: boolean"
IMAGE = "width_px: int, height_px: int, tissue_fraction: double, background_od: double, focus_score: double, nucleus_threshold: double, n_overlaps: int, scale_mode: string, nucleus_blur: double, nucleus_min_area: double, nucleus_max_area: double, border_margin: int, cell_reach: int, background_inner: int, background_outer: int"
POLYGON = "struct<roi_id: string, compartment: string, action: string, selection_source: string, selection_method: string, reviewer: string, annotation_status: string, x: array<double>, y: array<double>>"
KINDS = {"cell": CELL, "region": REGION, "roi": ROI, "overlap": OVERLAP, "image": IMAGE}
#: Rows of a fluorescence run, and its compartments (fixed values).
COMPARTMENTS = ("global", "nucleus", "cytoplasm", "extracellular")
CHANNEL = "channel_name: string, marker: string"
THRESHOLD = "threshold_method: string, threshold_value: double, threshold_source: string, threshold_qc_status: string"
CHANNEL_KINDS = {
    "channel": f"{CHANNEL}, channel_role: string, channel_index: int, n_planes: int, raw_min: double, raw_max: double, corr_min: double, corr_max: double, mean_signal: double, saturated_pixel_fraction: double, near_zero_pixel_fraction: double, dynamic_range_used: double, background_method: string, background_estimated: double, channel_qc_flags: string",
    "compartment": f"{CHANNEL}, compartment: string, pixel_count: long, area_um2: double, mean_intensity: double, median_intensity: double, integrated_intensity: double, max_intensity: double, intensity_sd: double, positive_pixel_count: long, positive_area_fraction: double, {THRESHOLD}",
    "cell": f"{CHANNEL}, cell_id: int, " + ", ".join(f"{d}_pixel_count: long, {d}_area_um2: double, {d}_mean_intensity: double, {d}_median_intensity: double, {d}_integrated_intensity: double" for d in ("nuclear", "cytoplasmic", "cell")) + ", nuclear_to_cytoplasmic_ratio: double, is_positive_cell: boolean",
    "puncta": f"{CHANNEL}, compartment: string, puncta_count: long, puncta_count_per_cell: double, total_puncta_area_um2: double, puncta_density_per_um2: double, puncta_mean_intensity: double, puncta_integrated_intensity: double, threshold_used: double",
    "coloc": "compartment: string, marker_a: string, marker_b: string, pixel_count: long, pearson_r: double, manders_m1: double, manders_m2: double, threshold_a: double, threshold_b: double, colocalization_qc_status: string",
    "roi": "included_roi_ids: string, excluded_roi_ids: string, roi_mask_status: string, included_pixel_count: long, excluded_pixel_count: long, included_fraction: double",
    "image": "n_cells: int, effective_cell_propagation_radius: int, nuclear_area_fraction: double, cytoplasmic_area_fraction: double, extracellular_area_fraction: double, qc_flags: string",
}


def tagged_schema(kinds: dict[str, str]) -> str:
    return ", ".join(["image_id string", "kind string", *(f"{name} struct<{fields}>" for name, fields in kinds.items()), "error string"])


TAGGED = tagged_schema(KINDS)


#: Rows that a task passes on together.
ROWS_TOGETHER = 10_000


@dataclass
class CellOptions:
    """Thresholds and the ring of the local background (pixels)."""

    threshold: float = 0.08
    local_background: bool = True
    inner: int = 22
    outer: int = 36
    least_pixels: int = 60


def number(v: float) -> float | None:
    return float(v) if np.isfinite(v) else None


def whole_half_even(v: np.ndarray, size: int) -> np.ndarray:
    """Pixels (from 0) of centres (from 0): rounded half to even as counted from 1, clamped to the image."""
    return np.clip(np.rint(v + 1), 1, size).astype(int) - 1


def sorted_quantile(values: np.ndarray, first: np.ndarray, count: np.ndarray, q: float) -> np.ndarray:
    """The quantile (linear between order statistics) of each run of sorted values; NaN for an empty one."""
    if not len(values):
        return np.full(len(count), np.nan)
    at = np.maximum(count - 1, 0) * q
    low = np.floor(at).astype(int)
    a = values[np.minimum(first + low, len(values) - 1)]
    b = values[np.minimum(first + np.minimum(low + 1, np.maximum(count - 1, 0)), len(values) - 1)]
    return np.where(count > 0, a + (at - low) * (b - a), np.nan)


def label_stats(values: np.ndarray, labels: np.ndarray, n: int, back: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """``CELL_STATS`` of the labels 1..n over finite values, less each label's background (0 at least)."""
    use = (labels > 0) & np.isfinite(values)
    lab, raw = labels[use] - 1, values[use]
    v = np.maximum(raw - back[lab], 0)
    order = np.lexsort((v, lab))
    count = np.bincount(lab, minlength=n)
    first = np.cumsum(count) - count
    some = np.maximum(count, 1)
    none = count == 0

    def share(hit: np.ndarray) -> np.ndarray:
        return np.where(none, np.nan, np.bincount(lab[hit], minlength=n) / some)

    def mean_of(x: np.ndarray, hit: np.ndarray) -> np.ndarray:
        m = np.bincount(lab[hit], minlength=n)
        return np.where(m > 0, np.bincount(lab[hit], x[hit], n) / np.maximum(m, 1), 0.0)

    high, high_raw = v >= threshold, raw >= threshold
    stats = (
        count.astype(float), np.where(none, np.nan, np.bincount(lab, v, n) / some), sorted_quantile(v[order], first, count, 0.5), sorted_quantile(v[order], first, count, 0.9),
        share(high), mean_of(v, high), np.where(none, np.nan, np.bincount(lab, raw, n) / some), share(high_raw), mean_of(raw, high_raw),
    )
    return dict(zip(CELL_STATS, stats, strict=True))


def area_stats(values: np.ndarray, mask: np.ndarray, threshold: float) -> tuple:
    """``AREA_STATS`` of the finite values under a mask; without any, areas are 0 and the rest null."""
    v = values[mask & np.isfinite(values)]
    if not len(v):
        return 0.0, 0.0, None, None, None, None
    high = v >= threshold
    return float(len(v)), float(high.sum()), float(high.mean()), float(v.mean()), float(v[high].mean()) if high.any() else 0.0, float(v.sum())


def field_background(values: np.ndarray, tissue: np.ndarray, cells: np.ndarray) -> float:
    """Median of the tissue outside cells; NaN if there is none."""
    v = values[tissue & (cells == 0) & np.isfinite(values)]
    return float(np.median(v)) if len(v) else np.nan


def local_backgrounds(values: np.ndarray, tissue: np.ndarray, cells: np.ndarray, cx: np.ndarray, cy: np.ndarray, o: CellOptions) -> np.ndarray:
    """Median of each centre's ring in the tissue outside cells; the field's where the ring has too few pixels, 0 if the option is off."""
    whole = np.nan_to_num(field_background(values, tissue, cells))
    if not o.local_background:
        return np.zeros(len(cx))
    h, w = values.shape
    free = tissue & (cells == 0) & np.isfinite(values)
    dy, dx = np.mgrid[-o.outer : o.outer + 1, -o.outer : o.outer + 1]
    far = dx * dx + dy * dy
    ring = (far >= o.inner**2) & (far <= o.outer**2)
    out = np.full(len(cx), whole)
    for i, (x, y) in enumerate(zip(np.rint(cx + 1).astype(int) - 1, np.rint(cy + 1).astype(int) - 1, strict=True)):
        top, left = max(0, y - o.outer), max(0, x - o.outer)
        place = (slice(top, min(h, y + o.outer + 1)), slice(left, min(w, x + o.outer + 1)))
        part = ring[top - (y - o.outer) :, left - (x - o.outer) :][: place[0].stop - top, : place[1].stop - left]
        near = values[place][part & free[place]]
        if len(near) >= o.least_pixels:
            out[i] = np.median(near)
    return out


def measure_cells(values: np.ndarray, nuclei: np.ndarray, cells: np.ndarray, tissue: np.ndarray, regions: dict[str, np.ndarray], o: CellOptions, haematoxylin: np.ndarray | None = None) -> list[dict]:
    """A row (``CELL``) for each nucleus; ``rois`` names the regions that count it: its centre's pixel is theirs and tissue."""
    n = int(nuclei.max(initial=0))
    if not n:
        return []
    f = k.features(nuclei, values if haematoxylin is None else haematoxylin)
    back = local_backgrounds(values, tissue, cells, f["cx"], f["cy"], o)
    domains = {"nuclear": nuclei, "cytoplasm": np.where(nuclei > 0, 0, cells), "whole_cell": cells}
    stats = {f"{d}_{s}": v for d, labels in domains.items() for s, v in label_stats(values, labels, n, back, o.threshold).items()}
    x, y = whole_half_even(f["cx"], values.shape[1]), whole_half_even(f["cy"], values.shape[0])
    counted = {name: mask[y, x] & tissue[y, x] for name, mask in regions.items()}
    return [
        {"cell_id": i + 1, "cx": f["cx"][i], "cy": f["cy"][i], "nucleus_area_px": f["area"][i], "eccentricity": f["eccentricity"][i], "circularity": f["circularity"][i], "haematoxylin_mean": f["mean"][i], "local_background_od": back[i]}
        | {"rois": [name for name, inside in counted.items() if inside[i]]}
        | {name: number(v[i]) for name, v in stats.items()}
        for i in range(n)
    ]


def measure_region(values: np.ndarray, nuclei: np.ndarray, cells: np.ndarray, region: np.ndarray, threshold: float) -> dict:
    """The area statistics of the four domains of a region (its tissue)."""
    nuclear, cellular = region & (nuclei > 0), region & (cells > 0)
    masks = {"tissue": region, "nuclear": nuclear, "cytoplasm": cellular & ~nuclear, "extracellular": region & ~cellular}
    return {f"{d}_{s}": v for d, mask in masks.items() for s, v in zip(AREA_STATS, area_stats(values, mask, threshold), strict=True)}


@dataclass
class Rois:
    """Masks of an image's annotations."""

    analysis: np.ndarray
    regions: dict[str, np.ndarray] = field(default_factory=dict)
    rows: list[dict] = field(default_factory=list)
    overlaps: list[dict] = field(default_factory=list)


def roi_masks(width: int, height: int, polygons: Sequence) -> Rois:
    """What polygons (``POLYGON``, vertices in order, counted from 1) select.

    Exclude ROIs leave the analysis, include ROIs are regions; overlaps are those of
    include ROIs. A vertex outside the image, fewer than three vertices or no pixel
    at all is an error.
    """
    out = Rois(np.ones((height, width), dtype=bool))
    masks = {}
    for p in sorted(polygons, key=lambda p: p["roi_id"]):
        xs, ys = np.asarray(p["x"], dtype=float), np.asarray(p["y"], dtype=float)
        if len(xs) < 3:
            raise ValueError(f"ROI has fewer than three vertices: {p['roi_id']}")
        if not (np.isfinite(xs).all() and np.isfinite(ys).all() and xs.min() >= 1 and ys.min() >= 1 and xs.max() <= width and ys.max() <= height):
            raise ValueError(f"ROI coordinates fall outside the image: {p['roi_id']}")
        mask = masks[p["roi_id"]] = k.polygon_mask(width, height, xs, ys)
        if not mask.any():
            raise ValueError(f"ROI selects no pixel: {p['roi_id']}")
        named = {c: p[c] for c in ("roi_id", "compartment", "action", "selection_source", "selection_method", "reviewer", "annotation_status")}
        out.rows.append(named | {"n_vertices": len(xs), "x_min": xs.min(), "x_max": xs.max(), "y_min": ys.min(), "y_max": ys.max(), "selected_area_px": int(mask.sum())})
        if p["action"] == "exclude":
            out.analysis &= ~mask
        else:
            out.regions[p["roi_id"]] = mask
    part = {r["roi_id"]: r["compartment"] for r in out.rows}
    chosen = sorted(out.regions)
    for i, a in enumerate(chosen):
        for b in chosen[i + 1 :]:
            both = int((masks[a] & masks[b]).sum())
            if both:
                shares = {f"overlap_fraction_roi_{j}": both / int(masks[r].sum()) for j, r in ((1, a), (2, b))}
                out.overlaps.append({"roi_id_1": a, "compartment_1": part[a], "roi_id_2": b, "compartment_2": part[b], "overlap_area_px": both, **shares, "same_compartment": part[a] == part[b]})
    return out


def focus(grey: np.ndarray) -> float | None:
    """Mean squared forward difference along x plus that along y."""
    parts = [np.diff(grey, axis=a) ** 2 for a in (0, 1)]
    return sum(float(p.mean()) for p in parts) if all(p.size for p in parts) else None


def tagged_rows(image_id: str, **rows: list[dict]) -> list[dict]:
    return [{"image_id": image_id, "kind": kind, kind: row} for kind, some in rows.items() for row in some]


def each_image(images: DataFrame, measure: Callable[[object], list[dict]], kinds: dict[str, str] = KINDS) -> DataFrame:
    """Tagged rows of every image row (image_id and what ``measure`` needs); an exception becomes a row of kind error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["image_id", "kind", *kinds, "error"]

        def out(rows: list[dict]) -> pd.DataFrame:
            return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in columns})

        for frame in frames:
            held: list[dict] = []
            for row in frame.itertuples(index=False):
                try:
                    held += measure(row)
                except Exception as e:  # one bad image must not end the run
                    held.append({"image_id": row.image_id, "kind": "error", "error": f"{type(e).__name__}: {e}"})
                while len(held) >= ROWS_TOGETHER:
                    yield out(held[:ROWS_TOGETHER])
                    held = held[ROWS_TOGETHER:]
            if held:
                yield out(held)

    return images.mapInPandas(run, tagged_schema(kinds))


def rows_of(tagged: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind, with their fields as columns."""
    return tagged.where(F.col("kind") == kind).select("image_id", f"{kind}.*")


def measure_labels(planes: DataFrame, o: CellOptions) -> DataFrame:
    """Tagged rows of images that are segmented already: image_id, h, w, value (float32), nuc, cell (int32) and tissue (bytes) as binary."""

    def measure(row) -> list[dict]:
        shape = (row.h, row.w)
        values = np.frombuffer(row.value, "<f4").reshape(shape).astype(float)
        nuclei, cells = (np.frombuffer(b, "<i4").reshape(shape) for b in (row.nuc, row.cell))
        tissue = np.frombuffer(row.tissue, "u1").reshape(shape) > 0
        whole = {"roi_id": "GLOBAL", "compartment": "global", "selection_source": "automatic", "selection_method": "whole_tissue"}
        region = whole | measure_region(values, nuclei, cells, tissue, o.threshold)
        return tagged_rows(row.image_id, cell=measure_cells(values, nuclei, cells, tissue, {"GLOBAL": np.ones(shape, dtype=bool)}, o), region=[region])

    return each_image(planes.select(F.col("image_id").cast("string").alias("image_id"), "h", "w", "value", "nuc", "cell", "tissue"), measure)


# fluorescence


def corrected(plane: np.ndarray, method: str, radius: int, constant: float | None) -> tuple[np.ndarray, float, str]:
    """A channel less its background, the mean background, and the method that was applied."""
    how = {"top_hat": "top_hat", "rolling_ball": "top_hat", "morphological_opening": "top_hat", "local_background": "local", "local": "local", "user_defined_background_roi": "constant", "constant": "constant"}.get(method, "none")
    if how == "none" or (how == "constant" and constant is None):
        return plane, 0.0, "none"
    if how == "local":
        back = k.gaussian(plane, max(15, 2 * int(radius) + 1) / 2)
        return np.maximum(plane - back, 0), float(back.mean()), method
    if how == "constant":
        return np.maximum(plane - constant, 0), float(constant), method
    out = k.background(plane, "top_hat", int(radius))
    return out, float((plane - out).mean()), method


def channel_quality(raw: np.ndarray, less: np.ndarray, saturated: float = 0.005) -> dict:
    """Range, signal, saturation, dynamic range and flags of a channel."""
    from tessella.operators.pixels import SATURATION_CUTS

    v = raw[np.isfinite(raw)]
    if not len(v):
        return {"channel_qc_flags": "EMPTY_CHANNEL"}
    low, high = float(v.min()), float(v.max())
    cut = SATURATION_CUTS[0] if high > 255 else SATURATION_CUTS[1] if high > 1 else SATURATION_CUTS[2]
    full, dark = float((v >= cut).mean()), float((v <= low + 1e-5).mean())
    a, b = np.quantile(v, [0.001, 0.999])
    used = float((b - a) / (high - low)) if high > low else 0.0
    signal = float(np.nanmean(less))
    back = float(v.mean()) - signal
    flags = [name for name, holds in (("HIGH_SATURATION", full > saturated), ("LOW_DYNAMIC_RANGE", used < 0.05 and high > 0), ("NO_SIGNAL", high == 0 or signal < 1e-6), ("HIGH_BACKGROUND", back > 0.6 * max(1e-5, signal))) if holds]
    return {"raw_min": low, "raw_max": high, "corr_min": float(np.nanmin(less)), "corr_max": float(np.nanmax(less)), "mean_signal": signal, "saturated_pixel_fraction": full, "near_zero_pixel_fraction": dark, "dynamic_range_used": used, "channel_qc_flags": ";".join(flags) or "PASS"}


def positivity(plane: np.ndarray, method: str, manual: float | None = None) -> dict:
    """A threshold (``THRESHOLD``) of a channel; an empty channel has none, an unknown method takes the 90 % quantile of values above 0."""
    v = plane[np.isfinite(plane) & (plane > 0)]
    if not len(v):
        found = ("empty_channel", None, "no_valid_signal", "EMPTY_CHANNEL")
    elif method == "manual" and manual is not None:
        found = ("manual", float(manual), "user_specified", "LOCKED_MANUAL")
    elif method == "otsu":
        found = ("otsu", k.otsu(plane), "automatic_image_histogram", "AUTO_OTSU")
    elif method in ("percentile", "percentile_based"):
        found = ("percentile_90", float(np.quantile(v, 0.9)), "automatic_percentile", "AUTO_PERCENTILE")
    elif method in ("background", "background_based"):
        centre = float(np.median(v))
        found = ("bg_plus_3_sd", centre + 3 * 1.4826 * float(np.median(np.abs(v - centre))), "background_distribution", "AUTO_BACKGROUND_BASED")
    else:
        found = ("percentile_90_fallback", float(np.quantile(v, 0.9)), "default_fallback", "FALLBACK")
    return dict(zip(("threshold_method", "threshold_value", "threshold_source", "threshold_qc_status"), found, strict=True))


def compartment_masks(nuclei: np.ndarray, cells: np.ndarray, tissue: np.ndarray) -> dict[str, np.ndarray]:
    return dict(zip(COMPARTMENTS, (tissue, nuclei > 0, (cells > 0) & (nuclei == 0), tissue & (cells == 0)), strict=True))


def compartment_rows(plane: np.ndarray, masks: dict[str, np.ndarray], cut: dict, um: float) -> list[dict]:
    """Intensity of each compartment; one without pixels has count, area and sum 0, and its positivity isn't evaluable."""
    out, t = [], cut["threshold_value"]
    for name, mask in masks.items():
        v = plane[mask & np.isfinite(plane)]
        row = {"compartment": name, "pixel_count": len(v), "area_um2": len(v) * um * um, "integrated_intensity": float(v.sum())} | cut
        if len(v):
            row |= {"mean_intensity": float(v.mean()), "median_intensity": float(np.median(v)), "max_intensity": float(v.max()), "intensity_sd": float(v.std(ddof=1)) if len(v) > 1 else None}
            if t is not None:
                row |= {"positive_pixel_count": int((v >= t).sum()), "positive_area_fraction": float((v >= t).mean())}
        out.append(row)
    return out


def cell_rows(plane: np.ndarray, nuclei: np.ndarray, cells: np.ndarray, threshold: float | None, um: float) -> list[dict]:
    """Nucleus, cytoplasm and cell of each label: pixels, mean, median, sum, their ratio and positivity."""
    n = int(nuclei.max(initial=0))
    out: list[dict] = [{"cell_id": i + 1} for i in range(n)]
    zero = np.zeros(n)
    for name, labels in (("nuclear", nuclei), ("cytoplasmic", np.where(nuclei > 0, 0, cells)), ("cell", cells)):
        stats = label_stats(plane, labels, n, zero, 0.0)
        for i, row in enumerate(out):
            count, mean = stats["area_px"][i], number(stats["dab_raw_mean_od"][i])
            row |= {f"{name}_pixel_count": int(count), f"{name}_area_um2": count * um * um, f"{name}_mean_intensity": mean, f"{name}_median_intensity": number(stats["dab_median_od"][i]), f"{name}_integrated_intensity": count * mean if mean is not None else 0.0}
    for row in out:
        a, b, c = (row[f"{name}_mean_intensity"] for name in ("nuclear", "cytoplasmic", "cell"))
        row |= {"nuclear_to_cytoplasmic_ratio": a / b if a is not None and b is not None and b > 1e-6 else None, "is_positive_cell": c >= threshold if c is not None and threshold is not None else None}
    return out


def puncta_rows(plane: np.ndarray, masks: dict[str, np.ndarray], n_cells: int, small: float, large: float, deviations: float, um: float) -> list[dict]:
    """Bright spots that touch each compartment: number, per cell, area, density and intensity."""
    found = k.spots(plane, small, large, deviations)
    d = np.maximum(k.gaussian(plane, small) - k.gaussian(plane, large), 0)
    out = []
    for name, mask in masks.items():
        here = (found > 0) & mask
        count, area, v = len(np.unique(found[here])), float(mask.sum()) * um * um, plane[here]
        out.append(
            {"compartment": name, "puncta_count": count, "puncta_count_per_cell": None if name == "extracellular" else count / max(1, n_cells), "total_puncta_area_um2": float(here.sum()) * um * um, "puncta_density_per_um2": count / area if area else 0.0}
            | {"puncta_mean_intensity": float(v.mean()) if len(v) else 0.0, "puncta_integrated_intensity": float(v.sum()), "threshold_used": float(d.mean() + deviations * d.std())}
        )
    return out


def colocalisation_row(a: np.ndarray, b: np.ndarray, mask: np.ndarray, marker_a: str, marker_b: str, least: int = 30) -> dict:
    """Pearson's correlation and Manders' shares of two channels under a mask, thresholds by Otsu; not evaluable under ``least`` pixels."""
    both = mask & np.isfinite(a) & np.isfinite(b)
    x, y = a[both], b[both]
    row = {"compartment": "global", "marker_a": marker_a, "marker_b": marker_b, "pixel_count": len(x)}
    if len(x) < least:
        return row | {"colocalization_qc_status": "NOT_EVALUABLE_LOW_PIXEL_COUNT"}
    ta, tb = k.otsu(a), k.otsu(b)
    r = float(np.corrcoef(x, y)[0, 1]) if x.std(ddof=1) > 1e-8 and y.std(ddof=1) > 1e-8 else None
    share = lambda own, other, cut: float(own[other >= cut].sum() / own.sum()) if own.sum() > 1e-8 else None
    return row | {"pearson_r": r, "manders_m1": share(x, y, tb), "manders_m2": share(y, x, ta), "threshold_a": ta, "threshold_b": tb, "colocalization_qc_status": "PASS"}
