"""Segmentation of nuclei and cells, one image in a task at a time.

A plane frame has ``image_id, h, w, data`` (float32, row by row, as binary) or
several such data columns; planes travel as binary, never as a row for each
pixel, and only the labels come back as pixel rows where a query needs them. A
failing image gives a row with its error instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessella.functions import kernels as k
from tessella.operators import pixels as px

#: Bytes of label planes that a task passes on together.
FRAME_BYTES = 32 << 20
#: Bytes of planes that a task turns from Arrow to NumPy at once.
SLICE_BYTES = 1 << 20
LABELS = "h int, w int, nuc binary, cell binary, tissue binary, n_cells int, status string, error string"


@dataclass
class StainOptions:
    """Brightfield segmentation (lengths in pixels)."""

    blur: float = 1.5
    least_threshold: float = 0.12
    min_area: float = 20.0
    max_area: float = 2000.0
    min_circularity: float = 0.0
    max_eccentricity: float = 0.995
    min_mean: float = 0.02
    margin: int = 1
    reach: int = 8
    tolerance: float = 1.0
    tissue_od: float = 0.10
    tissue_closing: int = 2


@dataclass
class FluorescenceOptions:
    """Fluorescence segmentation (lengths in pixels). ``nucleus_threshold``: otsu, or a number."""

    blur: float = 1.5
    nucleus_threshold: str | float = "otsu"
    min_area: float = 30.0
    max_area: float = 4000.0
    tolerance: float = 1.0
    watershed_reach: int = 1
    radius: int = 15
    radius_cap: int = 10
    gap: float = 1.0
    reference_share: float = 0.5
    tissue_share: float = 0.02


def unmixed(rgb: np.ndarray, analysis: np.ndarray, white_quantile: float = 0.98) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Haematoxylin, DAB and the sum of optical densities of an RGB image, after white balance on its analysed pixels."""
    if not analysis.any():
        raise ValueError("no pixel is left to analyse")
    bright = rgb.mean(-1)
    white = np.median(rgb[analysis & (bright >= np.quantile(bright[analysis], white_quantile))], axis=0)
    od = -np.log(np.maximum(np.clip(rgb / np.where(white >= 0.5, white, 1.0), 0, 1), 1 / 255))
    c = np.maximum(np.nan_to_num(od @ np.linalg.inv(px.stain_matrix()), posinf=0, neginf=0), 0)
    return c[..., 0], c[..., 1], od.sum(-1)


def stain_tissue(total: np.ndarray, analysis: np.ndarray, o: StainOptions) -> np.ndarray:
    """Analysed pixels over the least density, closed; excluded ones stay out."""
    return k.closing((total > o.tissue_od) & analysis, k.disc(o.tissue_closing)) & analysis


def stain_threshold(haematoxylin: np.ndarray, tissue: np.ndarray, o: StainOptions) -> float:
    smooth = k.gaussian(k.scale01(haematoxylin), o.blur)
    return float(max(k.otsu(smooth[tissue]) if tissue.any() else 1.0, o.least_threshold))


def stain_nuclei(haematoxylin: np.ndarray, tissue: np.ndarray, o: StainOptions) -> np.ndarray:
    """Blur, threshold, open, close, fill, watershed and gates on size, shape, stain and border."""
    smooth = k.gaussian(k.scale01(haematoxylin), o.blur)
    mask = (smooth > stain_threshold(haematoxylin, tissue, o)) & tissue
    mask = k.fill_holes(k.closing(k.opening(mask, k.disc(1)), k.disc(1)))
    labels = k.watershed(k.distance(mask), mask, o.tolerance)
    f = k.features(labels, haematoxylin)
    h, w = labels.shape
    inside = (f["cx"] > o.margin) & (f["cx"] < w - 1 - o.margin) & (f["cy"] > o.margin) & (f["cy"] < h - 1 - o.margin)
    keep = (f["area"] >= o.min_area) & (f["area"] <= o.max_area) & (f["circularity"] >= o.min_circularity) & (f["eccentricity"] <= o.max_eccentricity) & (f["mean"] >= o.min_mean) & inside
    return k.renumber(labels, np.flatnonzero(keep) + 1)


def stain_cells(total: np.ndarray, nuclei: np.ndarray, tissue: np.ndarray, analysis: np.ndarray, o: StainOptions) -> np.ndarray:
    """Cells: nuclei grown over the total optical density, scaled by its analysed pixels, in the tissue within reach."""
    near = k.dilate(nuclei > 0, k.disc(o.reach)) & tissue
    return k.propagate(k.scale01(total, within=analysis), nuclei, near)


def guarded_radius(nuclei: np.ndarray, o: FluorescenceOptions) -> int:
    """Expansion that keeps ``gap`` pixels between the nearest cells, within the configured radius and cap."""
    f = k.features(nuclei, nuclei.astype(float))
    limit = min(o.radius, o.radius_cap)
    if len(f["area"]) < 2:
        return limit
    r = np.sqrt(f["area"] / np.pi)
    order = np.argsort(f["cx"])
    cx, cy, r = f["cx"][order], f["cy"][order], r[order]
    span = 2 * limit + o.gap + 2 * r.max()
    least = np.inf
    for i in range(len(cx)):  # pairs beyond the span cannot bind
        j = int(np.searchsorted(cx, cx[i] + span, side="right"))
        if j > i + 1:
            d = np.hypot(cx[i + 1 : j] - cx[i], cy[i + 1 : j] - cy[i]) - r[i + 1 : j] - r[i]
            least = min(least, float(d.min()))
    return limit if not np.isfinite(least) else int(max(0, min(limit, np.floor((least - o.gap) / 2))))


def open_contacts(cells: np.ndarray, nuclei: np.ndarray) -> np.ndarray:
    """Clear the pixels at which two cells touch, but for nuclei."""
    pad, touch = np.pad(cells, 1), np.zeros(cells.shape, dtype=bool)
    for dy, dx in k.NEAR4:
        other = pad[1 + dy : 1 + dy + cells.shape[0], 1 + dx : 1 + dx + cells.shape[1]]
        touch |= (other > 0) & (other != cells) & (cells > 0)
    return np.where(touch & (nuclei == 0), 0, cells)


def fluorescence_nuclei(nuclear: np.ndarray, o: FluorescenceOptions) -> np.ndarray:
    smooth = k.gaussian(nuclear, o.blur)
    top = float(smooth.max(initial=0.0))
    if not top > 0:
        return np.zeros(nuclear.shape, dtype=np.int32)
    cut = k.otsu(smooth / top) * top if o.nucleus_threshold == "otsu" else float(o.nucleus_threshold)
    mask = k.opening(k.fill_holes(smooth > cut), k.disc(1))
    labels = k.watershed(k.distance(mask), mask, o.tolerance, o.watershed_reach)
    area = np.bincount(labels.ravel(), minlength=1)
    return k.renumber(labels, [i for i in range(1, len(area)) if o.min_area <= area[i] <= o.max_area])


def fluorescence_cells(nuclear: np.ndarray, nuclei: np.ndarray, o: FluorescenceOptions, reference: np.ndarray | None = None) -> np.ndarray:
    """Nuclei grown by the guarded radius, within the reference channel if there is one, with a gap between cells."""
    if not nuclei.any():
        return nuclei
    near = k.distance(nuclei == 0) <= guarded_radius(nuclei, o)
    if reference is not None:
        smooth = k.gaussian(reference, 2.0)
        top = float(smooth.max(initial=0.0))
        if top > 0:
            near &= (smooth > o.reference_share * k.otsu(smooth / top) * top) | (nuclei > 0)
    return open_contacts(k.propagate(k.gaussian(nuclear, o.blur), nuclei, near), nuclei)


def tissue_proxy(nuclear: np.ndarray, reference: np.ndarray | None, share: float) -> np.ndarray:
    top = nuclear if reference is None else np.maximum(nuclear, reference)
    return k.opening(top > share * top.max(initial=0.0), k.disc(1))


def segmentation_flags(n_cells: int, tissue_share: float, proxy: bool = True) -> str:
    flags = ["NO_CELLS"] if n_cells == 0 else ["LOW_CELL_COUNT"] if n_cells < 10 else []
    flags += ["NO_TISSUE"] if tissue_share == 0 else ["SEGMENTATION_SUSPECT"] if tissue_share < 0.001 else []
    flags += ["TISSUE_PROXY"] if proxy else []
    return ";".join(flags) or "PASS"


def plane(row, column: str) -> np.ndarray | None:
    data = getattr(row, column, None)
    return None if data is None else np.frombuffer(data, dtype="<f4").reshape(row.h, row.w).astype(float)


def id_type(planes: DataFrame) -> str:
    """The type of ``image_id``, which results keep: manifests have texts, other tables numbers."""
    return planes.schema["image_id"].dataType.simpleString()


def each_image(planes: DataFrame, segment: Callable) -> DataFrame:
    """Apply ``segment`` (row -> nuclei, cells, tissue) to every plane row; errors become rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, size = [], 0
            for row in frame.itertuples(index=False):
                out = {"image_id": row.image_id, "h": row.h, "w": row.w, "nuc": None, "cell": None, "tissue": None, "n_cells": 0, "status": "OK", "error": None}
                try:
                    nuclei, cells, tissue = segment(row)
                    out |= {"nuc": nuclei.astype("<i4").tobytes(), "cell": cells.astype("<i4").tobytes(), "tissue": tissue.astype("u1").tobytes(), "n_cells": int(nuclei.max(initial=0))}
                except Exception as e:  # one bad image must not end the run
                    out |= {"status": "ERROR", "error": f"{type(e).__name__}: {e}"}
                rows.append(out)
                size += 9 * row.h * row.w
                if size > FRAME_BYTES:
                    yield pd.DataFrame(rows)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows)

    return planes.mapInPandas(run, f"image_id {id_type(planes)}, {LABELS}")


def segment_stained(planes: DataFrame, options: StainOptions | None = None) -> DataFrame:
    """Labels of brightfield images from planes ``haematoxylin`` and ``od_sum`` (sum of optical densities).

    Where there is a plane ``analysis`` (bytes, 1: analysed), excluded pixels are no
    tissue from the start, and again after the closing.
    """
    o = options or StainOptions()

    def segment(row):
        h, total = plane(row, "haematoxylin"), plane(row, "od_sum")
        given = getattr(row, "analysis", None)
        analysis = np.frombuffer(given, dtype=np.uint8).reshape(h.shape) > 0 if given else np.ones(h.shape, dtype=bool)
        tissue = stain_tissue(total, analysis, o)
        nuclei = stain_nuclei(h, tissue, o)
        return nuclei, stain_cells(total, nuclei, tissue, analysis, o), tissue

    return each_image(planes, segment)


def segment_fluorescent(planes: DataFrame, options: FluorescenceOptions | None = None) -> DataFrame:
    """Labels of fluorescence images from planes ``nuclear`` and, if there, ``reference``."""
    o = options or FluorescenceOptions()

    def segment(row):
        nuclear, reference = plane(row, "nuclear"), plane(row, "reference")
        nuclei = fluorescence_nuclei(nuclear, o)
        return nuclei, fluorescence_cells(nuclear, nuclei, o, reference), tissue_proxy(nuclear, reference, o.tissue_share)

    return each_image(planes, segment)


def nucleus_features(planes: DataFrame, options: FluorescenceOptions | None = None) -> DataFrame:
    """(image_id, nuc_label, area, cx, cy, eccentricity) of the nuclei of planes ``nuclear``: segmented and measured in one pass, no pixel leaves its task.

    An image that fails gives no row; ``segment_fluorescent`` tells why.
    """
    o = options or FluorescenceOptions()
    columns = ("area", "cx", "cy", "eccentricity")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, found = [], []
            for row in frame.itertuples(index=False):
                try:
                    nuclei = fluorescence_nuclei(plane(row, "nuclear"), o)
                except Exception:  # one bad image must not end the run
                    continue
                f = k.features(nuclei, nuclei.astype(float))
                n = len(f["area"])
                ids += [row.image_id] * n
                found.append(np.column_stack([np.arange(1, n + 1), *(f[c] for c in columns)]))
            if ids:
                table = np.concatenate(found)
                yield pd.DataFrame({"image_id": ids, "nuc_label": table[:, 0].astype("i4"), "area": table[:, 1].astype("i8"), **{c: table[:, i] for i, c in enumerate(columns[1:], 2)}})

    return planes.mapInPandas(run, f"image_id {id_type(planes)}, nuc_label int, area long, cx double, cy double, eccentricity double")


def decode_instances(code: np.ndarray) -> np.ndarray:
    """Labels of an instance-colour mask: the commonest colour is background, every other colour's regions are objects."""
    values, count = np.unique(code, return_counts=True)
    return k.value_components(code, values[np.argmax(count)])


def external_mask(mask: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    if mask.shape != shape:
        raise ValueError(f"the mask has {mask.shape}, the image {shape}")
    return k.components(mask > 0)


def label_pixels(labels: DataFrame) -> DataFrame:
    """Pixel rows (image_id, x, y, nuc_label, cell_label, tissue) of the images that were segmented."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                y, x = np.divmod(np.arange(r.h * r.w), r.w)
                yield pd.DataFrame({"image_id": r.image_id, "x": x.astype("i4"), "y": y.astype("i4"), "nuc_label": np.frombuffer(r.nuc, "<i4"), "cell_label": np.frombuffer(r.cell, "<i4"), "tissue": np.frombuffer(r.tissue, "u1") > 0})

    return labels.where("status = 'OK'").mapInPandas(run, f"image_id {id_type(labels)}, x int, y int, nuc_label int, cell_label int, tissue boolean")


def small_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose planes ``column`` have ``SLICE_BYTES`` at most, or of one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, begin = np.cumsum(size), 0
        while begin < len(size):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def plane_pixels(planes: DataFrame, column: str, name: str = "v") -> DataFrame:
    """Pixel rows (image_id, x, y, value) of a plane column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_batches(batches, "data"):
            for i, r in enumerate(part.select(["h", "w", "data"]).to_pandas().itertuples(index=False)):
                y, x = np.divmod(np.arange(r.h * r.w, dtype="i4"), np.int32(r.w))
                ids = part.column("image_id").take(pa.array(np.full(len(x), i)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(x), pa.array(y), pa.array(np.frombuffer(r.data, "<f4").astype(float))], ["image_id", "x", "y", name])

    return planes.select("image_id", "h", "w", F.col(column).alias("data")).mapInArrow(run, f"image_id {id_type(planes)}, x int, y int, {name} double")


def map_planes(planes: DataFrame, column: str, kernel: Callable[[np.ndarray], np.ndarray], name: str) -> DataFrame:
    """Add a plane column with the kernel's result."""
    fields = [f for f in planes.schema.fields if f.name != name]
    schema = StructType([*fields, StructField(name, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_batches(batches, column):
            rows = part.select(["h", "w", column]).to_pandas().itertuples(index=False)
            made = pa.array([kernel(plane(r, column)).astype("<f4").tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in fields), made], schema.names)

    return planes.mapInArrow(run, schema)
