"""A segmentation against true instance masks, image by image in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import kernels as k
from tessella.operators import scoring, segment
from tessella.sources import images as im

SCORES = "image_id string, n_truth long, n_predicted long, tp long, mean_matched_iou double, dice double, iou double, error string"
#: Scores that every image has, and those that need objects (fixed values).
ALWAYS, WHERE_DEFINED = ("dice", "iou"), ("precision", "recall", "f1", "count_error", "mean_matched_iou")


def true_labels(mask: np.ndarray) -> np.ndarray:
    """Objects of a mask [row, column, sample] of 0 to 1: by colour if it has several samples, else the regions above 0."""
    if mask.shape[2] < 2:
        return k.components(mask[..., 0] > 0)
    level = np.round(np.clip(mask[..., :3], 0, 1) * 255).astype(np.int64)
    return segment.decode_instances(level @ np.array([1, 256, 65536])[: level.shape[2]])


def matched(predicted: np.ndarray, truth: np.ndarray, threshold: float = 0.5) -> np.ndarray:
    """IoU of the one-to-one matches by falling IoU of ``threshold`` or more, from the pairs that share pixels."""
    n, m = int(predicted.max(initial=0)), int(truth.max(initial=0))
    both = (predicted > 0) & (truth > 0)
    if not both.any():
        return np.zeros(0)
    pair, shared = np.unique(truth[both].astype(np.int64) * (n + 1) + predicted[both], return_counts=True)
    t, p = np.divmod(pair, n + 1)
    iou = shared / (np.bincount(predicted.ravel(), minlength=n + 1)[p] + np.bincount(truth.ravel(), minlength=m + 1)[t] - shared)
    order = np.argsort(-iou, kind="stable")
    order = order[iou[order] >= threshold]
    free_p, free_t, out = np.ones(n + 1, dtype=bool), np.ones(m + 1, dtype=bool), []
    for i in order.tolist():
        if free_p[p[i]] and free_t[t[i]]:
            free_p[p[i]] = free_t[t[i]] = False
            out.append(iou[i])
    return np.array(out)


def label_scores(predicted: np.ndarray, truth: np.ndarray) -> dict:
    """Counts, matches, and Dice and IoU of the foregrounds (0 where both are empty)."""
    if predicted.shape != truth.shape:
        raise ValueError(f"the mask has {truth.shape}, the image {predicted.shape}")
    a, b, found = predicted > 0, truth > 0, matched(predicted, truth)
    both, either = int((a & b).sum()), int((a | b).sum())
    return {"n_truth": int(truth.max(initial=0)), "n_predicted": int(predicted.max(initial=0)), "tp": len(found), "mean_matched_iou": float(found.mean()) if len(found) else None, "dice": 2 * both / (both + either) if either else 0.0, "iou": both / either if either else 0.0}


def nuclei_of(image: np.ndarray, o: segment.FluorescenceOptions) -> np.ndarray:
    grey = image[..., 0]
    return segment.fluorescence_nuclei((grey - grey.min()) / (grey.max() - grey.min() + 1e-8), o)


def score_images(pairs: DataFrame, predict: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``SCORES`` of image_id, image and mask (file contents); an image that can't be scored has an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                row = {"image_id": r.image_id}
                try:
                    if r.mask is None:
                        raise FileNotFoundError("no mask")
                    row |= label_scores(predict(im.first_image(r.image)), true_labels(im.first_image(r.mask)))
                except Exception as e:  # one bad image must not end the run
                    row |= {"error": f"{type(e).__name__}: {e}"}
                yield pd.DataFrame([row], columns=[c.split()[0] for c in SCORES.split(", ")]).astype(object).where(lambda d: d.notna(), None)

    return pairs.select("image_id", "image", "mask").mapInPandas(run, SCORES)


def stem(path: str) -> Column:
    """A file's name without folders and its last ending."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", "")


def image_pairs(spark: SparkSession, images: str, masks: str, split: str | None = None) -> DataFrame:
    """Images of a folder with the mask of the same stem; ``split``: a text file that names the images to take, one a line."""
    each = spark.read.format("binaryFile").load(images).select(stem("path").alias("image_id"), F.col("content").alias("image"))
    if split:
        named = spark.read.text(split).select(stem("value").alias("image_id")).where("image_id <> ''").distinct()
        each = each.join(named, "image_id", "left_semi")
    return each.join(spark.read.format("binaryFile").load(masks).select(stem("path").alias("image_id"), F.col("content").alias("mask")), "image_id", "left")


def benchmark(pairs: DataFrame, options: segment.FluorescenceOptions | None = None) -> DataFrame:
    """Object scores of each image, with precision, recall, F1 and relative count error."""
    o = options or segment.FluorescenceOptions(min_area=30, max_area=4000)
    return scoring.object_scores(score_images(pairs, lambda image: nuclei_of(image, o)))


def means(scores: DataFrame) -> DataFrame:
    """Means over the images that were scored; those that need objects over the images that have them."""
    return scoring.benchmark_means(scores.where("error is null"), ALWAYS, WHERE_DEFINED)


