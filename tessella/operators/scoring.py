"""Scores of a segmentation against truth."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import ratio


def greedy_matches(overlaps: DataFrame, keys: Sequence[str], a: str, b: str, threshold: float = 0.5) -> DataFrame:
    """One-to-one matches by falling IoU (ties by labels), of ``threshold`` or more.

    Over a threshold of 0.5 an object has one such partner at most, so that only
    the pairs themselves count; at or below it they are matched image by image.
    """
    pairs = overlaps.where(F.col("iou") >= threshold)
    if threshold > 0.5:
        return pairs

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        used_a, used_b, keep = set(), set(), []
        rows = rows.sort_values(["iou", a, b], ascending=[False, True, True], kind="stable")
        for i, (x, y) in enumerate(zip(rows[a], rows[b], strict=True)):
            if x not in used_a and y not in used_b:
                used_a.add(x)
                used_b.add(y)
                keep.append(i)
        return rows.iloc[keep]

    return pairs.groupBy(*keys).applyInPandas(match, pairs.schema)


def object_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and relative count error from n_truth, n_predicted and tp; null where not defined."""
    p, r = ratio(F.col("tp"), F.col("n_predicted")), ratio(F.col("tp"), F.col("n_truth"))
    out = counts.withColumns({"fp": F.col("n_predicted") - F.col("tp"), "fn": F.col("n_truth") - F.col("tp"), "precision": p, "recall": r})
    total = F.col("precision") + F.col("recall")
    return out.withColumns({"f1": F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total), "count_error": ratio(F.abs(F.col("n_predicted") - F.col("n_truth")), F.col("n_truth"))})


def pixel_overlap(pixels: DataFrame, keys: Sequence[str], predicted: str, truth: str) -> DataFrame:
    """Dice and IoU of the foregrounds; 0 where both are empty."""
    p, t = F.col(predicted) > 0, F.col(truth) > 0
    both, np_, nt = F.count(F.when(p & t, 1)), F.count(F.when(p, 1)), F.count(F.when(t, 1))
    return pixels.groupBy(*keys).agg(F.when(np_ + nt > 0, 2 * both / F.nullif(np_ + nt, F.lit(0))).otherwise(0.0).alias("dice"), F.when(np_ + nt > 0, both / F.nullif(np_ + nt - both, F.lit(0))).otherwise(0.0).alias("iou"))


def benchmark_means(scores: DataFrame, everywhere: Sequence[str], where_defined: Sequence[str]) -> DataFrame:
    """Means over all images, and over those on which a score is defined."""
    return scores.agg(F.count(F.lit(1)).alias("n_images"), *(F.avg(c).alias(f"mean_{c}") for c in (*everywhere, *where_defined)))


