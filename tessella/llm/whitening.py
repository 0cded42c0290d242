"""Whitening of embeddings: covariance by column aggregates in Spark, eigenvectors by LAPACK.

One aggregation has an expression for every pair of dimensions of the upper
triangle: the sum of products of values that are centred first. Only those
sums, d (d + 1) / 2 numbers, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import materialise, small_batches, table

#: A component counts if its eigenvalue is over this share of the largest; others are rounding.
LEAST_SHARE = 1e-12
#: Sums of a task are added up in this many branches before the last addition.
BRANCHES = 64
#: Entries are 64ths, counted from this one (fixed values); larger ones than a long can hold stay at its end.
SCALE, OFFSET, LARGEST = 64, 1_000_000, float(2**62)


def integer_vectors(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``x``: the vector's entries as long ``floor(64 c) + 1000000``, without rows that have none.

    A vector goes if it is null or empty or holds a null, NaN or infinite entry, and
    if it isn't as long as most vectors are (of lengths equally common: the longest).
    """
    v = F.col(column).cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & (F.size(v) > 0)
    kept = rows.where(v.isNotNull()).where(sound)
    size = kept.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).head()
    if size is None:
        return kept.withColumn("x", F.array().cast("array<long>"))
    held = F.transform(v, lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long") + OFFSET)
    return kept.where(F.size(v) == size.d).withColumn("x", held)


def summed(rows: DataFrame, sums: Sequence[Column]) -> list:
    """The sums of all rows, added up within tasks, then in ``BRANCHES`` branches, then once."""
    names = [f"s{i}" for i in range(len(sums))]
    parts = rows.withColumn("branch", F.spark_partition_id() % BRANCHES).groupBy("branch").agg(*(F.sum(s).alias(n) for s, n in zip(sums, names, strict=True)))
    return list(parts.agg(*(F.sum(n).alias(n) for n in names)).head())


def centred(x: np.ndarray, count: int, totals: Sequence[int]) -> np.ndarray:
    """n x - S of each entry, exact: as long where that fits, else as Python's integers."""
    reach = max(int(x.max(initial=0)), -int(x.min(initial=0))) * count + max(map(abs, totals), default=0)
    kind = np.int64 if reach < 2**62 else object
    return x.astype(kind) * count - np.array(totals, dtype=kind)


def squares(apart: np.ndarray) -> list[int | None]:
    """Exact sum of the squares of each row; None where a long can't hold it."""
    if apart.dtype != object and apart.shape[1] * max(int(apart.max(initial=0)), -int(apart.min(initial=0))) ** 2 < 2**62:
        return (apart * apart).sum(1).tolist()
    return [s if s < 2**63 else None for s in (apart.astype(object) ** 2).sum(1).tolist()]


def vectors_of(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, d)


def covariance(rows: DataFrame, column: str, d: int, count: int) -> np.ndarray:
    """Covariance (divisor ``count``) of the centred vectors of ``column``: one aggregation, one expression for each pair of the upper triangle."""
    named = rows.select(*(F.get(column, F.lit(i)).alias(f"c{i}") for i in range(d)))
    sums = summed(named, [F.expr(f"c{i} * c{j}") for i in range(d) for j in range(i, d)])
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = np.array(sums, dtype=float) / count
    return out + np.triu(out, 1).T


def components(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` eigenvalues, falling, and their unit eigenvectors as columns, without those that are 0 but for rounding."""
    values, vectors = np.linalg.eigh(cov)  # LAPACK's divide and conquer
    order = np.argsort(values)[::-1][:most]
    values, vectors = values[order], vectors[:, order]
    keep = values > max(LEAST_SHARE * max(values.max(initial=0.0), 0.0), 0.0)
    return values[keep], vectors[:, keep]


def whiten(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", most: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each vector and component.

    The model is fitted on the distinct vectors. Vectors that ``integer_vectors``
    drops give no row. Repeated rows give theirs each, and a null id stays null.
    With fewer than two distinct vectors, or an empty table, there is no component
    and no row; where vectors span fewer dimensions than ``most`` there are as many
    components. ``deviation`` is null where a long can't hold it. Other columns are not read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = integer_vectors(rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("v")), "v").select("vec_id", "x")
    fitted = materialise(found.select("x").distinct(), "whitening-fit")
    first = fitted.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).head()
    n, d = first.n, first.d or 0
    none = rows.sparkSession.createDataFrame([], schema)
    if n < 2 or not d:
        return none
    totals = [int(s) for s in summed(fitted, [F.get("x", F.lit(i)).cast("decimal(20,0)") for i in range(d)])]

    def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = centred(vectors_of(batch, "x", d), n, totals).astype(float) / n
            yield pa.RecordBatch.from_arrays([pa.array(list(m), pa.list_(pa.float64()))], ["m"])

    cov = covariance(fitted.mapInArrow(middle, "m array<double>"), "m", d, n)
    values, vectors = components(cov, most)
    k = len(values)
    if not k:
        return none
    weights, share = vectors / np.sqrt(values), values / np.trace(cov)

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = centred(vectors_of(batch, "x", d), n, totals)
            z = apart.astype(float) / n @ weights
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(squares(apart), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))], ["vec_id", "deviation", "z"])

    whitened = "vec_id long, deviation long, z array<double>"
    of_fit = fitted.select(F.lit(0).cast("long").alias("vec_id"), "x").mapInArrow(white, whitened)
    error = float(np.abs(covariance(of_fit, "z", k, n) - np.eye(k)).max())
    out = found.mapInArrow(white, whitened).select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    explained = F.element_at(F.array(*(F.lit(float(s)) for s in share)), F.col("k") + 1)
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """``whiten`` over all ``embeddings``, 16 components."""
    small_batches(spark)
    return whiten(table(spark, sf_dir, "embeddings"))
