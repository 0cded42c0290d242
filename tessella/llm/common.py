"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    That setting names the storage which the driver and all executors share. It
    must be set on a cluster; only where the driver is the one executor (master
    local, as in tests) a temp folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/tessella-scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    This cuts the lineage: a lost executor costs a re-read, never the
    recomputation of what came before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def total_counts(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of ``count`` of their batches: an array of ``size`` numbers.

    The sums travel in compressed parts of 2**16 numbers and are added up in a tree
    of two levels, so that no task adds up more than a 64th of the tasks.
    """
    part = 1 << 16

    def packed(number: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([zlib.compress(counts.astype("<i8").tobytes(), 1)], pa.binary())], ["part", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = count(batches)
        for number, at in enumerate(range(0, size, part)):
            if total[at : at + part].any():
                yield packed(number, total[at : at + part])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                total[number] = total.get(number, 0) + np.frombuffer(zlib.decompress(counts.as_py()), dtype="<i8")
        for number, counts in total.items():
            yield packed(number, counts)

    schema = "part int, counts binary"
    parts = rows.mapInArrow(run, schema).withColumn("branch", F.spark_partition_id() % 64)
    parts = parts.repartition("part", "branch").select("part", "counts").mapInArrow(add, schema).repartition("part").mapInArrow(add, schema)
    total = np.zeros(size, dtype=np.int64)
    for r in parts.collect():
        total[r.part * part : (r.part + 1) * part] += np.frombuffer(zlib.decompress(r.counts), dtype="<i8")
    return total


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches to Python of at most this size, so that very long texts come one by one.

    Every query that sends texts to Python begins with this, so that none depends on
    what ran before it in the session. Spark reads the setting when the returned
    frame runs, so it stays set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def doc_key(column: str = "doc_id") -> Column:
    """The record key as text; a missing key has a name of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def bounded_sample(df: DataFrame, rows: int, *ties: str) -> DataFrame:
    """At most ``rows`` rows by hash of ``doc_id`` (no larger than the table).

    A large table is first thinned by another hash to about twice as many rows,
    so that what its tasks send to be merged doesn't grow with their number.
    """
    n = df.count()
    if n > 3 * rows:
        df = df.where(F.pmod(F.xxhash64(doc_key(), F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * (2 * rows + 50) / n))
    return df.orderBy(F.md5(doc_key()), "doc_id", *ties).limit(rows)


def slices(batches: Iterator, max_bytes: int = 1 << 21) -> Iterator:
    """Cut Arrow batches so that each holds about ``max_bytes`` or one row."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, int(rows * max_bytes / max(batch.nbytes, 1))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many lines below as keep it from clashing with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
