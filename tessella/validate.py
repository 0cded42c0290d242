"""Check a manifest and its annotations: ``python -m tessella.validate --manifest=M.csv [--roi=R.csv] [--out=FOLDER]``.

Writes the issues as TSV into the folder and exits with 2 if there are errors.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import inputs, reports, validation as va
from tessella.sources.manifest import read_csv


def existing_files(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Those of ``paths`` (full_path) that are files, in any store that Spark reads.

    Spark lists the folders without reading contents. That listing leaves out empty
    files, so what it lacks is looked up one by one; only distinct folders and those
    paths come to the driver, a partition at a time.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def exists(name: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(conf).exists(path)

    folders = paths.select(F.regexp_replace("full_path", r"[^/\\]*$", "").alias("f")).where("f <> ''").distinct()
    there = [r.f for r in folders.toLocalIterator() if exists(r.f)]
    if not there:
        return spark.createDataFrame([], "path string")
    listed = spark.read.format("binaryFile").load(there).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    rest = paths.where("full_path <> ''").distinct().join(listed, F.col("full_path") == F.col("path"), "left_anti")
    empty = [(r.full_path,) for r in rest.toLocalIterator() if exists(r.full_path)]
    return listed.unionByName(spark.createDataFrame(empty, "path string"))


def run(spark: SparkSession, manifest_path: str, roi_path: str | None, out: str) -> tuple[int, int]:
    """Numbers of errors and warnings; the issues are written to ``out``."""
    manifest, base = read_csv(spark, manifest_path), os.path.dirname(os.path.abspath(manifest_path)) if "://" not in manifest_path else manifest_path.rsplit("/", 1)[0]
    named = va.resolve_aliases(manifest, inputs.ALIASES)
    files = existing_files(spark, named.select(inputs.path_in("file_path", base).alias("full_path"))) if "file_path" in named.columns else None
    log = inputs.validate(manifest, read_csv(spark, roi_path) if roi_path else None, base, files).cache()
    reports.write_table(log, out, "tsv", ["level", "scope", "issue", "id"])
    n = {r.level: r["count"] for r in log.groupBy("level").count().collect()}
    return n.get("ERROR", 0), n.get("WARNING", 0)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessella.validate", description=__doc__)
    parser.add_argument("--manifest", required=True)
    parser.add_argument("--roi")
    parser.add_argument("--out")
    a = parser.parse_args(arguments)
    out = a.out or os.path.join(os.path.dirname(a.manifest), "input_validation.tsv")
    errors, warnings = run(SparkSession.builder.getOrCreate(), a.manifest, a.roi, out)
    print(f"Validation report: {out}\nErrors: {errors} Warnings: {warnings}")
    return 2 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
