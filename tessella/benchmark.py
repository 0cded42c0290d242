"""Score the nuclear segmentation: ``python -m tessella.benchmark --images=FOLDER --masks=FOLDER --out=FOLDER [--split=FILE]``.

Writes ``scores`` (a row for each image) and ``means`` as CSV. Exits with 1 if an image could not be scored, 2 if none was.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tessella.operators import benchmark as bm, reports


def run(spark: SparkSession, images: str, masks: str, out: str, split: str | None = None) -> tuple[int, int]:
    """Numbers of images scored and failed."""
    reports.write_table(bm.benchmark(bm.image_pairs(spark, images, masks, split)), f"{out}/work/scores")
    scores = spark.read.parquet(f"{out}/work/scores")
    reports.write_table(scores, f"{out}/scores", "csv", ["image_id"])
    reports.write_table(bm.means(scores), f"{out}/means", "csv")
    n, failed = scores.count(), scores.where("error is not null").count()
    return n - failed, failed


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessella.benchmark", description=__doc__)
    for name, need in (("images", True), ("masks", True), ("out", True), ("split", False)):
        parser.add_argument(f"--{name}", required=need)
    a = parser.parse_args(arguments)
    scored, failed = run(SparkSession.builder.getOrCreate(), a.images, a.masks, a.out, a.split)
    print(f"Images scored: {scored} failed: {failed}")
    return 2 if not scored else 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
