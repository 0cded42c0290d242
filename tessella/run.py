"""Run a manifest: ``python -m tessella.run --manifest=M.csv --out=FOLDER [--roi=R.csv] [--config=C.csv] [--condition-order=A,B] [--format=csv]``.

The modality of the manifest decides which run it is. Exits with 0 if every image was
measured, 1 if some failed (see ``work/image_errors``), 2 if the run could not
be made, and 3 if it is blocked as images failed quality control.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tessella.operators import validation as va
from tessella.plans import runs
from tessella.sources import manifest as mf


def folder_of(path: str) -> str:
    return path.rsplit("/", 1)[0] if "://" in path else os.path.dirname(os.path.abspath(path))


def run(spark: SparkSession, manifest_path: str, out: str, roi_path: str | None = None, config_path: str | None = None, condition_order: str | None = None, kind: str = "csv") -> tuple[int, int]:
    """Numbers of images measured and failed."""
    if va.modality(mf.read_csv(spark, manifest_path)) == "if":
        done = runs.channel_run(spark, mf.channel_manifest(spark, manifest_path), folder_of(manifest_path), out, mf.roi_vertices(spark, roi_path) if roi_path else None, mf.read_options(spark, config_path, mf.ChannelRunOptions()) if config_path else None, condition_order, kind)
    else:
        done = runs.stain_run(spark, mf.stain_manifest(spark, manifest_path), folder_of(manifest_path), out, mf.roi_vertices(spark, roi_path) if roi_path else None, mf.read_options(spark, config_path, mf.StainRunOptions()) if config_path else None, condition_order, kind)
    return done.n_images, done.n_failed


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessella.run", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name, need in (("manifest", True), ("out", True), ("roi", False), ("config", False), ("condition-order", False)):
        parser.add_argument(f"--{name}", required=need)
    parser.add_argument("--format", default="csv", choices=("csv", "tsv", "parquet"))
    a = parser.parse_args(arguments)
    try:
        measured, failed = run(SparkSession.builder.getOrCreate(), a.manifest, a.out, a.roi, a.config, a.condition_order, a.format)
    except runs.BlockedByQuality as e:
        print(e, file=sys.stderr)
        return 3
    except (ValueError, RuntimeError) as e:
        print(e, file=sys.stderr)
        return 2
    print(f"Images measured: {measured} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
