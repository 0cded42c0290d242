"""Intake of reviewers' reports: each run takes the files that came since the last one.

    python -m jobs.review_intake --reports=FOLDER --out=FOLDER --checkpoint=FOLDER [--config=FILE]

A file stream with a checkpoint reads new Parquet files once and appends a compact
row for each report (words, lines, digest, flags; no text) to ``reports``, partitioned
by source. From these rows it then writes ``register``, partitioned by quality
status, where a report is also flagged if an earlier one has the same words, and
``summary``, a row for each source. Both are made anew from ``reports`` each run, so a run
that stopped half way is mended by the next, and a run without new files changes nothing.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, mapped, session, settings_of
from tessella.operators.joins import spread_join

SHIPPED = "review_intake.csv"
#: Flags that fail a report (fixed values); others ask for a look.
FAILING = ("EMPTY_REPORT", "COPIED_REPORT")
REPORTS = "report_id long, lang string, n_words long, n_lines long, n_repeated_lines long, digest string, flags array<string>, source string"
REGISTER = "report_id long, source string, lang string, n_words long, n_lines long, n_repeated_lines long, digest string, n_copies long, first_report_id long, qc_flags string, qc_status string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def checked(reports: DataFrame, settings: Mapping[str, str]) -> DataFrame:
    """A row (``REPORTS``) for each report. A null text is empty; the digest ignores case of A-Z and kinds of blanks, and is null without words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")
    plain = F.translate(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), UPPER, LOWER)
    out = reports.select(
        F.col("report_id").cast("long").alias("report_id"), "lang", F.size(words).cast("long").alias("n_words"), F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_repeated_lines"),
        F.when(plain != "", F.md5(plain)).alias("digest"), plain.rlike(rf"\b({settings['artifact_words']})").alias("artifact"), "source",
    )
    flags = F.array_compact(
        F.array(
            F.when(F.col("n_words") == 0, "EMPTY_REPORT"),
            F.when(F.col("n_words").between(1, int(settings["least_words"]) - 1), "SHORT_REPORT"),
            F.when(F.col("n_words") > int(settings["most_words"]), "LONG_REPORT"),
            F.when((F.col("n_lines") >= 4) & (F.col("n_repeated_lines") >= float(settings["repeated_lines"]) * F.col("n_lines")), "REPEATED_LINES"),
            F.when(F.col("artifact"), "ARTIFACT_REPORTED"),
        )
    )
    return out.select("report_id", "lang", "n_words", "n_lines", "n_repeated_lines", "digest", flags.alias("flags"), "source")


def pattern_of(path: str) -> str:
    """A pattern that matches ``path`` alone: a file stream takes a single file by a pattern only, and a folder either way."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def take_new(spark: SparkSession, reports_path: str, out: str, checkpoint: str, settings: Mapping[str, str]) -> int:
    """Append the rows of all new files to ``out``/reports; how many reports were read."""
    schema = spark.read.parquet(reports_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings["max_files_per_batch"]).parquet(pattern_of(reports_path))
    rows = checked(mapped(stream, settings, "reports"), settings)
    query = rows.writeStream.format("parquet").partitionBy("source").option("path", f"{out}/reports").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def register(reports: DataFrame) -> DataFrame:
    """All reports with the copies of their words and their final flags; the least report_id of a digest is the first."""
    copies = reports.where("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("n_copies"), F.min("report_id").alias("first_report_id")).where("n_copies > 1")
    all_rows = spread_join(reports, copies, "digest")
    copied = F.when(F.col("n_copies").isNotNull() & ~F.col("report_id").eqNullSafe(F.col("first_report_id")), "COPIED_REPORT")
    flags = F.array_compact(F.concat("flags", F.array(copied)))
    out = all_rows.withColumns({"f": flags, "n_copies": F.coalesce("n_copies", F.lit(1)), "first_report_id": F.coalesce("first_report_id", "report_id")})
    status = F.when(F.arrays_overlap("f", F.array(*(F.lit(x) for x in FAILING))), "FAIL_REVIEW_REQUIRED").when(F.size("f") > 0, "REVIEW").otherwise("PASS")
    return out.select("report_id", "source", "lang", "n_words", "n_lines", "n_repeated_lines", "digest", "n_copies", "first_report_id", F.when(F.size("f") > 0, F.array_join("f", ";")).otherwise("PASS").alias("qc_flags"), status.alias("qc_status"))


def summary(rows: DataFrame) -> DataFrame:
    """Reports, words and statuses of each source."""
    n = F.count(F.lit(1))
    return rows.groupBy("source").agg(n.alias("n_reports"), F.sum("n_words").alias("n_words"), *(F.count_if(F.col("qc_status") == s).alias(f"n_{s.lower()}") for s in ("PASS", "REVIEW", "FAIL_REVIEW_REQUIRED")))


def read_register(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(REGISTER).parquet(f"{out}/register")


def run(spark: SparkSession, reports_path: str, out: str, checkpoint: str, settings: Mapping[str, str]) -> int:
    """The whole job; how many new reports it took."""
    new = take_new(spark, reports_path, out, checkpoint, settings)
    log.info("read %d new reports from %s", new, reports_path)
    register(spark.read.schema(REPORTS).parquet(f"{out}/reports")).write.mode("overwrite").partitionBy("qc_status").parquet(f"{out}/register")
    rows = read_register(spark, out)
    summary(rows).write.mode("overwrite").parquet(f"{out}/summary")
    log.info("wrote %d reports of %d sources to %s", rows.count(), spark.read.parquet(f"{out}/summary").count(), out)
    return new


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.review_intake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("reports", "out", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    a = parser.parse_args(arguments)
    spark = session("review_intake")
    try:
        run(spark, a.reports, a.out, a.checkpoint, settings_of(spark, a.config, SHIPPED))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
