"""Digests of files and their comparison with a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Endings of text files, whose line ends don't count (fixed values).
TEXT_ENDINGS = r"(?i)\.(r|py|md|txt|csv|tsv|cff|yml|yaml|json|toml|cfg|ini|sh|html|svg)$"


def digest(content: str, path: str) -> Column:
    """SHA-256 of a file in lower-case hex; of a text file with CR LF as LF."""
    b = F.col(content)
    # as Latin-1, where each byte is a character
    plain = F.encode(F.replace(F.decode(b, "ISO-8859-1"), F.lit("\r\n"), F.lit("\n")), "ISO-8859-1")
    return F.when(F.col(path).rlike(TEXT_ENDINGS), F.sha2(plain, 256)).otherwise(F.sha2(b, 256))


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder), size and digest of every file, one file in a task at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = folder.rstrip("/").removeprefix("file:")
    return files.select(F.regexp_replace(F.substring_index("path", root + "/", -1), "^/+", "").alias("path"), F.col("length").alias("size"), digest("content", "path").alias("digest"))


def listed_digests(spark: SparkSession, path: str) -> DataFrame:
    """path and digest of a list with lines ``digest  path``."""
    line = F.regexp_extract(F.col("value"), r"^([0-9A-Fa-f]{64})\s+\*?(.+)$", 2), F.lower(F.regexp_extract("value", r"^([0-9A-Fa-f]{64})\s+\*?(.+)$", 1))
    return spark.read.text(path).select(line[0].alias("path"), line[1].alias("digest")).where("path <> ''")


def compare(listed: DataFrame, found: DataFrame) -> DataFrame:
    """path and status (OK, CHANGED, MISSING or UNLISTED) of every path of either table (path, digest)."""
    both = listed.select("path", F.col("digest").alias("listed")).join(found.select("path", F.col("digest").alias("found")), "path", "full")
    status = F.when(F.col("found").isNull(), "MISSING").when(F.col("listed").isNull(), "UNLISTED").when(F.col("listed") == F.col("found"), "OK").otherwise("CHANGED")
    return both.select("path", status.alias("status"))
