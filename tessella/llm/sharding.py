"""Sharding by rendezvous (highest random weight) hashing.

Every pair of record key and shard gets a pseudo-random score
``-weight / ln(u)``, ``u`` in (0, 1) from an MD5 of key and shard number, and a
record goes to the shard with the highest score. A new shard therefore takes
rows only into itself: the scores of the others do not change.

Only built-in column expressions run here, so that the whole operator stays in
the JVM. Rows of a shard are numbered without one task seeing the shard: a
second digest of the key deals each shard into buckets of bounded size, the
bucket counts (from the key column alone) give each bucket its first slot, and
a window numbers the rows inside a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import doc_key, table, text_or_empty

#: Rows that a bucket holds on average; the window sorts that many at a time.
ROWS_PER_BUCKET = 20_000


def unit_hash(key: Column, tag: str) -> Column:
    """52 bits of MD5(key ':' tag) as an integer."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{tag}"))), 1, 13), 16, 10).cast("long")


def scored(key: Column, shard: int, weight: float, even: bool) -> Column:
    drawn = unit_hash(key, str(shard))
    # with equal weights the hash itself has the order of -w / ln(u)
    score = drawn if even else F.lit(-float(weight)) / F.log((drawn + F.lit(1)) / F.lit(2.0**52 + 2))
    return F.struct(score.alias("score"), F.lit(shard).alias("shard"))


def best_shard(key: Column, weights: Sequence[float], even: bool) -> Column:
    """Score and number of the shard with the highest score; a tie goes to the larger number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    each = [scored(key, shard, weight, even) for shard, weight in enumerate(weights)]
    return each[0] if len(each) == 1 else F.greatest(*each)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    return best_shard(key, weights, min(weights) == max(weights))["shard"].cast("int")


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Give every row its shard, its slot there and its shard if one more (of mean weight) came.

    Rows with equal ``doc_id`` share a shard and are numbered by their content;
    a null ``doc_id`` is a key of its own; a null text has size 1 and the CRC of
    no bytes. Slots run from 0 without a gap in each shard. An empty table gives
    an empty result. Other columns of the input are not read.
    """
    rows = docs.count()
    buckets = max(1, math.ceil(rows / (len(weights) * rows_per_bucket)))
    key = doc_key()
    even = min(weights) == max(weights)
    crc = F.crc32(text_or_empty().cast("binary")).cast("long")
    measured = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        crc.alias("text_crc32"),
        best_shard(key, weights, even).alias("best"),
        # a key with many texts fills many buckets
        (unit_hash(F.concat(key, F.lit(":"), crc), "bucket") % F.lit(buckets)).cast("int").alias("bucket"),
    ).select("doc_id", "size", "text_crc32", F.col("best.shard").alias("shard"), "bucket", F.greatest("best", scored(key, len(weights), sum(weights) / len(weights), even))["shard"].alias("grown_shard"))
    # rows alike are counted where they are, and get a run of slots
    alike = measured.groupBy(*measured.columns).agg(F.count(F.lit(1)).alias("n"))
    first = (
        measured.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("first", F.sum("n_rows").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n_rows"))
        .select("shard", "bucket", "first")
    )
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        alike.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .join(first, ["shard", "bucket"])
        .select("*", F.explode(F.sequence(F.col("first") + F.col("before"), F.col("first") + F.col("before") + F.col("n") - 1)).alias("slot"))
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
    )


def op6_rendezvous(spark, sf_dir: str) -> DataFrame:
    """``shard_documents`` of all ``documents`` over 16 even shards."""
    return shard_documents(table(spark, sf_dir, "documents"))


#: The CRC table is made by its rule, as DuckDB has no such function; doc_id is unique here.
OP6_SQL = """WITH cr AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, coalesce(text, '') AS text FROM documents),
h AS (SELECT doc_id, s, CAST('0x' || substr(md5(k || ':' || s), 1, 13) AS BIGINT) AS u FROM d, range(17) r(s)),
b AS (SELECT doc_id, max(struct_pack(u := u, s := s)) FILTER (s < 16) AS best, max(struct_pack(u := u, s := s)) AS grown FROM h GROUP BY 1),
m AS (SELECT doc_id, octet_length(encode(text)) + 1 AS size, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32, best.s AS shard, grown.s AS grown_shard, k FROM d JOIN b USING (doc_id), cr),
n AS (SELECT *, CAST('0x' || substr(md5(k || ':' || text_crc32 || ':bucket'), 1, 13) AS BIGINT) % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / (16 * ROWS)) AS BIGINT)) AS bucket FROM m)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard FROM n""".replace("ROWS", str(ROWS_PER_BUCKET))
