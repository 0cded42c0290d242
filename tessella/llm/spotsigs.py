"""SpotSigs fingerprints of documents.

An anchor is a common word; its signature is the anchor with the next two
content words at distance one. A text's signatures form its set; a text without
any takes all its runs of three words (or its words) instead. The fingerprint is
the sorted set of 32-bit signature hashes in base 64. Two sets are compared by
Jaccard likeness; where a least likeness is asked for, only if their sizes allow
it, which also gives the partitions by set length of ``similar_documents``.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import materialise, slices, small_batches, table, text_or_empty

#: Common words of English, German, French and Spanish that serve as anchors (fixed values).
ANCHORS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "der die das und ist ein eine von zu mit den dem des für auf im sich nicht als auch "
    "le la les un une et est de des du en que qui dans pour par sur pas au avec "
    "el los las una y es del que se por con para su al lo no como"
).split()
CHAIN, FLOOR = 2, 0.0
#: Rows of a block of neighbouring documents at most, where the shuffle's partitions don't make it smaller.
BLOCK_ROWS = 1_000_000


def signature_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted 32-bit signatures of each text."""
    from tessella.llm import words

    h, bounds = words.word_hashes(column, classes=words.LETTERS)
    anchors, _ = words.word_hashes(pa.array(ANCHORS), classes=words.LETTERS)
    anchors = np.unique(anchors)
    at = np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)
    anchor = anchors[at] == h
    content = np.flatnonzero(~anchor)
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    spots = np.flatnonzero(anchor)
    nth = np.searchsorted(content, spots)  # the first content word after the anchor
    whole = nth + CHAIN <= len(content)
    spots, nth = spots[whole], nth[whole]
    inside = content[nth + CHAIN - 1] < doc_end[spots] if len(spots) else np.zeros(0, dtype=bool)
    spots, nth = spots[inside], nth[inside]
    value = h[spots] * words.SALT[0]
    for i in range(CHAIN):
        value = value + h[content[nth + i]] * words.SALT[i + 1]
    value = words.mix(value) >> np.uint64(32)
    cut = np.searchsorted(spots, bounds)
    sets = []
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if a == b and bounds[i] < bounds[i + 1]:
            own = h[bounds[i] : bounds[i + 1]]
            sets.append(np.unique(words.grams(own, min(3, len(own))) >> np.uint64(32)).astype(np.uint32))
        else:
            sets.append(np.unique(value[a:b]).astype(np.uint32))
    return sets


def fingerprint(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def signatures_of(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray, floor: float = FLOOR) -> float:
    """Jaccard likeness; 0 where the sizes alone keep it below ``floor``. Two empty sets are alike."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < floor * large:
        return 0.0
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (small + large - both)


def block_borders(keyed: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The first (doc_id, hash) of each block but the first: quantiles of doc_id; an id that several of them name is cut by even hashes."""
    found = sorted(keyed.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)) if parts > 1 else []
    ids, count = np.unique(np.array([int(b) for b in found], dtype=np.int64), return_counts=True)
    low = [np.iinfo(np.int64).min + j * (2**64 // int(c)) for c in count for j in range(c)]
    return np.repeat(ids, count), np.array(low, dtype=np.int64)


def blocks_of(ids: np.ndarray, hashes: np.ndarray, border_ids: np.ndarray, border_hashes: np.ndarray) -> np.ndarray:
    """How many borders are at or before each (doc_id, hash)."""
    left, right = np.searchsorted(border_ids, ids, side="left"), np.searchsorted(border_ids, ids, side="right")
    out = left.copy()
    for a in np.unique(left[left < right]):  # ids that are borders
        at = np.flatnonzero((left == a) & (right > a))
        out[at] = a + np.searchsorted(border_hashes[a : right[at[0]]], hashes[at], side="right")
    return out.astype(np.int32)


def ordered_blocks(docs: DataFrame, rows: int | None = None) -> DataFrame:
    """doc_id, text, h (its hash), block and own, in blocks of neighbours; each block ends with a copy (own false) of the first rows of the next.

    Rows are ordered by doc_id, then by the text's hash, so that an id with many rows
    fills many blocks. There are as many blocks as the shuffle has partitions, or more
    where one would have over BLOCK_ROWS rows (or ``rows``): the driver holds the
    borders, some 50 bytes for a million documents. A task reads its block as a
    stream, in the order that Spark sorts it to disk. The first block follows the
    last. A null doc_id is the smallest. Only rows equal to a block's first in both
    are copied.
    """
    spark = docs.sparkSession
    n = docs.count()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("h"))
    parts = max(1, math.ceil(n / rows)) if rows else max(min(n // 100 + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))), math.ceil(n / BLOCK_ROWS))
    border_ids, border_hashes = block_borders(keyed, parts)

    @F.pandas_udf("int")
    def block_of(doc_id, h):
        ids = doc_id.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
        return __import__("pandas").Series(blocks_of(ids, h.to_numpy(dtype=np.int64), border_ids, border_hashes))

    blocks = keyed.withColumn("block", block_of("doc_id", "h"))
    firsts = blocks.select("block", "doc_id", "h").groupBy("block").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("first")).orderBy("block").collect()
    chain = [(r.block, firsts[i - 1].block, r.first.doc_id, r.first.h) for i, r in enumerate(firsts)]  # a row for each block
    if not chain:
        return blocks.withColumn("own", F.lit(True))
    before = spark.createDataFrame(chain, "block int, previous int, first long, first_h long")
    marked = blocks.join(F.broadcast(before), "block")  # a row for a block, see above
    here, there = F.struct("block", F.lit(True).alias("own")), F.struct(F.col("previous").alias("block"), F.lit(False).alias("own"))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("h") == F.col("first_h")), F.array(here, there)).otherwise(F.array(here))
    return marked.withColumn("to", F.explode(copies)).select("doc_id", "text", "h", "to.block", "to.own")


def with_neighbours(docs: DataFrame, rows: int | None = None) -> DataFrame:
    """doc_id, text and next_text (of the next document by doc_id, then the text's hash; after the last the first), block after block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held = None  # held: an own row whose follower is still to come
        first = None  # of the block, for a table of one block

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.string())], ["doc_id", "text", "next_text"])

        for batch in slices(batches):
            done = []
            for b, own, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("block", "own", "doc_id", "text")), strict=True):
                if b != block:
                    if held:
                        done.append((*held, first))
                    block, held, first = b, None, text
                if held:
                    done.append((*held, text))
                    held = None
                if own:
                    held = (doc_id, text)
            if done:
                yield out(done)
        if held:
            yield out([(*held, first)])

    blocks = ordered_blocks(docs, rows)
    one = blocks.select("block", F.expr("not own").alias("copy"), "doc_id", "own", "h", "text")
    return one.repartition("block").sortWithinPartitions("block", "copy", "doc_id", "h", "text").select("block", "own", "doc_id", "text").mapInArrow(run, "doc_id long, text string, next_text string")


def edit(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the next text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, floor: float = FLOOR) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    A null text is empty; texts without words have an empty fingerprint and are
    alike. Rows with one doc_id follow each other by the hash of their text. A table of one row
    has itself as its next document; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, following = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
            edited = [edit(t, f) for t, f in zip(texts, following, strict=True)]
            own, other, after = signature_sets(batch.column("text")), signature_sets(pa.array(edited, pa.string())), signature_sets(batch.column("next_text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                    pa.array([fingerprint(s) for s in own]),
                    pa.array([fingerprint(s) for s in other]),
                    pa.array([likeness(a, b, floor) for a, b in zip(own, other, strict=True)]),
                    pa.array([likeness(a, b, floor) for a, b in zip(own, after, strict=True)]),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_neighbours(docs).mapInArrow(run, schema)


def similar_documents(prints: DataFrame, similarity: float = 0.75) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints, each with the smallest doc_id that has it, of at least ``similarity``.

    Sets are partitioned by length: partition p holds the sizes from
    (1/similarity)**p on, so that a partner is in the same partition or the next.
    Within them, sets meet on the signatures of their prefixes in hash order.
    Documents with equal fingerprints count once. ``prints``: doc_id, fingerprint.
    """

    @F.pandas_udf("array<long>")
    def signatures(column):
        return column.map(lambda t: signatures_of(t).astype(np.int64))

    step = math.log(1 / similarity)
    sets = prints.where("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).withColumn("s", signatures("fingerprint")).withColumn("n", F.size("s"))
    sets = materialise(sets.select("doc_id", "s", "n", F.floor(F.log("n") / step + 1e-9).cast("int").alias("part")), "spotsigs")
    keys = sets.select("doc_id", "n", "part", F.explode(F.expr(f"slice(s, 1, n - cast(ceil({similarity} * n) as int) + 1)")).alias("key"))
    a = keys.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "key", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    b = keys.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "key", "part")
    found = a.join(b, ["key", "part"]).where((F.col("a") != F.col("b")) & (F.col("na") >= F.col("nb") * similarity) & (F.col("nb") >= F.col("na") * similarity))
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    full = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return full.withColumn("likeness", both / (F.size("sa") + F.size("sb") - both)).where(F.col("likeness") >= similarity).select("a", "b", "likeness")


def op10_spotsigs(spark, sf_dir: str) -> DataFrame:
    """``fingerprints`` of all ``documents``."""
    small_batches(spark)
    return fingerprints(table(spark, sf_dir, "documents"))
