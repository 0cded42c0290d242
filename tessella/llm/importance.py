"""Quality by importance resampling.

Two bag-of-n-grams models over hashed unigrams and bigrams of word and mark
tokens, one of the target (labelled good documents) and one of the raw corpus,
give each document the log-ratio of its probabilities as importance weight. The
models take n-grams as independent, which those of one document are not; so its
likelihoods are tempered by EVIDENCE / (n + EVIDENCE), at every length alike.
Adding Gumbel noise, fixed by the key, and keeping the k largest draws k
documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import bounded_sample, materialise, slices, small_batches, table, total_counts

#: Hash buckets of n-grams, pseudo-counts of a bucket, labelled rows at most (by hash of the key), of which one in CALIBRATE only sets the cut.
BUCKETS, SMOOTHING, LABELLED_ROWS, CALIBRATE = 1 << 16, 8.0, 20_000, 3
#: The n-grams of a document depend on each other: n of them weigh as n * EVIDENCE / (n + EVIDENCE) independent ones.
EVIDENCE = 512


def hashed_grams(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each unigram and bigram, and the text it is from."""
    from tessella.llm import words

    h, bounds = words.word_hashes(column, classes=words.WORDS_AND_MARKS, fold=False)
    doc = np.repeat(np.arange(len(column)), np.diff(bounds))
    pairs = words.grams(h, 2)
    inside = doc[1:] == doc[:-1] if len(doc) > 1 else np.zeros(0, dtype=bool)
    bucket = np.concatenate([h, pairs[inside]]) >> np.uint64(64 - buckets.bit_length() + 1)
    return bucket.astype(np.int64), np.concatenate([doc, doc[1:][inside]])


def good_ids(labels: DataFrame, rows: int = LABELLED_ROWS) -> dict[int, int]:
    """doc_id -> quality of at most ``rows`` labelled documents; of several labels the largest."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    return {r.doc_id: r.quality for r in bounded_sample(known, rows).collect()}


def calibrates(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % CALIBRATE == 0


def gram_counts(docs: DataFrame, labelled: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Counts by bucket over all documents: row 0 the raw corpus, row 1 the good documents."""
    shared = docs.sparkSession.sparkContext.broadcast(labelled)  # LABELLED_ROWS at most

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        quality, total = shared.value, np.zeros((2, buckets), dtype=np.int64)
        for batch in slices(batches):
            bucket, doc = hashed_grams(batch.column("text"), buckets)
            total[0] += np.bincount(bucket, minlength=buckets)
            kind = np.array([quality.get(d, -1) for d in batch.column("doc_id").to_pylist()])[doc] if len(doc) else np.zeros(0, int)
            total[1] += np.bincount(bucket[kind == 1], minlength=buckets)
        return total.ravel()

    return total_counts(docs.select(F.col("doc_id").cast("long"), "text"), count, 2 * buckets).reshape(2, buckets)


def log_ratio(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw).

    The target counts are drawn towards what the raw model expects of as many
    n-grams by ``smoothing`` counts a bucket, so that an n-gram which the target
    lacks by chance says little.
    """
    expected = counts[0] * (counts[1].sum() / max(1, counts[0].sum()))
    return np.log((counts[1] + smoothing) / (expected + smoothing))


def gumbel(doc_id: list, texts: pa.Array, seed: int) -> np.ndarray:
    """Standard Gumbel noise fixed by key and seed; rows without a key draw by their text."""
    import xxhash

    draw = [xxhash.xxh64_intdigest(f"{seed}:{d}" if d is not None else f"{seed}::{t.as_py()}") for d, t in zip(doc_id, texts, strict=True)]
    u = (np.array(draw, dtype=np.uint64) >> np.uint64(11)).astype(float) / 2.0**53
    return -np.log(-np.log(np.clip(u, 1e-16, 1 - 1e-16)))


def weigher(docs: DataFrame, labels: DataFrame, seed: int, temperature: float, evidence: float = EVIDENCE):
    """A function of an Arrow batch that gives log weights and keys. Infinite ``evidence``: plain likelihoods."""
    counts = gram_counts(docs, {d: q for d, q in good_ids(labels).items() if not calibrates(d)})
    ratio = log_ratio(counts) if counts[1].sum() else np.zeros(BUCKETS)

    def weigh(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        bucket, doc = hashed_grams(batch.column("text"))
        size = np.bincount(doc, minlength=batch.num_rows)
        weight = np.bincount(doc, ratio[bucket], minlength=batch.num_rows) / (1 + size / evidence)
        return weight, weight + temperature * gumbel(batch.column("doc_id").to_pylist(), batch.column("text"), seed)

    return weigh


def score_with(docs: DataFrame, weigh) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, weigh(batch))], ["doc_id", "log_weight", "gumbel_key"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, log_weight double, gumbel_key double")


def importance(docs: DataFrame, labels: DataFrame, seed: int = 17, temperature: float = 1.0, evidence: float = EVIDENCE) -> DataFrame:
    """doc_id, log_weight and gumbel_key of every document, the key being log_weight + temperature * noise.

    With n n-grams, log_weight is their summed log-ratio times evidence / (n + evidence).

    A null or empty text has weight 0 (log). Without good labels all weights are 0.
    """
    return score_with(docs, weigher(docs, labels, seed, temperature, evidence))


def choose_size(scored: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> int:
    """How many documents to keep: those as likely good as the labelled ones show.

    The cut on the key that tells the labelled documents of the calibrating fold
    (at most ``rows``) apart with the fewest errors, a lost good document counting five times; without
    labels of both kinds every document is kept.
    """
    known = {d: q for d, q in good_ids(labels, rows).items() if calibrates(d)}
    spark = scored.sparkSession
    if not known:
        return scored.count()
    bounded = spark.createDataFrame(list(known.items()), "doc_id long, quality int")
    # an id with several rows counts once, with its least key
    pairs = scored.join(F.broadcast(bounded), "doc_id").groupBy("doc_id", "quality").agg(F.min("gumbel_key")).select("min(gumbel_key)", "quality").collect()
    key, good = np.array([r[0] for r in pairs]), np.array([r[1] for r in pairs])
    if not len(key) or good.min() == good.max():
        return scored.count()
    order = np.argsort(key)
    lost = np.concatenate([[0], np.cumsum(5 * good[order] - (1 - good[order]))])  # against keeping all
    at = int(np.argmin(lost))
    if at == 0:
        return scored.count()
    low, high = key[order[at - 1]], key[order[at]] if at < len(key) else key[order[-1]] + 1
    return scored.where(F.col("gumbel_key") >= (low + high) / 2).count()


def top_k(scored: DataFrame, k: int, by: str = "gumbel_key") -> DataFrame:
    """The ``k`` rows with the largest ``by``, ties by doc_id, without sorting the table.

    Histograms of 4096 bins narrow the interval of the k-th value down until few
    rows are left in it; only those are sorted.
    """
    n = scored.count()
    if k >= n:
        return scored
    if k <= 0:
        return scored.limit(0)
    low, high = scored.agg(F.min(by), F.max(by)).head()
    above = 0  # rows over the interval
    while True:
        inside = scored.where((F.col(by) >= low) & (F.col(by) <= high))
        width = (high - low) / 4096
        if not width > 0 or low + width == low:
            break
        bins = inside.groupBy(F.least(F.floor((F.col(by) - low) / width), F.lit(4095)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(by).alias("lo"), F.max(by).alias("hi")).orderBy(F.desc("bin")).collect()
        for r in bins:
            if above + r.n >= k:
                low, high, rows = r.lo, r.hi, r.n
                break
            above += r.n
        if rows <= 10_000 or low == high:
            break
    sure = scored.where(F.col(by) > high)
    # rows alike in every column are counted, not moved; the ones that stay are made again from their number
    alike = scored.where((F.col(by) >= low) & (F.col(by) <= high)).groupBy(*scored.columns).agg(F.count(F.lit(1)).alias("rows_alike"))
    before = Window.orderBy(F.desc(by), "doc_id", *scored.columns).rowsBetween(Window.unboundedPreceding, -1)
    stay = F.least(F.col("rows_alike"), F.lit(k - above) - F.coalesce(F.sum("rows_alike").over(before), F.lit(0)))
    last = alike.withColumn("stay", stay).where("stay > 0").withColumn("one", F.explode(F.sequence(F.lit(1), F.col("stay").cast("int"))))
    return sure.unionByName(last.select(scored.columns))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 17) -> DataFrame:
    """The documents kept: doc_id, log_weight, gumbel_key.

    ``k`` defaults to ``choose_size``. Rows with equal doc_id share their noise
    and may be kept or not by their own texts; an empty table gives an empty
    result. Only doc_id and text of ``docs`` are read.
    """
    scored = materialise(importance(docs, labels, seed), "importance")
    return top_k(scored, choose_size(scored, labels) if k is None else k)


def kept_documents(docs: DataFrame, labels: DataFrame, seed: int = 17) -> DataFrame:
    """The documents, with all their columns, that ``resample`` keeps.

    The k-th largest key is the cut, so that documents tied with it stay too;
    the keys are computed again where the documents are, and no row moves.
    """
    weigh = weigher(docs, labels, seed, 1.0)
    scored = materialise(score_with(docs, weigh), "importance")
    cut = top_k(scored, choose_size(scored, labels)).agg(F.min("gumbel_key")).head()[0]
    if cut is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(weigh(batch)[1] >= cut))

    return docs.mapInArrow(run, docs.schema)


def op1_importance(spark, sf_dir: str) -> DataFrame:
    """``resample`` of all ``documents``."""
    small_batches(spark)
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
