"""Token-id files with a shared zstandard dictionary and an index for single documents.

A data set is a folder with ``dictionary`` (one Parquet row: the dictionary) and
``ids``: one file for each range of ``doc_id``, in ascending order of the part
number in its name. A file holds, each followed by one line feed,

* ``TESSIDS1`` and the 8-byte xxHash64 of the dictionary (zero: none),
* a zstandard frame for each document: its ids as little-endian uint32,
* the index: a zstandard frame with 33 bytes a document (see ``INDEX``), the
  8-byte length of that frame and ``TESSIDX1``.

Any Hadoop file system can hold the files: Spark's text writer puts the bytes of
a row down unchanged, so its commit protocol covers them, and ``binaryFile``
reads them. A lost executor costs the repetition of its tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import bounded_sample, materialise, scratch_path, slices, small_batches, table, text_or_empty

MAGIC, TRAILER, END_ID = b"TESSIDS1", b"TESSIDX1", 2
INDEX = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u8"), ("tokens", "<u8")])


def dictionary_hash(dictionary: bytes) -> bytes:
    import xxhash

    return xxhash.xxh64_digest(dictionary) if dictionary else bytes(8)


def train_dictionary(docs: DataFrame, vocabulary: str, samples: int = 2000, longest: int = 8192, size: int = 1 << 16) -> bytes:
    """A zstandard dictionary from the id arrays of a bounded sample.

    The sample is the ``samples`` documents (by hash of the key) that have a text, of a
    longer one a stretch of ``longest`` characters whose place the text's hash
    decides: at most 16 M characters on the driver. Too few or too uniform samples
    give no dictionary (``b""``).
    """
    import zstandard

    from tessella.llm.tokens import ChunkEncoder

    begin = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - longest + 1, F.lit(1)).cast("long")) + 1
    few = bounded_sample(docs.where(F.length("text") > 0).select("doc_id", F.substring("text", begin.cast("int"), F.lit(longest)).alias("text")), samples, "text")
    arrays = [ids.tobytes() for ids in ChunkEncoder(vocabulary).encode([r.text for r in few.collect()])]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, arrays)) // 10)), arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Write ids of every whole text (null: no text), each with id 2 after it, in ascending order of ``doc_id``.

    A null ``doc_id`` comes first; rows with one ``doc_id`` are ordered by a hash of
    their text, so that an id with many texts fills many files.
    Other columns are not read. An empty table gives a data set without files.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, vocabulary)
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    parts = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from tessella.llm.tokens import encoder

        tokens = encoder(vocabulary)
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        index, offset = [], 0
        for batch in slices(batches):
            rows = [] if index else [MAGIC + dictionary_hash(dictionary)]
            entries = np.zeros(batch.num_rows, dtype=INDEX)
            offset = offset or len(rows[0]) + 1
            for i, (doc_id, ids) in enumerate(zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text")), strict=True)):
                frame = pack.compress(np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes())
                entries[i] = (doc_id is None, doc_id or 0, offset, len(frame), len(ids) + 1)
                rows.append(frame)
                offset += len(frame) + 1
            index.append(entries)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row"])
        if index:
            body = zstandard.compress(np.concatenate(index).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([body + len(body).to_bytes(8, "little") + TRAILER], pa.binary())], ["row"])

    (
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("h"))
        .repartitionByRange(parts, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text")
        .mapInArrow(files, "row binary")
        .select(F.col("row").cast("string").alias("value"))
        .write.text(f"{path}/ids")
    )


def read_index(content: bytes) -> np.ndarray:
    """The index of a file: a row for each document."""
    import zstandard

    end = len(content) - 1
    if content[: len(MAGIC)] != MAGIC or content[end - 8 : end] != TRAILER:
        raise ValueError("not a token-id file")
    size = int.from_bytes(content[end - 16 : end - 8], "little")
    return np.frombuffer(zstandard.decompress(content[end - 16 - size : end - 16]), dtype=INDEX)


def read_document(content: bytes, entry: np.void, dictionary: bytes) -> np.ndarray:
    """Ids of one document, without touching the others."""
    return unpack(content, [entry], dictionary)[0]


def unpack(content: bytes, entries, dictionary: bytes) -> list[np.ndarray]:
    import zstandard

    if content[8:16] != dictionary_hash(dictionary):
        raise ValueError("the file was written with another dictionary")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return [np.frombuffer(reader.decompress(content[int(e["offset"]) : int(e["offset"] + e["size"])]), dtype="<u4") for e in entries]


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian uint32) of each document; ``start`` counts the ids before it in the data set."""
    dictionary = bytes(spark.read.schema("dictionary binary").parquet(f"{path}/dictionary").head().dictionary)
    schema = "part long, doc_id long, before long, n_tokens long, ids binary"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
                content = content.as_py()
                index = read_index(content)
                before = np.cumsum(index["tokens"]).astype("i8") - index["tokens"].astype("i8")
                for at in range(0, len(index), 500):
                    some = index[at : at + 500]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), name), pa.int64()),
                            pa.array(some["doc_id"].astype("i8"), pa.int64(), mask=some["null"].astype(bool)),
                            pa.array(before[at : at + 500]),
                            pa.array(some["tokens"].astype("i8")),
                            pa.array([x.tobytes() for x in unpack(content, some, dictionary)], pa.binary()),
                        ],
                        ["part", "doc_id", "before", "n_tokens", "ids"],
                    )

    files = spark.read.format("binaryFile").load(f"{path}/ids").select(F.regexp_extract("path", r"part-(\d+)-", 1).cast("long").alias("part"), "content")
    return files.mapInArrow(documents, schema)


def with_start(rows: DataFrame) -> DataFrame:
    """Replace ``part`` and ``before`` by ``start``. The one task that adds up sees one row for each file."""
    total = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = total.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return rows.join(first, "part").withColumn("start", F.col("first") + F.col("before")).drop("part", "before", "first")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` written to token files and read back, with the CRC of each document's ids."""
    small_batches(spark)
    path = scratch_path(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    read = read_token_files(spark, path).select("part", "before", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return with_start(materialise(read, "token-ids-read")).select("doc_id", "start", "n_tokens", "ids_crc32")
