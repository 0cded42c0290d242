"""WARC archives by way of a chunked record table.

Every page becomes rows of (record, chunk number, at most ``chunk`` bytes). A
chunk row is written as one WARC/1.1 record: the first as ``response``, later
ones as ``continuation`` segments, so that nothing on the way holds more than a
chunk. A page whose payload another page has too, with a larger ``page_id``, is
a ``revisit`` record without payload. Archives are plain ``.warc`` bytes that
Spark's text writer puts on any Hadoop file system: a record ends in CR LF CR LF
and the writer adds the last LF. Reading puts the segments of a record in order
and feeds them one by one to the digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import materialise, scratch_path, slices, small_batches, table
from tessella.operators.joins import spread_join

CHUNK = 1 << 16
#: An archive holds at most so many records of at most a chunk each: 128 MiB.
RECORDS_PER_FILE = 2048
#: Groups of equal payloads (about 100 bytes each) up to which they are broadcast.
BROADCAST_GROUPS = 100_000
NO_PAGE = -(1 << 63)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = "record_id string, page_id long, segment int, segments boolean, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def record_urn(page_id: int | None, tag: int) -> str:
    """A UUID URN of page id and a tag; the page id can be read back from it."""
    h = (NO_PAGE if page_id is None else page_id).to_bytes(8, "big", signed=True).hex() + (tag & (2**64 - 1)).to_bytes(8, "big").hex()
    return f"urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def page_of(urn: str) -> int | None:
    page = int.from_bytes(bytes.fromhex(urn[9:].replace("-", "")[:16]), "big", signed=True)
    return None if page == NO_PAGE else page


def chunk_table(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (page_id, url, tag, digest, size, keeper, keeper_tag, chunk_no, chunks, payload).

    ``keeper`` is set where the page revisits another. Equal payloads: the page
    with the largest (page_id, hash of url and payload) keeps it; rows that equal it in both
    are responses too. A null payload is empty, a null page_id the smallest.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    heads = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
        digest.alias("digest"),
    ).withColumn("tag", F.xxhash64("url", "digest"))
    heads = heads.withColumn("size", F.octet_length("payload").cast("long"))
    groups = heads.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "tag")).alias("last"))
    groups = materialise(groups.where("n > 1").select("digest", "size", F.col("last.page_id").alias("keeper"), F.col("last.tag").alias("keeper_tag")), "warc-groups")
    if groups.count() <= BROADCAST_GROUPS:
        joined = heads.join(F.broadcast(groups), ["digest", "size"], "left")
    else:  # the commonest payloads, as of an empty page, don't go through the shuffle
        key = F.concat_ws(":", "digest", "size")
        joined = spread_join(heads.withColumn("group", key), groups.select(key.alias("group"), "keeper", "keeper_tag"), "group").drop("group")
    keeps = F.col("keeper_tag").isNull() | (F.col("page_id").eqNullSafe(F.col("keeper")) & (F.col("tag") == F.col("keeper_tag")))
    joined = joined.withColumns({"keeper": F.when(~keeps, F.col("keeper")), "keeper_tag": F.when(~keeps, F.col("keeper_tag"))})
    chunks = F.when(F.col("keeper_tag").isNull(), F.greatest(F.lit(1), F.ceil(F.col("size") / chunk))).otherwise(1).cast("int")
    return (
        joined.withColumn("chunks", chunks)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("payload", F.when(F.col("keeper_tag").isNull(), F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b"")))
    )


def warc_record(r: dict) -> bytes:
    """The record of a chunk row, without its last line feed."""
    urn = record_urn(r["page_id"], r["tag"])
    block, number = r["payload"], r["chunk_no"] + 1
    head = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", r["url"])]
    if number == 1:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode() + block
        head += [("WARC-Record-ID", f"<{urn}>"), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(r['digest'])}")]
    else:
        head += [("WARC-Record-ID", f"<urn:sha1:{hashlib.sha1(f'{urn}#{number}'.encode()).hexdigest()}>"), ("WARC-Segment-Origin-ID", f"<{urn}>")]
    if r["keeper_tag"] is not None:
        kind = "revisit"
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_urn(r['keeper'], r['keeper_tag'])}>")]
    else:
        kind = "response" if number == 1 else "continuation"
        if r["chunks"] > 1:
            head.append(("WARC-Segment-Number", str(number)))
            if number == r["chunks"]:
                head.append(("WARC-Segment-Total-Length", str(r["size"])))
    head += [("WARC-Block-Digest", f"sha1:{base32_sha1(hashlib.sha1(block).hexdigest())}"), ("Content-Length", str(len(block)))]
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r"


def write_archives(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write a WARC record (or its segments) for each row of ``pages``; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(r) for r in batch.to_pylist()], pa.binary())], ["row"])

    rows = chunk_table(pages, chunk).mapInArrow(run, "row binary")
    rows.select(F.col("row").cast("string").alias("value")).write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def records_in(content: memoryview) -> Iterator[tuple[dict, memoryview]]:
    """Headers (lower-case names) and block of each record of an archive."""
    at = 0
    while at < len(content):
        body = bytes(content[at : at + 65536]).find(b"\r\n\r\n")
        if body < 0:
            body = bytes(content[at:]).find(b"\r\n\r\n")
        lines = bytes(content[at : at + body]).decode().split("\r\n")
        if body < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin, size = at + body + 4, int(head["content-length"])
        yield head, content[begin : begin + size]
        at = begin + size + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row for each WARC record; of a segmented record, a row with the bytes of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("segment", pa.int32()), ("segments", pa.bool_()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for head, block in records_in(memoryview(content.as_buffer())):
                    row = dict.fromkeys(schema.names)
                    row |= {"record_type": head["warc-type"], "segment": int(head.get("warc-segment-number", 1)), "segments": "warc-segment-number" in head}
                    urn = head["warc-segment-origin-id" if row["record_type"] == "continuation" else "warc-record-id"].strip("<>")
                    row |= {"record_id": urn, "page_id": page_of(urn)}
                    if row["record_type"] != "continuation":
                        http = bytes(block[:4096]).find(b"\r\n\r\n") + 4
                        row["payload_bytes"] = int(re.search(rb"(?i)content-length: (\d+)", bytes(block[:http]))[1])
                        block = block[http:]
                    if row["record_type"] == "revisit":
                        row |= {"payload_digest": head["warc-payload-digest"].removeprefix("sha1:"), "refers_to": page_of(head["warc-refers-to"].strip("<>"))}
                    elif row["segments"]:
                        row["payload"] = bytes(block)
                    else:
                        row["payload_digest"] = base32_sha1(hashlib.sha1(block).hexdigest())
                        if len(block) != row["payload_bytes"]:
                            raise ValueError(f"{urn}: {len(block)} payload bytes of {row['payload_bytes']}")
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if len(rows) >= 1000 or size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content").mapInArrow(run, PARSED)


def join_segments(segments: DataFrame) -> DataFrame:
    """One row for each segmented record, its digest taken segment by segment.

    Equal rows of ``pages`` give equal segments; each distinct one counts once
    in the digest and the record comes as often as its first segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, ready = None, []

        def close():
            if state["bytes"] != state["want"]:
                raise ValueError(f"{state['id']}: {state['bytes']} payload bytes of {state['want']}")
            ready.extend([(state["id"], state["page"], state["bytes"], base32_sha1(state["sha"].hexdigest()))] * state["copies"])

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["record_id", "page_id", "payload_bytes", "payload_digest"])

        for batch in batches:
            for urn, page, segment, payload, want in zip(*(batch.column(c) for c in ("record_id", "page_id", "segment", "payload", "payload_bytes")), strict=True):
                urn, segment = urn.as_py(), segment.as_py()
                if state is None or state["id"] != urn:
                    if state:
                        close()
                    state = {"id": urn, "page": page.as_py(), "bytes": 0, "sha": hashlib.sha1(), "want": want.as_py(), "copies": 0, "seen": 0}
                state["copies"] += segment == 1
                if segment == state["seen"]:
                    continue
                if segment != state["seen"] + 1:
                    raise ValueError(f"{urn}: segment {segment} after {state['seen']}")
                state["seen"] = segment
                payload = payload.as_buffer()
                state["sha"].update(payload)
                state["bytes"] += payload.size
                if len(ready) >= 1000:
                    yield out()
                    ready = []
        if state:
            close()
        if ready:
            yield out()

    keyed = segments.select("record_id", "page_id", "segment", "payload", "payload_bytes").repartition("record_id").sortWithinPartitions("record_id", "segment")
    return keyed.mapInArrow(run, "record_id string, page_id long, payload_bytes long, payload_digest string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record."""
    read = materialise(read_records(spark, path), "warc-read")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    joined = join_segments(read.where("segments")).select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return read.where("not segments").select(names).unionByName(joined)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records and read back."""
    small_batches(spark)
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


#: Base32 has no function in SQL: each 5 hex digits give 4 of its characters.
OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS keeper FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT)) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM m
"""
