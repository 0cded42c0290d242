"""Packing of documents into training windows by best-fit decreasing.

A document longer than a window is first cut into full windows. The rests are
placed in order of falling length, each into the open window with the least
room that holds it; a segment tree over the room (0 to the window's length)
finds that window. This is done inside each task over bounded batches of tokens.
The pieces of windows that a batch leaves partly empty then go through a second
round of the same kind over all tasks, in which only numbers move: so padding
does not grow with the number of partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import materialise, slices, small_batches, table, text_or_empty

WINDOW, END_ID = 4096, 2
#: Tokens packed together: 16 MB of ids. Pieces packed together in the second round, for which one part in EMPTY of their window has to be empty.
BATCH_TOKENS, TOGETHER, EMPTY = 1 << 22, 500_000, 64


class RoomTree:
    """Open windows by their room; finds the least room of at least a given size in O(log window)."""

    def __init__(self, window: int):
        self.width = 1 << window.bit_length()
        self.count = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = room + self.width
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) of the tightest fit."""
        count, node = self.count, need + self.width
        while not count[node]:
            while node & 1:  # a right child: what follows is right of its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.width:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.width
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece (1 to ``window`` long, in the order given), and the number of windows."""
    where, offset, tree, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), RoomTree(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found, used = (window, used), used + 1
        room, at = found
        where[i], offset[i] = at, window - room
        if room > n:
            tree.add(room - n, at)
    return where, offset, used


def pack_documents(docs: DataFrame, vocabulary: str, window: int = WINDOW, batch_tokens: int = BATCH_TOKENS, ids: Column | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A null or empty text is one piece with the end id alone. Rows with equal
    ``doc_id`` are documents of their own. Other columns are not read; an empty
    table gives no pieces. A sequence id holds the number of the task above bit
    40. Another expression over ``ids`` may take their place, as they are written
    to shared storage once between the rounds.
    """
    pieces = pack_in_tasks(docs, vocabulary, window, batch_tokens)
    return pack_rests(materialise(pieces.withColumn("ids", F.col("ids") if ids is None else ids), "packing"), window)


def pack_rests(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The second round: the pieces of windows with much room (``open``) are packed anew, wherever they come from."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        sequence, offset, length = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("sequence_id", "offset", "length"))
        order = np.lexsort((offset, sequence, -length))
        sequence, offset = sequence[order], offset[order]
        where, at, used = best_fit_decreasing(length[order], window)
        # the new windows take names of those taken apart; should there be more of them, all stays as it was
        names = np.unique(sequence)
        if used > len(names):
            return
        yield pa.RecordBatch.from_arrays([pa.array(sequence), pa.array(offset), pa.array(names[where]), pa.array(at)], ["sequence_id", "offset", "new_id", "new_offset"])

    rests = pieces.where("open")
    parts = max(1, -(-rests.count() // TOGETHER))
    moved = rests.select("sequence_id", "offset", "length").repartition(parts, "sequence_id")
    moved = materialise(moved.mapInArrow(pack, "sequence_id long, offset long, new_id long, new_offset long"), "packing-rests")
    placed = rests.join(moved, ["sequence_id", "offset"], "left").withColumns({"sequence_id": F.coalesce("new_id", "sequence_id"), "offset": F.coalesce("new_offset", "offset")})
    return pieces.where("not open").drop("open").unionByName(placed.select(pieces.drop("open").columns))


def pack_in_tasks(docs: DataFrame, vocabulary: str, window: int = WINDOW, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """The first round, with ``open``: whether a piece's window has much room."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessella.llm.tokens import encoder

        tokens, used, held, size = encoder(vocabulary), TaskContext.get().partitionId() << 40, [], 0
        for batch in slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text")), strict=True):
                held.append((doc_id, np.append(ids, np.uint32(END_ID)).astype("<u4")))
                size += len(ids) + 1
                if size >= batch_tokens:
                    used = yield from packed(held, used)
                    held, size = [], 0
        yield from packed(held, used)

    def packed(held: list, used: int):
        held = sorted(held, key=lambda d: (d[0] is None, d[0] or 0, len(d[1]), zlib.crc32(d[1])))
        total = np.array([len(ids) for _, ids in held], dtype=np.int64)
        full = total // window
        rest = np.flatnonzero(total % window)
        where, offset, more = best_fit_decreasing(total[rest] % window, window)
        doc = np.concatenate([np.repeat(np.arange(len(held)), full), rest])
        nth = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        start = np.concatenate([nth * window, full[rest] * window])
        length = np.concatenate([np.full(full.sum(), window), total[rest] % window])
        sequence = used + np.concatenate([more + np.arange(full.sum()), where])
        offset = np.concatenate([np.zeros(full.sum(), np.int64), offset])
        tokens_in = np.bincount(where, total[rest] % window, minlength=more).astype(np.int64)
        room = np.concatenate([np.full(full.sum(), False), (window - tokens_in > window // EMPTY)[where]])
        keys = [d for d, _ in held]
        for at in range(0, len(doc), 2000):
            s = slice(at, at + 2000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in doc[s]], pa.int64()),
                    pa.array(start[s]),
                    pa.array(length[s]),
                    pa.array([held[i][1][a : a + n].tobytes() for i, a, n in zip(doc[s], start[s], length[s], strict=True)], pa.binary()),
                    pa.array(total[doc[s]]),
                    pa.array(sequence[s]),
                    pa.array(offset[s]),
                    pa.array(room[s]),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open"],
            )
        return used + more + int(full.sum())

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean"
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(pack, schema)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=F.crc32("ids"))
    return pieces.select("doc_id", "start", "length", F.col("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
