"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Words are runs of letters, lower-cased. Seeds of a test item are its 3-grams and
its rarest words, by the number of documents that hold them. An alignment of
score s needs s * n matched words of an item of n at least; so of its
n - ceil(s * n) + k rarest words k are matched, whatever was changed, inserted or
left out. A document with a 3-gram of an item, or with k of those words, is
aligned with the item around the seeds, word by word; the score is the best local
alignment's share of a full match. So every alignment with the least score is
found: the 3-grams give near copies, the rare words what no 3-gram survives in.

Items are a query set that goes against all documents in blocks of bounded size:
a block is broadcast, more items only mean more passes (two for each block).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import doc_key, slices, small_batches, table, total_counts

#: Words of a long seed; rare words that have to meet at most; least score; characters of items in a block.
SEED, RARE, LEAST_SCORE, BLOCK_CHARS = 3, 4, 0.5, 20_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of texts that are aligned together.
CELLS_TOGETHER = 500_000
FOUND = "doc_id long, item_id long, score double, first_word long, last_word long"


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    from tessella.llm import words

    h, bounds = words.letter_words(pa.array(texts, pa.string()))
    return [h[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def seeds_in(h: np.ndarray, n: int = SEED) -> np.ndarray:
    from tessella.llm.words import grams

    return grams(h, min(n, len(h))) if len(h) else grams(h, n)


def matches_needed(n: int, least: float) -> int:
    """Words of an item of ``n`` that an alignment of score ``least`` matches at least."""
    return max(1, math.ceil(least * n - 1e-9))


class SeedIndex:
    """Seeds of the items of a block: hash -> (item, word)."""

    def __init__(self, words: list[np.ndarray], grams: list[tuple[np.ndarray, np.ndarray]]):
        item = np.repeat(np.arange(len(grams)), [len(g) for g, _ in grams])
        at = np.concatenate([a for _, a in grams]) if grams else np.zeros(0, int)
        key = np.concatenate([g for g, _ in grams]) if grams else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.words, self.key, self.item, self.at = words, key[order], item[order], at[order]
        self.unique = np.unique(self.key)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[self.unique >> np.uint64(48)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``grams`` that are seeds, and their numbers in ``unique``."""
        at = np.flatnonzero(self.maybe[grams >> np.uint64(48)])
        if not len(self.unique) or not len(at):
            return np.zeros(0, int), np.zeros(0, int)
        number = np.minimum(np.searchsorted(self.unique, grams[at]), len(self.unique) - 1)
        hit = self.unique[number] == grams[at]
        return at[hit], number[hit]

    def times(self, numbers: np.ndarray) -> np.ndarray:
        """How many items' words each seed stands for."""
        return np.searchsorted(self.key, self.unique[numbers], side="right") - np.searchsorted(self.key, self.unique[numbers], side="left")

    def places(self, positions: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, word of the document at which the item would begin, word of the item) of every occurrence of the seeds."""
        count = self.times(numbers)
        low = np.searchsorted(self.key, self.unique[numbers], side="left")
        entry = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return self.item[entry], np.repeat(positions, count) - self.at[entry], self.at[entry]


class Seeds:
    """Both kinds of seeds of a block's items. ``counts``: documents with each of ``vocabulary``, the sorted words of the items."""

    def __init__(self, words: list[np.ndarray], vocabulary: np.ndarray, counts: np.ndarray, least: float):
        self.words, self.least = words, least
        long = [seeds_in(w) for w in words]
        self.long = SeedIndex(words, [(g, np.arange(len(g))) for g in long])
        self.sizes = sorted({min(SEED, len(w)) for w in words})  # items of fewer words than a seed are seeds as a whole
        rare, self.needed = [], np.zeros(len(words), np.int64)
        for i, w in enumerate(words):
            if len(w) < SEED:
                rare.append((w[:0], np.zeros(0, int)))
                continue
            matched = matches_needed(len(w), least)
            self.needed[i] = min(RARE, matched)
            order = np.lexsort((np.arange(len(w)), w, counts[np.searchsorted(vocabulary, w)]))
            at = np.sort(order[: len(w) - matched + self.needed[i]])
            rare.append((w[at], at))
        self.rare = SeedIndex(words, rare)

    def meeting(self, at: np.ndarray, number: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, begin) where enough different rare words of an item meet, as close as gaps can bring them apart."""
        doc = np.searchsorted(bounds, at, side="right") - 1
        item, begin, place = self.rare.places(at - bounds[doc], number)
        doc = np.repeat(doc, self.rare.times(number))
        order = np.lexsort((begin, item, doc))
        doc, item, begin, place = doc[order], item[order], begin[order], place[order]
        size = np.array([len(w) for w in self.words], dtype=np.int64)
        reach = np.ceil(2 * (1 - self.least) * size[item]).astype(np.int64)
        group = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])) if len(doc) else doc
        other = np.minimum(np.arange(len(doc)) + self.needed[item] - 1, max(0, len(doc) - 1))
        first = np.flatnonzero((np.arange(len(doc)) + self.needed[item] <= len(doc)) & (group[other] == group) & (begin[other] - begin <= reach))
        # both are sorted by group and begin
        low = int(begin.min()) if len(begin) else 0
        span = (int(begin.max()) - low if len(begin) else 0) + int(reach.max(initial=0)) + 2
        ends = np.searchsorted(group * span + begin - low, group[first] * span + begin[first] - low + reach[first], side="right")
        keep = [i for i, j in zip(first.tolist(), ends.tolist(), strict=True) if len(set(place[i:j].tolist())) >= self.needed[item[i]]]
        return doc[keep], item[keep], begin[keep]

    def candidates(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, word of the text at which the item would begin), sorted by text and item; ``h`` are the words of all texts."""
        from tessella.llm import words

        found = []
        for n in self.sizes:
            at, number = self.long.hits(words.grams(h, n))
            doc = np.searchsorted(bounds, at, side="right") - 1
            inside = at + n <= bounds[doc + 1]
            at, number, doc = at[inside], number[inside], doc[inside]
            item, begin, _ = self.long.places(at - bounds[doc], number)
            found.append((np.repeat(doc, self.long.times(number)), item, begin))
        found.append(self.meeting(*self.rare.hits(h), bounds))
        doc, item, begin = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((item, doc))
        return doc[order], item[order], begin[order]


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each item with its text: the best local alignment's score over that of a full match, and the last word of the text in it.

    All pairs at once: a row is one word of each item, longest items first; a gap
    along a text is a running maximum.
    """
    order = sorted(range(len(items)), key=lambda i: -len(items[i]))
    lengths = np.array([len(items[i]) for i in order])
    width = max(map(len, texts), default=0)
    text, here = np.zeros((len(order), width), np.uint64), np.zeros((len(order), width), bool)
    for k, i in enumerate(order):
        text[k, : len(texts[i])], here[k, : len(texts[i])] = texts[i], True
    slope = GAP * np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(order), width + 1), np.int32)
    best, last = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
    for nth in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -nth, side="left"))  # items with more words than this
        word = np.array([items[i][nth] for i in order[:n]], dtype=np.uint64)
        new = row[:n, :-1] + np.where((text[:n] == word[:, None]) & here[:n], np.int32(MATCH), np.int32(MISMATCH))
        np.maximum(new, row[:n, 1:] + GAP, out=new)
        np.maximum(new, 0, out=new)
        row[:n, 1:] = new
        row[:n] = np.maximum.accumulate(row[:n] - slope, axis=1) + slope
        at = row[:n].argmax(1)
        score = row[np.arange(n), at]
        more = score > best[:n]
        best[:n], last[:n] = np.where(more, score, best[:n]), np.where(more, at - 1, last[:n])
    back = np.argsort(order)
    return best[back] / (MATCH * np.array([len(x) for x in items])), last[back]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """``align`` for one pair."""
    score, last = align([item], [text])
    return float(score[0]), int(last[0])


def windows(begins: np.ndarray, size: int, words: int, least: float = LEAST_SCORE) -> list[tuple[int, int]]:
    """Stretches of a document of ``words`` words around the places where an item of ``size`` words may begin.

    An alignment of score ``least`` has gaps of at most 2 * (1 - least) * size words, which shift and stretch it.
    """
    pad, out = math.ceil(2 * (1 - least) * size) + 1, []
    begins = np.unique(begins)
    cut = np.flatnonzero(np.diff(begins) > size) + 1
    for run in np.split(begins, cut):
        at = 0
        while at < len(run):  # a long run is taken in stretches of twice the item
            stop = int(np.searchsorted(run, run[at] + size, side="right"))
            out.append((max(0, int(run[at]) - pad), min(words, int(run[stop - 1]) + size + pad)))
            at = stop
    return out


def blocks_of(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and words of the items, in blocks of about BLOCK_CHARS characters. Items without words are left out."""
    total = items.agg(F.sum(F.length("text"))).head()[0] or 0
    parts = total // BLOCK_CHARS + 1
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64(doc_key("item_id")), F.lit(parts)) == part).select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").collect()
        words = item_words([r.text for r in rows])
        yield [r.item_id for r, w in zip(rows, words, strict=True) if len(w)], [w for w in words if len(w)]


def document_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each word of the sorted ``vocabulary`` occurs, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # BLOCK_CHARS bound it

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        from tessella.llm import words

        known, total = SeedIndex([], [(shared.value, np.zeros(len(shared.value), int))]), np.zeros(len(shared.value), np.int64)
        for batch in slices(batches):
            h, bounds = words.letter_words(batch.column("text"))
            at, number = known.hits(h)
            doc = np.searchsorted(bounds, at, side="right") - 1
            total += np.bincount(np.unique(doc * len(total) + number) % max(1, len(total)), minlength=len(total))
        return total

    return total_counts(docs.select("text"), count, len(vocabulary))


def seeds_of(docs: DataFrame, items: DataFrame, least: float) -> Iterator[tuple[list, Seeds]]:
    for ids, words in blocks_of(items):
        if ids:
            vocabulary = np.unique(np.concatenate(words))
            yield ids, Seeds(words, vocabulary, document_counts(docs, vocabulary), least)


def found_in(column: pa.Array, seeds: Seeds) -> Iterator[tuple[int, int, tuple[float, int, int]]]:
    """(text, item, match) of every match in a column of texts."""
    from tessella.llm import words

    h, bounds = words.letter_words(column)
    doc, item, begin = seeds.candidates(h, bounds)
    if not len(doc):
        return
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (item[1:] != item[:-1])) + 1
    wait: list[tuple[int, int, int, int]] = []
    width = 0
    best: dict[tuple[int, int], tuple[float, int, int]] = {}

    def compare() -> None:
        score, last = align([seeds.words[i] for _, i, _, _ in wait], [h[bounds[d] + a : bounds[d] + b] for d, _, a, b in wait])
        for (d, i, a, _), x, y in zip(wait, score.tolist(), last.tolist(), strict=True):
            if x >= seeds.least and ((d, i) not in best or x > best[d, i][0]):
                best[d, i] = (x, a, a + y)
        wait.clear()

    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(doc)], strict=True):
        d, i = int(doc[lo]), int(item[lo])
        words_of, text = seeds.words[i], h[bounds[d] : bounds[d + 1]]
        for a, b in windows(begin[lo:hi], len(words_of), len(text), seeds.least):
            if np.isin(words_of, text[a:b]).sum() >= seeds.least * len(words_of):  # else no alignment can score enough
                wait.append((d, i, a, b))
                width = max(width, b - a)
                if len(wait) * width > CELLS_TOGETHER:
                    compare()
                    width = 0
    compare()
    for (d, i), match in best.items():
        yield d, i, match


def contaminations(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """A row (doc_id, item_id, score, first_word, last_word) for each document and test item with a score of ``least`` or more.

    Null and empty texts hold nothing; items without words are held by nothing;
    an item of fewer words than a seed is found where a text has it whole. A
    document's row comes as often as the document. Only doc_id and text, item_id
    and text are read; empty tables give an empty result.
    """
    spark = docs.sparkSession
    out = None
    for ids, seeds in seeds_of(docs, items, least):
        shared = spark.sparkContext.broadcast((ids, seeds))  # BLOCK_CHARS bound it

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, seeds = shared.value
            for batch in slices(batches):
                key, rows = batch.column("doc_id").to_pylist(), []
                for d, i, (score, first, last) in found_in(batch.column("text"), seeds):
                    rows.append((key[d], ids[i], score, first, last))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "item_id", "score", "first_word", "last_word"])

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], FOUND) if out is None else out


def clean_documents(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents, with all their columns, that hold no test item; no row moves.

    Rows are judged one by one: null and empty texts stay, and so do all rows where
    there is no item with words; repeated rows stay or go together.
    """
    for _, seeds in seeds_of(docs, items, least):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                for d, _, _ in found_in(batch.column("text"), shared.value):
                    keep[d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
