"""Size-aware heavy-light join of documents on the Jaccard likeness of their word shingles.

Sets of at least ``similarity`` likeness are found by keys that two such sets
must share. All sets order their shingles in one global way: those that a
fixed-size count sketch of the corpus shows as frequent last, then by hash.
With c = ceil(similarity * n) shingles to share at least,

* a small set (light, n <= boundary) enumerates all fixed-size subsets (pairs)
  of its first n - c + 2 shingles; two small sets that link share such a pair;
* a large set (heavy) scans the inverted lists of its first n - c + 1 shingles;
  small sets near the boundary post theirs there too.

The boundary is the size with the least cost: subsets enumerated on one side,
postings times the expected length of their lists on the other.

A posting also says how many shingles its set has from that place on (``rest``).
Two sets of a list can link by its key only if both have as many left as their
pair must share; so documents that hold one frequent passage, which stands last
in their order, are no candidates of each other unless it makes them alike.

Equal sets count once (by a 64-bit digest and the set's size). Short lists give
all their pairs. In a long one the members are first compared with a few, the
stars, which in a family of copies are those with few changes; then only pairs
are compared that are not yet known to hang together, within the task that holds
the list, or two blocks of it. So a family costs its size and not its square,
while no connection is lost. Every candidate must share enough keys, and every
link is checked on the full sets. Components come from large-star/small-star
rounds.

Both ends of a link lie in one component. So all links, not only those that
connect, come from comparing the different sets of each component with each
other, in pairs of blocks of bounded size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessella.llm.common import free_name, materialise, release_memory, slices, small_batches, table

WORDS, SIMILARITY = 5, (3, 4)
#: Cells of the count sketch (64 MB of counts, 16 MB of levels), sent in blocks.
CELLS, CELL_BLOCKS = 1 << 24, 64
CELL_SHIFT = np.uint64(64 - 24)
#: Lists of more members are long; stars of a long list; members in a block of one; members that a task holds of a list before it passes them on.
SHORT_LIST, STARS, BLOCK_MEMBERS, HELD = 4, 4, 2000, 200_000
#: Members of a list up to which each is held against all others there.
EACH_OTHER = 512
#: Shingles of a subset.
SUBSET = 2
#: Bits of the filter for sets to fetch (4 MB at most).
FILTER_BITS = 1 << 25
#: Members that one task compares with a star before the star is dealt again.
STAR_SHARE = 400
#: Sets and shingles of a block of a component, of which a task holds two; pairs up to which sets are compared one by one.
BLOCK_SETS, BLOCK_SHINGLES, FEW_PAIRS = 1000, 1_000_000, 64
#: Ids (8 bytes each) up to which they are broadcast.
BROADCAST_IDS = 1_000_000


def least_overlap(n: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Shingles that a set of ``n`` shares at least with any set that it links to."""
    return -(-n * similarity[0] // similarity[1])


def prefix_length(n: int, shared: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Of its shingles in global order, so many contain ``shared`` of those that a linked set has too."""
    return n - least_overlap(n, similarity) + shared if least_overlap(n, similarity) >= shared else 0


def subsets_of(n: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    return math.comb(prefix_length(n, SUBSET, similarity), SUBSET)


def largest_small(list_length: float, similarity: tuple[int, int] = SIMILARITY) -> int:
    """The size from which on subsets cost more than scanning lists, whatever the other sets are."""
    n = 1
    while subsets_of(n, similarity) <= prefix_length(n, 1, similarity) * (1 + list_length) or subsets_of(n + 1, similarity) <= prefix_length(n + 1, 1, similarity) * (1 + list_length):
        n += 1
    return n


def choose_boundary(sizes: dict[int, int], list_length: float, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Largest small size. ``sizes``: number of sets by size, up to ``largest_small``; ``list_length``: postings that one posting meets."""

    def cost(x: int) -> float:
        near = least_overlap(x + 1, similarity)
        total = 0.0
        for n, count in sizes.items():
            if n <= x:
                total += count * (subsets_of(n, similarity) + (prefix_length(n, 1, similarity) if n >= near else 0))
            else:
                total += count * prefix_length(n, 1, similarity) * (1 + list_length)
        return total

    return min([0, *sizes], key=lambda x: (cost(x), x))


def set_digest(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a sorted set."""
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def batches_of_sets(batches: Iterator[pa.RecordBatch], words: int):
    from tessella.llm.words import shingle_sets

    for batch in slices(batches):
        yield [(d, s, set_digest(s) if len(s) else 0) for d, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), words), strict=True)]


def packed_counts(counts: np.ndarray) -> bytes:
    """A bit for each count over 0, then the counts less one: a byte each, 255 for those that follow in full."""
    some = counts[counts > 0] - 1
    large = some[some >= 255]
    return zlib.compress(np.packbits(counts > 0).tobytes() + np.minimum(some, 255).astype(np.uint8).tobytes() + large.astype("<u4").tobytes(), 1)


def add_counts(total: np.ndarray, packed: bytes) -> None:
    raw, bits = zlib.decompress(packed), len(total) // 8
    at = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, bits)))
    some = np.frombuffer(raw, np.uint8, len(at), bits).astype(np.int64)
    some[some == 255] = np.frombuffer(raw, "<u4", offset=bits + len(at))
    total[at] += some + 1


def survey(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """A row (doc_id, n, sid) for each document, and the count sketch of all shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.uint32)
        names = ["doc_id", "n", "sid", "block", "counts"]
        for rows in batches_of_sets(batches, words):
            cell, count = np.unique(np.concatenate([s for _, s, _ in rows]) >> CELL_SHIFT, return_counts=True)
            cells[cell] += count.astype(np.uint32)
            ids, sizes, digests = [r[0] for r in rows], [len(r[1]) for r in rows], [r[2] for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names)
        if cells.any():
            parts = [packed_counts(p) for p in np.split(cells, CELL_BLOCKS)]
            none = pa.nulls(CELL_BLOCKS, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(range(CELL_BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                add_counts(total.setdefault(block, np.zeros(CELLS // CELL_BLOCKS, dtype="<i8")), counts.as_py())
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(t.tobytes(), 1) for t in total.values()], pa.binary())], ["block", "counts"])

    read = materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, sid long, block int, counts binary"), "jaccard-survey")
    cells = np.zeros(CELLS, dtype=np.float32)
    for row in read.where("block is not null").select("block", "counts").repartition(CELL_BLOCKS, "block").mapInArrow(add, "block int, counts binary").collect():
        size = CELLS // CELL_BLOCKS
        cells[row.block * size : (row.block + 1) * size] = np.frombuffer(zlib.decompress(row.counts), dtype="<i8")
    return read.where("block is null").select("doc_id", "n", "sid"), cells


def heaviness(cells: np.ndarray) -> np.ndarray:
    """0 for cells that chance explains, else a level for every half power of two over that."""
    mean = sum(float(part.sum(dtype=float)) for part in np.split(cells, CELL_BLOCKS)) / len(cells)
    usual = np.float32(mean + 5 * np.sqrt(mean) + 2)
    return np.concatenate([np.clip(np.ceil(2 * np.log2(np.maximum(part, 1) / usual)), 0, 120).astype(np.uint8) for part in np.split(cells, CELL_BLOCKS)])


def keys_of(shingles: np.ndarray, level: np.ndarray, boundary: int, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The keys under which a set looks for others, and how many shingles it can share at most with a set that it first meets there."""
    from tessella.llm.words import mix

    n = len(shingles)
    ordered = shingles[np.lexsort((shingles, level[shingles >> CELL_SHIFT]))]
    keys, rest = [], []
    if n > boundary or n >= least_overlap(boundary + 1, similarity):
        keys.append(ordered[: prefix_length(n, 1, similarity)])
        rest.append(n - np.arange(len(keys[-1])))
    if n <= boundary:
        first = ordered[: prefix_length(n, SUBSET, similarity)]
        i, j = np.triu_indices(len(first), 1)
        keys.append(mix(first[i] * np.uint64(0x9E3779B97F4A7C15) + mix(first[j])))
        rest.append(n - j + 1)  # the second of the pair stands at j, so one shared shingle more than from there on
    return np.concatenate(keys), np.concatenate(rest)


def overlap_of(a, b, similarity: tuple[int, int] = SIMILARITY):
    """Shingles that linked sets of ``a`` and ``b`` shingles share at least."""
    return -(-similarity[0] * (a + b) // (similarity[0] + similarity[1]))


def able(n: np.ndarray, rest: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Whether each member of a list may link by it to any other; for long lists, to the smallest size that it could link to."""
    if len(n) <= EACH_OTHER:
        both = overlap_of(n[:, None], n[None, :], similarity) <= np.minimum(rest[:, None], rest[None, :])
        np.fill_diagonal(both, False)
        return both.any(1)
    return overlap_of(n, np.maximum(n.min(), -(-n * similarity[0] // similarity[1])), similarity) <= rest


#: kind 0: a pair (x, y) of a short list, with sizes, and whether they may link by it. Kind 1: a member of a long list: x key, y set, nx its size, ny its rest.
MET = "kind int, x long, y long, nx int, ny int, able boolean, members int"


def met_in_lists(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs and members (``MET``) of lists that come one after the other, as rows (key, sid, span) without repeated sets."""

    def batch_of(kind: int, x, y, nx, ny, flag, members) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y), pa.array(nx.astype(np.int32)), pa.array(ny.astype(np.int32)), pa.array(flag), pa.array(np.broadcast_to(members, len(x)).astype(np.int32))],
            ["kind", "x", "y", "nx", "ny", "able", "members"],
        )

    def emit(key: np.ndarray, sid: np.ndarray, span: np.ndarray, open_key) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        n, rest = span >> 32, span & 0xFFFFFFFF
        start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        size = np.diff(start, append=len(key))
        long = (size > SHORT_LIST) | (key[start] == open_key if open_key is not None else False)
        for m in range(2, SHORT_LIST + 1):
            first = start[~long & (size == m)]
            if not len(first):
                continue
            i, j = np.triu_indices(m, 1)
            i, j = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
            yield batch_of(0, sid[i], sid[j], n[i], n[j], overlap_of(n[i], n[j], similarity) <= np.minimum(rest[i], rest[j]), m)
        some = np.flatnonzero(np.repeat(long, size))
        if len(some):
            flag = np.zeros(len(key), dtype=bool)
            for a, m in zip(start[long].tolist(), size[long].tolist(), strict=True):
                # what a task can't hold as a whole may meet others
                flag[a : a + m] = True if key[a] == open_key else able(n[a : a + m], rest[a : a + m], similarity)
            yield batch_of(1, key[some], sid[some], n[some], rest[some], flag[some], np.repeat(size, size)[some])

    held, open_key = [np.zeros(0, np.int64)] * 3, None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "sid", "span"), strict=True)]
        key = held[0]
        last = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
        if len(key) - last > HELD:  # pass on what there is of a list that has no end
            yield from emit(*(h[:last] for h in held), open_key)
            open_key = int(key[-1])
            yield from emit(*(h[last:] for h in held), open_key)
            held = [np.zeros(0, np.int64)] * 3
        elif last:
            yield from emit(*(h[:last] for h in held), open_key)
            held = [h[last:] for h in held]
    yield from emit(*held, open_key)
    release_memory()


def postings_met(cells: np.ndarray, level: np.ndarray) -> float:
    """Postings that one posting of a cell without a level meets on average; frequent shingles hardly come into prefixes."""
    n, total, squares = 0, 0.0, 0.0
    for part, heavy in zip(np.split(cells, CELL_BLOCKS), np.split(level, CELL_BLOCKS), strict=True):
        light = part[heavy == 0].astype(float)
        n, total, squares = n + len(light), total + float(light.sum()), squares + float(np.dot(light, light))
    return max(0.0, squares / max(1.0, total) - total / n - 1) if n else 0.0


def met(docs: DataFrame, words: int, level: np.ndarray, boundary: int, similarity: tuple[int, int]) -> DataFrame:
    """What the lists with two different sets at least give (``MET``)."""
    shared = docs.sparkSession.sparkContext.broadcast(level)  # CELLS bytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for rows in batches_of_sets(batches, words):
            new = []
            for _, s, sid in rows:
                if len(s) and sid not in seen:
                    seen.add(sid)
                    new.append((*keys_of(s, level, boundary, similarity), len(s), sid))
            if len(seen) > 1_000_000:  # only saves repeated rows
                seen.clear()
            if new:
                count = [len(k) for k, _, _, _ in new]
                size = np.repeat(np.array([n for _, _, n, _ in new], dtype=np.int64), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for k, _, _, _ in new]).view(np.int64)), pa.array(np.repeat(np.array([d for _, _, _, d in new], dtype=np.int64), count)), pa.array(size << 32 | np.concatenate([r for _, r, _, _ in new]))],
                    ["key", "sid", "span"],
                )

    rows = docs.select("doc_id", "text").mapInArrow(run, "key long, sid long, span long")
    order = Window.partitionBy("key").orderBy("sid")
    near = rows.withColumns({"least": F.first("sid").over(order), "after": F.lead("sid").over(order)})
    # of equal neighbours the last stays; a list of one set goes
    lists = near.where("after <> sid or after is null and least <> sid").select("key", "sid", "span")
    return materialise(lists.mapInArrow(lambda batches: met_in_lists(batches, similarity), MET), "jaccard-met")


def fetch_sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """(sid, n, items) of the wanted sets (sid, doc_id) and of some others, read from the texts of those documents. A set may come again."""
    bits = 1 << max(10, min(FILTER_BITS.bit_length() - 1, (16 * max(1, wanted.count())).bit_length()))
    cell = F.col("sid").bitwiseXOR(F.coalesce("doc_id", F.lit(0))).bitwiseAND(F.lit(bits - 1))
    words_of = wanted.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")).toArrow()
    mask = np.zeros(bits // 64, dtype=np.int64)
    mask[words_of["word"].to_numpy()] = words_of["bits"].to_numpy()  # bits / 64 rows at most
    shared = docs.sparkSession.sparkContext.broadcast(mask.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, seen = shared.value, set()
        for found in batches_of_sets(batches, words):
            sid = np.array([r[2] for r in found], dtype=np.int64)
            at = ((sid ^ np.array([r[0] or 0 for r in found], dtype=np.int64)) & (bits - 1)).astype(np.uint64)
            hit = (mask[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
            keep = []
            for r, h in zip(found, hit.tolist(), strict=True):
                if h and len(r[1]) and r[2] not in seen:
                    seen.add(r[2])
                    keep.append(r)
            if len(seen) > 1_000_000:
                seen.clear()
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array([r[2] for r in keep], pa.int64()), pa.array([len(r[1]) for r in keep], pa.int32()), pa.array([r[1].view(np.int64) for r in keep], pa.list_(pa.int64()))], ["sid", "n", "items"])

    return materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "sid long, n int, items array<long>"), "jaccard-sets")


def keys_needed(a: int, b: int, boundary: int, similarity: tuple[int, int]) -> int:
    """Keys that linked sets of ``a`` and ``b`` shingles have in common at least.

    Their prefixes share one shingle more than the pair's overlap exceeds what
    the larger set needs at least; of two small sets, the longer prefixes share
    one more, and every two of those are a key.
    """
    shared = overlap_of(a, b, similarity) - least_overlap(max(a, b), similarity) + 1
    return math.comb(shared + 1, 2) if max(a, b) <= boundary else shared


def similar(both: int, a: int, b: int, similarity: tuple[int, int]) -> bool:
    return similarity[1] * both >= similarity[0] * (a + b - both)


def verify(pairs: DataFrame, sets: DataFrame, test: Callable[[int, int, int], bool]) -> DataFrame:
    """The pairs (x, y, known) whose ``sets`` (sid, n, items) pass the test on ``known`` and the common items, and on both sizes.

    A set is dealt to as many tasks as its number of partners asks for; a task
    holds one at a time. Sets may come repeatedly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star = own = size = last = None
        for batch in batches:
            found = []
            for s, known, y, n, items in zip(*(batch.column(c).to_pylist() for c in ("star", "known", "y", "n")), batch.column("items"), strict=True):
                if (s, y) == last:
                    continue
                last, mine = (s, y), items.values.to_numpy(zero_copy_only=False)
                if y is None:
                    star, own, size = s, mine.copy(), n
                elif s != star:
                    raise ValueError("a pair came without its set")
                elif test(known + np.intersect1d(own, mine, assume_unique=True).size, size, n):
                    found.append((s, y))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["x", "y"])

    # only sets with many partners are dealt to several tasks
    many = materialise(pairs.groupBy("x").count().where(F.col("count") > STAR_SHARE).select("x", F.ceil(F.col("count") / STAR_SHARE).cast("int").alias("salts")), "jaccard-many")
    salted = pairs.join(many, "x", "left").select("x", "y", "known", F.pmod("y", F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    stars = salted.groupBy("x", "salt").agg(F.lit(None).cast("long").alias("y"), F.lit(0).alias("known"))
    both = salted.select(F.col("x").alias("star"), "salt", "y", F.col("known").cast("int"), F.col("y").alias("sid"))
    both = both.unionByName(stars.select(F.col("x").alias("star"), "salt", "y", "known", F.col("x").alias("sid")))
    return both.join(sets, "sid").select("star", "salt", "known", "y", "n", "items").repartition("star", "salt").sortWithinPartitions("star", "salt", F.asc_nulls_first("y")).mapInArrow(run, "x long, y long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of its component. Alternates large-star and small-star steps until nothing changes."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).head())

    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "components")
    was = mark(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialise(small.distinct(), "components")
        now = mark(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each set of ``a`` and each of ``b``.

    Shingles that few sets have add to the pairs that have them; the others are
    columns of two matrices that are multiplied some thousand columns at a time.
    """
    if len(a) * len(b) <= FEW_PAIRS:
        return np.array([[np.intersect1d(x, y, assume_unique=True).size for y in b] for x in a])

    def postings_of(sets):  # shingles, number and first place of each one's sets, the sets by shingle
        every, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(every, kind="stable")
        value, start, count = np.unique(every[order], return_index=True, return_counts=True)
        return value, start, count, of[order]

    def members(start, count, of):
        return of[np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())]

    (va, sa, ca, oa), (vb, sb, cb, ob) = postings_of(a), postings_of(b)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    sa, ca, sb, cb = sa[ia], ca[ia], sb[ib], cb[ib]
    total = np.zeros(len(a) * len(b), dtype=np.int64)
    few = np.flatnonzero(ca * cb <= FEW_PAIRS)
    for part in np.split(few, range(50_000, len(few), 50_000)):
        left, times = members(sa[part], ca[part], oa), np.repeat(cb[part], ca[part])
        right = members(np.repeat(sb[part], ca[part]), times, ob)
        total += np.bincount(np.repeat(left, times) * len(b) + right, minlength=len(total))
    total = total.reshape(len(a), len(b))
    many = np.flatnonzero(ca * cb > FEW_PAIRS)
    for part in np.split(many, range(2000, len(many), 2000)):
        x, y = np.zeros((len(a), len(part)), np.float32), np.zeros((len(b), len(part)), np.float32)
        x[members(sa[part], ca[part], oa), np.repeat(np.arange(len(part)), ca[part])] = 1
        y[members(sb[part], cb[part], ob), np.repeat(np.arange(len(part)), cb[part])] = 1
        total += np.rint(x @ y.T).astype(np.int64)
    return total


def links_within(labels: DataFrame, sets: DataFrame, similarity: tuple[int, int], counts: bool = False) -> DataFrame:
    """All links (a, b), a < b, between different sets of each component; with ``counts`` (sid, n_links) in parts to be added up.

    ``labels``: (node, label); ``sets``: (sid, n, items) of all nodes. Every pair of
    blocks of a component is a group of rows of its own.
    """
    names = ["sid", "n_links"] if counts else ["a", "b"]

    def linked(held: dict) -> pa.RecordBatch | None:
        (ids, x), (ids2, y) = next(iter(held.values())), list(held.values())[-1]
        n, m = np.array([len(v) for v in x]), np.array([len(v) for v in y])
        both = common_counts(x, y)
        good = similarity[1] * both >= similarity[0] * (n[:, None] + m[None, :] - both)
        ids, ids2 = np.array(ids, dtype=np.int64), np.array(ids2, dtype=np.int64)
        if len(held) == 1:
            np.fill_diagonal(good, False)
        if counts:
            sid, links = (ids, good.sum(1)) if len(held) == 1 else (np.concatenate([ids, ids2]), np.concatenate([good.sum(1), good.sum(0)]))
            some = links > 0
            return pa.RecordBatch.from_arrays([pa.array(sid[some]), pa.array(links[some].astype(np.int64))], names)
        i, j = np.nonzero(np.triu(good) if len(held) == 1 else good)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids2[j])), pa.array(np.maximum(ids[i], ids2[j]))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j", "block", "sid")), strict=True)
            for (label, i, j, block, sid), items in zip(keys, batch.column("items"), strict=True):
                if (label, i, j) != group:
                    # of two blocks one may be empty
                    if held and (len(held) == 2 or group[1] == group[2]):
                        yield linked(held)
                    group, held = (label, i, j), {}
                ids, own = held.setdefault(block, ([], []))
                if ids and ids[-1] == sid:
                    continue
                ids.append(sid)
                own.append(items.values.to_numpy(zero_copy_only=False).copy())
        if held and (len(held) == 2 or group[1] == group[2]):
            yield linked(held)
        release_memory()

    member = labels.select(F.col("node").alias("sid"), "label").join(sets, "sid")
    size = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    several = materialise(member.groupBy("label").agg(size.alias("blocks")).where("blocks > 1"), "jaccard-blocks")
    placed = member.join(several, "label", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "items")
    return placed.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "block", "sid").mapInArrow(run, f"{names[0]} long, {names[1]} long")


def apart_in_lists(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs (x, y, nx, ny) of two labels that may link by a list; rows come by (key, i, j, block), of which a group holds one block or two."""
    seen: set = set()

    def pairs(group: list) -> Iterator[pa.RecordBatch]:
        (sid, n, rest, label), (i, j, block) = (np.concatenate(c) for c in zip(*(g[:4] for g in group), strict=True)), (np.concatenate(c) for c in zip(*(g[4:] for g in group), strict=True))
        left = block == i[0]
        right = left if i[0] == j[0] else ~left
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        if not len(a) or not len(b):
            return
        for some in np.split(a, range(500, len(a), 500)):
            link = (label[some, None] != label[None, b]) & (overlap_of(n[some, None], n[None, b], similarity) <= np.minimum(rest[some, None], rest[None, b]))
            p, q = np.nonzero(link)
            p, q = some[p], b[q]
            if i[0] == j[0]:
                once = p < q
                p, q = p[once], q[once]
            swap = sid[p] > sid[q]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            new = [k for k, pair in enumerate(zip(sid[p].tolist(), sid[q].tolist(), strict=True)) if pair not in seen and not seen.add(pair)]
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(sid[p][new]), pa.array(sid[q][new]), pa.array(n[p][new].astype(np.int32)), pa.array(n[q][new].astype(np.int32))], ["x", "y", "nx", "ny"])
            if len(seen) > 500_000:  # only saves repeated rows
                seen.clear()

    group, at = [], None
    for batch in batches:
        columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("sid", "n", "rest", "label", "i", "j", "block", "key")]
        if not len(columns[0]):
            continue
        key, i, j = columns[7], columns[4], columns[5]
        cut = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
            own = (int(key[lo]), int(i[lo]), int(j[lo]))
            if group and own != at:
                yield from pairs(group)
                group = []
            at = own
            group.append([c[lo:hi] for c in columns[:7]])
    if group:
        yield from pairs(group)
    release_memory()


def jaccard_links(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n, sid) of every document, links (a, b) between different sets that connect all sets which links connect, and (sid, n, items) of those sets and others."""
    per_doc, cells = survey(docs, words)
    level = heaviness(cells)
    meets = postings_met(cells, level)
    del cells  # the driver keeps no more of the sketch than its levels
    release_memory()
    largest = largest_small(meets, similarity)
    sizes = {r.n: r["count"] for r in per_doc.where(F.col("n").between(1, largest)).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, meets, similarity)
    found = met(docs, words, level, boundary, similarity)
    del level
    release_memory()
    first = per_doc.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    p, q = similarity

    def may_link(a: str, b: str, rest_a: str, rest_b: str):  # both have enough shingles left
        return F.ceil(F.lit(p) * (F.col(a) + F.col(b)) / F.lit(p + q) - 1e-9) <= F.least(rest_a, rest_b)

    def needed(a: str, b: str):  # keys_needed as a column
        shared = F.ceil(F.lit(p) * (F.col(a) + F.col(b)) / F.lit(p + q) - 1e-9) - F.ceil(F.greatest(a, b) * p / q - 1e-9) + 1
        return F.when(F.greatest(a, b) <= boundary, shared * (shared + 1) / 2).otherwise(shared)

    # pairs of short lists, with the number of these that they share
    short = found.where("kind = 0").groupBy("x", "y", "nx", "ny").agg(F.count(F.lit(1)).alias("c"), F.max("able").alias("able"))
    short = materialise(short, "jaccard-short")
    long = found.where("kind = 1").select(F.col("x").alias("key"), F.col("y").alias("sid"), F.col("nx").alias("n"), F.col("ny").alias("rest"), "able", "members")
    # half of each key is enough here: where two halves agree by chance, a pair is only compared once more
    keys = long.groupBy("sid", "n").agg(F.count(F.lit(1)).alias("k"), (F.sum("members") / F.col("n")).alias("company"), F.collect_list(F.shiftright("key", 32).cast("int")).alias("items"))
    keys = materialise(keys, "jaccard-keys")

    def links_of(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The pairs (x, y, nx, ny, c) that share enough keys, links among them, and the sets compared."""
        k = [keys.select(F.col("sid").alias(c), F.col("k").alias(f"k{c}")) for c in ("x", "y")]
        few = pairs.where(F.col("c") < needed("nx", "ny")).join(k[0], "x").join(k[1], "y")
        few = materialise(few.where(F.col("c") + F.least("kx", "ky") >= needed("nx", "ny")).select("x", "y", F.col("c").alias("known")), "jaccard-few")
        few = verify(few, keys.select("sid", "n", "items"), lambda both, a, b: both >= keys_needed(a, b, boundary, similarity))
        some = pairs.where(F.col("c") >= needed("nx", "ny")).select("x", "y").unionByName(few)
        some = materialise(some.withColumn("known", F.lit(0)), "jaccard-candidates")
        nodes = some.select(F.explode(F.array("x", "y")).alias("sid")).distinct()
        sets = fetch_sets(docs, words, materialise(nodes.join(first, "sid"), "jaccard-wanted"))
        links = verify(some, sets, lambda both, a, b: similar(both, a, b, similarity))
        return some, materialise(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "jaccard-links"), sets

    # the stars of a list are the members that meet most others for their size: of a family of copies, those with few changes
    rows = materialise(long.where("able").join(keys.select("sid", "company"), "sid").select("key", "sid", "n", "rest", "company"), "jaccard-rows")
    stars = rows.groupBy("key", F.pmod("sid", F.lit(STARS))).agg(F.min(F.struct((-F.col("company")).alias("c"), "sid", "n", "rest")).alias("s"))
    stars = stars.select("key", F.col("s.sid").alias("star"), F.col("s.n").alias("n2"), F.col("s.rest").alias("rest2"))
    starred = rows.join(stars, "key").where((F.col("sid") != F.col("star")) & may_link("n", "n2", "rest", "rest2"))
    ordered = F.col("sid") < F.col("star")
    starred = starred.select(F.least("sid", "star").alias("x"), F.greatest("sid", "star").alias("y"), F.when(ordered, F.col("n")).otherwise(F.col("n2")).alias("nx"), F.when(ordered, F.col("n2")).otherwise(F.col("n")).alias("ny"))
    pairs = short.unionByName(starred.select("*", F.lit(0).alias("c"), F.lit(True).alias("able")))
    pairs = materialise(pairs.groupBy("x", "y", "nx", "ny").agg(F.sum("c").alias("c"), F.max("able").alias("able")).where("able").drop("able"), "jaccard-pairs")
    _, links, sets = links_of(pairs)
    # what hangs together by now has one label; a set without a link stands for itself
    label = materialise(components(links), "jaccard-labels").withColumnRenamed("node", "sid")
    labelled = materialise(rows.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid")).drop("company"), "jaccard-labelled")
    lists = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi")
    lists = materialise(lists.select("key", F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int").alias("blocks")), "jaccard-open")
    placed = labelled.join(lists, "key").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "n", "rest", "label")
    placed = placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "block")
    rest = placed.mapInArrow(lambda batches: apart_in_lists(batches, similarity), "x long, y long, nx int, ny int").distinct()
    rest = rest.join(pairs.select("x", "y"), ["x", "y"], "left_anti").join(short.select("x", "y", "c"), ["x", "y"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    _, more, others = links_of(materialise(rest, "jaccard-rest"))
    return per_doc, materialise(links.unionByName(more), "jaccard-links"), sets.unionByName(others)


def jaccard_pairs(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sid) of every document, and all links (a, b), a < b, between different sets."""
    per_doc, links, sets = jaccard_links(docs, words, similarity)
    return per_doc, links_within(materialise(components(links), "jaccard-labels"), sets, similarity)


def jaccard_components(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) and n_links of every document.

    n_links is the number of different texts (as sets of shingles) that the
    document links to; its exact copies are in its component and no links. A null or empty text, or one of white space, has no shingles and links with
    nothing. Rows with equal ``doc_id`` are documents of their own; a null
    ``doc_id`` names a component only if no other member has an id. Other columns
    are not read; an empty table gives an empty result.
    """
    per_doc, links, sets = jaccard_links(docs, words, similarity)
    labels = materialise(components(links), "jaccard-labels")
    counts = links_within(labels, sets, similarity, counts=True).groupBy("sid").agg(F.sum("n_links").alias("n_links"))
    least = materialise(per_doc.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least")), "jaccard-least")
    # only linked sets have a label; joins on one stand apart from sums over it, so that Spark can split a large component
    linked = materialise(labels.withColumnRenamed("node", "sid").join(least, "sid"), "jaccard-linked")
    whole = materialise(linked.groupBy("label").agg(F.min("least").alias("component_id")), "jaccard-whole")
    linked = linked.join(whole, "label").select("sid", "component_id").join(counts, "sid", "left")
    component = least.join(linked, "sid", "left").select("sid", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    component = materialise(component, "jaccard-components")
    return per_doc.join(component, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, that have the smallest doc_id of their component.

    Of rows with one doc_id, one stays or none. Documents without an id are all kept, as
    nothing names them.
    """
    parts = materialise(jaccard_components(docs, words, similarity).select("doc_id", "component_id"), "jaccard-parts")
    first = F.bool_or(F.col("doc_id") == F.col("component_id"))
    gone = parts.where("doc_id is not null").groupBy("doc_id").agg(first.alias("first")).where("not first").select("doc_id")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    again = parts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    again = materialise(again, "jaccard-again")
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(kept.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))


def one_row_of_each(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row, with all its columns, of each component: of the smallest doc_id, then the smallest digest of its set.

    Rows are told apart by doc_id and set, so rows of other components under one
    doc_id stay; a null doc_id comes last. Of rows equal in both, the first by their
    columns as JSON stays. A row without shingles links with nothing and stays.
    """
    per_doc, links, _ = jaccard_links(docs, words, similarity)
    labels = materialise(components(links), "jaccard-labels").withColumnRenamed("node", "sid")
    rows = per_doc.where("n > 0").groupBy("doc_id", "sid").agg(F.count(F.lit(1)).alias("copies"))
    rows = materialise(rows.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid")), "jaccard-parts")
    leads = materialise(rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sid")).alias("lead")), "jaccard-leads")
    stays = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("sid") == F.col("lead.sid"))
    # pairs that go, and pairs of which one row of several stays
    marked = rows.join(leads, "label").withColumn("stays", stays).where("not stays or copies > 1")
    own_sid, marked_id, marked_sid, stays = (free_name(docs, c) for c in ("own_sid", "marked_id", "marked_sid", "stays"))
    marked = materialise(marked.select(F.col("doc_id").alias(marked_id), F.col("sid").alias(marked_sid), F.col("stays").alias(stays)), "jaccard-marked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessella.llm.words import shingle_sets

        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64())], [*batch.schema.names, own_sid])

    keyed = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(own_sid, LongType())]))
    few = marked.count() <= BROADCAST_IDS
    met = F.col("doc_id").cast("long").eqNullSafe(F.col(marked_id)) & (F.col(own_sid) == F.col(marked_sid))

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    again = marked.where(F.col(stays))
    if again.isEmpty():
        return keyed.join(bounded(marked), met, "left_anti").select(docs.columns)
    several = keyed.join(bounded(again), met, "left_semi")
    row = F.struct(*docs.columns)
    first = several.groupBy(F.col("doc_id").alias("key"), own_sid).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return keyed.join(bounded(marked), met, "left_anti").select(docs.columns).unionByName(first)


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_components(table(spark, sf_dir, "documents"))


#: Every two sets that share a shingle are compared; for thousands of documents, not for millions.
OP2_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM w),
st AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS digest FROM sh GROUP BY 1),
md AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY digest, n) AS sid FROM st),
sd AS (SELECT sid, s FROM md JOIN sh ON md.doc_id = sh.doc_id AND md.doc_id = sid),
sz AS (SELECT DISTINCT sid, n FROM md),
pr AS (SELECT a.sid AS a, b.sid AS b, count(*) AS c FROM sd a JOIN sd b ON a.s = b.s AND a.sid < b.sid GROUP BY 1, 2),
ln AS (SELECT a, b FROM pr JOIN sz x ON x.sid = a JOIN sz y ON y.sid = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ed AS (SELECT a, b FROM ln UNION ALL SELECT b, a FROM ln),
rc AS (SELECT sid AS node, sid AS root FROM sz UNION SELECT ed.b, rc.root FROM rc JOIN ed ON ed.a = rc.node),
cp AS (SELECT node, min(root) AS component_id FROM rc GROUP BY 1), dg AS (SELECT a, count(*) AS n_links FROM ed GROUP BY 1)
SELECT d.doc_id, coalesce(md.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM documents d LEFT JOIN md USING (doc_id) LEFT JOIN cp ON cp.node = md.sid LEFT JOIN dg ON dg.a = md.sid"""
