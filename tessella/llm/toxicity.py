"""Toxicity by weak supervision.

A lexicon entry is a word, or the first 4 to 8 bytes of a longer word, that goes
with one of the labels in the training fold when it occurs at all or twice. Entries
that one word can have at once (a word, its beginnings, each once and twice) are
one root and belong to one voter. A voter votes "toxic" if one of its entries
occurs, else it abstains; one voter holds the entries of clean texts and votes
"clean". Patterns vote on how many words of a text are in the lexicon, how dense and
how varied they are, cut where the labelled training texts come apart best.

A generative label model with a latent class explains all votes, abstentions
included: each voter has a table of its votes given the class and the vote of the
one voter it correlates with most (a maximum spanning tree over conditional
mutual information), fitted by expectation maximisation without labels, from the
votes of the patterns on. A linear classifier on the lexical features and patterns is
trained on the posterior labels and scores every text. Given labels choose the
lexicon's entries and the cuts of the patterns, and two numbers, a slope and a
shift, that put the classifier's scores on the scale of probabilities.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import bounded_sample, materialise, slices, small_batches, table

#: Labelled rows to learn from at most (by hash of the key), lexical features, voters they are dealt to, least documents with a feature.
TRAIN_ROWS, FEATURES, VOTERS, LEAST_DOCS = 8000, 1024, 12, 5
#: Half a log-likelihood ratio that a feature needs (about 1e-5 by chance), and the share of toxic documents that an entry of toxic texts has at least, surely.
LEAST_GAIN, LEAST_SHARE = 9.0, 0.5
PREFIXES = (4, 5, 6, 7, 8)
#: Mutual information of two voters over the entropy of one of them, from which on they are almost one.
ALMOST_ONE = 0.5


def feature_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Even hashes of words and word beginnings, the word each is from, and the bounds of the texts' words."""
    from tessella.llm import words

    column = pc.utf8_lower(column)
    h, bounds, first, end = words.word_hashes(column, positions=True, classes=words.LETTERS)
    data, _ = words.text_buffers(column)
    word = np.arange(len(h))
    found, of = [h], [word]
    lead = np.zeros(len(h), dtype=np.uint64)
    for k in range(1, max(PREFIXES) + 1):
        longer = (end - first)[word] >= k + (k in PREFIXES)
        word, lead = word[longer], lead[longer]
        lead = lead * np.uint64(257) + data[first[word] + k - 1]
        if k in PREFIXES:
            found.append(words.mix(lead * np.uint64(16) + np.uint64(k)))
            of.append(word)
    return np.concatenate(found) & ~np.uint64(1), np.concatenate(of), bounds


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, toxic, text and features (odd: the even one below it occurs twice) of at most ``rows`` labelled documents outside the held-out fold.

    An id with several texts is learnt from by the least of them, so that rows are bounded as ids are.
    """
    key = F.col("doc_id").cast("string")
    known = labels.where("doc_id is not null and toxic is not null").where(F.crc32(key.cast("binary")) % 5 != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = bounded_sample(known, rows)  # bounds what is broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, word, bounds = feature_hashes(batch.column("text"))
            doc = np.searchsorted(bounds, word, side="right") - 1
            order = np.argsort(doc, kind="stable")
            h, cut = h[order], np.searchsorted(doc[order], np.arange(batch.num_rows + 1))
            sets = []
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                once, count = np.unique(h[a:b], return_counts=True)
                sets.append(np.concatenate([once, once[count > 1] | np.uint64(1)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(sets, pa.list_(pa.int64())), batch.column("text")], ["doc_id", "toxic", "features", "text"])

    few = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known), "doc_id")
    few = few.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return materialise(few.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, features array<long>, text string"), "toxicity-train")


def lexicon(train: DataFrame, features: int = FEATURES) -> list[tuple[int, int, int]]:
    """(feature, documents, toxic documents) with the strongest association (log-likelihood ratio), strongest first."""
    total = train.agg(F.count(F.lit(1)), F.sum("toxic")).head()
    n, t = float(total[0]), float(total[1] or 0)
    if not n or not 0 < t < n:
        return []
    counts = train.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("d"), F.sum("toxic").alias("k")).where(F.col("d") >= LEAST_DOCS)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    d, k = F.col("d").cast("double"), F.col("k").cast("double")
    g = part(k, d * t / n) + part(d - k, d * (n - t) / n) + part(F.lit(t) - k, (F.lit(n) - d) * t / n + 1e-9) + part(F.lit(n - t) - (d - k), (F.lit(n) - d) * (n - t) / n + 1e-9)
    chosen = [(r.f, r.d, r.k) for r in counts.withColumn("g", g).where(F.col("g") >= LEAST_GAIN).orderBy(F.desc("g"), "f").limit(features).collect()]
    # one that goes with toxic texts, but not surely enough for a vote, belongs to neither side
    return [(f, d, k) for f, d, k in chosen if surely(k, d) >= LEAST_SHARE or k * n < d * t]


def surely(k: int, d: int, z: float = 1.64) -> float:
    """Lower end of Wilson's interval for the share k / d."""
    return (k / d + z * z / (2 * d) - z * ((k / d * (1 - k / d) + z * z / (4 * d)) / d) ** 0.5) / (1 + z * z / d)


class Lexicon:
    """Chosen features, and what a text has of them."""

    def __init__(self, chosen: list[tuple[int, int, int]], voters: int = VOTERS):
        feature = np.array([f for f, _, _ in chosen], dtype=np.int64).view(np.uint64)
        self.side = np.array([surely(k, d) >= LEAST_SHARE for _, d, k in chosen], dtype=bool)
        self.size = len(chosen)
        self.base = np.unique(feature & ~np.uint64(1))
        self.number = np.full((2, len(self.base)), -1)  # of the feature "once" and of "twice"
        at = np.searchsorted(self.base, feature & ~np.uint64(1))
        self.number[(feature & np.uint64(1)).astype(int), at] = np.arange(self.size)
        self.toxic_base = ((self.number >= 0) & self.side[self.number]).any(0) if self.size else np.zeros(0, bool)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[self.base >> np.uint64(48)] = True
        self.voters = voters
        self.deal([])

    def deal(self, links: Iterable[tuple[int, int]]) -> None:
        """Give the roots to voters in order of strength; ``links`` are pairs of bases that a word has at once."""
        root = list(range(len(self.base)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in links:
            x, y = sorted((top(a), top(b)))
            root[y] = x
        of_feature = np.zeros(self.size, dtype=int)
        for kind in (0, 1):
            at = np.flatnonzero(self.number[kind] >= 0)
            of_feature[self.number[kind, at]] = at
        voter: dict[int, int] = {}
        self.group = np.full(self.size, -1)
        for i in np.flatnonzero(self.side).tolist():
            self.group[i] = voter.setdefault(top(int(of_feature[i])), len(voter)) % self.voters
        self.groups = min(self.voters, len(voter))

    def links(self, column: pa.Array) -> np.ndarray:
        """Pairs of bases of toxic texts that a word of these texts has at once, as rows of two."""
        h, word, _ = feature_hashes(column)
        at = np.minimum(np.searchsorted(self.base, h), max(0, len(self.base) - 1))
        hit = (self.base[at] == h) & self.toxic_base[at] if self.size else np.zeros(len(h), dtype=bool)
        at, word = at[hit], word[hit]
        order = np.argsort(word, kind="stable")
        at, word = at[order], word[order]
        same = word[1:] == word[:-1]
        return np.unique(np.stack([at[:-1][same], at[1:][same]], axis=1), axis=0)

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature) pairs as two arrays, and for each text how many of its words are in the toxic part, its words, and the features there."""
        h, word, bounds = feature_hashes(column)
        few = np.flatnonzero(self.maybe[h >> np.uint64(48)])
        h, word = h[few], word[few]
        at = np.minimum(np.searchsorted(self.base, h), max(0, len(self.base) - 1))
        hit = self.base[at] == h if self.size else np.zeros(len(h), dtype=bool)
        at, word = at[hit], word[hit]
        doc = np.searchsorted(bounds, word, side="right") - 1
        pair, count = np.unique(doc * max(1, len(self.base)) + at, return_counts=True)
        doc, at = np.divmod(pair, max(1, len(self.base)))
        text, feature = np.concatenate([doc, doc[count > 1]]), np.concatenate([self.number[0, at], self.number[1, at[count > 1]]])
        text, feature = text[feature >= 0], feature[feature >= 0]
        n, length = len(column), np.maximum(1, np.diff(bounds))
        toxic = np.unique(word[self.toxic_base[np.searchsorted(self.base, h[hit])]]) if self.size else word
        words = np.bincount(np.searchsorted(bounds, toxic, side="right") - 1, minlength=n)
        kinds = np.bincount(text[self.side[feature]] if self.size else text, minlength=n)
        return text, feature, np.stack([words, length, kinds], axis=1)

    def calibrate(self, stats: np.ndarray, toxic: np.ndarray) -> None:
        """Cut the number, density and variety of lexicon words where the fewest training rows are on the wrong side, amid the widest such gap."""
        self.cuts = []
        for value in self.measures(stats):
            steps, at = np.unique(value, return_inverse=True)
            lost, false = np.bincount(at, toxic, minlength=len(steps)), np.bincount(at, 1 - toxic, minlength=len(steps))
            # errors with the cut at each step but the first, which no text without a hit may reach
            wrong = np.cumsum(lost)[:-1] + (false.sum() - np.cumsum(false)[:-1])
            if not len(wrong):
                self.cuts.append(max(1e-6, float(steps[-1]) if len(steps) and steps[-1] > 0 else 1.0))
                continue
            low, high = np.maximum(steps[:-1], 0.5 * steps[steps > 0].min()), steps[1:]
            best = np.flatnonzero(wrong == wrong.min())
            i = int(best[np.argmax(high[best] / low[best])])
            self.cuts.append(float(np.sqrt(low[i] * high[i])))

    @staticmethod
    def measures(stats: np.ndarray) -> list[np.ndarray]:
        return [stats[:, 0].astype(float), stats[:, 0] / stats[:, 1], stats[:, 2].astype(float)]

    def patterns(self, stats: np.ndarray) -> np.ndarray:
        """Three votes a text: 1 at the cut and above, 2 clearly below."""
        votes = np.zeros((len(stats), 3), dtype=np.int8)
        for j, (value, cut) in enumerate(zip(self.measures(stats), self.cuts, strict=True)):
            votes[value >= cut, j], votes[value < 0.8 * cut, j] = 1, 2
        return votes

    def votes(self, text: np.ndarray, feature: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        """A column for each voter of the lexicon, one for the entries of clean texts, then the patterns."""
        n, groups = len(patterns), self.groups
        votes = np.zeros((n, groups + 4), dtype=np.int8)
        toxic = self.side[feature] if self.size else np.zeros(0, dtype=bool)
        votes[text[toxic], self.group[feature[toxic]]] = 1
        votes[text[~toxic], groups] = 2
        votes[:, -3:] = patterns
        return votes

    def design(self, text: np.ndarray, feature: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs, with the votes of the patterns as six more features and the density in ten steps."""
        patterns = self.patterns(stats)
        row, col = np.nonzero(patterns)
        step = np.clip(np.ceil(2 * np.log2(np.maximum(stats[:, 0] / stats[:, 1], 1e-6) / self.cuts[1])) + 5, 0, 9).astype(int)
        return np.concatenate([text, row, np.arange(len(stats))]), np.concatenate([feature, self.size + 2 * col + patterns[row, col] - 1, self.size + 6 + step])

    def score(self, column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
        row, col = self.design(*self.read(column))
        return 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, weights[col], minlength=len(column)), -500, 500)))


class LabelModel:
    """p(class) * prod_j p(vote_j | vote of parent(j), class), the parents forming a tree."""

    def fit(self, votes: np.ndarray, rounds: int = 60, first: int = 0) -> LabelModel:
        """Expectation maximisation without labels, from the share of "toxic" among the votes of the last ``first`` voters (0: all) on: until the classes are settled with the correlations that almost make two voters one, then with all of the tree."""
        one_hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)  # n, m, 3
        start = votes[:, -first:] if first else votes
        post = np.clip((start == 1).sum(1) / np.maximum(1, (start > 0).sum(1)), 0.02, 0.98)
        # copies of a voter could pass for the class if taken as independent, and so could weak correlations that are taken in too early
        for least, steps in ((ALMOST_ONE, rounds), (0.0, rounds // 10)):
            self.parent = self.dependencies(one_hot, post, least)
            for _ in range(steps):
                self.estimate(one_hot, post)
                old, post = post, self.posterior(votes)
                if np.abs(old - post).max() < 1e-4:
                    break
        return self

    @staticmethod
    def dependencies(one_hot: np.ndarray, post: np.ndarray, least: float = 0.0) -> np.ndarray:
        """Maximum spanning tree over the mutual information of two votes given the class, of edges with the share ``least`` of what either vote holds."""
        n, m, _ = one_hot.shape
        flat = one_hot.reshape(n, m * 3)
        info, own = np.zeros((m, m)), np.zeros(m)
        for weight in (post, 1 - post):
            joint = ((flat * weight[:, None]).T @ flat / max(weight.sum(), 1e-9)).reshape(m, 3, m, 3) + 1e-9
            one = joint.sum(3)[:, :, 0]
            share = weight.sum() / n
            info += share * (joint * np.log(joint / (one[:, :, None, None] * one[None, None]))).sum((1, 3))
            own -= share * (one * np.log(one)).sum(1)
        info[info < least * np.minimum(own[:, None], own[None, :])] = 0
        parent, best, inside = np.full(m, -1), info[0].copy(), np.zeros(m, dtype=bool)
        source = np.zeros(m, dtype=int)
        inside[0] = True
        for _ in range(m - 1):  # Prim's algorithm
            j = int(np.argmax(np.where(inside, -np.inf, best)))
            parent[j], inside[j] = source[j] if best[j] > 1e-3 else -1, True
            closer = info[j] > best
            best, source = np.where(closer, info[j], best), np.where(closer, j, source)
        return parent

    def estimate(self, one_hot: np.ndarray, post: np.ndarray) -> None:
        """tables[j][class, vote of parent (0 without one), vote]."""
        self.prior = float(np.clip(post.mean(), 0.005, 0.5))
        self.tables = []
        for j, p in enumerate(self.parent):
            given = one_hot[:, p] if p >= 0 else np.ones((len(one_hot), 1))
            table = np.stack([(given * w[:, None]).T @ one_hot[:, j] for w in (1 - post, post)]) + 0.1
            self.tables.append(table / table.sum(2, keepdims=True))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logit = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j, p in enumerate(self.parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), dtype=int)
            logit += np.log(self.tables[j][1, given, votes[:, j]] / self.tables[j][0, given, votes[:, j]])
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def accuracies(self, votes: np.ndarray) -> list[float]:
        """Of each voter: the share of its cast votes that are right, as the model sees it."""
        post = self.posterior(votes)
        right = np.where(votes == 1, post[:, None], 1 - post[:, None]) * (votes > 0)
        return (right.sum(0) / np.maximum(1, (votes > 0).sum(0))).tolist()


def train_linear(row: np.ndarray, col: np.ndarray, target: np.ndarray, features: int, rounds: int = 400, ridge: float = 3e-4, step: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels (Adam, full batch)."""
    n = len(target)
    w = np.zeros(features + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = w[-1] + np.bincount(row, w[col], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target
        g = np.append(np.bincount(col, error[row], minlength=features), error.sum()) / n
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= step * 0.5 ** (4 * t / rounds) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:-1], float(w[-1])


def scaled(z: np.ndarray, toxic: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that make the logits ``z`` fit the labels (Newton's method on two numbers, held near 1 and 0 by ``ridge``)."""
    x = np.stack([z, np.ones(len(z))], axis=1)
    v, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        slope = x.T @ (p - toxic) / len(z) + ridge * (v - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(z) + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        v = v - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(v[0]), 0.01), float(v[1])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, np.ndarray, float]:
    """The lexicon, the weights of its features and patterns, and the bias. Without labels of both classes: nothing is toxic."""
    train = training_rows(docs, labels)
    known = Lexicon(lexicon(train))
    if not known.size:
        known.cuts = [1.0, 1.0, 1.0]
        return known, np.zeros(16), -1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text, feature, stats = known.read(batch.column("text"))
            hits = [feature[text == i] for i in range(batch.num_rows)]
            links = [[]] * (batch.num_rows - 1) + [known.links(batch.column("text")).ravel()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(hits, pa.list_(pa.int64())), pa.array(stats.tolist(), pa.list_(pa.int64())), pa.array(links, pa.list_(pa.int64()))], ["doc_id", "toxic", "hits", "stats", "links"])

    rows = train.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, hits array<long>, stats array<long>, links array<long>").orderBy("doc_id").collect()  # TRAIN_ROWS at most
    known.deal(sorted({pair for r in rows for pair in zip(r.links[::2], r.links[1::2], strict=True)}))
    text = np.repeat(np.arange(len(rows)), [len(r.hits) for r in rows])
    feature = np.array([h for r in rows for h in r.hits], dtype=np.int64)
    stats = np.array([r.stats for r in rows], dtype=np.int64)
    toxic = np.array([r.toxic for r in rows])
    known.calibrate(stats, toxic)
    votes = known.votes(text, feature, known.patterns(stats))
    row, col = known.design(text, feature, stats)
    weights, bias = train_linear(row, col, LabelModel().fit(votes, first=3).posterior(votes), known.size + 16)
    slope, shift = scaled(bias + np.bincount(row, weights[col], minlength=len(rows)), toxic)
    return known, slope * weights, slope * bias + shift


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    ``labels`` (doc_id, toxic) are learnt from where crc32(doc_id as text) mod 5
    is not 0. A score depends on the text alone: equal texts score alike, a null
    or empty text scores as one without features. A null doc_id counts as
    ``null`` in ``held_out``. Several labels of one document count as their
    largest. An empty table gives an empty result; other columns are not read.
    """
    known, weights, bias = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(known.score(batch.column("text"), weights, bias))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return scored.select("doc_id", (F.crc32(key.cast("binary")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose score is under 0.5; no row moves.

    Equal texts stay or go together, whatever their doc_id. A null or empty text scores as one without
    features. Without labels of both kinds every document stays; an empty table stays empty.
    """
    known, weights, bias = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(known.score(batch.column("text"), weights, bias) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """``score_toxicity`` over all ``documents``."""
    small_batches(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
