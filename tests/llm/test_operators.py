import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests.llm import brute

from tessella.llm import chat, decontaminate, importance, jaccard_join, spotsigs, toxicity, warc

EDGE = [(1, "a b c"), (2, ""), (3, None), (None, "no key"), (5, "same text here is it"), (5, "same text here is it"), (7, "same text here is it"), (9, "word " * 9000), (-4, "é ß 😀"), (11, " \n\t")]


def prose(rng, n, size=400):
    return [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in rng.integers(0, size, n)]


# n-gram Jaccard join


def copies(seed):
    """Texts of every length with copies edited a little or a lot, and a passage that many share."""
    rng = np.random.default_rng(seed)
    rows, passage = [], prose(rng, 40, 10**6)
    for n in (1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 70, 120, 300):
        base = prose(rng, n, 10**6)
        for _ in range(12):
            t = list(base)
            for _ in range(rng.integers(0, max(2, n // 12))):
                t[rng.integers(0, len(t))] = f"x{rng.integers(0, 9)}"
            if rng.random() < 0.3:
                t = t + passage
            rows.append(" ".join(t).upper() if rng.random() < 0.2 else "  ".join(t))
    order = rng.permutation(len(rows))
    return [(int(i) * 3 + 1, rows[j]) for i, j in enumerate(order)] + EDGE


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_components(documents, seed):
    rows = copies(seed)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(rows)).collect()), key=str)
    assert got == sorted(brute.jaccard_components(rows), key=str)


@pytest.mark.parametrize("boundary", [0, 5, 12, 64])
def test_jaccard_boundary_changes_nothing(documents, boundary, monkeypatch):
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *a: boundary)
    rows = copies(7)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(rows)).collect()), key=str)
    assert got == sorted(brute.jaccard_components(rows), key=str)


def plain_links(rows):
    """Links between different sets, as pairs of frozen sets."""
    sets = list({frozenset(brute.shingles(t)) for _, t in rows} - {frozenset()})
    return [(a, b) for i, a in enumerate(sets) for b in sets[:i] if a & b and 4 * len(a & b) >= 3 * len(a | b)]


@pytest.mark.parametrize("block", [3, 1000])
def test_jaccard_all_links(documents, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows = copies(8)
    links, want = plain_links(rows), {}
    for a, b in links:
        want[a], want[b] = want.get(a, 0) + 1, want.get(b, 0) + 1
    expected = sorted(((d, want.get(frozenset(brute.shingles(t)), 0)) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_links) for r in jaccard_join.jaccard_components(documents(rows)).collect()), key=str) == expected
    pairs = [(r.a, r.b) for r in jaccard_join.jaccard_pairs(documents(rows))[1].collect()]
    assert len(set(pairs)) == len(pairs) == len(links) > 0 and all(a < b for a, b in pairs)


def test_common_counts():
    rng = np.random.default_rng(13)
    for n, m, size in ((1, 1, 50), (3, 90, 300), (40, 30, 5000), (60, 60, 70)):
        a, b = ([np.unique(rng.integers(0, size, rng.integers(1, 60))) for _ in range(k)] for k in (n, m))
        assert jaccard_join.common_counts(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]


def test_no_member_goes_that_a_middle_size_lets_link(documents, monkeypatch):
    """The set of 10 has one key with the set of 11; with sets of 10 or 12 it would need two."""
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *a: 0)
    shared = " ".join(f"s{c}" for c in "abcdefghi")
    rows = [(1, f"{shared} a"), (2, f"ya yb {shared}"), (3, f"ya yb z {shared}"), (4, "z")]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(documents(rows), words=1).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_jaccard_empty(documents):
    assert jaccard_join.jaccard_components(documents([(1, "a")]).limit(0)).count() == 0


def test_one_of_each(documents):
    rows = copies(4)
    kept = jaccard_join.one_of_each(documents(rows)).collect()
    want = {c for d, n, c in brute.jaccard_components(rows) if d is not None and d == c}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in kept) == sum(d is None for d, _ in rows)


def test_one_row_of_each(spark, documents):
    import corpus_pipeline

    rng = np.random.default_rng(17)
    a, b, c, d = (" ".join(prose(rng, 40, 10**6)) for _ in range(4))
    # an id with texts of its own, ids that lead one component and follow in another, copies without an id, rows without words
    rows = [(1, a), (1, b), (1, a), (2, b), (2, c), (3, c.upper()), (None, d), (None, d), (None, d + " more"), (None, a), (7, ""), (7, ""), (None, None)]
    kept = [(r.doc_id, (r.text or "").lower()) for r in corpus_pipeline.near_duplicates(spark, documents(rows), "").collect()]
    assert sum(k == (None, "") for k in kept) == 1 and kept.count((7, "")) == 2
    kept = sorted((k for k in kept if k[1]), key=str)
    assert [k for k in kept if k[0] is not None] == sorted([(1, a), (1, b), (2, c)])
    assert len(kept) == 4 and kept[-1][0] is None and kept[-1][1] in (d, d + " more")


def test_keys_needed_never_exceeds_what_linked_sets_share():
    rng = np.random.default_rng(5)
    level = np.zeros(jaccard_join.CELLS, np.uint8)
    for _ in range(400):
        n = int(rng.integers(2, 90))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, n // 5 + 1)))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 5)))).astype(np.uint64)]))
        both = np.intersect1d(a, b).size
        if not len(a) or not len(b) or not jaccard_join.similar(both, len(a), len(b), (3, 4)) or (a.size == b.size == both):
            continue
        for boundary in (0, 10, 64):
            (x, _), (y, _) = (jaccard_join.keys_of(s, level, boundary, (3, 4)) for s in (a, b))
            assert np.intersect1d(x, y).size >= jaccard_join.keys_needed(len(a), len(b), boundary, (3, 4)) >= 1


# chat formatting


SAID = ["<|im_end|>", "<\\|x", "<<|im_sep|>>", "line\nbreak", "", None, "😀 é", "a < b | c", "<|endoftext|>"]


def test_escape_is_reversible():
    for t in SAID:
        assert chat.unescape(chat.escape(t)) == (t or "") and "<|" not in chat.escape(t)


@pytest.mark.parametrize("longest", [1, 1 << 20])
def test_chat_round_trip(spark, longest):
    rows = [(c, i, r, t) for c in (1, 2, None) for i, (r, t) in enumerate(zip(["user", "assistant", None, "assistant", "sys\n<|im_sep|>", "assistant", "assistant", "user", "assistant"], SAID, strict=True))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string").repartition(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, path, longest), path).collect()}
    assert len(got) == 3
    for c in (1, 2, None):
        turns = [(r or "", t or "") for k, _, r, t in rows if k == c]
        learnt = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(learnt)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert got[c].formatted_chars == len(chat.render(turns)[0])


def test_offset_mask():
    offsets = np.array([[0, 2], [2, 5], [5, 6], [6, 6], [6, 9]])
    assert chat.offset_mask(offsets, [(2, 5), (8, 9)]).tolist() == [0, 1, 0, 0, 1]
    assert chat.offset_mask(offsets, []).tolist() == [0] * 5


# WARC


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_warc_round_trip(spark, tmp_path, chunk):
    rows = [(1, "http://a b", "same"), (2, "u", "same"), (4, "v", "same"), (3, None, None), (5, "w", ""), (6, "x", "é" * 50 + "\r\n\r\nWARC/1.1\r\n"), (7, "y\r\nz", "line\n" * 30), (None, "n", "same"), (8, "r", "twice " * 5), (8, "r", "twice " * 5)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), chunk)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    last = {}
    for p, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if p is None else p)
    for p, _, h in rows:
        body = (h or "").encode()
        for r in by[p]:
            assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
            keeper = last[h or ""] == p
            assert r.record_type == ("response" if keeper else "revisit") and r.refers_to == (None if keeper else last[h or ""])


def test_warc_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert not list((tmp_path / "w").glob("*.txt")) or warc.read_archives(spark, str(tmp_path / "w")).count() == 0


# SpotSigs


def test_fingerprints(documents):
    rng = np.random.default_rng(2)
    rows = [*EDGE, *((100 + i, "the " + " of the ".join(prose(rng, 60)) + "!") for i in range(40))]
    got = sorted(spotsigs.fingerprints(documents(rows)).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for i, (d, _) in enumerate(order):
        t, f = texts[i], texts[(i + 1) % len(texts)]
        cut = len(t) // 4
        want.append((d, len(t), hashlib.sha256((t[: len(t) - cut] + f[:cut]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id and r.doc_id >= 100:
            assert r.near_edited > 0.4 and r.near_next < 0.3
    for r in got:
        by_text.setdefault(dict((d, t or "") for d, t in order)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprints_in_blocks(documents, monkeypatch):
    rows = [(i, f"text {i} the end of it {i * i}") for i in range(200)]
    one = {r.doc_id: r for r in spotsigs.fingerprints(documents(rows)).collect()}
    real = spotsigs.ordered_blocks
    monkeypatch.setattr(spotsigs, "ordered_blocks", lambda d, rows=7: real(d, 7))
    many = {r.doc_id: r for r in spotsigs.fingerprints(documents(rows)).collect()}
    assert one == many


def test_signatures_follow_anchors():
    column = pa.array(["The cat of sat mat. the of dog ran", "cat sat"])
    sets = spotsigs.signature_sets(column)
    assert len(sets[0]) == 4 and len(sets[1]) == 1
    assert spotsigs.signatures_of(spotsigs.fingerprint(sets[0])).tolist() == sets[0].tolist()
    assert spotsigs.likeness(sets[0], sets[0]) == 1 and spotsigs.likeness(np.zeros(0), sets[0]) == 0 and spotsigs.likeness(np.zeros(0), np.zeros(0)) == 1


def test_similar_documents(spark, documents):
    rng = np.random.default_rng(8)
    base = ["the " + " the ".join(prose(rng, 40, 10**6)) for _ in range(15)]
    rows = []
    for b in base:
        words = b.split()
        rows += [b, " ".join(words[: int(len(words) * 0.9)]), " ".join(words[: int(len(words) * 0.5)])]
    prints = spotsigs.fingerprints(documents(list(enumerate(rows)))).select("doc_id", "fingerprint").cache()
    sets = {r.doc_id: spotsigs.signatures_of(r.fingerprint) for r in prints.collect()}
    want = {(a, b) for a in sets for b in sets if a < b and spotsigs.likeness(sets[a], sets[b]) >= 0.75}
    assert {(r.a, r.b) for r in spotsigs.similar_documents(prints).collect()} == want and want


# toxicity


def toxic_rows(n=1200, seed=3):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words, bad = prose(rng, int(rng.integers(20, 200))), rng.random() < 0.15
        if bad:
            for _ in range(3 + len(words) // 30):
                words[rng.integers(0, len(words))] = str(rng.choice(["Idiot", "scum", "moron", "zarkel" + "abcdefgh"[int(rng.integers(0, 8))]]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents):
    rows, labels = toxic_rows()
    flipped = [(d, 1 - t if __import__("zlib").crc32(str(d).encode()) % 5 == 0 else t, 1) for d, t in labels]  # held-out labels must not matter
    df = spark.createDataFrame(flipped, "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents(rows + [(None, None), (-1, "")]), df).collect()}
    truth = dict(labels)
    held = [d for d in truth if got[d].held_out]
    assert 150 < len(held) < 350 and all(got[d].held_out == (__import__("zlib").crc32(str(d).encode()) % 5 == 0) for d in truth)
    assert np.mean([got[d].predicted == truth[d] for d in held]) > 0.97
    assert got[None].predicted == got[-1].predicted == 0 and 0 <= got[-1].score <= 1
    kept = {r.doc_id for r in toxicity.clean_documents(documents(rows), df).collect()}
    assert kept == {d for d in truth if not got[d].predicted}


def test_toxicity_without_labels(spark, documents):
    df = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_toxicity(documents(EDGE), df).collect()} == {0}
    assert toxicity.score_toxicity(documents(EDGE).limit(0), df).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    good, poor = [0.95, 0.9, 0.9, 0.85], 0.6
    votes = np.stack([np.where(rng.random(4000) < a, y, ~y) for a in [*good, poor]] + [y & False], axis=1)
    votes[:, -1] = votes[:, 0]  # a copy of the first voter
    cast = np.where(votes, 1, 2).astype(np.int8)
    model = toxicity.LabelModel().fit(cast)
    assert ((model.posterior(cast) >= 0.5) == y).mean() > 0.94
    assert model.parent[5] == 0 or model.parent[0] == 5
    for got, truth in zip(model.accuracies(cast), [*good, poor, good[0]], strict=True):
        assert abs(got - truth) < 0.03
    other = [p for j, p in enumerate(model.parent) if j not in (0, 5)]
    joint = [abs(model.tables[j][1, 1, 1] - model.tables[j][1, 2, 1]) for j, p in enumerate(model.parent) if p >= 0 and {j, p} != {0, 5}]
    assert len(other) == 4 and all(x < 0.2 for x in joint)  # independent voters hardly depend on their parents


def test_expectation_maximisation_climbs():
    """The likelihood that the E step takes never falls in a round, abstentions included."""
    rng = np.random.default_rng(4)
    y = rng.random(2000) < 0.3
    votes = np.stack([np.where(rng.random(2000) < 0.4, 0, np.where(rng.random(2000) < a, 1 + ~y, 1 + y)) for a in (0.9, 0.8, 0.85, 0.7)], axis=1).astype(np.int8)
    one_hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    model, post, last = toxicity.LabelModel(), np.clip((votes == 1).mean(1), 0.1, 0.9), -np.inf
    model.parent = np.array([-1, 0, 0, 1])
    for _ in range(20):
        model.estimate(one_hot, post)
        log = np.log([[1 - model.prior], [model.prior]]) + sum(np.log(model.tables[j][:, votes[:, p] if p >= 0 else np.zeros(2000, int), votes[:, j]]) for j, p in enumerate(model.parent))
        now = np.logaddexp(*log).sum()
        assert now >= last - 1.0  # up to the pseudo-counts
        last, post = now, model.posterior(votes)
        assert np.allclose(post, np.exp(log[1] - np.logaddexp(*log)))


# importance resampling


def test_importance_keeps_the_good(spark, documents):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(prose(rng, 60)) if i % 5 else " ".join(f"{w}!!" for w in prose(rng, 60)).upper()) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    got = {r.doc_id for r in importance.resample(documents([*rows, (None, "x")]), labels).collect()}
    assert {i for i, _ in rows if i % 5} <= got and not {i for i, _ in rows if i % 5 == 0} & got
    assert {r.doc_id for r in importance.kept_documents(documents(rows), labels).collect()} == got - {None}


def test_weights_like_plain_counts(spark, documents):
    """log_weight equals what plain counting of hashed unigrams and bigrams gives, at every length."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(prose(rng, int(n), 60)) + ("!" if n % 2 else " Ok, done.")) for i, n in enumerate([0, 1, 2, 5, 30, 200, 3000] * 6)] + [(None, "x y"), (900, None)]
    quality = [(i, i % 3 % 2, 0) for i in range(40)]
    labels = spark.createDataFrame(quality, "doc_id long, quality int, toxic int")

    def grams(text):
        bucket, doc = importance.hashed_grams(pa.array([text], pa.string()))
        tokens = re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]+", text or "")
        assert len(bucket) == len(tokens) + max(0, len(tokens) - 1)
        return bucket.tolist()

    raw, good = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for d, t in rows:
        for g in grams(t):
            raw[g] += 1
            good[g] += d is not None and d < 40 and quality[d][1] == 1 and not importance.calibrates(d)
    expected = raw * good.sum() / raw.sum()
    ratio = np.log((good + importance.SMOOTHING) / (expected + importance.SMOOTHING))
    for evidence in (importance.EVIDENCE, float("inf")):
        got = {(r.doc_id): (r.log_weight, r.gumbel_key) for r in importance.importance(documents(rows), labels, temperature=0.0, evidence=evidence).collect()}
        for d, t in rows:
            own = grams(t)
            assert abs(got[d][0] - ratio[own].sum() / (1 + len(own) / evidence)) < 1e-6 and got[d][0] == got[d][1]


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(0, 1, 30_000), np.full(500, 0.25)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "doc_id long, gumbel_key double")
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    for k in (0, 1, 10, 12_000, 12_300, len(values), len(values) + 5):
        assert {r.doc_id for r in importance.top_k(df, k).collect()} == set(order[:k])


def test_gumbel_top_k_samples_in_proportion(spark):
    keys = importance.gumbel(list(range(20000)), pa.array([""] * 20000), 17)
    assert abs(keys.mean() - 0.5772) < 0.03 and abs(keys.var() - np.pi**2 / 6) < 0.08


def test_importance_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.resample(documents(EDGE), none).count() == len(EDGE)
    assert importance.resample(documents(EDGE).limit(0), none).count() == 0


# decontamination


def plain_smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * len(a))


def test_smith_waterman():
    rng = np.random.default_rng(9)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 15)).astype(np.uint64), rng.integers(0, 5, rng.integers(0, 25)).astype(np.uint64)
        assert decontaminate.smith_waterman(a, b)[0] == pytest.approx(plain_smith_waterman(a, b))


def test_contaminations(spark, documents):
    rng = np.random.default_rng(10)
    items = [" ".join(prose(rng, 40, 10**6)) for _ in range(30)] + ["one two", None]
    def changed(text, every):
        w = text.split()
        return " ".join("new" if i % every == 0 else x for i, x in enumerate(w))
    rows, want = [], set()
    for i in range(300):
        filler = prose(rng, 80, 10**6)
        if i % 3 == 0:
            j = int(rng.integers(0, 30))
            passage = [items[j], items[j].upper() + ".", changed(items[j], 5), changed(items[j], 4)][i % 4]
            filler[40:40] = passage.split()
            want.add((i, j))
        rows.append((i, " ".join(filler)))
    bench = spark.createDataFrame([(j, t, "en") for j, t in enumerate(items)], "item_id long, text string, lang string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(documents(rows + EDGE), bench).collect()}
    assert got == want
    kept = {r.doc_id for r in decontaminate.clean_documents(documents(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in want}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminations(documents(rows), empty).count() == 0
    assert decontaminate.clean_documents(documents(rows).limit(0), bench).count() == 0


def test_large_family_of_an_edited_item(spark, documents):
    rng = np.random.default_rng(21)
    item = prose(rng, 40, 10**6)
    edited = ["new" if i % 5 == 0 else w for i, w in enumerate(item)]
    rows = [(i, " ".join(prose(rng, 30, 10**6) + edited + prose(rng, 30, 10**6))) for i in range(60)]
    rows += [(100 + i, " ".join(prose(rng, 60, 10**6))) for i in range(20)]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contaminations(documents(rows), bench).collect()) == list(range(60))
    assert {r.doc_id for r in decontaminate.clean_documents(documents(rows), bench).collect()} == set(range(100, 120))


@pytest.mark.parametrize("vocabulary", [12, 60, 10**6])
def test_contaminations_like_exhaustive_alignment(spark, documents, vocabulary):
    """Every document against every item, word by word: what no 3-gram survives in is found too."""
    rng = np.random.default_rng(vocabulary)
    items = [prose(rng, int(n), vocabulary) for n in (3, 4, 5, 9, 16, 25, 40)]
    rows = []
    for i in range(60):
        item = items[i % len(items)]
        kind = i // len(items) % 5
        if kind == 0:  # every third word changed: half a match
            own = ["new" if k % 3 == 2 else w for k, w in enumerate(item)]
        elif kind == 1:  # a word between every two
            own = [x for w in item for x in (w, "and")][:-1]
        elif kind == 2:  # words left out
            own = [w for w in item if rng.random() < 0.7]
        elif kind == 3:
            own = [w for w in item if rng.random() < 0.9 for w in ([w, "more"] if rng.random() < 0.2 else [w])]
        else:
            own = prose(rng, 30, vocabulary)
        rows.append((i, " ".join(prose(rng, int(rng.integers(0, 20)), vocabulary) + own + prose(rng, int(rng.integers(0, 20)), vocabulary))))
    bench = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")
    want = {(d, j) for d, t in rows for j, item in enumerate(items) if plain_smith_waterman(item, t.split()) >= 0.5}
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminations(documents(rows), bench).collect()}
    assert set(got) == want and len(want) > 20
    for (d, j), score in got.items():
        assert score == pytest.approx(plain_smith_waterman(items[j], rows[d][1].split()))


def test_items_shorter_than_a_seed(spark, documents):
    rows = [(1, "some words before alpha beta and after"), (2, "alpha"), (3, "a long text with Gamma in it"), (4, "beta alpha is another order"), (5, "Alpha, beta!"), (6, "ends with alpha"), (7, "beta begins"), (8, "gamma gamma")]
    bench = spark.createDataFrame([(0, "alpha beta"), (1, "gamma"), (2, "one item of more words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in decontaminate.contaminations(documents(rows), bench).collect()}
    assert got == {(1, 0, 1.0), (5, 0, 1.0), (3, 1, 1.0), (8, 1, 1.0)}
    assert {r.doc_id for r in decontaminate.clean_documents(documents(rows), bench).collect()} == {2, 4, 6, 7}


def test_item_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    texts = [" ".join(prose(np.random.default_rng(j), 10, 10**6)) for j in range(20)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(j, f"before it all {t} and after") for j, t in enumerate(texts)]
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminations(documents(rows), bench).collect()} == {(j, j) for j in range(20)}


def test_pipeline_on_small_tables(spark, tmp_path):
    import corpus_pipeline

    rows, labels = toxic_rows(400, 11)
    rng = np.random.default_rng(12)
    item = " ".join(prose(rng, 40, 10**6))
    rows += [(1000, rows[0][1]), (1001, rows[1][1] + " more"), (1002, item + " " + rows[3][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, t) for d, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept, truth = {r.doc_id for r in pieces}, dict(labels)
    clean = {d for d in truth if not truth[d]}
    assert len(clean - kept) <= 0.03 * len(clean) and not {1000, 1001, 1002} & kept
    assert len({d for d in truth if truth[d]} & kept) <= 2
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert re.match("packing", corpus_pipeline.STAGES[-1][0])


def test_llm_queries_against_sql(spark):
    from tests import oracle

    from tessella.llm import registry

    con = oracle.connect("/root/testdata/sf0.001")
    for name, sql in registry.oracle_sql().items():
        assert oracle.differences(spark, con, registry.queries()[name], sql, "/root/testdata/sf0.001") == "", name


# one key on a third of all rows


def test_labelled_rows_are_bounded_whatever_an_id_repeats(spark, documents, monkeypatch):
    rows, labels = toxic_rows(300, 5)
    hot = next(d for d, t in labels if t and __import__("zlib").crc32(str(d).encode()) % 5)
    df = spark.createDataFrame(labels, "doc_id long, toxic int")
    many = documents(rows + [(hot, f"{rows[hot][1]} {i}") for i in range(150)])
    train = toxicity.training_rows(many, df)
    assert train.count() == train.select("doc_id").distinct().count() <= 300
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(many, df).collect()}
    assert sum(got[d] != t for d, t in labels) <= 3


def test_tied_rows_of_one_key_are_counted(spark, documents):
    df = spark.createDataFrame([(7, 0.5, 1.0)] * 60 + [(100 + i, 0.5, 2.0) for i in range(20)] + [(8, 0.5, 1.0)] * 5 + [(9, 0.5, 0.0)], "doc_id long, log_weight double, gumbel_key double")
    got = [r.doc_id for r in importance.top_k(df, 63).collect()]
    assert len(got) == 63 and got.count(7) == 43 and got.count(8) == 0
    assert importance.top_k(df, 84).count() == 84


def test_near_duplicates_with_clashing_columns(spark):
    import corpus_pipeline

    names = ["own_sid", "marked_id", "MARKED_SID", "stays", "key", "row", "lead"]
    text = " ".join(prose(np.random.default_rng(1), 40, 10**6))
    docs = spark.createDataFrame([(i, text, *names) for i in (3, 1, 1)] + [(5, "other", *names)], f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_fingerprints_of_one_id_are_dealt_to_blocks(documents):
    rows = [(5, f"the word {i} of it {i * i} is here") for i in range(300)] + [(i, f"the text {i} of others") for i in range(10, 310)]
    blocks = spotsigs.ordered_blocks(documents(rows), 20).collect()
    sizes = {}
    for r in blocks:
        sizes[r.block] = sizes.get(r.block, 0) + 1
    assert sum(r.own for r in blocks) == 600 and len(blocks) - 600 == len(sizes) > 20 and max(sizes.values()) < 90
    got = spotsigs.with_neighbours(documents(rows), 20).collect()
    follow = {(r.doc_id, r.text): r.next_text for r in got}
    assert len(got) == len(follow) == 600 and len(set(follow.values())) == 600
    at, seen = rows[0][1], 0
    while seen < 600:  # one circle through all texts
        at, seen = next(v for (d, t), v in follow.items() if t == at), seen + 1
    assert at == rows[0][1]
    assert all(follow[i, t] == f"the text {i + 1} of others" for i, t in rows[300:-1])
