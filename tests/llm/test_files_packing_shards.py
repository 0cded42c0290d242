import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessella.llm import packing, sharding, token_files

EDGE = [(1, "a b c"), (2, ""), (3, None), (None, "no key"), (5, "same"), (5, "same"), (7, "same"), (9, "word " * 9000), (-4, "é ß 😀"), (12, "see <|endoftext|> here")]


def plain(name, text):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def test_token_files(spark, documents, tmp_path):
    name = "byte_bpe_50k.json"
    token_files.write_token_files(documents(EDGE), str(tmp_path / "t"), public_tokenizers.path(name))
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_files.with_start(token_files.read_token_files(spark, str(tmp_path / "t"))).collect())
    at, want = 0, []
    for i, t in sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain(name, t)
        want.append((at, i, len(ids), ids.tobytes()))
        at += len(ids)
    assert got == want


def test_token_files_single_document(spark, documents, tmp_path):
    rows = [(i, f"word{i} and more words {i * i}") for i in range(300)]
    path = str(tmp_path / "t")
    token_files.write_token_files(documents(rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").head().dictionary)
    assert dictionary
    content = bytes(spark.read.format("binaryFile").load(f"{path}/ids").head().content)
    entry = token_files.read_index(content)[1]
    ids = token_files.read_document(content, entry, dictionary)
    assert ids.tolist() == plain("byte_bpe_50k.json", dict(rows)[int(entry["doc_id"])]).tolist()
    with pytest.raises(ValueError):
        token_files.read_document(content, entry, b"other")


def test_empty_tables(spark, documents, tmp_path):
    none = documents([(1, "x")]).limit(0)
    token_files.write_token_files(none, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert sharding.shard_documents(none).count() == 0


@pytest.mark.parametrize("batch_tokens", [50, 1 << 24])
def test_packing(documents, batch_tokens):
    name = "word_bpe_49k.json"
    rows = EDGE + [(100 + i, "w " * (i * 37 % 300)) for i in range(200)]
    got = packing.pack_documents(documents(rows), public_tokenizers.path(name), window=128, batch_tokens=batch_tokens).collect()
    by_doc, by_window = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 128
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_window.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    for i, t in rows:
        ids = plain(name, t)
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        copies = sum(1 for j, _ in rows if j == i)
        assert sum(r.length for r in pieces) == copies * len(ids)
        if copies == 1:
            assert b"".join(bytes(r.ids) for r in pieces) == ids.tobytes()
            assert all(r.doc_tokens == len(ids) for r in pieces)
            assert [r.start for r in pieces] == [128 * k for k in range(len(pieces))]


def test_padding_does_not_grow_with_partitions(documents):
    rows = [(i, "w " * (i * 37 % 90)) for i in range(300)]
    docs = documents(rows).repartition(30)
    got = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), window=512).collect()
    total, used = sum(r.length for r in got), len({r.sequence_id for r in got})
    assert total == sum(len(plain("word_bpe_49k.json", t)) for _, t in rows)
    assert used <= -(-total // 512) + 1


def test_best_fit_is_tightest():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lengths = rng.integers(1, 65, 80)
        where, offset, used = packing.best_fit_decreasing(lengths, 64)
        rooms, want = [], []
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in rooms if r >= lengths[i]]
            want.append(min(fits) if fits else 64)
            if fits:
                rooms.remove(min(fits))
            rooms.append(want[-1] - lengths[i])
        order = np.argsort(-lengths, kind="stable")
        assert (64 - offset[order]).tolist() == want
        assert used == len(set(where.tolist())) == len(rooms)


def test_shards(spark, documents):
    rows = EDGE + [(1000 + i, f"t{i % 7}") for i in range(2000)]
    got = sharding.shard_documents(documents(rows), rows_per_bucket=20).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 60 < sum(r.grown_shard == 16 for r in got) < 190  # about a 17th
    at = {r.doc_id: r for r in got}
    assert (at[3].size, at[3].text_crc32) == (1, 0)
    assert (at[-4].size, at[-4].text_crc32) == (len("é ß 😀".encode()) + 1, zlib.crc32("é ß 😀".encode()))
    again = {r.doc_id: r.shard for r in sharding.shard_documents(documents([(i, "other") for i, _ in rows]), (1.0,) * 17).collect()}
    assert all(again[r.doc_id] == r.grown_shard for r in got)


def test_weights(spark):
    docs = spark.range(20000).selectExpr("id doc_id", "'x' text")
    count = {r.shard: r["count"] for r in sharding.shard_documents(docs, (1.0, 3.0)).groupBy("shard").count().collect()}
    assert 0.72 < count[1] / 20000 < 0.78


def test_shards_with_a_hot_key(spark, documents):
    rows = [(5, "copy")] * 400 + [(5, f"text {i}") for i in range(400)] + [(i, "x") for i in range(800)]
    got = sharding.shard_documents(documents(rows), weights=(1.0,) * 4, rows_per_bucket=20)
    slots = {}
    for r in got.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == 1600 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_an_id_with_many_texts_fills_many_files(spark, documents, tmp_path):
    rows = [(5, f"text number {i}") for i in range(400)] + [(i, "other") for i in range(200)]
    path = str(tmp_path / "t")
    token_files.write_token_files(documents(rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    got = token_files.with_start(token_files.read_token_files(spark, path)).collect()
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(d for d, _ in rows)
    sizes = [len(token_files.read_index(bytes(r.content))) for r in spark.read.format("binaryFile").load(f"{path}/ids").collect() if r.length]
    assert len(sizes) == 4 and max(sizes) < 300


def test_long_texts_enter_the_dictionary(documents):
    rows = [(i, " ".join(f"very long text of rare words {j % 97}" for j in range(2000))) for i in range(40)]
    assert token_files.train_dictionary(documents(rows), public_tokenizers.path("byte_bpe_50k.json"), longest=4000)
