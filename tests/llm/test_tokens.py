import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessella.llm import tokens
from tessella.llm.tokens import ChunkEncoder

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PLAIN = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in NAMES}
CHUNKED = {n: ChunkEncoder(public_tokenizers.path(n)) for n in NAMES}

def check(name, texts):
    plain = [PLAIN[name].encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in CHUNKED[name].encode(texts)] == plain


@pytest.mark.parametrize("name", NAMES)
def test_edge_texts(name):
    check(name, ["", " ", "  a", "a  b", "a   b ", "a \n b", "it's  we'll", " a", "\0 a", "a \0b", "a  b", "a  b", "x 　y", "<|endoftext|> <|startoftext|>", "a\r\n\r\n b", "ΑΣ ΣΑΣ", "é ́e", "😀 😀😀", "w" * 300 + " " + "w" * 300, "a \x1cb", "a\x85 b"])


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("ab'st.1! \n\t\0\x1c\x85 　éß😀Σ́<|>")), max_size=30), max_size=5))
def test_like_plain_encoding(name, texts):
    check(name, texts)


@pytest.mark.parametrize("name", NAMES)
def test_words_that_a_plain_polynomial_confuses(name):
    word = "a"
    for _ in range(11):  # Thue and Morse's sequence and its complement
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    for texts in ([word, other], [other, word], [f"{word} {other}", other]):
        check(name, texts)


@pytest.mark.parametrize("name", NAMES)
def test_pieces_with_one_hash_keep_their_own_ids(name, monkeypatch):
    monkeypatch.setattr(tokens, "hash_stretches", lambda data, begin, end: ((end - begin) % 3).astype(np.uint64))
    own, plain = ChunkEncoder(public_tokenizers.path(name)), PLAIN[name]
    for texts in (["one two six", "six two ten ten"], ["a bb ccc dddd", "two"], ["x" * 70 + " " + "y" * 70 + " " + "x" * 70, "", "one"]):
        assert [x.tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_as_text():
    name, text = NAMES[0], "see <|endoftext|> here"
    assert 50256 in CHUNKED[name].encode([text])[0].tolist()
    assert 50256 not in ChunkEncoder(public_tokenizers.path(name), special_as_text=True).encode([text])[0].tolist()
