"""Tree concatenation against encoding each text as a whole."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm import tokens
from quillmesh.llm.tokens import BYTE_BPE_50K, encode_texts, join_encodings, token_bytes, tree_join

PIECES = token_bytes(BYTE_BPE_50K)


def encode(text):
    return encode_texts([text], BYTE_BPE_50K)[0]


def by_tree(text, leaf, window=8):
    bounds = tokens._leaf_bounds(len(text), leaf)
    leaves = [encode(text[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
    if window == 8:
        return tree_join(leaves, encode, PIECES)
    while len(leaves) > 1:
        leaves = [join_encodings(leaves[i], leaves[i + 1], encode, PIECES, window) for i in range(0, len(leaves) - 1, 2)] + leaves[len(leaves) - len(leaves) % 2 :]
    return leaves[0]


def test_bytes_of_tokens_are_exact():
    text = "Åse's  naïve café\n\n漢字 😀 1234 <|endoftext|>"
    assert b"".join(PIECES[t] for t in encode(text)).decode() == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120), st.integers(1, 12), st.sampled_from([1, 2, 8]))
def test_any_text(text, leaf, window):
    assert by_tree(text, leaf, window) == encode(text)


def test_awkward_runs():
    rnd = random.Random(2)
    parts = ["a", "the", "ing", "'s", "'re", "'", "'ll", " ", "  ", "\n", "1", "22", "é", "漢", "😀", "!", "...", "-", "\t", "don't", "'S", " ", "́", "ſ", "\x1c", "’s"]
    for _ in range(1500):
        pool = rnd.sample(parts, rnd.randint(1, 5))
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(2, 50)))
        assert by_tree(text, rnd.choice([1, 2, 5, 16]), rnd.choice([1, 2, 8])) == encode(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, " " * 20_000 + "x", "漢" * 9_000, "'" * 9_000 + "s", "lorem ipsum " * 4_000, "aB3'" * 5_000])
def test_long_unsplit_texts(text):
    assert by_tree(text, 1024) == encode(text)


def test_corpus(spark):
    texts = [(1, "short"), (2, ""), (3, None), (4, " \n"), (5, "x" * 5000), (5, "x" * 5000), (6, "words and 'more' words " * 300), (None, "no id " * 200), (7, "<|endoftext|>")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], "doc_id long, text string, id string, size int")
    got = tokens.encode_corpus(df, leaf_chars=64)
    assert got.columns == ["doc_id", "ids"]
    want = sorted(((i, encode(t) if t else []) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, list(r.ids)) for r in got.collect()), key=repr) == want
    sizes = tokens.encode_corpus(df, leaf_chars=64, sizes_only=True)
    assert sorted((tuple(r) for r in sizes.collect()), key=repr) == sorted(((i, len(x)) for i, x in want), key=repr)
    assert tokens.encode_corpus(df.where("doc_id = 99")).count() == 0
