import random

import numpy as np
import pytest

from namesake.llm import token_counts as tc
from namesake.llm.words import library, vocabulary_path

from .conftest import ROWS, table

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]
ODD = ["", " ", "x" * 500, "ab " * 300, "y" * 200 + " " + "z" * 200, " " * 500, ("w" * 90 + " ") * 5, "<|endoftext|>" * 30, "é漢 \x85\xa0　" * 60, "a  b   c\n\n d\t e" * 40, "don't 'll it's " * 40]


@pytest.fixture(scope="module", params=FILES)
def file(request):
    path = vocabulary_path(request.param)
    if request.param.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return path, tc.chunk_encoder(path), lambda s: len(sp.encode(s))
    tok = library(path)
    return path, tc.chunk_encoder(path), lambda s: len(tok.encode(s, add_special_tokens=False).ids)


def test_spliced_counts(file):
    path, encode, whole = file
    assert tc.stable_boundaries(path)
    for text in ODD:
        assert tc.count_tokens(text, encode, 64, 8) == whole(text), text


def test_random_texts(file):
    _, encode, whole = file
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("abc'.0 \n é漢s  ") for _ in range(rng.randrange(600)))
        chunk = rng.randrange(8, 100)
        assert tc.count_tokens(text, encode, chunk, rng.randrange(1, 8)) == whole(text), (text, chunk)


def test_prose_is_spliced_without_growing(file):
    _, encode, whole = file
    sizes = []
    text = " ".join(f"Some words of prose, number {i};" for i in range(4000))
    got = tc.count_tokens(text, lambda s: sizes.append(len(s)) or encode(s), 4096, 64)
    assert got == whole(text) and max(sizes) <= 4096 and sum(sizes) < 1.1 * len(text)


def test_splice_needs_agreement():
    text = "abcd efgh ijkl mnop qrst"
    tokens = lambda ids, starts, ends: tuple(np.array(x) for x in (ids, starts, ends))
    left = tokens([1, 2, 3, 4], [0, 4, 9, 14], [4, 9, 14, 19])
    right = tokens([9, 2, 3, 4, 5], [2, 4, 9, 14, 19], [4, 9, 14, 19, 24])
    assert tc.splice(text, left, right, 2, 19) == (2, 2)
    other = tokens([9, 2, 7, 8, 5], [2, 4, 9, 14, 19], [4, 9, 14, 19, 24])
    assert tc.splice(text, left, other, 2, 19) == (1, 1)
    crossing = tokens([9, 3, 4, 5], [2, 9, 14, 19], [10, 14, 19, 24])
    assert tc.splice(text, left, crossing, 2, 15) is None


def test_operator(docs, empty):
    tok = library(vocabulary_path())
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tc.token_counts(docs).collect())
    n = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted((str(i), len((t or "").encode()), n(t), n(t) > 2048) for i, t, _ in ROWS)
    assert tc.token_counts(empty).count() == 0


def test_other_vocabularies(file, docs):
    path, _, whole = file
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in tc.token_counts(docs, path=path).collect())
    assert got == sorted((str(i), whole(t or "")) for i, t, _ in ROWS)


def test_long_unbroken_text(spark):
    """One word of 300,000 letters, and prose behind it: the chunk grows over the word and is spliced after it."""
    text = "".join(random.Random(5).choice("abcdefgh") for _ in range(300_000)) + " and then some words" * 4000
    want = len(library(vocabulary_path()).encode(text, add_special_tokens=False).ids)
    assert [r["n_tokens"] for r in tc.token_counts(table(spark, [(1, text, "a"), (2, "b", "a")])).orderBy("doc_id").collect()] == [want, 1]
