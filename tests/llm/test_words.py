import random

import numpy as np
import pyarrow as pa
import pytest

from namesake.llm import words
from namesake.llm.words import encoder, library, vocabulary_path

ODD = [
    "", "a\x1fb \x1c c\x85d\xa0e", "Don'T 'LL 12a_ß É ıİ ﬁ Å̊ ́x", "<|ENDOFTEXT|><|endoftext|>x<|startoftext|>", " z　漢 字", "Hello World's 123 x İΣΣ naïve  ok'll", "qxzj漢字テスト🎉🎉 שלום",
    "a\x00b 'S 'LL don'T K Å ﬁ ", "_a_ 9a9", "́x é", "x" * 3000, " \n\t ", "a<b <c ''s 'the x's'", "ŉ ŀ ÀÉÎ×÷", "word.... (word) word,,, 'tis 't", "\x1cab",
]


def check(e, tok, texts):
    ids, counts = e.batch(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends, strict=True):
        assert ids[end - n : end].tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_batches_are_the_library_s():
    path = vocabulary_path()
    tok, rng = library(path), random.Random(1)
    made = ["".join(rng.choice("abcqxz'0 <|é漢ßǼ.stǅ") for _ in range(rng.randrange(60))) for _ in range(600)]
    e = encoder(path)
    check(e, tok, ODD + made)
    check(e, tok, made[::-1])  # remembered by now
    assert e.batch(pa.array([], pa.string()))[0].tolist() == []


def test_slices_keep_rows_in_order():
    texts = pa.array(["ab " * n for n in (0, 1, 5, 400, 2, 0, 3)])
    assert list(words.slices(texts, 20)) == [(0, 3), (3, 1), (4, 3)]
    assert list(words.slices(texts.slice(2), 20)) == [(0, 1), (1, 1), (2, 3)]
    assert sum(n for _, n in words.slices(texts, 1)) == len(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_only_the_proven_file_goes_by_words(name):
    assert words.by_words(vocabulary_path()) and not words.by_words(vocabulary_path(name))
    assert isinstance(encoder(vocabulary_path(name)), words.TextEncoder)


def test_memory_is_bounded_in_bytes():
    """20 MB of unbroken text in many words: long ones are not remembered, and two generations hold what is allowed."""
    made = words.Remembered(lambda k: b"x" * len(k), limit=100_000)
    for i in range(5000):
        assert made.all([f"k{i}"]) == [b"x" * len(f"k{i}")]
    made.all(["y" * 20_000_000])
    held = sum(words.ENTRY_BYTES + len(k) + len(v) for g in (made.young, made.old) for k, v in g.items())
    assert held <= 200_000 and len(made.young) + len(made.old) > 300


def test_long_unbroken_text():
    e = encoder(vocabulary_path())
    text = "ab1" * 1_000_000
    ids, counts = e.batch(pa.array([text, "漢" * 100_000], pa.string()))
    assert counts[0] == 2_000_000 and len(ids) == counts.sum() and max(map(len, [*e.odd.young, *e.piece.young])) <= words.LONGEST


def test_new_pieces_pass_the_library_together():
    """Thousands of new words take few calls of the library, none for a single word, and what is held stays bounded."""
    path, rng = vocabulary_path(), random.Random(2)
    tok, calls = library(path), []
    e = words.WordEncoder(lambda s: tok.encode(s, add_special_tokens=False).ids, lambda p: calls.append(p) or [t.id for t in tok.model.tokenize(p)], "<u2", words.many_pieces(tok))
    e.known.limit = 600_000
    made = ["".join(rng.choice("abcdefghéàœß") for _ in range(rng.randrange(1, 80))) + rng.choice(["", ".", ",", "!'\"", "#~"]) for _ in range(9000)]
    for at in range(0, 9000, 1500):
        check(e, tok, [" ".join(made[max(0, at - 500) : at + 1500])])
        assert e.known.held() <= 600_000 and max(map(len, e.known.keys.to_pylist()), default=0) <= words.LONGEST
    assert all(len(p) > words.LONGEST // 2 for p in calls)
    assert len(e.known.keys) > 300


def test_pieces_one_by_one_where_ends_are_not_marked():
    """Where the numbers of pre-tokens and of ends differ, each goes to the library alone."""
    tok = library(vocabulary_path())
    e = words.WordEncoder(lambda s: tok.encode(s, add_special_tokens=False).ids, lambda p: [t.id for t in tok.model.tokenize(p)], "<u2", lambda pieces: None)
    check(e, tok, ODD)
    check(e, tok, ODD[::-1])
