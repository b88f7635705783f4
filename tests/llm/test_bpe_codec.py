import random
from hashlib import sha256

import pytest

from namesake.llm import bpe_codec as bc
from namesake.llm.words import library, vocabulary_path

from .conftest import ROWS

ODD = ["", "Hello World's 123 <|endoftext|>x İΣΣ naïve  ok'll", "qxzj漢字テスト🎉🎉 שלום", "a\x00b 'S 'LL don'T K Å ﬁ ", "_a_ 9a9 a\x1fb", "<|startoftext|><|endoftext|><|endoftext", "́x é", "x" * 3000, " \n\t "]


@pytest.fixture(scope="module")
def tok():
    return library(vocabulary_path())


def test_as_the_library(tok):
    c = bc.codec(vocabulary_path())
    rng = random.Random(1)
    made = ["".join(rng.choice("abcqxz'0 <|é漢ßǼ.") for _ in range(rng.randrange(60))) for _ in range(400)]
    for text in ODD + made:
        ids = tok.encode(text, add_special_tokens=False).ids
        assert c.encode(text).tolist() == ids, text
        assert c.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_cuts_are_pairs_that_no_token_holds():
    inside = bc.forced_pairs(["ab", "bc</w>", "d"], "</w>")
    assert inside == {"ab", "bc"}
    assert bc.fragments("abcdab", inside) == ["abc", "d", "ab"] and bc.fragments("a", inside) == ["a"]


def test_operators(docs, empty, tok):
    encoded = bc.encode_documents(docs)
    want = sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids) for i, t, _ in ROWS)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded.collect()) == want
    decoded = sorted((str(r["doc_id"]), r["text"]) for r in bc.decode_documents(encoded).collect())
    assert decoded == sorted((i, tok.decode(ids, skip_special_tokens=False)) for i, ids in want)
    digests = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bc.round_trip_digests(docs).collect())
    hexed = lambda s: sha256(s.encode()).hexdigest()
    assert digests == sorted((i, len(ids), hexed(" ".join(map(str, ids))), hexed(tok.decode(ids, skip_special_tokens=False))) for i, ids in want)
    assert bc.round_trip_digests(empty).count() == bc.encode_documents(empty).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bc.Codec(vocabulary_path("byte_bpe_50k.json"))
