import random

import pytest

from namesake.llm import winnowing as w

from .conftest import ROWS


def brute(text, k, window):
    codes = [ord(c) for c in text]
    if not codes:
        return []
    k = min(k, len(codes))
    grams = []
    for i in range(len(codes) - k + 1):
        h = 0
        for c in codes[i : i + k]:
            h = (h * int(w.BASE) + c + 1) % 2**64
        h ^= h >> 29
        grams.append((h * 0xBF58476D1CE4E5B9 % 2**64) >> 32)
    window = min(window, len(grams))
    out = []
    for i in range(len(grams) - window + 1):
        low = min(grams[i : i + window])
        at = max(j for j in range(i, i + window) if grams[j] == low)
        if not out or out[-1] != (low, at):
            out.append((low, at))
    return out


@pytest.mark.parametrize("size", [0, 1, 4, 5, 12, 13, 90, 400])
def test_brute_force(size):
    rng = random.Random(size)
    text = "".join(rng.choice("ab é🎉") for _ in range(size))
    assert [(x >> 32, x & 0xFFFFFFFF) for x in w.winnow(text, 5, 8).tolist()] == brute(text, 5, 8)


def test_rightmost_of_equal_hashes():
    assert [x & 0xFFFFFFFF for x in w.winnow("a" * 40, 5, 8).tolist()] == list(range(7, 36))


def test_shared_passage_is_found():
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = word(w.K + w.W - 1)
    for _ in range(20):
        a, b = word(rng.randrange(300)) + passage + word(50), word(rng.randrange(300)) + passage + word(80)
        assert set(w.hashes(w.winnow(a))) & set(w.hashes(w.winnow(b)))


def test_operator(docs, empty):
    rows = w.edited_neighbours(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(rows) == len(ROWS)
    expected = {}
    for i, (doc, text, _) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edit = text[: len(text) - cut] + other[:cut]
        expected.setdefault(doc, []).append((len(text), w.written(w.winnow(text)), w.written(w.winnow(edit))))
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append((r["n_chars"], r["fingerprint"], r["edited_fingerprint"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    assert w.edited_neighbours(empty).collect() == []


def test_alone_and_marks(spark, docs):
    one = spark.createDataFrame([(5, "only " * 40)], "doc_id long, text string")
    row = w.edited_neighbours(one).collect()[0]
    assert row["near_next"] == 1.0 and row["n_chars"] == 200
    marks = {r["doc_id"]: r["marks"] for r in w.fingerprints(docs).collect()}
    assert marks[4] == [] and marks[6] == marks[7] and len(marks[6]) > 10


def test_many_buckets(spark):
    """Every row's successor, across buckets that are dealt to different tasks."""
    data = [(i * 7, f"text number {i} " * 30) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    got = {}
    for part in w.beside_next(df, 9).rdd.glom().collect():
        for a, b in zip(part, part[1:]):
            if a["bucket"] == b["bucket"]:
                got[a["doc_id"]] = b["doc_id"]
    assert got == {i * 7: (i + 1) % 200 * 7 for i in range(200)}
