import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from namesake.llm import quality as q

from .conftest import ROWS, table


@pytest.fixture(scope="module")
def made():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["the", "an", "re", "ti", "on"]) for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for _ in range(300):
        words = [word() for _ in range(rng.randrange(20, 120))]
        bad = rng.random() < 0.3
        texts.append(" ".join(w + rng.choice(["###", "%%%"]) for w in words) if bad else " ".join(words) + ".")
        labels.append(int(not bad))
    return texts, labels


@pytest.fixture(scope="module")
def net(made):
    return q.fit(made[0][:200], made[1][:200])


def test_held_out_accuracy(made, net):
    tables = net.tables()
    right = [(q.score(t, net, tables) >= 0.5) == y for t, y in zip(made[0][200:], made[1][200:])]
    assert np.mean(right) >= 0.95


def test_convolution_against_loops(net):
    text = "Ab é " * 80
    raw = q.padded(text)
    n = len(raw) - q.WIDTH + 1
    out = np.array([sum(net.filters[j, raw[t + j]] for j in range(q.WIDTH)) for t in range(n)])
    cells = [out[a : a + q.CELL].max(0) for a in range(0, n, q.CELL)]
    want = np.array([np.maximum(a, b) for a, b in zip(cells, cells[1:])])
    assert np.allclose(q.pooled(raw, net.tables()), want, atol=1e-4)


def test_whole_document_counts(net):
    """Junk far behind a good start lowers the score."""
    good = "the anre tion reti onthe an. " * 400
    tables = net.tables()
    assert q.score(good + "the### an%%% re### ti%%% " * 200, net, tables) < q.score(good, net, tables)


def test_operator(spark, docs, empty, net):
    rows = q.score_documents(docs, net).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert q.score_documents(empty, net).count() == 0
    kept = q.good_documents(docs, net, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert q.good_documents(docs, net, threshold=1.1).count() == 0


def test_sample_and_labels(spark):
    df = table(spark, [(i, f"text {i}", "a") for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(3, None, 0), (None, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    texts, y = q.training_sample(df, labels)
    used = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(texts) == sorted(f"text {i}" for i in used) and len(y) == len(used)
    assert dict(zip(texts, y)).get("text 4", 1) == 1
    held = {r[0]: r[1] for r in df.select("doc_id", q.held_out(F.col("doc_id"))).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_without_labels(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net = q.fit(*q.training_sample(empty, labels))
    assert q.score("anything", net, net.tables()) == 0.5
    assert q.fit(["a", "b"], [1, 1]).constant == 1.0
