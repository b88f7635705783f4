import numpy as np
import pytest

import corpus_pipeline
from namesake.llm import bpe_codec, quality

from .test_shingle_sets import kept_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/out"
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_columns(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_classifier_keeps_what_it_scores_well(spark, stages):
    _, before, after = stages[0]
    net = quality.fit(*quality.training_sample(before, spark.read.parquet(f"{SF}/labels.parquet")))
    tables = net.tables()
    want = [r["doc_id"] for r in before.collect() if quality.score(r["text"] or "", net, tables) >= quality.THRESHOLD]
    assert sorted(ids(after)) == sorted(want)


def test_exact_copies_go(stages):
    _, before, after = stages[1]
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    best = {}
    for r in before.collect():
        best[lower(r["text"])] = max(best.get(lower(r["text"]), -1), r["doc_id"])
    assert sorted(ids(after)) == sorted(best.values())


def test_near_copies_go_and_others_stay(stages):
    _, before, after = stages[2]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before.collect()}
    kept = set(ids(after))
    near = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    assert not [(a, b) for a in kept for b in kept if a < b and near(a, b) >= 0.9]
    for lost in set(sets) - kept:
        assert max(near(lost, other) for other in sets if other != lost) >= 0.65


def test_near_copies_are_the_exact_components(stages):
    """The least id of each component of true five-word similarity 0.8, and nothing else, stays."""
    _, before, after = stages[2]
    rows = [(r["doc_id"], r["text"], None) for r in before.collect()]
    assert sorted((i is None, i or 0) for i in ids(after)) == kept_ids(rows)


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_mixture_keeps_all(stages):
    _, before, after = stages[3]
    found = ids(after)
    assert set(found) == set(ids(before)) and max(np.unique(found, return_counts=True)[1]) <= 2


def test_encoding(stages):
    _, before, after = stages[4]
    tok = bpe_codec.library(bpe_codec.vocabulary_path())
    want = {r["doc_id"]: len(tok.encode(r["text"], add_special_tokens=False).ids) for r in before.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in after.collect()} == want and after.count() == before.count()


def test_run(spark, stages):
    assert sorted(ids(corpus_pipeline.run(spark, SF))) == sorted(ids(stages[-1][2]))
