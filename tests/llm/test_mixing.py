import math

import pytest
from pyspark.sql import functions as F

from namesake.llm import mixing

from .conftest import ROWS


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i < 600 else "mid" if i < 900 else "small") for i in range(1000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def shares(corpus):
    return corpus.groupBy("source").agg(F.sum(mixing.tokens(F.col("text"))).alias("tokens"))


def test_exponent_for_repetition(corpus):
    table = {r[0]: r[1] for r in shares(corpus).collect()}
    a = mixing.bisect_exponent(shares(corpus), max_repeats=2.0)
    spread = math.log(max(table.values()) / min(table.values()))
    assert a == pytest.approx(1 - math.log(2) / spread, abs=2e-6)


def test_exponent_for_entropy(corpus):
    table = [r[1] for r in shares(corpus).collect()]
    a = mixing.bisect_exponent(shares(corpus), target_entropy=0.95)

    def entropy(x):
        p = [t**x for t in table]
        return -sum(q / sum(p) * math.log(q / sum(p)) for q in p) / math.log(len(p))

    assert entropy(a) >= 0.95 - 1e-9 and entropy(a + 1e-5) < 0.95


def test_plan_meets_quotas(corpus):
    plan = mixing.mixing_plan(corpus, max_repeats=2.0).cache()
    assert plan.count() == 1000 and plan.filter("copies < 1 OR copies > 2").count() == 0
    taken = {r[0]: (r[1], r[2]) for r in plan.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")), F.sum("tokens")).collect()}
    assert taken["big"][0] == taken["big"][1]
    a = mixing.bisect_exponent(shares(corpus), max_repeats=2.0)
    for source, (got, own) in taken.items():
        quota = own**a * max(t / t**a for _, t in taken.values())
        assert quota - 1 <= got <= quota + 6, source


def test_budget_drops_and_repeats(corpus):
    plan = mixing.mixing_plan(corpus, max_repeats=1.5, budget=1000)
    total = plan.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0]
    assert 1000 <= total <= 1020
    again = mixing.mixing_plan(corpus, max_repeats=1.5, budget=1000)
    assert plan.exceptAll(again).count() == 0


def test_streams_are_whole_permutations(corpus):
    """Each source's stream has no gap and no overlap, every whole epoch has each document once, in orders of its own,
    and the last one is cut where the quota is reached."""
    rows = mixing.mixing_order(corpus, max_repeats=3.0, budget=12000, seed=4).collect()
    texts = {r["doc_id"]: r for r in corpus.collect()}
    orders = {}
    for source in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: r["position"])
        at = 0
        for r in own:
            assert r["position"] == at and r["tokens"] == len(texts[r["doc_id"]]["text"].split()) + 1
            at += r["tokens"]
        assert own[-1]["position"] < own[-1]["quota"] <= at
        size = sum(t["source"] == source for t in texts.values())
        for epoch in range(own[-1]["epoch"] + 1):
            ids = [r["doc_id"] for r in own if r["epoch"] == epoch]
            assert len(set(ids)) == len(ids) and (epoch == own[-1]["epoch"] or len(ids) == size)
            orders[source, epoch] = ids
    assert orders["small", 0] != orders["small", 1] and orders["small", 0] != sorted(orders["small", 0])


def test_sources_run_side_by_side(spark, corpus):
    """Every quarter of the mixture, in the order of its rows, has the sources in about the same shares."""
    out = [r["source"] for r in mixing.mixed(corpus, max_repeats=2.0).collect()]
    quarter = len(out) // 4
    for i in range(4):
        own = out[i * quarter : (i + 1) * quarter]
        for source in ("big", "mid", "small"):
            assert own.count(source) / quarter == pytest.approx(out.count(source) / len(out), abs=0.05)


def test_names_of_helpers_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a", "s", 5, "x", "y"), (2, "b", None, 6, "z", "w")], "doc_id long, text string, source string, id int, place string, `from` string")
    assert sorted(mixing.mixed(df).collect()) == sorted(df.collect()) and mixing.mixed(df).columns == df.columns


def test_rows_keep_their_columns(docs, empty):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == {(i, t) for i, t, _ in ROWS}
    assert mixing.mixed(empty).count() == 0 and mixing.mixing_plan(empty).count() == 0


def test_states_one_limit(corpus):
    with pytest.raises(ValueError):
        mixing.bisect_exponent(shares(corpus), 0.9, 2.0)
