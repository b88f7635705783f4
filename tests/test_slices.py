"""The pool makes every pair once without exchanging pairs, a slice of references at a time, and leaves no shuffle files."""

import pytest
from pyspark.sql import functions as F

from namesake.operators import retrieval
from namesake.plans import queries as q
from namesake.plans import views
from namesake.sources.shared import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entities(spark):
    return materialise(views.references(spark, SF), "references"), materialise(views.targets(spark, SF), "targets")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("cap", [10, 40, 1000])
def test_a_pair_of_several_keys_is_made_once(entities, cap):
    refs, targets = entities
    rk, tk, counts = retrieval.stored_keys(refs, targets, both=True)
    broad = retrieval.broad_keys(rk, counts, cap)
    pairs = retrieval.primary_intersections(broad).unionByName(retrieval.extra_intersections(broad))
    want = retrieval.blocked_pairs(rk, tk, counts, cap).unionByName(retrieval.intersect(pairs, tk, cap)).distinct()
    assert rows(retrieval.candidate_pool(refs, targets, cap)) == rows(want)


@pytest.mark.parametrize("name", ["er_pool", "er_set_similarity", "er_weighted_overlap"])
def test_pairs_are_not_exchanged(spark, name):
    plan = q.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join ") <= 3


def test_slices_make_the_same_candidates(entities, monkeypatch):
    refs, targets = entities
    whole = rows(retrieval.candidates(refs, targets))
    monkeypatch.setattr(retrieval, "SLICE_PAIRS", 30_000)
    parts = []
    plain = retrieval.slices
    monkeypatch.setattr(retrieval, "slices", lambda own, other: (parts.append(1) or part for part in plain(own, other)))
    assert rows(retrieval.candidates(refs, targets)) == whole and len(parts) > 1


def test_best_pairs_alone_are_written(spark, monkeypatch):
    seen, plain = [], q.policy.best_position
    monkeypatch.setattr(q.policy, "best_position", lambda pairs: seen.append(pairs.groupBy("ref_id").count().agg(F.max("count")).first()[0]) or plain(pairs))
    q.er_best_candidate(spark, SF)
    assert seen == [1]


def test_a_written_table_leaves_no_shuffle_files(spark):
    status = spark._jsparkSession.sparkContext().env().mapOutputTracker()
    before = status.shuffleStatuses().size()
    materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "few")
    assert status.shuffleStatuses().size() <= before


def test_records_of_a_small_file_are_dealt_over_all_cores(spark):
    assert views.references(spark, SF).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
