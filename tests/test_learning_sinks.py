import json

import pytest
from pyspark.sql import functions as F

from namesake.operators import learn
from namesake.sources import records, sinks


@pytest.fixture(scope="module")
def pairs(spark):
    """Links that one feature tells apart, with some noise in another."""
    return spark.range(400).select(
        F.concat(F.lit("S1-"), F.col("id") % 50).alias("ref_id"), F.concat(F.lit("S2-"), "id").alias("target_id"), (F.col("id") % 4 == 0).cast("int").alias("label"),
        (F.when(F.col("id") % 4 == 0, 0.7).otherwise(0.2) + F.pmod(F.xxhash64("id"), F.lit(100)) / 500.0).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 100.0).alias("y"),
    ).cache()


def test_model_kinds_tell_links_apart(pairs):
    assert set(learn.model_kinds()) == {"boosted", "slow_boosted", "linear_svm"}
    for name, fit in learn.model_kinds().items():
        scored = fit(pairs, ["x", "y"])(pairs)
        low, high = (scored.filter(F.col("label") == y).agg(f("score")).first()[0] for y, f in ((0, F.max), (1, F.min)))
        assert low < high, name


def test_selected_model(pairs):
    value = lambda scored: scored.agg(F.corr("score", "label")).first()[0]
    model, found, setting = learn.selected_model(pairs, pairs, ["x", "y"], [(2, 1), (4, 2)], value)
    assert found > 0.9 and setting in [(2, 1), (4, 2)] and learn.importance(model, ["x", "y"])["x"] > 0.5


def test_margin_grid(pairs):
    grid = learn.margin_grid(pairs.withColumnRenamed("x", "score"))
    assert grid == sorted(grid) and grid[0] == -3 and grid[-1] == 3 and len(grid) > 200


def test_scaling(pairs):
    rows = {r["feature"]: r for r in learn.scaling(pairs, ["x", "y"]).collect()}
    assert set(rows) == {"x", "y"} and rows["y"]["mean"] == pytest.approx(0.5, abs=0.05) and rows["x"]["std"] > 0


def test_feature_store(spark, pairs, tmp_path):
    sinks.write_features(pairs, f"{tmp_path}/f", ["x", "y"])
    back = records.read_features(spark, f"{tmp_path}/f")
    assert dict(back.dtypes) == {"ref_id": "string", "target_id": "string", "label": "int", "x": "float", "y": "float"} and back.count() == 400


def test_ordered_lists(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"S1-{i}", "") for i in range(40)], "ref_idx int, source1_entity_id string, matched_entity_ids string").repartition(3)
    sinks.write_ordered_tsv(rows, f"{tmp_path}/o")
    lines = [line for part in sorted((tmp_path / "o").glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert [line.split("\t")[0] for line in lines] == [f"S1-{i}" for i in range(40)]


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"threshold": 0.7}))
    assert records.read_config(str(tmp_path / "c.json")) == {"threshold": 0.7}


def test_report(spark):
    assert json.loads(sinks.report(spark.range(1).select(F.lit(2).alias("rows"), F.lit(0.5).alias("value")))) == {"rows": 2, "value": 0.5}
