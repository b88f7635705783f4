import json

import pytest
from pyspark.sql import functions as F

from namesake.operators import review, validate
from namesake.sources import records, sinks
from namesake.streaming import micro_batches


def make(spark, rows):
    return spark.createDataFrame(rows, records.SCHEMA)


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", 'A "quoted" name', "", "US"), ("S1-2", "tab\tinside", "two\nlines", "France"), ("S1-3", "", " x ", "")]
    df = make(spark, rows)
    sinks.write_tsv(df, f"{tmp_path}/out", one_file=True)
    back = records.read_tsv(spark, f"{tmp_path}/out")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_header_is_checked(spark, tmp_path):
    (tmp_path / "bad.tsv").write_text("entity_id\tname\nS1-1\tx\n")
    with pytest.raises(Exception):
        records.read_tsv(spark, str(tmp_path / "bad.tsv")).collect()
    with pytest.raises(ValueError):
        validate.check_header(["entity_id"])


def test_numbering(spark):
    a = make(spark, [(f"S2-{i}", "n", "a", "c") for i in range(50)])
    b = make(spark, [(f"S3-{i}", "n", "a", "c") for i in range(30)])
    got = {r["entity_id"]: r["rid"] for r in records.numbered([a, b]).collect()}
    order = sorted(f"S2-{i}" for i in range(50)) + sorted(f"S3-{i}" for i in range(30))
    assert got == {e: i + 1 for i, e in enumerate(order)}
    part = records.position_slice(records.numbered([a, b]), 10, 15)
    assert sorted(r["rid"] for r in part.collect()) == [11, 12, 13, 14, 15]


def test_input_checks(spark):
    good, more = make(spark, [("S1-1", "a", "b", "c")]), make(spark, [("S2-1", "a", "b", "c")])
    validate.check_inputs(good, {2: more, 3: make(spark, [])})
    with pytest.raises(ValueError, match="duplicate entity ID"):
        validate.check_inputs(good.union(good), {2: more})
    with pytest.raises(ValueError, match="invalid entity ID"):
        validate.check_inputs(good, {2: make(spark, [("S2-01", "a", "b", "c")])})
    with pytest.raises(ValueError, match="at least one"):
        validate.check_inputs(good, {2: make(spark, [])})


def test_output_checks(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "ref_id string, target_id string")
    refs, targets = spark.createDataFrame([("a",), ("b",)], "ref_id string"), spark.createDataFrame([("x",), ("y",)], "target_id string")
    found = pairs([("a", "x"), ("a", "y"), ("b", "x")])
    validate.check_outputs(refs, targets, pairs([("a", "x")]), found)
    for links, candidates, message in (([("b", "y")], found, "outside"), ([("a", "x"), ("b", "x")], found, "several"), ([("a", "x"), ("a", "x")], found, "duplicate"), ([], pairs([("a", "z")]), "unknown target"), ([], pairs([("c", "x")]), "unknown reference")):
        with pytest.raises(ValueError, match=message):
            validate.check_outputs(refs, targets, pairs(links), candidates)
    assert validate.same_selection(found, found).count() == 0
    numbered = spark.createDataFrame([(0, "a"), (1, "b")], "ref_idx int, ref_id string")
    swapped = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c")], "ref_idx int, ref_id string")
    assert validate.out_of_order(numbered, numbered).count() == 0 and validate.out_of_order(numbered, swapped).count() == 3


def test_manifest(tmp_path):
    (tmp_path / "in").write_text("x")
    now = validate.manifest([str(tmp_path / "in")], {"top_k": 80})
    (tmp_path / "m.json").write_text(json.dumps(now))
    assert not validate.stale(tmp_path / "m.json", now) and validate.stale(tmp_path / "none.json", now)
    assert validate.stale(tmp_path / "m.json", validate.manifest([str(tmp_path / "in")], {"top_k": 8}))


def test_lists(spark):
    refs = spark.createDataFrame([("a", 0), ("b", 1)], "ref_id string, ref_idx int")
    pairs = spark.createDataFrame([("a", "z", 0, 0.5), ("a", "c", 1, 0.25)], "ref_id string, target_id string, cand_pos int, score double")
    assert {r["source1_entity_id"]: r["m"] for r in sinks.id_lists(refs, pairs, "m").collect()} == {"a": "z,c", "b": ""}
    assert {r["ref_id"]: r["scores"] for r in sinks.score_lists(refs, pairs).collect()} == {"a": [0.5, 0.25], "b": []}


def test_html_cannot_be_closed(spark):
    payload = json.dumps({"name": "</script><b>&"})
    page = sinks.render_html(payload, "<script>__REPORT_JSON__</script>")
    inner = page.removeprefix("<script>").removesuffix("</script>")
    assert "<" not in inner and json.loads(inner) == {"name": "</script><b>&"}


def test_review(spark):
    rows = spark.createDataFrame(
        [("a", "x", 0.9, 0.8, True, True, "1 St", "2 St"), ("a", "y", 0.79, 0.8, False, False, "1 St", ""), ("b", "x", 0.85, 0.8, True, False, "", "2 St"), ("b", "z", 0.3, 0.8, True, True, "", " ")],
        "ref_id string, target_id string, score double, threshold double, before boolean, selected boolean, ref_address string, target_address string",
    )
    decided = review.decisions(rows).cache()
    got = {(r["ref_id"], r["target_id"]): r["decision"] for r in decided.collect()}
    assert got == {("a", "x"): "accepted", ("a", "y"): "below_policy_threshold", ("b", "x"): "assigned_to_other_reference", ("b", "z"): "accepted_by_fallback"}
    refs = spark.createDataFrame([("a", "1 St", "us"), ("b", "", "us"), ("c", "9", "fr")], "ref_id string, ref_address string, country string")
    flags = review.review_flags(refs, decided).cache()
    assert {r["ref_id"]: r["flags"] for r in flags.collect()} == {"a": [review.FLAGS[2], review.FLAGS[3]], "b": [review.FLAGS[0], review.FLAGS[1], review.FLAGS[3], review.FLAGS[4]], "c": []}
    assert review.review_summary(flags).first().asDict() == {"references": 3, "candidates": 4, "matches": 2, "unmatched": 1, "flagged": 2}
    items = {r["ref_id"]: json.loads(r["item"]) for r in review.review_items(refs, flags, decided, ["score"]).collect()}
    assert [json.loads(x)["target_id"] for x in items["a"]["shown"]] == ["x", "y"] and items["c"]["matches"] == 0
    found = review.searched(refs.join(flags, "ref_id"), "ST", "us", "flagged")
    assert [r["ref_id"] for r in found.collect()] == ["a"]


def test_export(spark):
    rows = lambda d: spark.createDataFrame([("a", "x", d, 0.5, True)], "reference_id string, target_id string, decision string, model_score double, model_selected boolean")
    out = json.loads(review.exported(rows("match"), "abc", "2026-01-01").first()["export"])
    assert out["decisions"][0]["decision"] == "match" and out["schema_version"] == 1
    with pytest.raises(ValueError):
        review.exported(rows("perhaps"), "abc", "2026-01-01")


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    make(spark, [(f"S1-{i}", "Golden Crane LLC", "1 Street", "US") for i in range(10)]).repartition(2).write.parquet(f"{tmp_path}/in")

    def names(batch):
        return batch.select("eid", "core")

    for _ in range(2):
        micro_batches.match_stream(micro_batches.arriving(spark, f"{tmp_path}/in"), names, f"{tmp_path}/out", f"{tmp_path}/c")
    assert micro_batches.matched(spark, f"{tmp_path}/out").count() == 10
    make(spark, [("S1-99", "New", "", "US")]).write.mode("append").parquet(f"{tmp_path}/in")
    micro_batches.match_stream(micro_batches.arriving(spark, f"{tmp_path}/in"), names, f"{tmp_path}/out", f"{tmp_path}/c")
    assert micro_batches.matched(spark, f"{tmp_path}/out").filter("eid = 'S1-99'").count() == 1


def test_stage_is_taken_up(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert micro_batches.stage(spark, f"{tmp_path}/s", build).count() == 3
    assert len(calls) == 1


def test_stage_of_other_inputs_is_made_again(spark, tmp_path):
    made, source = [], f"file://{tmp_path}/in"
    build = lambda: made.append(1) or spark.read.parquet(source)
    run = lambda **settings: micro_batches.stage(spark, f"file://{tmp_path}/s", build, micro_batches.depends(spark, [source], settings))
    spark.range(3).write.parquet(source)
    assert run(top_k=80).count() == run(top_k=80).count() == 3 and len(made) == 1
    assert run(top_k=8).count() == 3 and len(made) == 2
    spark.range(2).write.mode("append").parquet(source)
    assert run(top_k=8).count() == 5 and run(top_k=8).count() == 5 and len(made) == 3
