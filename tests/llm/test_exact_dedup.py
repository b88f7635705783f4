from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from namesake.llm import exact_dedup as ed

from .conftest import ROWS, table


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, keep):
    out = []
    for i, t, _ in rows:
        group = [j for j, u, _ in rows if lower(u) == lower(t)]
        ids = [j for j in group if j is not None]
        best = keep(ids) if ids else None
        out.append((str(i), str(best), len(group), i == best, sha256(lower(t).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("runs", [1, 5, 64])
def test_groups(docs, keep, runs):
    rows = ed.duplicate_groups(docs, keep=keep, runs=runs).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in rows) == brute(ROWS, max if keep == "max" else min)


def test_one_row_of_each_text_stays(spark, docs, empty):
    kept = ed.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(lower(r["text"]) for r in kept.collect()) == sorted({lower(t) for _, t, _ in ROWS})
    assert ed.deduplicated(empty).count() == 0 and ed.duplicate_groups(empty).count() == 0


def test_large_group(spark):
    df = table(spark, [(i, "Copy" if i % 3 else f"text {i}", "a") for i in range(900)])
    assert sorted(r["doc_id"] for r in ed.deduplicated(df).collect()) == sorted([i for i in range(0, 900, 3)] + [899])


def test_native(docs):
    plan = ed.duplicate_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_keep_is_checked(docs):
    with pytest.raises(ValueError):
        ed.duplicate_groups(docs, keep="any")


def test_names_of_helpers_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a", 5, "x", "y"), (2, "A", 6, "z", "w"), (3, "b", 7, "u", "v")], "doc_id long, text string, ID int, digest string, _digest string")
    kept = ed.deduplicated(df)
    assert kept.columns == df.columns and sorted(kept.select("doc_id", "ID", "digest", "_digest").collect()) == [(2, 6, "z", "w"), (3, 7, "u", "v")]


@pytest.mark.parametrize("keep", ["max", "min"])
def test_runs_are_sorted_lists_merged_in_rounds(spark, monkeypatch, keep):
    """Many small segments, more than eight runs and three exchanges: the same as plain grouping, by way of sorted lists."""
    monkeypatch.setattr(ed, "SEGMENT", 7)
    rows = [(None if i % 50 == 0 else (i * 37) % 600 - 300, f"text {i % 90}" if i % 4 else "hot", "a") for i in range(700)]
    got = ed.duplicate_groups(table(spark, rows), keep=keep, runs=300).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got) == brute(rows, max if keep == "max" else min)


def test_equal_keys_merge_and_others_do_not(spark):
    entry = "struct<digest:binary,check:bigint,size:int,unnamed:boolean,order:bigint,doc_id:bigint,copies:bigint,n:bigint>"
    rows = [(b"a", 1, 1, False, -9, 9, 1, 4), (b"a", 1, 1, False, -2, 2, 1, 1), (b"a", 2, 1, False, -8, 8, 1, 1), (b"b", 1, 1, False, -1, 1, 2, 3)]
    df = spark.createDataFrame([(rows,), ([],)], f"entries array<{entry}>")
    got = [[(e["doc_id"], e["n"]) for e in r[0]] for r in df.select(ed.first_of_each(F.col("entries"), 8)).collect()]
    assert got == [[(9, 5), (8, 1), (1, 3)], []]
