"""Queries against their SQL at the smallest scale, and the entry without the text subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from namesake.plans import queries as q

SF = "/root/testdata/sf0.001"
TABLES = ("part", "documents")
CHECKED = ["er_normalize", "er_numbers", "er_canonical", "er_ids", "er_arrival_order", "er_primary_keys", "er_extra_keys", "er_empty_address_keys", "er_reference_keys", "er_blocked_pairs", "er_broad_intersections", "er_weighted_overlap", "er_gram_cosine", "er_name_kernels", "er_threshold_sweep", "er_metrics", "er_checks", "er_review_flags", "er_pilot", "er_candidates", "er_fuzzy_baseline", "er_empty_address_candidates", "er_plain_features", "er_linear_scores", "er_intersected_pairs_40"]


def canonical(df):
    df = df[sorted(df.columns)].astype(object)
    df = df.map(lambda v: None if v is None or (not hasattr(v, "__len__") and pd.isna(v)) else round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.shape == () else v)
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, duck, name):
    got, want = canonical(q.QUERIES[name](spark, SF).toPandas()), canonical(duck.execute(q.ORACLE_SQL[name]).df())
    pd.testing.assert_frame_equal(got, want)


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(q.ORACLE_SQL) <= set(q.QUERIES)


def test_entry_without_the_text_subpackage(tmp_path):
    """The rest imports and lists its queries when the text operators are not there."""
    root = Path(__file__).resolve().parents[1]
    for path in [root / "__spark_entry__.py", *(root / "namesake").rglob("*.py")]:
        if "llm" not in path.parts:
            target = tmp_path / path.relative_to(root)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(path.read_text())
    code = "import __spark_entry__ as e; assert e.queries() and not any(k.startswith('op') for k in e.queries()); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_a_fault_inside_the_text_subpackage_is_not_hidden(tmp_path):
    root = Path(__file__).resolve().parents[1]
    for path in [root / "__spark_entry__.py", *(root / "namesake").rglob("*.py")]:
        if "llm" not in path.parts:
            target = tmp_path / path.relative_to(root)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(path.read_text())
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert done.returncode and "no_such_module_at_all" in done.stderr


def test_no_join_in_a_loop(spark):
    """Blocking and its rivals are equi-joins."""
    for name in ("er_blocked_pairs", "er_rival_counts", "er_intersected_pairs"):
        plan = q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
