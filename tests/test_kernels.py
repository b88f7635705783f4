"""Kernels against the plain dynamic programme, and the properties that any similarity has."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namesake.functions import similarity as sim


def naive(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


words = st.text("abcé d", max_size=90)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=8))
def test_lcs(pairs):
    a, b = map(list, zip(*pairs))
    assert sim.lcs_lengths(a, b).tolist() == [naive(x, y) for x, y in pairs]


@pytest.mark.parametrize("m,n", [(64, 64), (64, 65), (65, 65), (63, 700), (200, 90)])
def test_word_borders(m, n):
    rng = np.random.default_rng(m * n)
    a, b = ("".join(rng.choice(list("abc"), k)) for k in (m, n))
    assert sim.lcs_lengths([a], [b])[0] == naive(a, b)


@settings(max_examples=100, deadline=None)
@given(words, words)
def test_properties(a, b):
    for kernel in (sim.ratios, sim.token_sort_ratios, sim.token_set_ratios, sim.partial_ratios):
        value = kernel([a], [b])[0]
        assert 0 <= value <= 1 and value == pytest.approx(kernel([b], [a])[0])
    assert sim.ratios([a], [a])[0] == 1


def test_empty_strings():
    assert sim.ratios(["", "", "a"], ["", "a", ""]).tolist() == [1, 0, 0]
    assert sim.token_sort_ratios([""], [""])[0] == 1 and sim.token_set_ratios([""], [""])[0] == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("red blue bolt ring big".split()), max_size=5), st.lists(st.sampled_from("red blue bolt widget big".split()), max_size=5))
def test_token_sets(p, q):
    x, y = set(p), set(q)
    both = " ".join(sorted(x & y))
    a, b = " ".join([*sorted(x & y), *sorted(x - y)]), " ".join([*sorted(x & y), *sorted(y - x)])
    r = lambda u, v: 2 * naive(u, v) / (len(u) + len(v))
    if not x or not y:
        want = 0
    elif both and (x <= y or y <= x):
        want = 1
    else:
        want = max([r(a, b), *([r(both, a), r(both, b)] if both else [])])
    assert sim.token_set_ratios([" ".join(p)], [" ".join(q)])[0] == pytest.approx(want)


def test_partial():
    assert sim.partial_ratio("abc", "xxabcxx") == 1
    assert sim.partial_ratio("abcd", "bcde") == pytest.approx(max(2 * 3 / 7, 2 * 3 / 7))
    assert sim.partial_ratio("", "") == 1 and sim.partial_ratio("", "a") == 0


def test_numbers():
    best, mean = sim.number_similarities([["12", "7"], [], ["1"]], [["12", "13"], ["1"], []])
    assert best.tolist() == [1, 0, 0] and mean.tolist() == [0.5, 0, 0]


def test_set_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["a", "b", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    rows = df.select(sim.jaccard(F.col("a"), F.col("b")), sim.containment(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(1 / 3, 0.5), (0.0, 0.0), (0.0, 0.0)]


def test_columns_are_the_kernels(spark):
    from pyspark.sql import functions as F

    data = [("red bolt", "bolt red"), ("", ""), ("a b", "a c")] * 3
    df = spark.createDataFrame(data, "a string, b string")
    got = df.select(sim.ratio(F.col("a"), F.col("b")), sim.token_sort_ratio(F.col("a"), F.col("b")), sim.token_set_ratio(F.col("a"), F.col("b"))).collect()
    a, b = map(list, zip(*data))
    want = list(zip(sim.ratios(a, b), sim.token_sort_ratios(a, b), sim.token_set_ratios(a, b)))
    assert np.allclose([tuple(r) for r in got], want)
