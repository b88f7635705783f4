"""Similarity kernels.  Set measures are columns; edit measures are Arrow functions over vectors of pairs.

The edit measure is the normalised Indel similarity, 2 * LCS / (len a + len b).  The length of the longest common
subsequence comes from a bit-parallel recurrence over one 64-bit word a pair, run for all pairs of a batch at once;
pairs whose shorter string is longer than 64 use Python's integers as wide words.  Every distinct pair of a batch is
computed once.  All results are between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 64
#: Pairs whose windows partial_ratios measures in one batch.
SHARED = 1000


def _wide_lcs(a: str, b: str) -> int:
    """The recurrence on one integer of len(a) bits: a bit is cleared where a longer subsequence ends."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _raw(strings: list[str], width: int) -> np.ndarray:
    """(strings, width) code points; past the end the last one there is."""
    return np.frombuffer("".join(s.ljust(width, "\U0010ffff") for s in strings).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(strings), width)


def _codes(strings: list[str], width: int, alphabet: np.ndarray) -> np.ndarray:
    """(strings, width) places in the alphabet; past the end the place after the last."""
    return np.minimum(np.searchsorted(alphabet, _raw(strings, width).ravel()), len(alphabet)).reshape(len(strings), width)


def _tables(strings: list[str], alphabet: np.ndarray) -> np.ndarray:
    """For each string and character the bits of the positions at which it stands, and zeros for no character."""
    code = _codes(strings, WIDTH, alphabet)
    table = np.zeros((len(strings), len(alphabet) + 1), np.uint64)
    every = np.arange(len(strings))
    for i in range(max(map(len, strings))):
        table[every, code[:, i]] |= np.uint64(1) << np.uint64(i)
    table[:, -1] = 0
    return table


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs."""
    if not len(a):
        return np.zeros(0, np.int64)
    x, short = pd.factorize(np.array([p if len(p) <= len(q) else q for p, q in zip(a, b, strict=True)], object))
    y, long = pd.factorize(np.array([q if len(p) <= len(q) else p for p, q in zip(a, b, strict=True)], object))
    return np.concatenate([coded_lcs(list(short), list(long), x[at : at + 8192], y[at : at + 8192]) for at in range(0, len(x), 8192)])


def coded_lcs(a: list[str], b: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of a[x[i]] and b[y[i]]: each string is prepared once, whatever the pairs.

    The strings of a are the words of bits, so those over 64 characters go the wide way.
    """
    out = np.zeros(len(x), np.int64)
    sizes, lengths = np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b))
    fits = (sizes[x] > 0) & (sizes[x] <= WIDTH) & (lengths[y] > 0) & (lengths[y] <= 8 * WIDTH)
    pick = np.flatnonzero(fits)
    if len(pick):
        used, p = np.unique(x[pick], return_inverse=True)
        texts, q = np.unique(y[pick], return_inverse=True)
        left, right = [a[i] for i in used.tolist()], [b[i] for i in texts.tolist()]
        alphabet = np.array(sorted(set("".join(left))), "U1").view(np.uint32)
        rows = _codes(right, int(lengths[texts].max()), alphabet).T
        known = np.concatenate([alphabet, [0]])
        rows = np.where(known[rows] == _raw(right, rows.shape[0]).T, rows, len(alphabet))
        table, base = _tables(left, alphabet).ravel(), p * (len(alphabet) + 1)
        row = np.full(len(pick), ~np.uint64(0))
        for step in np.ascontiguousarray(rows):
            hit = table[base + step[q]] & row
            row = (row + hit) | (row - hit)
        size = sizes[x[pick]].astype(np.uint64)
        mask = np.where(size == 64, ~np.uint64(0), (np.uint64(1) << (size & np.uint64(63))) - np.uint64(1))
        out[pick] = sizes[x[pick]] - np.bitwise_count(row & mask)
    for i in np.flatnonzero(~fits & (sizes[x] > 0) & (lengths[y] > 0)).tolist():
        out[i] = _wide_lcs(a[x[i]], b[y[i]])
    return out


def coded_ratios(a: list[str], b: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Normalised Indel similarity of a[x[i]] and b[y[i]]; two empty strings are alike."""
    total = np.fromiter(map(len, a), np.float64, len(a))[x] + np.fromiter(map(len, b), np.float64, len(b))[y]
    return np.divide(2.0 * coded_lcs(a, b, x, y), total, out=np.ones(len(x)), where=total > 0)


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised Indel similarity; two empty strings are alike."""
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    return np.divide(2.0 * lcs_lengths(a, b), total, out=np.ones(len(a)), where=total > 0)


def sorted_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    ordered = {x: sorted_tokens(x) for x in {*a, *b}}
    return ratios([ordered[x] for x in a], [ordered[y] for y in b])


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    x, left = pd.factorize(np.array(a, object))
    y, right = pd.factorize(np.array(b, object))
    return coded_token_sets(list(left), list(right), x, y)


def coded_token_sets(a: list[str], b: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """On the sets of tokens of a[x[i]] and b[y[i]]: 0 if either is empty, 1 if one holds the other, else the best of
    three comparisons.

    With the shared tokens S and the differences A and B, each in order, these are (S A, S B), (S, S A) and (S, S B).
    The first two share the prefix S, so its subsequence is S and that of A and B; the others follow from lengths.
    """
    out = np.zeros(len(x))
    left, right, spread, shared, at = [], [], [], [], []
    first, second = [frozenset(s.split()) for s in a], [frozenset(s.split()) for s in b]
    for i, (j, k) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        p, q = first[j], second[k]
        if not p or not q:
            continue
        both = p & q
        if both and (len(both) == len(p) or len(both) == len(q)):
            out[i] = 1.0
            continue
        at.append(i)
        left.append(" ".join(sorted(p - both)))
        right.append(" ".join(sorted(q - both)))
        shared.append(sum(map(len, both)) + max(0, len(both) - 1))
        spread.append(1 if both else 0)
    if at:
        s, gap = np.array(shared, float), np.array(spread, float)
        la, lb = np.array([len(x) for x in left], float), np.array([len(x) for x in right], float)
        whole_a, whole_b = s + gap + la, s + gap + lb
        common = s + gap + lcs_lengths(left, right)
        best = 2 * common / (whole_a + whole_b)
        best = np.where(s > 0, np.maximum(best, np.maximum(2 * s / (s + whole_a), 2 * s / (s + whole_b))), best)
        out[at] = best
    return out


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair the best similarity of the shorter string to a window of its length in the longer one, cut off at
    the edges.  The windows of many pairs are one batch of the kernel."""
    if len(a) > SHARED:
        return np.concatenate([partial_ratios(a[at : at + SHARED], b[at : at + SHARED]) for at in range(0, len(a), SHARED)])
    out = np.array([float(x == y) if not x or not y else 0.0 for x, y in zip(a, b, strict=True)])
    left, right, of = [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if not x or not y:
            continue
        for p, q in ((x, y), (y, x)) if len(x) == len(y) else (((x, y) if len(x) < len(y) else (y, x)),):
            m = len(p)
            windows = {q[max(0, at) : at + m] for at in range(1 - m, len(q))}
            left += [p] * len(windows)
            right += windows
            of += [i] * len(windows)
    if of:
        np.maximum.at(out, np.array(of), ratios(left, right))
    return out


def partial_ratio(a: str, b: str) -> float:
    return float(partial_ratios([a], [b])[0])


def number_similarities(a: list[list[str]], b: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """For each number of a its best similarity to a number of b: the greatest and the mean of these; 0 if one is empty."""
    m, n = (np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b))
    best, mean = np.zeros(len(a)), np.zeros(len(a))
    some = np.flatnonzero((m > 0) & (n > 0))
    if len(some):
        found = ratios([p for i in some for p in a[i] for _ in b[i]], [q for i in some for _ in a[i] for q in b[i]])
        rows = np.repeat(n[some], m[some])  # one entry for each number of a: how many of b it met
        tops = np.maximum.reduceat(found, np.cumsum(rows) - rows)
        starts = np.cumsum(m[some]) - m[some]
        best[some], mean[some] = np.maximum.reduceat(tops, starts), np.add.reduceat(tops, starts) / m[some]
    return best, mean


def once(kernel: Callable[[list[str], list[str]], np.ndarray]) -> Callable[[pd.Series, pd.Series], pd.Series]:
    """A kernel over the distinct pairs of two series."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series(dtype="float64")
        left, x = pd.factorize(a.fillna(""))
        right, y = pd.factorize(b.fillna(""))
        code, pairs = pd.factorize(left * len(y) + right)
        return pd.Series(kernel(x[pairs // len(y)].tolist(), y[pairs % len(y)].tolist())[code])

    return run


def _column(kernel: Callable) -> Callable[[Column, Column], Column]:
    run = once(kernel)

    @F.pandas_udf(T.DoubleType())
    def measured(a: pd.Series, b: pd.Series) -> pd.Series:
        return run(a, b)

    return measured


ratio = _column(ratios)
token_sort_ratio = _column(token_sort_ratios)
token_set_ratio = _column(token_set_ratios)
partial_token_ratio = _column(partial_ratios)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Shared elements over those of the smaller set, or over 1."""
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), least)


def weight(frequency: Column) -> Column:
    """Of a key in a weighted overlap: rare ones count more."""
    return 1 / F.sqrt(F.greatest(F.lit(1), frequency))


@F.arrow_udf(T.DoubleType())
def sparse_dot(grams_a: pa.Array, values_a: pa.Array, grams_b: pa.Array, values_b: pa.Array) -> pa.Array:
    """Dot products of sparse vectors, each an ascending array of indices and one of values; null is the zero vector."""
    keys, values = [], []
    for grams, of in ((grams_a, values_a), (grams_b, values_b)):
        size = pc.fill_null(pc.list_value_length(grams), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(grams), dtype=np.int64), size)
        keys.append(row << 32 | grams.flatten().to_numpy(zero_copy_only=False))
        values.append(of.flatten().to_numpy(zero_copy_only=False))
    at = np.searchsorted(keys[1], keys[0])
    hit = np.flatnonzero(at < len(keys[1]))
    hit = hit[keys[1][at[hit]] == keys[0][hit]]
    return pa.array(np.bincount(keys[0][hit] >> 32, values[0][hit] * values[1][at[hit]], len(grams_a)))


@F.arrow_udf(T.StructType([T.StructField("names", T.DoubleType()), T.StructField("addresses", T.DoubleType())]))
def pool_measures(core_a: pa.Array, core_b: pa.Array, roman_a: pa.Array, roman_b: pa.Array, sorted_a: pa.Array, sorted_b: pa.Array, address_a: pa.Array, address_b: pa.Array) -> pa.Array:
    """What a search ranks by: names by their sorted tokens, in either spelling; addresses by sorted tokens and token sets.

    Cores, spellings and `sorted` have their tokens in order.  Every distinct string of a batch is prepared once, and
    every distinct pair of strings is measured once.
    """

    def measured(kernel, a: pa.Array, b: pa.Array) -> np.ndarray:
        left, right = a.dictionary_encode(), b.dictionary_encode()
        x, y = left.indices.to_numpy().astype(np.int64), right.indices.to_numpy().astype(np.int64)
        pairs, back = np.unique(x * max(1, len(right.dictionary)) + y, return_inverse=True)
        return kernel(left.dictionary.to_pylist(), right.dictionary.to_pylist(), pairs // max(1, len(right.dictionary)), pairs % max(1, len(right.dictionary)))[back]

    names = measured(coded_ratios, core_a, core_b)
    spelled = pc.or_(pc.not_equal(core_a, roman_a), pc.not_equal(core_b, roman_b))
    other = np.flatnonzero(spelled.to_numpy(zero_copy_only=False))
    if len(other):
        names[other] = np.maximum(names[other], measured(coded_ratios, roman_a.take(pa.array(other)), roman_b.take(pa.array(other))))
    addresses = np.zeros(len(names))
    there = np.flatnonzero(pc.and_(pc.not_equal(address_a, ""), pc.not_equal(address_b, "")).to_numpy(zero_copy_only=False))
    if len(there):
        of = lambda c: c.take(pa.array(there))
        addresses[there] = 0.55 * measured(coded_ratios, of(sorted_a), of(sorted_b)) + 0.45 * measured(coded_token_sets, of(address_a), of(address_b))
    return pa.StructArray.from_arrays([pa.array(names), pa.array(addresses)], ["names", "addresses"])
