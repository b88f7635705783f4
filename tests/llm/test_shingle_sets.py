"""The stage's kept ids against exact components of five-word Jaccard >= 0.8, by brute force."""

import numpy as np
import pytest

from namesake.llm import shingle_sets as ss
from namesake.llm import simhash as sh

from .conftest import table


def shingles(text, words=5):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept_ids(rows, similarity=0.8):
    """The smallest id of each component; null ids are the largest."""
    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= similarity:
                label[top(i)] = top(j)
    best = {}
    for i, (number, _, _) in enumerate(rows):
        best[top(i)] = min(best.get(top(i), (True, 0)), (number is None, number or 0))
    return sorted(best.values())


def check(spark, rows):
    got = [r["doc_id"] for r in sh.without_near_copies(table(spark, rows)).select("doc_id").collect()]
    assert sorted((i is None, i or 0) for i in got) == kept_ids(rows)


def planted(rng, lengths, per):
    """Texts with copies in which ever more words at one place are changed, on both sides of 0.8, or cut at the end."""
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows, number = [], 0
    for length in lengths:
        for _ in range(per):
            text = [word() for _ in range(length)]
            rows.append((number, " ".join(text), "a"))
            near = list(text)
            n = max(1, length - 4)
            for k in range(int(rng.integers(0, max(2, n // 6)))):
                near[(length // 3 + k) % length] = word()
            rows.append((number + 1, " ".join(near), "b"))
            rows.append((number + 2, " ".join(text[: length - int(rng.integers(0, n // 3 + 2))]), "b"))
            number += 3
    return rows


def test_both_sides_of_the_threshold(spark):
    rows = planted(np.random.default_rng(7), [5, 6, 8, 9, 10, 12, 14, 20, 40, 100, 300], 12)
    sims = [jaccard(shingles(rows[i][1]), shingles(rows[i + k][1])) for i in range(0, len(rows), 3) for k in (1, 2)]
    assert sum(0.75 <= s < 0.8 for s in sims) >= 5 and sum(0.8 <= s < 0.85 for s in sims) >= 5
    check(spark, rows)


def test_short_texts_at_the_threshold(spark):
    """8 words in 9 have 4 of 5 shingles, similarity 0.8; 7 in 8 have 3 of 4."""
    rows = []
    for i in range(20):
        words = [f"w{i}x{k}" for k in range(9)]
        rows += [(4 * i, " ".join(words), "a"), (4 * i + 1, " ".join(words[:8]), "a"), (4 * i + 2, " ".join(f"v{w}" for w in words[:8]), "a"), (4 * i + 3, " ".join(f"v{w}" for w in words[:7]), "a")]
    check(spark, rows)
    assert len(kept_ids(rows)) == 60


def test_common_lines_and_a_large_group(spark):
    """A line that all have, and a group of copies of one text that differ from each other by more than from it."""
    rng = np.random.default_rng(1)
    line = [f"line{k}" for k in range(30)]
    rows = [(i, " ".join([*line, *(f"t{i}x{k}" for k in range(int(rng.integers(1, 40))))]), "a") for i in range(150)]
    base = [f"base{k}" for k in range(120)]
    for i in range(350):
        near = list(base)
        for at in rng.choice(120, int(rng.integers(0, 4)), replace=False):
            near[at] = f"c{i}x{at}"
        rows.append((1000 + i, " ".join(near), "b"))
    check(spark, rows)


def test_the_table_around_does_not_matter(spark):
    """Two texts link among few rows and among many."""
    pair = [(1, " ".join(f"p{k}" for k in range(9)), "a"), (2, " ".join(f"p{k}" for k in range(8)), "a")]
    rng = np.random.default_rng(2)
    others = [(10 + i, " ".join(f"o{x}" for x in rng.integers(0, 10**6, 30)), "a") for i in range(1500)]
    check(spark, pair)
    check(spark, pair + others)


def test_null_and_repeated_ids(spark):
    """A near copy under a null or repeated id takes no other row of that id with it."""
    text = lambda name, n=60: " ".join(f"{name}{k}" for k in range(n))
    near = lambda name: text(name, 59)
    rows = [(1, text("a"), "a"), (None, near("a"), "a"), (None, text("b"), "a"), (7, near("a"), "a"), (7, text("c"), "a"), (8, text("d"), "a"), (8, near("d"), "a"), (9, text("e"), "a"), (9, text("e"), "a")]
    kept = sh.without_near_copies(table(spark, rows)).select("doc_id", "text").collect()
    firsts = sorted(r["text"].split()[0] for r in kept)
    assert firsts == ["a0", "b0", "c0", "d0", "e0"]
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(1, text("a")), (None, text("b")), (7, text("c")), (9, text("e"))}


@pytest.mark.parametrize("m", [2, 40, 300])
def test_blocks_lose_no_pair(m):
    """All pairs at the threshold whose first common shingle makes the block are found, bit-sliced or not."""
    rng = np.random.default_rng(m)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([[np.uint64(0)], base[rng.random(60) < 0.93], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for _ in range(m)]
    n = np.array([len(s) for s in sets])
    bits = ss.folded([ss.parity_bits(s) for s in sets])
    assert all(ss.prefix(s, 0.8, *none)[0] == 0 for s in sets)
    zeros = np.zeros(m, np.int64)
    x, y = ss.block_pairs(np.arange(m), n, zeros, np.arange(m), zeros, bits, 0.8)
    want = {(i, j) for j in range(m) for i in range(j) if len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8}
    assert want <= set(zip(x.tolist(), y.tolist())) and (m < 40 or want)


def test_parity_bits_bound_the_difference():
    """Of sets of any two sizes, their bits differ in no more places than the sets."""
    rng = np.random.default_rng(4)
    for size in (1, 100, 511, 513, 1024, 3000):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        for keep, more in ((1.0, 0), (0.9, 3), (0.8, 0), (1.0, size // 4), (0.0, size)):
            b = np.unique(np.concatenate([a[rng.random(len(a)) < keep], rng.integers(0, 2**63, more, dtype=np.uint64)]))
            apart = len(np.setxor1d(a, b))
            got = int(ss.differing([ss.parity_bits(a)], [ss.parity_bits(b)])[0])
            assert got <= apart and got % 2 == apart % 2 and (keep or got > (len(a) + len(b)) / 9)
