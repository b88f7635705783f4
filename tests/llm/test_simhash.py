import re

import numpy as np
import pytest
import xxhash

from namesake.llm import simhash as sh
from namesake.llm.components import connected_components

from .conftest import LONG, ROWS, table


def brute(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(prints, radius):
    label = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius:
                    label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("text", ["", " \n", "a", "a b", "a B c", "É a\x1cb c d", "x " * 5000, LONG])
def test_fingerprint(text):
    assert int.from_bytes(sh.simhash(text), "little") == brute(text)


def random_prints(rng, m, words, radius):
    p = rng.integers(0, 2**63, (m, words), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (m, words), dtype=np.uint64)
    for i in range(m // 2):
        p[i] = p[rng.integers(m // 2, m)]
        for b in rng.choice(words * 64, rng.integers(0, radius + 2), replace=False):
            p[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    return p


@pytest.mark.parametrize("m,words,radius", [(2, 1, 2), (70, 1, 2), (300, 8, 110), (64, 8, 3), (600, 1, 18)])
def test_bit_sliced_distances(m, words, radius):
    p = random_prints(np.random.default_rng(m), m, words, radius)
    d = np.bitwise_count(p[:, None, :] ^ p[None, :, :]).sum(2)
    planes = sh.bit_planes(p)
    got = {(min(i, j), max(i, j)) for first in range(0, m, 256) for i, lanes in sh.near_lanes(p, planes, first, min(m, first + 256), radius) for j in lanes.tolist()}
    assert got == {(i, j) for i in range(m) for j in range(i + 1, m) if d[i, j] <= radius}


def test_keys_share_a_part():
    rng = np.random.default_rng(0)
    keys = sh.pigeonhole_keys(64, 2)
    for _ in range(200):
        flipped = set(rng.choice(64, 2, replace=False).tolist())
        assert any(not flipped & set(k) for k in keys)


def test_near_duplicates(spark, docs, empty, monkeypatch):
    rows = sh.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [brute(t or "") for _, t, _ in order]
    label = components(prints, 2)
    want = sorted((str(i), f"{p:016x}", str(order[label[k]][0])) for k, ((i, _, _), p) in enumerate(zip(order, prints)))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in rows) == want
    assert sh.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("limit", [8192, 40])
def test_links_lose_none(spark, monkeypatch, limit):
    """Also where blocks are over the limit and are compared by pairs of pieces."""
    monkeypatch.setattr(sh, "BLOCK_LIMIT", limit)
    rng = np.random.default_rng(5)
    p = np.unique(random_prints(rng, 300, 1, 2)[:, 0] & np.uint64(0xFFFF00000000FFFF))
    classes = spark.createDataFrame([(i, int(v).to_bytes(8, "little"), 1) for i, v in enumerate(p.tolist())], "class_id long, fingerprint binary, weight long")
    found = {r["node"]: r["component"] for r in connected_components(sh.links(classes, sh.pigeonhole_keys(64, 2), 2)).collect()}
    want = components(p.tolist(), 2)
    assert [found.get(i, i) for i in range(len(p))] == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (200, 100)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_near_copies(spark, empty):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    texts = [[word() for _ in range(200)] for _ in range(12)]
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    for i, t in enumerate(texts[:6]):
        near = list(t)
        near[60 + i] = "changed"
        rows.append((100 + i, " ".join(near), "b"))
    rows += [(300, None, "a"), (301, "", "a"), (302, "short", "a")]
    df = table(spark, rows)
    kept = sh.without_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(12), 300, 302]
    assert sh.without_near_copies(empty).count() == 0
