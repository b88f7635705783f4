import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from namesake.llm import chunk_store as cs
from namesake.llm.words import library, vocabulary_path

from .conftest import ROWS, table


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    return cs.write_store(docs, f"file://{tmp_path_factory.mktemp('store')}/s")


def test_documents(spark, stored):
    tok = library(vocabulary_path())
    got = sorted(cs.verified_documents(spark, stored).collect(), key=lambda r: r["start"])
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = {}
    for doc, text, _ in ROWS:
        ids.setdefault(doc, []).append([*tok.encode(text or "", add_special_tokens=False).ids, cs.END_ID])
    start = 0
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    for row in got:
        want = ids[row["doc_id"]][0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += row["n_tokens"]
    full = {r["start"]: r["ids"] for r in cs.read_documents(spark, stored).collect()}
    assert all(full[r["start"]] == ids[r["doc_id"]][0] for r in got)


def test_each_chunk_is_stored_once(spark, stored):
    objects = spark.read.parquet(f"{stored}/objects").filter("kind = 1")
    assert objects.count() == objects.select("digest").distinct().count()
    used = cs.recipes(spark, stored).select(F.explode("digests").alias("d")).distinct()
    assert used.count() == objects.count()


def test_manifest(spark, stored):
    rows = cs.recipes(spark, stored).orderBy("start").collect()
    by_bucket = {}
    for r in rows:
        by_bucket.setdefault(r["bucket"], []).append(bytes(r["root"]))
    found = {r["bucket"]: (bytes(r["root"]), r["documents"]) for r in spark.read.parquet(f"{stored}/manifest").collect()}
    assert {b: n for b, (_, n) in found.items()} == {b: len(x) for b, x in by_bucket.items()}
    for b, leaves in by_bucket.items():
        if len(leaves) & (len(leaves) - 1) == 0:
            assert found[b][0] == cs.merkle_root(leaves)
    assert len(cs.store_root(spark, stored)) == 32


def test_damage_is_noticed(spark, docs, tmp_path):
    path = cs.write_store(docs.filter("doc_id < 3"), f"file://{tmp_path}/s")
    objects = spark.read.parquet(f"{path}/objects").filter("kind = 1").withColumn("data", F.concat("data", F.lit(b"\0\0")))
    objects.drop("kind").write.mode("overwrite").parquet(f"{path}/bad/objects/kind=1")
    with pytest.raises(Exception, match="damaged"):
        cs.read_chunks(spark, f"{path}/bad").collect()


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 49000, n).astype("<u4") for n in (8000, 1000, 1777))

    def chunks(ids):
        marks = (np.flatnonzero(cs.rolling(ids) % np.uint64(cs.MEAN) == 0) + 1).tolist()
        ends = cs.cut_points(marks, 0, len(ids))
        assert ends[-1] == len(ids) and all(y - x <= cs.MOST for x, y in zip([0, *ends], ends))
        return {ids[x:y].tobytes() for x, y in zip([0, *ends], ends)}

    x, y = chunks(np.concatenate([a, shared])), chunks(np.concatenate([b, shared]))
    assert len(x & y) >= 0.6 * min(len(x), len(y))


def test_crc_of_parts():
    data = bytes(range(256)) * 9
    cuts = [0, 4, 400, 404, 2304]
    assert cs.crc_join([(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]) == zlib.crc32(data)


def test_empty_table(spark, empty, tmp_path):
    path = cs.write_store(empty, f"file://{tmp_path}/s")
    assert cs.verified_documents(spark, path).count() == 0 and cs.read_documents(spark, path).count() == 0


def test_without_an_end_id(spark, docs, tmp_path):
    """Empty documents have recipes without chunks, and no document is lost."""
    path = cs.write_store(docs, f"file://{tmp_path}/s", end_id=None)
    tok = library(vocabulary_path())
    want = sorted(tok.encode(t or "", add_special_tokens=False).ids for _, t, _ in ROWS)
    assert sorted(r["ids"] for r in cs.read_documents(spark, path).collect()) == want
    got = sorted(r["ids_crc32"] for r in cs.verified_documents(spark, path).collect())
    assert got == sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in want)


def test_lost_recipes_and_chunks_are_noticed(spark, docs, tmp_path):
    path = cs.write_store(docs.filter("doc_id < 9"), f"file://{tmp_path}/s")
    spark.read.parquet(f"{path}/recipes").filter("doc_id != 4").write.parquet(f"{path}/less/recipes")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{path}/less/manifest")
    spark.read.parquet(f"{path}/objects").write.partitionBy("kind").parquet(f"{path}/less/objects")
    for read in (cs.verified_documents, cs.read_documents):
        with pytest.raises(ValueError, match="manifest"):
            read(spark, f"{path}/less")
    some = spark.read.parquet(f"{path}/objects").filter("kind = 1").orderBy("digest").limit(1).select("digest").first()[0]
    for name in ("recipes", "manifest"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{path}/few/{name}")
    spark.read.parquet(f"{path}/objects").filter(F.col("digest") != F.lit(some)).write.partitionBy("kind").parquet(f"{path}/few/objects")
    for read in (cs.verified_documents, cs.read_documents):
        with pytest.raises(Exception, match="does not match its root"):
            read(spark, f"{path}/few").collect()


def test_wide_ids(spark, tmp_path):
    """An end id beyond 2 bytes makes ids of 4."""
    path = cs.write_store(table(spark, [(1, "a b c", "x"), (2, "", "x")]), f"file://{tmp_path}/s", end_id=70000)
    rows = {r["doc_id"]: r["ids"] for r in cs.read_documents(spark, path).collect()}
    assert rows[2] == [70000] and rows[1][-1] == 70000 and len(rows[1]) == 4


def test_marks_in_blocks_are_those_of_the_whole():
    ids = np.random.default_rng(3).integers(0, 49000, 3 * cs.BLOCK + 77).astype("<u2")
    for some in (ids, ids[: cs.BLOCK], ids[:5], ids[:0]):
        want = np.flatnonzero(cs.rolling(some) % np.uint64(cs.MEAN) == 0) + 1
        assert cs.cut_marks(some).tolist() == want.tolist()


def test_crcs_of_many_documents():
    """Documents without parts, with empty parts and with many bytes behind a part."""
    rng = np.random.default_rng(4)
    docs = [[rng.bytes(int(n)) for n in sizes] for sizes in ([], [0], [5], [7, 0, 300_000, 1], [], [4] * 50, [0, 0], [1_000_000, 3])]
    parts = [p for d in docs for p in d]
    crcs, sizes = np.array([zlib.crc32(p) for p in parts]), np.array([len(p) for p in parts])
    assert cs.joined_crcs(crcs, sizes, np.array([len(d) for d in docs])).tolist() == [zlib.crc32(b"".join(d)) for d in docs]
    assert cs.joined_crcs(crcs[:0], sizes[:0], np.array([], np.int64)).tolist() == [] and cs.crc_join([]) == 0
