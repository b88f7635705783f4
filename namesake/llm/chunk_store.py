"""Content-addressed store of token ids.

A rolling hash over the last WINDOW ids cuts each document's id stream into chunks, so equal passages give equal chunks
wherever they stand.  A chunk's SHA-256 is its address and each is stored once; a document is a recipe, the list of its
chunks' addresses, and has the Merkle root over them.  A manifest holds a root for each range of documents and one over
these.  Reading verifies every chunk against its address, every document against its root and every range of
documents against the manifest.

Layout under one path: objects/kind=1 (digest, data; in the order of the addresses' hashes), recipes (bucket, nth,
doc_id, start, n_tokens, digests, root; files in ascending order of doc_id), manifest (bucket, first_doc, documents, ids,
root).  A chunk's data are ids of 2 bytes each where the vocabulary has at most 65,536, else a byte 255 and ids of 4.

Cases: null text is empty and holds the end id alone (without an end id: nothing, with a recipe of no chunks); rows that
repeat a doc_id each have a recipe, ordered by root; an empty table gives an empty store; null ids sort first; further
columns are ignored; a very long text is one document of many chunks, encoded in one task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namesake.llm.common import id_and_text, ordered_bucket, shuffle_parts, work_dir
from namesake.llm.words import encoder, vocabulary_path

#: Ids that decide a cut, least, mean (a power of two) and most ids of a chunk.
WINDOW, LEAST, MEAN, MOST = 16, 128, 512, 4096
#: Bytes of text that are encoded and cut at a time, and ids that are hashed at a time.
SLICE_BYTES, BLOCK = 8 << 20, 1 << 14
#: Addresses a task remembers so as not to send a chunk again; others are dropped after the exchange.
SEEN = 300_000
END_ID = 1
MISMATCH = "a document does not match its root"


def rolling(ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """At i a hash of the last `window` ids up to i, by doubling; the first window - 1 entries are of fewer."""
    return _sums(ids, window) >> np.uint64(40)


def _sums(ids: np.ndarray, window: int) -> np.ndarray:
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    base, width = 0xD1B54A32D192ED03, 1
    while width < window:
        shifted = h[:-width] * np.uint64(base)
        h[width:] += shifted
        base, width = base * base & (1 << 64) - 1, 2 * width
    return h


def cut_marks(ids: np.ndarray, window: int = WINDOW, mean: int = MEAN) -> np.ndarray:
    """Positions after which the rolling hash asks for a cut.  Hashes are made for BLOCK ids at a time, which a processor's
    cache holds, after the window - 1 ids before them."""
    low, found = np.uint64((mean - 1) << 40), [np.zeros(0, np.int64)]
    for at in range(0, len(ids), BLOCK):
        before = min(at, window - 1)
        found.append(np.flatnonzero(_sums(ids[at - before : at + BLOCK], window)[before:] & low == 0) + at + 1)
    return np.concatenate(found)


def cut_points(marks: list[int], start: int, end: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of ids[start:end]; marks: ascending positions after which the rolling hash asks for a cut."""
    ends, at = [], start
    for m in [*marks, end]:
        while m - at > most:
            at += most
            ends.append(at)
        if m - at >= least and m < end:
            at = m
            ends.append(at)
    if at < end:
        ends.append(end)
    return ends


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairs are hashed with a prefix that no leaf has; an odd one moves up as it is; no leaves: the hash of nothing."""
    level = list(leaves) or [sha256(b"").digest()]
    while len(level) > 1:
        level = [sha256(b"\x01" + b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the CRC-32 polynomial, bits reflected."""
    p = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            p ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return p


@lru_cache(64)
def _doubled(k: int) -> np.ndarray:
    """For each byte of a CRC and each of its 256 values the product with x to the power 8 * 2 ** k."""
    square = 1 << 23
    for _ in range(k):
        square = _times(square, square)
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            out[byte, 1 << bit : 2 << bit] = out[byte, : 1 << bit] ^ np.uint32(_times(square, 1 << 8 * byte + bit))
    return out


def joined_crcs(crcs: np.ndarray, n_bytes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation; crcs and n_bytes: of the parts of all, one after another; counts: parts of each."""
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    until = np.concatenate([[0], np.cumsum(n_bytes)]).astype(np.int64)
    behind = np.repeat(until[bounds[1:]], counts) - until[1:]
    moved = crcs.astype(np.uint32)
    for k in range(int(behind.max(initial=0)).bit_length()):
        at = np.flatnonzero(behind >> k & 1)
        table, crc = _doubled(k), moved[at]
        moved[at] = table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]
    out = np.zeros(len(counts), np.uint32)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = np.bitwise_xor.reduceat(moved, bounds[some])
    return out


def crc_join(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from (CRC-32, bytes) of its parts."""
    crcs, sizes = np.array(parts, np.int64).reshape(-1, 2).T
    return int(joined_crcs(crcs, sizes, np.array([len(parts)]))[0])


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> np.ndarray:
    """The ids of documents one after another, each with the end id behind it."""
    if end_id is None:
        return ids
    out = np.empty(len(ids) + len(counts), ids.dtype if end_id < 1 << 8 * ids.dtype.itemsize else "<u4")
    ends = np.cumsum(counts) + np.arange(len(counts))
    own = np.ones(len(out), bool)
    own[ends] = False
    out[own], out[ends] = ids, end_id
    return out


def write_store(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int | None = END_ID) -> str:
    """Encodes every text, appends end_id (None: nothing) and writes the store.  One exchange carries the chunks' bytes."""
    spark, vocabulary = df.sparkSession, vocabulary or vocabulary_path()
    parts = shuffle_parts(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, seen, rows, task = encoder(vocabulary), set(), 0, TaskContext.get().partitionId()
        for b in batches:
            for at, ids, counts in encode.batches(b.column(1), SLICE_BYTES):
                names = ("kind", "digest", "data", "doc_id", "n_tokens", "digests", "root")
                out = {c: [] for c in names}
                flat = with_end(ids, counts, end_id)
                counts = counts + (end_id is not None)
                wide = flat.dtype.itemsize == 4
                marks = cut_marks(flat)
                raw, width, end = memoryview(flat.tobytes()), flat.dtype.itemsize, 0
                kind, digest, data = out["kind"], out["digest"], out["data"]
                bounds = np.cumsum(counts)
                firsts, lasts = np.searchsorted(marks, bounds - counts, "right").tolist(), np.searchsorted(marks, bounds).tolist()
                marks = marks.tolist()
                for nth, n in enumerate(counts.tolist()):
                    begin, end, addresses = end, end + n, []
                    for stop in cut_points(marks[firsts[nth] : max(firsts[nth], lasts[nth])], begin, end):
                        chunk = raw[width * begin : width * stop]
                        chunk = b"\xff" + chunk if wide else bytes(chunk)
                        begin, address = stop, sha256(chunk).digest()
                        addresses.append(address)
                        if address not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(address)
                            kind.append(1)
                            digest.append(address)
                            data.append(chunk)
                    out["digests"].append(addresses)
                    out["root"].append(merkle_root(addresses))
                chunks, size = len(kind), len(counts)
                kind += [0] * size
                digest += [struct.pack(">IQ", task, rows + i) for i in range(size)]
                data += [None] * size
                rows += size
                none = pa.nulls(chunks, pa.int64())
                doc = pa.concat_arrays([none, b.column(0).slice(at, size)])
                n_tokens = pa.concat_arrays([none, pa.array(counts, pa.int64())])
                lists = pa.array([None] * chunks + out["digests"], pa.list_(pa.binary()))
                roots = pa.array([None] * chunks + out["root"], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(digest, pa.binary()), pa.array(data, pa.binary()), doc, n_tokens, lists, roots], names=list(names))

    found = id_and_text(df, id_col, text_col).mapInArrow(run, "kind int, digest binary, data binary, doc_id long, n_tokens long, digests array<binary>, root binary")
    alone = Window.partitionBy("kind", "digest").orderBy("digest")
    objects = found.repartition(parts, "kind", "digest").withColumn("nth", F.row_number().over(alone)).filter("nth = 1").drop("nth")
    objects.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/objects")

    recipes = spark.read.schema("digest binary, data binary, doc_id long, n_tokens long, digests array<binary>, root binary, kind int").parquet(f"{path}/objects").filter("kind = 0").select("doc_id", "n_tokens", "digests", "root")
    recipes = recipes.withColumn("bucket", ordered_bucket(recipes, "doc_id", parts))
    before, offsets = 0, {}
    for bucket, ids in sorted(recipes.groupBy("bucket").agg(F.sum("n_tokens")).collect()):
        offsets[bucket], before = before, before + ids
    offset = F.create_map(*[F.lit(x) for k, v in offsets.items() for x in (k, v)])[F.col("bucket")] if offsets else F.lit(0)
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "root")
    ahead = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = recipes.withColumns({"start": (offset + F.coalesce(ahead, F.lit(0))).cast("long"), "nth": F.row_number().over(order).cast("long")})
    placed = placed.repartitionById(max(offsets, default=0) + 1, F.col("bucket")).sortWithinPartitions("nth")
    placed.select("bucket", "nth", "doc_id", "start", "n_tokens", "digests", "root").write.parquet(f"{path}/recipes")
    manifest(spark, path).write.parquet(f"{path}/manifest")
    return path


def recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bucket int, nth long, doc_id long, start long, n_tokens long, digests array<binary>, root binary").parquet(f"{path}/recipes")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each range of documents: bucket, first_doc, documents, ids, root over its documents' roots in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # complete subtrees, largest first: (height, hash)
        first, documents, ids, bucket = None, 0, 0, None
        for b in batches:
            for number, doc, n, root in zip(*(c.to_pylist() for c in b.columns), strict=True):
                bucket, first = number, doc if not documents else first
                documents, ids = documents + 1, ids + n
                stack.append([0, root])
                while len(stack) > 1 and stack[-1][0] == stack[-2][0]:
                    (height, right), (_, left) = stack.pop(), stack.pop()
                    stack.append([height + 1, sha256(b"\x01" + left + right).digest()])
        if documents:
            while len(stack) > 1:
                (_, right), (height, left) = stack.pop(), stack.pop()
                stack.append([height + 1, sha256(b"\x01" + left + right).digest()])
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "first_doc": pa.array([first], pa.int64()), "documents": pa.array([documents], pa.int64()), "ids": pa.array([ids], pa.int64()), "root": pa.array([stack[0][1]], pa.binary())})

    rows = recipes(spark, path).select("bucket", "nth", "doc_id", "n_tokens", "root")
    last = rows.agg(F.max("bucket")).first()[0]
    rows = rows.repartitionById((last or 0) + 1, F.col("bucket")).sortWithinPartitions("nth").select("bucket", "doc_id", "n_tokens", "root")
    return rows.mapInArrow(run, "bucket int, first_doc long, documents long, ids long, root binary")


def store_root(spark: SparkSession, path: str) -> bytes:
    """The Merkle root over the manifest's rows, of which there is one for each range."""
    return merkle_root([r[0] for r in spark.read.parquet(f"{path}/manifest").orderBy("bucket").select("root").collect()])


def unpack(chunk: bytes) -> np.ndarray:
    return np.frombuffer(chunk[1:], "<u4") if len(chunk) & 1 else np.frombuffer(chunk, "<u2").astype("<u4")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """digest, n_ids, crc32 (of the ids as 4 bytes each) of every stored chunk; a chunk that fails its address raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, crc = [], []
            for digest, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if sha256(data).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                ids = unpack(data)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["digest", "n_ids", "crc32"])

    return spark.read.schema("digest binary, data binary, kind int").parquet(f"{path}/objects").filter("kind = 1").select("digest", "data").mapInArrow(run, "digest binary, n_ids long, crc32 long")


def checked_recipes(spark: SparkSession, path: str) -> DataFrame:
    """The recipes; ranges whose documents, ids or root are not those of the manifest raise, and so do lost ranges."""
    stored = spark.read.schema("bucket int, first_doc long, documents long, ids long, root binary").parquet(f"{path}/manifest")
    found = manifest(spark, path)
    if stored.exceptAll(found).unionByName(found.exceptAll(stored)).limit(1).count():
        raise ValueError("the recipes do not match the manifest")
    return recipes(spark, path)


def _put_together(spark: SparkSession, path: str, chunks: DataFrame, *fields: str) -> DataFrame:
    """bucket, nth, doc_id, start, n_tokens, root, chunks (nth, digest and fields of every chunk) of every document."""
    rows = checked_recipes(spark, path).select("bucket", "nth", "doc_id", "start", "n_tokens", "root", F.posexplode_outer("digests").alias("at", "digest"))
    whole = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "digest", *fields)))).alias("chunks")
    of_row = [F.first(c).alias(c) for c in ("doc_id", "start", "n_tokens", "root")]
    return rows.join(chunks, "digest", "left").groupBy("bucket", "nth").agg(*of_row, whole).drop("bucket", "nth")


def _check(chunks: list[dict], root: bytes, n: int, sizes: list[int | None]) -> None:
    if None in sizes or merkle_root([c["digest"] for c in chunks]) != root or sum(sizes) != n:
        raise ValueError(MISMATCH)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (array of int) of every document, put together from its chunks.

    Chunks are checked against their addresses, documents against their roots and lengths, ranges against the manifest;
    a chunk that is lost raises too.
    """

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for digest, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if sha256(data).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
            yield b

    data = spark.read.schema("digest binary, data binary, kind int").parquet(f"{path}/objects").filter("kind = 1").select("digest", "data").mapInArrow(verified, "digest binary, data binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = []
            for n, root, row in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                pieces = [None if c["data"] is None else unpack(c["data"]) for c in row]
                _check(row, root, n, [None if p is None else len(p) for p in pieces])
                ids.append(np.concatenate([np.zeros(0, np.uint32), *pieces]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "start", "n_tokens", "ids"])

    return _put_together(spark, path, data, "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def verified_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files: checked as by read_documents.  A document's CRC is joined from
    those of its chunks, so no bytes move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(4)
            counts, chunks = pc.list_value_length(lists).to_numpy(), lists.flatten()
            digest, n_ids, crc32 = (pc.struct_field(chunks, c) for c in ("digest", "n_ids", "crc32"))
            if n_ids.null_count or crc32.null_count:
                raise ValueError(MISMATCH)
            ends, n_ids = np.cumsum(counts), n_ids.to_numpy()
            until = np.concatenate([[0], np.cumsum(n_ids)])
            if (until[ends] - until[ends - counts] != b.column(2).to_numpy()).any():
                raise ValueError(MISMATCH)
            digests = digest.to_pylist()
            for end, n, root in zip(ends.tolist(), counts.tolist(), b.column(3).to_pylist(), strict=True):
                if merkle_root(digests[end - n : end]) != root:
                    raise ValueError(MISMATCH)
            crcs = joined_crcs(crc32.to_numpy(), 4 * n_ids, counts)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crcs.astype(np.int64))], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _put_together(spark, path, read_chunks(spark, path), "n_ids", "crc32").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_documents(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes a store in the shared folder and reads it back, verified."""
    path = write_store(df, work_dir(df.sparkSession, "store"), vocabulary=vocabulary)
    return verified_documents(df.sparkSession, path)
