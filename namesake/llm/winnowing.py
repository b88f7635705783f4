"""Document fingerprints by winnowing.

Every k code points get a rolling hash; of each window of w hashes the smallest is chosen, the rightmost among equal
ones, and its position is kept.  So any passage of k + w - 1 code points that two texts share gives both a common
fingerprint, and nothing shorter than k can match.  A text shorter than k is one gram of its own length.

Cases: null text is empty, with the empty fingerprint; two empty fingerprints are alike (1), an empty and another not
(0); repeated rows each give a row; an empty table gives none; null ids sort first; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import id_and_text, ordered_bucket, shuffle_parts

#: Code points of a gram, and hashes of a window: passages of K + W - 1 = 100 code points are sure to be found.
K, W = 24, 77
BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32 bits for each k neighbours: a polynomial in BASE, built by doubling, then mixed."""
    h, width, done = codes.astype(np.uint64) + np.uint64(1), 1, None
    base, have = int(BASE), 0
    power = base
    while width <= k:
        if k & width:
            part = h
            if done is None:
                done, have = part, width
            else:
                n = len(codes) - have - width + 1
                done = done[:n] * np.uint64(pow(base, width, 1 << 64)) + part[have : have + n]
                have += width
        if 2 * width <= k:
            h = h[: len(h) - width] * np.uint64(power) + h[width:]
            power = power * power & _MASK
        width *= 2
    done = done ^ (done >> np.uint64(29))
    done = done * np.uint64(0xBF58476D1CE4E5B9)
    return done >> np.uint64(32)


def window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours: of the rest of one block and the start of the next."""
    n = len(keys)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.uint64(_MASK))
    padded[:n] = keys
    rows = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    rest = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rest[: n - w + 1], ahead[w - 1 : n])


def winnow(text: str, k: int = K, w: int = W) -> np.ndarray:
    """Chosen (hash << 32 | position), by position.  Texts are at most 2**32 - 1 code points long."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.zeros(0, np.uint64)
    h = gram_hashes(codes, min(k, len(codes)))
    late = np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64)  # smallest for the rightmost
    best = window_minima((h << np.uint64(32)) | late, min(w, len(h)))
    keep = np.ones(len(best), bool)
    keep[1:] = best[1:] != best[:-1]
    best = best[keep]
    return (best & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - (best & np.uint64(0xFFFFFFFF)))


def written(chosen: np.ndarray) -> str:
    """hash:position pairs in order of position, hashes as 8 hex digits."""
    return ",".join([f"{x >> 32:08x}:{x & 0xFFFFFFFF}" for x in chosen.tolist()])


def hashes(chosen: np.ndarray) -> np.ndarray:
    return np.unique(chosen >> np.uint64(32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """doc_id, marks (array of hash, position): the fingerprint of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())]))
        for b in batches:
            marks = [[{"hash": x >> 32, "position": x & 0xFFFFFFFF} for x in winnow(t, k, w).tolist()] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, kind)], names=["doc_id", "marks"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, marks array<struct<hash:long,position:long>>")


def beside_next(df: DataFrame, parts: int) -> DataFrame:
    """bucket, tail, doc_id, text in order within each partition; a bucket ends with the first row of the next one (tail).

    One shuffle by ranges of doc_id.  Only a row for each bucket is sent twice; the last bucket gets the first row of all.
    """
    rows = df.withColumn("bucket", ordered_bucket(df, "doc_id", parts))
    first = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("head"))
    there = sorted(r[0] for r in rows.select("bucket").distinct().collect())
    if there:
        before = F.create_map(*[F.lit(x) for pair in zip(there, [there[-1], *there[:-1]], strict=True) for x in pair])
        first = first.select(before[F.col("bucket")].alias("bucket"), F.lit(1).alias("tail"), "head.doc_id", "head.text")
        rows = rows.select("bucket", F.lit(0).alias("tail"), "doc_id", "text").unionByName(first)
        rows = rows.repartitionById(max(there) + 1, F.col("bucket"))
    else:
        rows = rows.select("bucket", F.lit(0).alias("tail"), "doc_id", "text")
    return rows.sortWithinPartitions("bucket", "tail", "doc_id", "text")


def edited_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text, of its edited text and how near they and the next document's are.

    The edited text has its last quarter (rounded down) replaced by as many first code points of the next document in
    order of doc_id, or all it has; the first document follows the last.  Equal ids are ordered by text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = []
        last = None  # (bucket, doc_id, text, fingerprint, its hashes, its string)

        def row(now, text, chosen):
            cut = len(now[2]) // 4
            edit = now[2][: len(now[2]) - cut] + text[:cut]
            other = winnow(edit, k, w) if cut else now[3]
            kept.append([now[1], len(now[2]), sha256(edit.encode()).hexdigest(), now[5], written(other) if cut else now[5], likeness(now[4], hashes(other)), likeness(now[4], chosen)])

        for b in batches:
            for bucket, tail, doc, text in zip(*(b.column(i) for i in range(4)), strict=True):
                bucket, tail, doc, text = bucket.as_py(), tail.as_py(), doc.as_py(), text.as_py()
                if tail and (last is None or last[0] != bucket):
                    continue
                mark = winnow(text, k, w)
                own = hashes(mark)
                if last is not None and last[0] == bucket:
                    row(last, text, own)
                last = None if tail else (bucket, doc, text, mark, own, written(mark))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), KINDS, strict=True)], names=NAMES)
                kept.clear()

    parts = shuffle_parts(df.sparkSession)
    return beside_next(id_and_text(df, id_col, text_col), parts).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
