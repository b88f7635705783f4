"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint has bit i set if more than half of its shingles' hashes have it.  Fingerprints are dealt into
blocks by keys, that is by some of their bits.  Within a block the bits are stored vertically, a plane of lanes for
each position.  The distances from one fingerprint to 64 others grow at once: carry-save adders count the differing
planes into vertical counters, and a word of 64 lanes is abandoned once all of its lanes exceed the radius.

`pigeonhole_keys` are exact: of radius + 3 parts of the bits at least three agree for a link, so every choice of three
parts is a key.  Links of a block are given as a spanning forest, never as all pairs; a block
over BLOCK_LIMIT is cut into sub-blocks of which each pair is compared, so that none is lost.

Cases: null text is empty; a text without words has fingerprint zero and links like any other; with fewer words than a
shingle the whole sequence is the one shingle; equal fingerprints are one class; rows that repeat an id are each kept
name one class; an empty table gives none; null ids lose to any other; a very long text is one row's work, its
shingles' hashes in memory at once; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import id_and_text, joined_back, materialise, shuffle_parts
from namesake.llm.components import connected_components

#: Most fingerprints that are compared in one piece; larger blocks are compared by pairs of halves of it.
BLOCK_LIMIT = 8192
SEED = 42
_ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of so many words, joined by single spaces; A-Z is lower-cased."""
    from xxhash import xxh64_intdigest

    found = text.encode().translate(_ASCII_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = (np.concatenate([[0], ends[:-1] + 1])[: len(found) - words + 1]).tolist()
    return np.fromiter([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64, len(starts))


def add_planes(planes: list[np.ndarray], counters: list[np.ndarray]) -> None:
    """Adds 16 planes to the vertical counters (lowest first): 15 carry-save adders and one ripple."""
    weight = 0
    while len(planes) > 1 or weight < len(counters):
        if weight == len(counters):
            counters.append(np.zeros_like(planes[0]))
        low, carries = counters[weight], []
        for a, b in zip(planes[::2], [*planes[1::2], None][: -(-len(planes) // 2)], strict=True):
            if b is None:
                carries.append(low & a)
                low = low ^ a
            else:
                u = a ^ b
                carries.append((a & b) | (u & low))
                low = u ^ low
        counters[weight] = low
        planes, weight = carries, weight + 1
        if not planes:
            return
    if planes:
        counters.append(planes[0])


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes.  Lanes are the 64 positions, planes the hashes."""
    n = len(hashes)
    if not n:
        return 0
    ones = lambda words: np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    if n < 1024:
        total = ones(hashes)
    else:
        # 16 rows of the table are added at once into columns of counters, which are summed last
        counters: list[np.ndarray] = []
        columns = min(256, n // 16)
        rest = n % columns
        table = hashes[: n - rest].reshape(-1, columns)
        for at in range(0, len(table), 16):
            add_planes(list(table[at : at + 16]), counters)
        total = sum((ones(np.ascontiguousarray(plane)) << weight for weight, plane in enumerate(counters)), ones(hashes[n - rest :]))
    tops = 0
    for i in np.flatnonzero(2 * total > n).tolist():
        tops |= 1 << i
    return tops


def remix(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Another 64 bits for each hash, for fingerprints of more words; salt 0 leaves them."""
    if not salt:
        return hashes
    h = hashes ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def simhash(text: str, words: int = 3, size: int = 64, distinct: bool = False) -> bytes:
    """The fingerprint of `size` bits, 8 little-endian bytes for each 64; distinct: repeated shingles count once."""
    h = shingle_hashes(text, words)
    if distinct:
        h = np.unique(h)
    return b"".join(majority_bits(remix(h, i)).to_bytes(8, "little") for i in range(size // 64))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, size: int = 64, distinct: bool = False) -> DataFrame:
    """doc_id, fingerprint (binary) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([simhash(t.as_py(), words, size, distinct) for t in b.column(1)], pa.binary())], names=["doc_id", "fingerprint"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint binary")


def pigeonhole_keys(size: int, radius: int) -> list[list[int]]:
    """Positions of the bits of each key: a link within the radius shares at least one key exactly."""
    parts = [[int(b) for b in x] for x in np.array_split(np.arange(size), radius + 3)]
    return [sum(chosen, []) for chosen in itertools.combinations(parts, 3)]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(fingerprints, words) -> (bits, lanes / 64): bit i of every fingerprint side by side."""
    m, words = prints.shape
    bits = np.unpackbits(prints.view(np.uint8).reshape(m, words * 8), axis=1, bitorder="little")
    lanes = np.zeros((words * 64, -(-m // 64) * 64), np.uint8)
    lanes[:, :m] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view(np.uint64)


def exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose vertical count is over the radius: compared from the highest counter down."""
    over = np.zeros_like(counters[0])
    equal = ~over
    for weight in range(max(len(counters), radius.bit_length()) - 1, -1, -1):
        plane = counters[weight] if weight < len(counters) else np.zeros_like(over)
        if radius >> weight & 1:
            equal = equal & plane
        else:
            over |= equal & plane
            equal = equal & ~plane
    return over


def near_lanes(prints: np.ndarray, planes: np.ndarray, first: int, last: int, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """For the fingerprints first..last of a block: those from its word of lanes on that are within the radius."""
    size, width = planes.shape
    begin = first // 64
    own = np.unpackbits(prints[first:last].view(np.uint8).reshape(last - first, -1), axis=1, bitorder="little")
    masks = np.ascontiguousarray(np.where(own.T, ~np.uint64(0), np.uint64(0)))  # (bits, queries)
    shape = (last - first, width - begin)
    rows = np.repeat(np.arange(shape[0]), shape[1])
    cols = np.tile(np.arange(begin, width), shape[0])
    counters: list[np.ndarray] = []
    dense, step = True, 16
    # no word can be abandoned before radius + 1 planes, and few unrelated ones are left after 2.5 times as many
    check = min(size, -(-int(2.5 * radius + 16) // step) * step)
    for at in range(0, size, step):
        if dense:
            block = [(planes[b, begin:][None, :] ^ masks[b][:, None]).ravel() for b in range(at, at + step)]
        else:
            block = [planes[b][cols] ^ masks[b][rows] for b in range(at, at + step)]
        add_planes(block, counters)
        done = at + step
        if done >= check and done < size and (done - check) % 64 == 0:
            alive = exceeds(counters, radius) != ~np.uint64(0)
            if not alive.any():
                return
            if alive.mean() < 0.8:
                rows, cols, dense = rows[alive], cols[alive], False
                counters = [c[alive] for c in counters]
    within = ~exceeds(counters, radius)
    hit = np.flatnonzero(within)
    where, lane = np.nonzero(np.unpackbits(within[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    query, lanes = rows[hit[where]] + first, cols[hit[where]] * 64 + lane
    real = (lanes < len(prints)) & (lanes != query)
    query, lanes = query[real], lanes[real]
    edges = np.flatnonzero(np.diff(query)) + 1
    for i, found in zip(query[np.concatenate([[0], edges])].tolist() if len(query) else [], np.split(lanes, edges), strict=False):
        yield i, found


def block_forest(ids: np.ndarray, prints: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links in a block: pairs of ids."""
    m = len(ids)
    label = np.arange(m)
    planes = bit_planes(prints)
    for first in range(0, m, 256):
        for i, lanes in near_lanes(prints, planes, first, min(m, first + 256), radius):
            found = label[lanes]
            low = min(int(found.min()), int(label[i]))
            if low == found.max() and low == label[i]:
                continue
            label[np.isin(label, np.unique(np.append(found, label[i])))] = low
    out = np.flatnonzero(label != np.arange(m))
    return ids[out].tolist(), ids[label[out]].tolist()


def links(classes: DataFrame, keys: list[list[int]], radius: int) -> DataFrame:
    """a, b: links between classes (class_id long, fingerprint binary), a spanning forest for each block."""
    spark = classes.sparkSession

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = [np.array(k) for k in keys]
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            raw = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(m, -1)
            bits = np.unpackbits(raw, axis=1, bitorder="little")
            for i, k in enumerate(chosen):
                value = np.zeros(m, np.int64)
                for at in k:
                    value = value << 1 | bits[:, at]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, i, np.int32)), pa.array(value), *b.columns], names=["band", "key", "class_id", "fingerprint"])

    rows = classes.select("class_id", "fingerprint").mapInArrow(keyed, "band int, key long, class_id long, fingerprint binary")
    sizes = rows.groupBy("band", "key").count()
    large = materialise(sizes.filter(F.col("count") > BLOCK_LIMIT), "large-blocks")
    if large.limit(1).count():
        half = BLOCK_LIMIT // 2
        rows = rows.join(large, ["band", "key"], "left").withColumn("pieces", F.coalesce(F.ceil(F.col("count") / half), F.lit(1)).cast("int"))
        rows = rows.withColumn("piece", F.pmod(F.xxhash64("class_id"), F.col("pieces")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        rows = rows.withColumns({"low": F.least("piece", "other"), "high": F.greatest("piece", "other")})
    else:
        rows = rows.withColumns({"low": F.lit(0), "high": F.lit(0)})
    blocks = rows.groupBy("band", "key", "low", "high").agg(F.collect_list("class_id").alias("ids"), F.collect_list("fingerprint").alias("prints")).filter(F.size("ids") > 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_side, b_side = [], []
            for ids, prints in zip(b.column(0), b.column(1), strict=True):
                number = ids.values.to_numpy(zero_copy_only=False)
                x, y = block_forest(number, np.frombuffer(b"".join(prints.values.to_pylist()), np.uint64).reshape(len(number), -1), radius)
                a_side += x
                b_side += y
            yield pa.RecordBatch.from_arrays([pa.array(a_side, pa.int64()), pa.array(b_side, pa.int64())], names=["a", "b"])

    found = blocks.select("ids", "prints").repartition(shuffle_parts(spark)).mapInArrow(compare, "a long, b long")
    return materialise(found.distinct(), "links")


def named(doc_id: Column) -> Column:
    return F.when(doc_id.isNull(), F.lit(2**63 - 1)).otherwise(doc_id)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: 64-bit fingerprints that differ in at most `radius` bits link,
    exactly; a component has its smallest doc_id."""
    prints = materialise(fingerprints(df, id_col, text_col, words), "simhash")
    classes = materialise(prints.groupBy("fingerprint").agg(F.min(named(F.col("doc_id"))).alias("class_id")).select("class_id", "fingerprint"), "classes")
    component = connected_components(links(classes, pigeonhole_keys(64, radius), radius))
    by_print = classes.join(component, classes["class_id"] == component["node"], "left").select("fingerprint", F.coalesce("component", "class_id").alias("component_id"))
    out = joined_back(prints, by_print, "fingerprint", "doc_id")
    text = F.lower(F.concat(*[F.hex(F.substring("fingerprint", i, 1)) for i in range(8, 0, -1)]))
    return out.select("doc_id", text.alias("fingerprint"), F.nullif("component_id", F.lit(2**63 - 1)).alias("component_id"))


def without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of df that stay, one of each component of texts that are exactly as similar, with all their columns."""
    from namesake.llm import shingle_sets  # which compares by the bit planes of this module

    return shingle_sets.without_near_copies(df, id_col, text_col, words, similarity)
