"""Quality classifier: a convolutional network over bytes, in numpy.

FILTERS learned filters of WIDTH bytes run over the whole document.  Their outputs are max-pooled over chunks of
2 * CELL bytes that overlap by half; a dense layer makes one logit of each chunk, and a last one combines the mean, the
least and the greatest chunk logit into one probability.  A filter over one-hot bytes is a sum of table rows, so
convolution is WIDTH / 2 look-ups by byte pairs.

The network is fitted on the driver to at most TRAIN_ROWS labelled rows (those of the smallest md5 of the id, with texts
of at most TRAIN_CHARS); everything is scored.  Which rows may be learned from is a function of the id alone.

Cases: null text is empty and gets a score from one chunk of zero bytes; labels that are null are left out, of rows
that repeat an id in labels the greatest counts; without labels of both kinds every score is the share of label 1, or
0.5 without any; repeated rows each give a row; an empty table gives none; a null id counts as the text "null"; a very
long text is scored whole, a chunk at a time; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import id_and_text

FILTERS, WIDTH, CELL = 24, 6, 128
TRAIN_ROWS, TRAIN_CHARS = 2500, 50_000
#: Chunks of a document that one epoch draws, epochs, chunks of a step, and the step size of Adam.
DRAWN, EPOCHS, STEP, RATE = 6, 8, 64, 0.01
#: The score from which a document is predicted to be good.
THRESHOLD = 0.3


@dataclass
class Net:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    shift: float
    last: np.ndarray  # of mean, least, greatest, 1
    constant: float | None = None

    def tables(self) -> list[np.ndarray]:
        """For each pair of filter positions the sums for all byte pairs."""
        return [(self.filters[j][:, None, :] + self.filters[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, WIDTH, 2)]


def padded(text: str) -> np.ndarray:
    """The text's bytes, and as many zeros as let a filter start at each of them, and at one at least."""
    raw = text.encode()
    return np.frombuffer(raw + bytes(WIDTH - 1 + (not raw)), np.uint8)


def pooled(raw: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """(chunks, FILTERS): each filter's maximum in every chunk of two neighbouring cells."""
    pairs = raw[:-1].astype(np.intp) << 8 | raw[1:]
    n = len(raw) - WIDTH + 1
    cells = np.empty((-(-n // CELL), tables[0].shape[1]), np.float32)
    block = 64 * CELL
    for at in range(0, n, block):
        to = min(n, at + block)
        out = tables[0].take(pairs[at:to], axis=0)
        for k, table in enumerate(tables[1:], 1):
            out += table.take(pairs[at + 2 * k : to + 2 * k], axis=0)
        cells[at // CELL : -(-to // CELL)] = np.maximum.reduceat(out, np.arange(0, to - at, CELL), axis=0)
    return np.maximum(cells[:-1], cells[1:]) if len(cells) > 1 else cells


def chunk_logits(raw: np.ndarray, net: Net, tables: list[np.ndarray]) -> np.ndarray:
    return np.maximum(pooled(raw, tables) + net.bias, 0) @ net.dense + net.shift


def combined(logits: np.ndarray) -> np.ndarray:
    return np.clip(np.array([logits.mean(), logits.min(), logits.max(), 1.0]), -30, 30)


def score(text: str, net: Net, tables: list[np.ndarray]) -> float:
    if net.constant is not None:
        return net.constant
    return float(1 / (1 + np.exp(-np.clip(combined(chunk_logits(padded(text), net, tables)) @ net.last, -30, 30))))


def fit(texts: list[str], labels: list[int], seed: int = 0) -> Net:
    """Chunks learn their document's label by Adam; then the last layer is fitted to whole documents by Newton's method."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    net = Net(rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0, np.array([1.0, 0, 0, 0]))
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    raws = [padded(t) for t in texts]
    size = 2 * CELL + WIDTH - 1
    params = [net.filters, net.bias, net.dense, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    # both labels weigh alike while chunks learn; the last layer restores the true share
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    steps = 0
    for _ in range(EPOCHS):
        rows, of = [], []
        for d, raw in enumerate(raws):
            cells = -(-(len(raw) - WIDTH + 1) // CELL)
            for c in rng.integers(0, max(1, cells - 1), min(DRAWN, max(1, cells - 1))):
                piece = raw[c * CELL : c * CELL + size]
                rows.append(np.pad(piece, (0, size - len(piece)), mode="edge") if len(piece) < size else piece)
                of.append(d)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), STEP):
            pick = order[at : at + STEP]
            x, docs = np.stack([rows[i] for i in pick]), np.array([of[i] for i in pick])
            n = x.shape[1] - WIDTH + 1
            out = params[0][0].take(x[:, :n], axis=0)
            for j in range(1, WIDTH):
                out += params[0][j].take(x[:, j : j + n], axis=0)
            place = out.argmax(1)  # (chunks, filters)
            top = np.take_along_axis(out, place[:, None, :], 1)[:, 0]
            hidden = np.maximum(top + params[1], 0)
            logit = hidden @ params[2] + params[3][0]
            slope = (1 / (1 + np.exp(-logit)) - y[docs]) * weight[docs] / len(pick)
            back = slope[:, None] * params[2] * (hidden > 0)
            grads = [np.zeros_like(params[0]), back.sum(0), hidden.T @ slope, np.array([slope.sum()], np.float32)]
            which = np.arange(FILTERS)[None, :]
            for j in range(WIDTH):
                np.add.at(grads[0][j], (np.take_along_axis(x, place + j, 1), np.broadcast_to(which, place.shape)), back)
            steps += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    net.filters, net.bias, net.dense, net.shift = params[0], params[1], params[2], float(params[3][0])
    tables = net.tables()
    z = np.stack([combined(chunk_logits(raw, net, tables)) for raw in raws])
    last = np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ last, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(4)
        last += np.linalg.solve(hessian, z.T @ (y - p) - 0.5 * last)
    net.last = last
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % 5 == 0


def training_sample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[list[str], list[int]]:
    """At most TRAIN_ROWS texts of at most TRAIN_CHARS and their labels; of rows that repeat an id the least text."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    y = y.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    y = y.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(TRAIN_ROWS)
    texts = id_and_text(df, id_col, text_col).filter(F.length("text") <= TRAIN_CHARS)
    one = texts.join(F.broadcast(y), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("one"))
    rows = one.select("doc_id", "one.*").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    return [r[1] for r in rows], [int(r[2] > 0) for r in rows]


_tables: dict[bytes, list[np.ndarray]] = {}


def score_documents(df: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, score: every whole text scored.  The network travels with the task: 150 KB whatever the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = net.filters.tobytes()
        if key not in _tables:
            _tables.clear()
            _tables[key] = net.tables()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([score(t.as_py(), net, _tables[key]) for t in b.column(1)], pa.float64())], names=["doc_id", "score"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def good_documents(df: DataFrame, net: Net, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df with a score of threshold or more, with all their columns, in one pass."""
    schema = df.schema
    at = [f.name for f in schema].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = net.filters.tobytes()
        if key not in _tables:
            _tables.clear()
            _tables[key] = net.tables()
        for b in batches:
            yield b.filter(pa.array([score(t.as_py() or "", net, _tables[key]) >= threshold for t in b.column(at)], pa.bool_()))

    return df.mapInArrow(run, schema)
