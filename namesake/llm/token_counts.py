"""Token counts of whole texts; huge documents by overlapping chunks that are spliced where both agree.

A document longer than a chunk is read as chunks that overlap.  The vocabulary's library encodes each with offsets.
Near its cut edges a chunk's tokens may differ from the whole text's, so two chunks are spliced inside their overlap at a
boundary that is proven stable: a space behind a character that is none, which no pre-token and no piece crosses in the
vocabularies that `stable_boundaries` accepts.  The proof is checked at each splice: no token of either chunk crosses
the place, and both give the same ids at the same offsets from there to the next such boundary.  Where an overlap holds
no such place, as in one long word, it is doubled, up to the whole text.

Cases: null text is empty and has 0 tokens; repeated rows each give a row; an empty table gives none; null ids stay
null; further columns are ignored; a very long text is one row's work, in memory a chunk at a time.  Vocabularies
without proven boundaries are counted by their library in one piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from namesake.llm.common import id_and_text
from namesake.llm.words import by_words, encoder, library, vocabulary_path

#: Characters of a chunk and of the overlap that is tried first.
CHUNK, OVERLAP = 32768, 512
#: A space behind a character that is no white space.
BOUNDARY = re.compile(r"(?<=\S) ")
#: ids, and start and end of each token in characters.
Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


def stable_boundaries(path: str) -> bool:
    """Whether no token of a vocabulary can cross a BOUNDARY.

    True for files that encoding by words is proven for; for byte-level files whose pre-tokenizer has white space at the
    start of a pre-token only; and for sentence pieces none of which has its space mark behind another character.
    """
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    pre = t.get("pre_tokenizer") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not t.get("normalizer")
    return by_words(path) or bool(byte_level and not any(" " in a["content"] or a["lstrip"] or a["rstrip"] for a in t["added_tokens"]))


def chunk_encoder(path: str) -> Callable[[str], Tokens]:
    """The library's encoding of a text with offsets."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def encode(text: str) -> Tokens:
            raw = np.frombuffer(text.encode(), np.uint8)
            before = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])  # characters before each byte
            found = sp.encode(text, return_type="proto", num_threads=1).pieces
            rows = np.array([(p.id, p.begin, p.end) for p in found], np.int64).reshape(-1, 3)
            return rows[:, 0], before[rows[:, 1]], before[rows[:, 2]]

        return encode
    tok = library(path)

    def encode(text: str) -> Tokens:
        found = tok.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2)
        return np.array(found.ids, np.int64), spans[:, 0], spans[:, 1]

    return encode


def placed(tokens: Tokens, at: int) -> Tokens:
    return tokens[0], tokens[1] + at, tokens[2] + at


def splice(text: str, left: Tokens, right: Tokens, lo: int, hi: int) -> tuple[int, int] | None:
    """Where chunks that overlap in [lo, hi) agree: the place in each list of the first token after the splice."""
    places = [m.start() for m in BOUNDARY.finditer(text, lo + 1, hi)]
    for p, q in zip(places[-2::-1], places[:0:-1], strict=True):
        (i, to_i), (j, to_j) = np.searchsorted(left[1], (p, q)).tolist(), np.searchsorted(right[1], (p, q)).tolist()
        apart = (i == 0 or left[2][i - 1] <= p) and (j == 0 or right[2][j - 1] <= p)
        if apart and np.array_equal(left[0][i:to_i], right[0][j:to_j]) and np.array_equal(left[1][i:to_i], right[1][j:to_j]):
            return i, j
    return None


def count_tokens(text: str, encode: Callable[[str], Tokens], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, by chunks where it is longer than one."""
    at, to, total, skip = 0, min(len(text), chunk), 0, 0
    now = encode(text[:to])
    while to < len(text):
        lap, found = min(overlap, to - at), None
        while found is None and lap < to - at:
            lo = to - lap
            beyond = min(len(text), lo + chunk)
            right = placed(encode(text[lo:beyond]), lo) if beyond > to else None
            found = splice(text, now, right, lo, to) if right else None
            lap *= 2
        if found is None:  # the overlap has grown over the chunk: the chunk grows instead
            chunk *= 2
            to = min(len(text), at + chunk)
            now = placed(encode(text[at:to]), at)
            continue
        total += found[0] - skip
        at, to, now, skip = lo, beyond, right, found[1]
    return total + len(now[0]) - skip


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every whole text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_text, stable, by_chunk = encoder(path), stable_boundaries(path), None
        for b in batches:
            texts = b.column(1)
            huge = pc.greater(pc.utf8_length(texts), CHUNK if stable else np.iinfo(np.int32).max)
            rest = pc.if_else(huge, "", texts)
            count = np.concatenate([np.zeros(0, np.int64), *(n for _, _, n in by_text.batches(rest))])
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
                by_chunk = by_chunk or chunk_encoder(path)
                count[i] = count_tokens(texts[i].as_py(), by_chunk)
            yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(count), pa.array(count > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
