"""BPE encoding and decoding with forced-boundary splitting.

A merge joins two neighbours into a vocabulary token, so it can only span bytes x y that stand side by side inside
some token.  Every byte pair that no token contains is therefore a certain cut: the fragments between cuts are
encoded independently, and their ids concatenated are the ids of the whole.  White space is the commonest such cut
here (no token holds any), next come pairs inside words.  Fragments that do not end their pre-token are encoded
without the vocabulary's word end.

Cases: null text is empty; an empty text has no ids and decodes to the empty text; repeated rows each give a row;
an empty table gives none; null ids stay null; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from namesake.llm.common import id_and_text
from namesake.llm.words import WordEncoder, by_words, library, special_strings, vocabulary_path


def forced_pairs(vocab: list[str], suffix: str) -> set[str]:
    """The pairs of byte characters that some token holds; all others are certain cuts."""
    inside: set[str] = set()
    for token in vocab:
        body = token.removesuffix(suffix) if suffix else token
        inside.update(body[i : i + 2] for i in range(len(body) - 1))
    return inside


def fragments(piece: str, inside: set[str]) -> list[str]:
    """Cuts a pre-token, written in the byte alphabet, at every pair that no token holds."""
    cuts = [i + 1 for i in range(len(piece) - 1) if piece[i : i + 2] not in inside]
    if not cuts:
        return [piece]
    return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]


class Codec:
    """encode(text) -> ids as the library gives them (no special tokens added); decode(ids) -> text as the library does."""

    def __init__(self, path: str):
        if not by_words(path):
            raise ValueError(f"{path}: forced boundaries are proven for vocabularies with the normaliser and pre-tokenizer in words.py only")
        from tokenizers import models

        tok = library(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        inside = forced_pairs(list(model["vocab"]), suffix)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        inner, last = models.BPE(vocab=model["vocab"], merges=merges), tok.model
        self.decoder = tok.decoder
        self.token = {i: t for t, i in model["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        specials = special_strings(path)
        special_ids = {a["content"]: a["id"] for a in spec["added_tokens"]}

        def encode_piece(level: str) -> list[int]:
            *front, end = fragments(level, inside)
            return [t.id for x in front for t in inner.tokenize(x)] + [t.id for t in last.tokenize(end)]

        def encode(text: str) -> list[int]:
            """Any text: special strings first, then the library's normaliser and pre-tokenizer, then fragments."""
            out: list[int] = []
            while text:
                at = min(((k, s) for s in specials if (k := text.find(s)) >= 0), key=lambda x: (x[0], -len(x[1])), default=(len(text), ""))
                for level, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text[: at[0]])) if at[0] else ():
                    out += encode_piece(level)
                if at[1]:
                    out.append(special_ids[at[1]])
                text = text[at[0] + len(at[1]) :]
            return out

        self.encoder = WordEncoder(encode, encode_piece, "<u2" if max(self.token) < 65536 else "<u4")
        strings = [self.token.get(i, "") for i in range(max(self.token) + 1)]
        self.strings, self.decimal = pa.array(strings, pa.large_string()), pa.array(map(str, range(len(strings))), pa.large_string())

    def encode(self, text: str) -> np.ndarray:
        return self.encoder.batch(pa.array([text], pa.string()))[0]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file the library puts single spaces between the token strings."""
        words = [self.token[i] for i in ids]
        return " ".join(words) if self.decoder is None else self.decoder.decode(words)

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the decimal ids and of the decoded text, of each text."""
        from hashlib import sha256

        for _, ids, counts in self.encoder.batches(texts):
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            spaced = lambda strings: pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), strings.take(pa.array(ids)).cast(pa.string())), " ")  # noqa: E731, B023
            decimal = spaced(self.decimal)
            decoded = spaced(self.strings) if self.decoder is None else pa.array([self.decode(ids[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)], pa.string())
            for n, x, y in zip(counts.tolist(), decimal, decoded, strict=True):
                yield n, sha256(x.as_buffer()).hexdigest(), sha256(y.as_buffer()).hexdigest()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int): every text encoded."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for at, ids, counts in c.encoder.batches(b.column(1)):
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(counts)), pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from rows of doc_id, ids; null ids decode to the empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text is encoded, and its ids are decoded, in one pass."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            n, of_ids, of_text = zip(*c.digests(b.column(1)), strict=True) if len(b) else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
