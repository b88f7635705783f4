"""Token ids of whole texts from a public tokenizer file, by the distinct words of a batch.

The normaliser of ``word_bpe_49k.json`` turns white space into single spaces, its pre-tokenizer drops these, and no
special token holds one.  So a text's ids are those of its words between ASCII white space, one after another.  A batch
of texts is split and its distinct words are numbered in Arrow; each distinct word is cut into pre-tokens once, each
distinct pre-token is encoded once, and numpy lays the ids out again in the order of the texts.  Pre-tokens are
remembered between batches as Arrow arrays or in two generations, both bounded in bytes; long ones are not remembered at all.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are encoded at a time; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
#: Bytes of one generation of remembered pre-tokens, each counted with ENTRY_BYTES, and the longest that is remembered.
MEMO_BYTES, ENTRY_BYTES, LONGEST = 32 << 20, 180, 64
#: Bytes of the pre-tokens that are remembered as Arrow and numpy arrays, with their ids.
KNOWN_BYTES = 24 << 20
#: Pre-tokens that go to the library as one string, and strings that go at a time.
GROUP = 64
#: Letters of Latin-1 and Latin Extended-A whose lower case and normal form are one character whatever stands beside them.
LATIN = "À-ÖØ-öø-įı-ňŊ-ſ"
#: Words of these alone are cut here, all others by the library.  No special token's start is among them.
PLAIN = f"^[!-;=-~{LATIN}]+$"
#: Plain words in lower case that are letters and then signs: two pre-tokens at most.
STEM_TAIL = f"^(?P<stem>[a-z{LATIN}]*)(?P<tail>[^a-z0-9{LATIN}]*)$"
#: The pre-tokenizer's pattern as it reads on other plain words in lower case.
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")
#: The normaliser and the pre-tokenizer that all this is proven for (fixed values of the vocabulary file).
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def library(path: str):
    """The tokenizers library's own encoder, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte: itself, or the next free one from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Remembered:
    """What `make` gives for strings, remembered in a young and an old generation of at most MEMO_BYTES each.

    What is asked for again moves to the young generation; when that is full it becomes the old one.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMO_BYTES):
        self.make, self.limit, self.young, self.old, self.size = make, limit, {}, {}, 0

    def missing(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            self.size += ENTRY_BYTES + len(key) + len(value)
            if self.size > self.limit:
                self.young, self.old, self.size = {}, self.young, 0
            self.young[key] = value
        return value

    def all(self, keys: list[str]) -> list[bytes]:
        found = list(map(self.young.get, keys))
        return [self.missing(k) if v is None else v for k, v in zip(keys, found, strict=True)]


def listed(strings: pa.Array) -> list[str]:
    """Strings without line ends as a list, by one long string."""
    if not len(strings):
        return []
    offsets = pa.array([0, len(strings)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, strings.cast(pa.string())), "\n")[0].as_py().split("\n")


def spread(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] for all i, one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return values[at]


def packer(dtype: str) -> Callable[[list[int]], bytes]:
    """From ids to little-endian bytes of 2 or 4 each."""
    code = {"<u2": "H", "<u4": "I"}[dtype]
    if sys.byteorder == "little" and array(code).itemsize == int(dtype[-1]):
        return lambda ids: array(code, ids).tobytes()
    return lambda ids: np.array(ids, dtype).tobytes()


class Known:
    """ids of many strings at once, remembered as arrays: what `make_all` gives for new ones, in the order it got them.

    Nothing is made in Python for a single string.  When the arrays are over `limit` bytes, the strings of the last call
    stay if they take half of that at most.
    """

    def __init__(self, make_all: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], dtype: np.dtype, limit: int = KNOWN_BYTES):
        self.make_all, self.dtype, self.limit = make_all, dtype, limit
        self.forget()

    def forget(self) -> None:
        self.keys, self.ids, self.lengths = pa.array([], pa.large_string()), np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def held(self) -> int:
        return self.keys.nbytes + self.ids.nbytes + self.lengths.nbytes

    def all(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct strings one after another, and how many each has."""
        place = pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy().astype(np.int64)
        new = place < 0
        place[new] = np.arange(len(self.keys), len(self.keys) + new.sum())
        fresh = keys.filter(pa.array(new))
        made, counts = self.make_all(fresh)
        self.keys = pa.concat_arrays([self.keys, fresh])
        self.ids, self.lengths = np.concatenate([self.ids, made]), np.concatenate([self.lengths, counts])
        lengths = self.lengths[place]
        ids = spread(self.ids, (np.cumsum(self.lengths) - self.lengths)[place], lengths)
        if self.held() > self.limit:
            self.keys, self.ids, self.lengths = keys, ids, lengths
            if self.held() > self.limit // 2:
                self.forget()
        return ids, lengths


def many_pieces(tok) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray] | None] | None:
    """From non-empty pre-tokens without spaces and "<" to their ids one after another and how many each has.

    The model sees each pre-token alone, as in `model.tokenize`; GROUP of them pass the library's border as one string,
    parted by spaces.  A vocabulary that marks ends of words tells where each one's ids end.  The result is None where
    pre-tokens and ends differ in number; the function is, where the file marks no ends in this way.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    vocab, suffix, alphabet = tok.get_vocab(with_added_tokens=False), tok.model.end_of_word_suffix, byte_alphabet()
    if not suffix or "<" not in suffix or not all(c in vocab and c + suffix in vocab for c in alphabet.values()):
        return None
    last = np.zeros(max(vocab.values()) + 1, bool)
    last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
    level = alphabet | {0x20: " "}
    alone = Tokenizer(tok.model)
    alone.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")

    def run(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        bounds = np.minimum(np.arange(0, len(pieces) + GROUP, GROUP), len(pieces))
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces.cast(pa.string())), " ").to_pylist()
        groups = [g if g.isascii() else g.encode().decode("latin-1").translate(level) for g in groups]
        ids = [np.zeros(0, np.int64)]
        for at in range(0, len(groups), GROUP):
            found = alone.encode_batch_fast(groups[at : at + GROUP], add_special_tokens=False)
            ids.append(np.fromiter(chain.from_iterable(e.ids for e in found), np.int64))
        whole = np.concatenate(ids)
        ends = np.flatnonzero(last[whole]) + 1
        return (whole, np.diff(ends, prepend=0)) if len(ends) == len(pieces) and (not len(whole) or last[whole[-1]]) else None

    return run


class WordEncoder:
    """Encodes batches of texts.

    `encode_piece` gives the ids of one pre-token in the byte alphabet, `encode` those of any text; `dtype` holds them.
    `encode_pieces`, if given, gives those of many pre-tokens: see `many_pieces`.
    """

    def __init__(self, encode: Callable, encode_piece: Callable, dtype: str, encode_pieces: Callable | None = None):
        chars = {chr(b): c for b, c in byte_alphabet().items()}
        level = lambda p: p if p.isascii() else "".join(map(chars.__getitem__, p.encode().decode("latin-1")))
        packed = packer(dtype)
        self.dtype = np.dtype(dtype)
        self.piece = Remembered(lambda p: packed(encode_piece(level(p))) if p else b"")
        self.odd = Remembered(lambda w: packed(encode(w)))

        def make_all(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            made = encode_pieces(pieces)
            if made is None:
                return self.laid_out(list(map(self.piece.make, pieces.to_pylist())))
            return made[0].astype(self.dtype), made[1]

        self.known = Known(make_all, self.dtype) if encode_pieces else None

    def laid_out(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), self.dtype), np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct stems and tails of plain words one after another, and how many each has."""
        if self.known is None:
            return self.laid_out(self.piece.all(listed(distinct)))
        size = pc.binary_length(distinct).to_numpy()
        usual = (size > 0) & (size <= LONGEST)
        ids, some = self.known.all(distinct.filter(pa.array(usual)))
        rest, others = self.laid_out(self.piece.all(distinct.filter(pa.array(~usual)).to_pylist()))
        starts, lengths = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        lengths[usual], lengths[~usual] = some, others
        starts[usual], starts[~usual] = np.cumsum(some) - some, len(ids) + np.cumsum(others) - others
        return spread(np.concatenate([ids, rest]), starts, lengths), lengths

    def words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of all distinct words one after another, and the start and length of each."""
        plain = pc.match_substring_regex(distinct, PLAIN)
        low = pc.utf8_lower(pc.if_else(plain, distinct, ""))
        cut = pc.extract_regex(low, STEM_TAIL)
        simple = pc.and_(plain, pc.is_valid(cut)).to_numpy(zero_copy_only=False)
        empty = pc.equal(distinct, "").to_numpy(zero_copy_only=False)
        chosen = np.zeros((len(distinct), 2), np.int64)
        fields = [pc.struct_field(cut, field).filter(pa.array(simple)).dictionary_encode() for field in ("stem", "tail")]
        for i, before in enumerate((1, 1 + len(fields[0].dictionary))):
            chosen[simple, i] = fields[i].indices.to_numpy() + before
        ids, lengths = self.pieces(pa.concat_arrays([f.dictionary for f in fields]))
        parts = []
        for at in np.flatnonzero(~simple & ~empty):
            if plain[at].as_py():
                parts.append(b"".join(self.piece.all(PIECE.findall(low[at].as_py()))))
            else:
                parts += self.odd.all([distinct[at].as_py()])
            chosen[at, 0] = len(lengths) + len(parts)
        more, others = self.laid_out(parts)
        ids, lengths = np.concatenate([ids, more]), np.concatenate([[0], lengths, others])
        size = lengths[chosen]
        whole = size.sum(axis=1)
        return spread(ids, (np.cumsum(lengths) - lengths)[chosen].ravel(), size.ravel()), np.cumsum(whole) - whole, whole

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of texts without nulls one after another, and how many each text has."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        ids, starts, lengths = self.words(coded.dictionary)
        word = coded.indices.to_numpy()
        size = lengths[word]
        until = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())]).astype(np.int64)
        return spread(ids, starts[word], size), np.diff(until[ends])

    def batches(self, texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The first row, ids and counts of slices of about `most` bytes; Arrow's memory goes back after the last."""
        for at, size in slices(texts, most):
            yield at, *self.batch(texts.slice(at, size))
        pa.default_memory_pool().release_unused()


def slices(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Start and number of rows of slices whose texts have `most` bytes, or that are one text."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + most, "right")))
        yield at, end - at
        at = end


def by_words(path: str) -> bool:
    """Whether a vocabulary file has exactly the normaliser and pre-tokenizer that encoding by words is proven for."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    same = (t.get("normalizer") or {}).get("normalizers") == NORMALIZERS and (t.get("pre_tokenizer") or {}).get("pretokenizers") == PRETOKENIZERS
    apart = all(a["content"].startswith("<") and not re.search(r"\s", a["content"]) and not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) for a in t["added_tokens"])
    return bool(same and apart and t["model"]["type"] == "BPE" and not t.get("post_processor"))


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [a["content"] for a in json.load(f)["added_tokens"]]


class TextEncoder:
    """The same batches for vocabularies that are encoded by whole texts, through their library."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode, size = (lambda s: sp.encode(s, num_threads=1)), sp.get_piece_size()
        else:
            tok = library(path)
            self.encode, size = (lambda s: tok.encode(s, add_special_tokens=False).ids), tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self.encode(t), self.dtype) for t in texts.to_pylist()]
        return np.concatenate(found) if found else np.zeros(0, self.dtype), np.fromiter(map(len, found), np.int64, len(found))

    batches = WordEncoder.batches


_encoders: dict[str, WordEncoder | TextEncoder] = {}


def encoder(path: str) -> WordEncoder | TextEncoder:
    """This process's encoder for a vocabulary file: by words where that is proven, else by whole texts."""
    if path not in _encoders:
        if by_words(path):
            tok = library(path)
            model = tok.model
            dtype = "<u2" if tok.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"
            _encoders[path] = WordEncoder(lambda s: tok.encode(s, add_special_tokens=False).ids, lambda p: [t.id for t in model.tokenize(p)], dtype, many_pieces(tok))
        else:
            _encoders[path] = TextEncoder(path)
    return _encoders[path]
