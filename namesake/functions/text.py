"""Scalar string functions as Spark columns.

Everything runs in the JVM: accents and capitals are folded by one ``translate`` whose table is built from the Unicode
decompositions, for every character that folds to one.  ``normalize`` gives other texts, those with characters that fold
to several (ligatures, Hangul, vowel signs of two parts), to ``normalize_unicode``, an Arrow function that is
handed null for all the rest.  Latin, Greek, Cyrillic and Indic letters are transliterated.  The empty string is the
missing value throughout.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesake.functions import lexicon

WORD = r"[\p{L}\p{M}\p{N}]+"


def _fold(text: str) -> str:
    """Case folding and compatibility decomposition without combining accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not 0x300 <= ord(c) <= 0x36F)


def _folding() -> tuple[str, str, str]:
    """Letters that fold to another one and these, and a class of the characters that fold to something else."""
    source, target, other = [], [], []
    for code in range(0x80, 0x10000):
        if 0x300 <= code <= 0x36F or 0xD800 <= code <= 0xDFFF or chr(code) == "ß":
            continue
        plain = _fold(chr(code))
        if plain == chr(code).lower():
            continue
        if len(plain) == 1 and len(chr(code).lower()) == 1:
            source += dict.fromkeys((chr(code), chr(code).lower()))
            target += [plain] * (len(source) - len(target))
        elif other and other[-1][1] == code - 1:
            other[-1][1] = code
        else:
            other.append([code, code])
    return "".join(source), "".join(target), "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in other) + "\\x{10000}-\\x{10ffff}]"


FOLD_FROM, FOLD_TO, SEVERAL = _folding()
ACCENTS = "[\\u0300-\\u036f]"


def words(text: Column) -> Column:
    """Non-empty pieces between spaces (an empty text has none)."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def joined(tokens: Column, by: str = " ") -> Column:
    return F.array_join(tokens, by)


def normalize(text: Column) -> Column:
    """Lower case, accents folded, "&" spelled out, runs of letters, marks and digits joined by single spaces."""
    return F.coalesce(normalize_unicode(F.when(~ascii_only(text) & text.rlike(SEVERAL), text)), normalize_native(text))


def normalize_native(text: Column) -> Column:
    """The same for texts in which every character folds to one (and ß)."""
    low = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    plain = F.when(ascii_only(text), low).otherwise(F.regexp_replace(F.translate(low, FOLD_FROM, FOLD_TO), ACCENTS, ""))
    return joined(F.regexp_extract_all(F.replace(plain, F.lit("&"), F.lit(" and ")), F.lit(WORD), F.lit(0)))


def fold_unicode(value: str) -> str:
    """What `normalize` gives, for any text."""
    import regex

    return " ".join(regex.findall(WORD, _fold(value).replace("&", " and ")))


@F.pandas_udf(T.StringType())
def normalize_unicode(text: pd.Series) -> pd.Series:
    memo = {v: fold_unicode(v) for v in text.dropna().unique()}
    return pd.Series([memo.get(v) for v in text], dtype=object)


def core(name: Column) -> Column:
    """A normalised name without legal forms; the whole name if nothing else is in it."""
    kept = joined(F.filter(words(name), lambda t: ~t.isin(lexicon.LEGAL)))
    return F.when(kept == "", name).otherwise(kept)


def abbreviated(address: Column) -> Column:
    """A normalised address with its long street words shortened."""
    short = F.create_map(*[F.lit(x) for pair in lexicon.ABBREVIATIONS.items() for x in pair])
    return joined(F.transform(words(address), lambda t: F.coalesce(short[t], t)))


def ascii_only(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _indic() -> dict[str, str]:
    """Spelling of the Devanagari letters, signs and digits by their Unicode names: consonants without their vowel."""
    out = {}
    for code in range(lexicon.DEVANAGARI, lexicon.DEVANAGARI + 0x80):
        sort, _, name = unicodedata.name(chr(code), "").removeprefix("DEVANAGARI ").removeprefix("VOWEL ").partition(" ")
        sound = name.removeprefix("CANDRA ").removeprefix("SHORT ").removeprefix("VOCALIC ").lower()
        if sort in ("SIGN", "LETTER") and sound in ("a", "aa", "i", "ii", "u", "uu", "e", "ai", "o", "au", "r", "rr", "l", "ll"):
            out[chr(code)] = sound if sound in ("ai", "au") else sound[0]
        elif sort == "LETTER" and name.endswith("A") and " " not in name:
            out[chr(code)] = sound[:-1][1:] if sound[:2] in ("tt", "dd", "nn", "ss", "rr", "ll") else sound[:-1]
        elif sort == "SIGN":
            out[chr(code)] = {"ANUSVARA": "n", "CANDRABINDU": "n", "VISARGA": "h"}.get(name, "")
        elif sort == "DIGIT":
            out[chr(code)] = str(unicodedata.digit(chr(code)))
    return out


def _spelling() -> tuple[dict[str, str], str, str]:
    """Letters that are spelled with several or none, and those with one and what they become."""
    known = lexicon.LATIN_SPELLING | lexicon.CYRILLIC_SPELLING | lexicon.GREEK_SPELLING | _indic()
    one = {a: b for a, b in known.items() if len(b) == 1}
    return {a: b for a, b in known.items() if len(b) != 1}, "".join(one), "".join(one.values())


SPELLED, SPELLED_FROM, SPELLED_TO = _spelling()
#: The letters of the other Indic blocks, and those of Devanagari at the same places.
INDIC_FROM = "".join(chr(block + i) for block in lexicon.INDIC for i in range(0x80))
INDIC_TO = "".join(chr(lexicon.DEVANAGARI + i) for _ in lexicon.INDIC for i in range(0x80))


def transliterated(text: Column) -> Column:
    """Latin, Greek, Cyrillic and Indic text in ASCII, lower case; letters of other scripts stay as they are."""
    spelled = F.translate(F.lower(text), INDIC_FROM, INDIC_TO)
    for letter, spelling in SPELLED.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    folded = F.regexp_replace(F.translate(spelled, FOLD_FROM, FOLD_TO), ACCENTS, "")
    return F.when(ascii_only(text), F.lower(text)).otherwise(F.translate(folded, SPELLED_FROM, SPELLED_TO))


def roman_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.replace(transliterated(text), F.lit("'"), F.lit("")), F.lit("[a-z0-9]+"), F.lit(0))


def roman_core(text: Column) -> Column:
    """Transliterated tokens without legal forms in either spelling."""
    return joined(F.filter(roman_tokens(text), lambda t: ~t.isin(lexicon.ROMAN_LEGAL)))


def unpadded(number: Column) -> Column:
    """A digit string without leading zeros; no cast, so that no length overflows."""
    return F.regexp_replace(number, "^0+(?=.)", "")


def numbers(address: Column) -> Column:
    """Numbers that stand alone, in order, zeros and repeats kept."""
    return F.regexp_extract_all(address, F.lit(r"(?U)\b\d+\b"), F.lit(0))


def numeric_tokens(address: Column) -> Column:
    """The distinct numbers that stand alone, without leading zeros."""
    return F.array_distinct(F.transform(F.regexp_extract_all(address, F.lit(r"\b[0-9]+\b"), F.lit(0)), unpadded))


def digit_runs(address: Column) -> Column:
    """Every run of digits, also inside words, without leading zeros."""
    return F.transform(F.regexp_extract_all(address, F.lit("[0-9]+"), F.lit(0)), unpadded)


def postal_tokens(address: Column) -> Column:
    return F.filter(numbers(address), lambda n: F.length(n).isin(5, 6))


def phonetic(text: Column) -> Column:
    """Consonants that sound alike become one letter; vowels, "h" and repeats go."""
    sound = F.translate(F.replace(transliterated(text), F.lit("ph"), F.lit("f")), lexicon.SOUND_FROM, lexicon.SOUND_TO)
    return F.regexp_replace(F.regexp_replace(sound, "[^b-df-gj-np-tv-z]", ""), r"(.)\1+", "$1")


def compact(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def context_name(core_name: Column) -> Column:
    return compact(transliterated(core_name))


def canonical_name(core_name: Column) -> Column:
    return joined(F.filter(words(roman_core(core_name)), lambda t: ~t.isin(lexicon.CANONICAL_LEGAL)))


def canonical_address(address: Column, country: Column) -> Column:
    """Ordinals and zero-padded numbers become plain numbers, state names become codes in the countries that have them."""
    text = F.regexp_replace(transliterated(address), r"\b([0-9]+)(?:st|nd|rd|th)\b", "$1")
    text = F.regexp_replace(text, r"\b0+(?=[0-9]+\b)", "")
    out = text
    for name, states in lexicon.STATES.items():
        coded = text
        # names are marked longest first so that none is read inside a longer one, then the marks become codes
        for i, state in enumerate(sorted(states, key=len, reverse=True)):
            coded = F.regexp_replace(coded, rf"\b{state}\b", f"\x02{chr(0x4E00 + i)}\x03")
        for i, state in enumerate(sorted(states, key=len, reverse=True)):
            coded = F.replace(coded, F.lit(f"\x02{chr(0x4E00 + i)}\x03"), F.lit(states[state]))
        out = F.when(country == name, coded).otherwise(out)
    return joined(F.regexp_extract_all(out, F.lit("[a-z0-9]+"), F.lit(0)))


def comparison_name(core_name: Column, country: Column) -> Column:
    """Names of French references are compared without their legal forms."""
    return F.when(country == "france", joined(F.filter(words(core_name), lambda t: ~t.isin(lexicon.FRENCH_LEGAL)))).otherwise(core_name)


def initials(text: Column) -> Column:
    return joined(F.transform(words(text), lambda t: F.substring(t, 1, 1)), "")


def letters_only(address: Column) -> Column:
    return F.regexp_replace(address, "[0-9]+", "")


def joined_digits(address: Column) -> Column:
    return F.regexp_replace(address, "[^0-9]", "")


def sorted_tokens(text: Column) -> Column:
    """Tokens in code point order, repeats kept."""
    return joined(F.array_sort(words(text)))


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^a-z]", ""))


def vowel_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^aeiou]", ""))


def digit_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{Nd}]", ""))


def hash_key(text: Column) -> Column:
    """A short stand-in for equality: 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def bucket(value: Column, modulo: int = 10000) -> Column:
    """A deterministic bucket of an id, from the first 15 hex digits of its MD5: for splits and samples."""
    return F.pmod(F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long"), F.lit(modulo)).cast("int")


def bucket_blake2(value: Column, modulo: int = 10000) -> Column:
    """The same from the big-endian number of an 8-byte BLAKE2b digest, which Spark lacks: an Arrow function."""

    @F.pandas_udf(T.IntegerType())
    def numbered(ids: pd.Series) -> pd.Series:
        from hashlib import blake2b

        return ids.map(lambda v: int.from_bytes(blake2b(v.encode(), digest_size=8).digest(), "big") % modulo).astype("int32")

    return numbered(value)


#: Ids: the source's number, and a decimal number without leading zeros under 2**30.
ID_LIMIT = 1 << 30


def id_valid(eid: Column, source: int) -> Column:
    number = F.regexp_extract(eid, r"^S[0-9]+-(0|[1-9][0-9]{0,9})$", 1)
    return eid.rlike(rf"^S{source}-(0|[1-9][0-9]{{0,9}})$") & (F.coalesce(number.try_cast("long"), F.lit(ID_LIMIT)) < ID_LIMIT)


def target_code(eid: Column) -> Column:
    """Targets of both sources in one range of numbers; null for anything that is not a target's id."""
    number = F.regexp_extract(eid, r"^S[23]-(0|[1-9][0-9]{0,9})$", 1).try_cast("long")
    return F.when(id_valid(eid, 2), number).when(id_valid(eid, 3), number + ID_LIMIT)


def id_list(text: Column) -> Column:
    return F.filter(F.split(text, ","), lambda x: x != "")
