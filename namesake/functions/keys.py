"""Blocking keys as arrays, to be exploded.  Every key starts with the country: blocking is by country too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from namesake.functions import lexicon, text

NAME_TOKENS, KEY_TOKENS, WORD_TOKENS, PAIR_TOKENS, NUMBERS = 6, 5, 7, 4, 3


def longest_first(tokens: Column) -> Column:
    """Distinct tokens by falling length, then by themselves."""
    keyed = F.transform(F.array_distinct(tokens), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda s: s["t"])


def name_tokens(core: Column) -> Column:
    return F.slice(longest_first(F.filter(text.words(core), lambda t: F.length(t) >= 3)), 1, NAME_TOKENS)


def address_tokens(address: Column, stop: list[str], n: int) -> Column:
    kept = F.filter(text.words(address), lambda t: (F.length(t) >= 4) & ~t.rlike(r"^\p{Nd}+$") & ~t.isin(stop))
    return F.slice(longest_first(kept), 1, n)


def _key(country: Column, family: str, *parts: Column) -> Column:
    return F.concat_ws("|", country, F.lit(family), *parts)


def _one(condition: Column, key: Column) -> Column:
    return F.when(condition, F.array(key)).otherwise(F.array().cast("array<string>"))


def primary_keys(core: Column, address: Column, country: Column) -> Column:
    """Families t, n, h, p, e, a and at, sorted and distinct."""
    small, numbers = text.compact(core), text.numbers(address)
    named = small != ""
    pairs = F.flatten(
        F.transform(F.slice(F.array_distinct(numbers), 1, NUMBERS), lambda n: F.transform(address_tokens(address, lexicon.KEY_STOP, KEY_TOKENS), lambda t: _key(country, "at", n, F.substring(t, 1, 8))))
    )
    return F.array_sort(F.array_distinct(F.flatten(F.array(
        F.transform(name_tokens(core), lambda t: _key(country, "t", F.substring(t, 1, 5))),
        _one(named, _key(country, "n", F.substring(small, 1, 8))),
        _one(named & (F.size(numbers) > 0), _key(country, "h", F.get(numbers, F.lit(0)), F.substring(small, 1, 3))),
        F.when(named, F.transform(text.postal_tokens(address), lambda n: _key(country, "p", n, F.substring(small, 1, 2)))).otherwise(F.array().cast("array<string>")),
        _one(core != "", name_key(core, country)),
        _one(address != "", address_key(address, country)),
        pairs,
    ))))


def name_key(core: Column, country: Column) -> Column:
    """Equal bags of name tokens; also the key that name frequencies are counted by."""
    return _key(country, "e", text.hash_key(text.sorted_tokens(core)))


def address_key(address: Column, country: Column) -> Column:
    return _key(country, "a", text.hash_key(address))


def word_keys(address: Column, country: Column) -> Column:
    """Distinct, in the order of the tokens they come from: the longest first."""
    return F.array_distinct(F.transform(address_tokens(address, lexicon.WORD_STOP, WORD_TOKENS), lambda t: _key(country, "w", F.substring(t, 1, 10))))


def full_name_keys(core: Column, country: Column) -> Column:
    """All tokens of three and more letters, of any number: for rarity weights."""
    return F.array_distinct(F.transform(F.filter(text.words(core), lambda t: F.length(t) >= 3), lambda t: _key(country, "f", t)))


def extra_keys(core: Column, address: Column, country: Column) -> Column:
    """Families f, w, s and d, sorted and distinct."""
    sounds = F.filter(F.transform(F.slice(text.roman_tokens(core), 1, NAME_TOKENS), text.phonetic), lambda s: F.length(s) >= 3)
    numbers = F.slice(F.array_distinct(text.digit_runs(address)), 1, NUMBERS)
    tokens = F.slice(address_tokens(address, lexicon.WORD_STOP, WORD_TOKENS), 1, PAIR_TOKENS)
    return F.array_sort(F.array_distinct(F.flatten(F.array(
        F.transform(name_tokens(core), lambda t: _key(country, "f", t)),
        word_keys(address, country),
        F.transform(sounds, lambda s: _key(country, "s", F.substring(s, 1, 6))),
        F.flatten(F.transform(numbers, lambda n: F.transform(tokens, lambda t: _key(country, "d", n, F.substring(t, 1, 8))))),
    ))))


def empty_address_keys(core: Column, country: Column) -> Column:
    """Families exact, word and prefix on the canonical name, for targets without an address."""
    name = text.canonical_name(core)
    small = text.compact(name)
    return F.array_sort(F.array_distinct(F.flatten(F.array(
        F.array(_key(country, "exact", text.hash_key(text.sorted_tokens(name)))),
        F.transform(F.filter(text.words(name), lambda t: F.length(t) >= 3), lambda t: _key(country, "word", t)),
        _one(F.length(small) >= 6, _key(country, "prefix", F.substring(small, 1, 12))),
    ))))


def reference_name_key(core: Column, country: Column) -> Column:
    """Equal for references of one name; that of all nameless ones is equal too."""
    return F.concat_ws("|", country, text.hash_key(text.sorted_tokens(text.comparison_name(core, country))))


def reference_address_key(address: Column, country: Column) -> Column:
    return F.when(address == "", "").otherwise(F.concat_ws("|", country, text.hash_key(text.sorted_tokens(address))))


def family(key: Column) -> Column:
    return F.get(F.split(key, r"\|"), F.lit(1))
