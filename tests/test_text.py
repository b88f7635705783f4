import hashlib

import pytest
from pyspark.sql import functions as F

from namesake.functions import keys, text


@pytest.fixture(scope="module")
def ask(spark):
    def run(make, *values):
        names = [f"c{i}" for i in range(len(values))]
        schema = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([values], schema).select(make(*map(F.col, names)).alias("x")).first()["x"]

    return run


NAMES = ["Café & Söhne GmbH", "STRASSE weiß", "", "  ", "Ñandú's №5", "a-b_c", "Ångström Ltd. Co", "İzmir", "ÆØ Łódź"]


@pytest.mark.parametrize("value", ["Café & Söhne GmbH", "STRASSE weiß", "", "  ", "Ñandú's 5", "a-b_c", "Ångström Ltd. Co", "é́x"])
def test_native_and_general_normalisation_agree(ask, value):
    assert ask(text.normalize, value) == text.fold_unicode(value)


@pytest.mark.parametrize("value", ["ﬁrm हिन्दी Straße", "ΑΘΉΝΑ Ο.Ε. & ΣΊΑ", "Общество Ёлка", "한국 상사", "ＦＵＬＬ ｗｉｄｔｈ ½", "கொ ொ കൊ", "ঢাকা ড়", "𝔸bc", "الشركة ﷲ", "株式会社"])
def test_other_scripts(ask, value):
    assert ask(text.normalize, value) == text.fold_unicode(value)


def test_only_what_folds_to_several_goes_to_python(spark):
    import re

    several = re.compile(text.SEVERAL.replace("\\x{10000}-\\x{10ffff}", "\U00010000-\U0010ffff"))
    for value in NAMES[:4] + NAMES[5:7] + ["हिन्दी लिमिटेड", "Общество", "Αθήνα", "株式会社"]:
        assert not several.search(value), value
    assert several.search("ﬁ") and several.search("한")


def test_transliteration(ask):
    assert ask(text.transliterated, "प्राइवेट लि") == "praivet li" and ask(text.transliterated, "प्रा") == "pra"
    assert ask(text.transliterated, "हिन्दी १२") == "hindi 12" and ask(text.transliterated, "গুজরাট") == "gujrat" and ask(text.transliterated, "ಬೆಂಗಳೂರು") == "bengluru"
    assert ask(text.transliterated, "Общество Щука") == "obshchestvo shchuka" and ask(text.transliterated, "Αθήνα Ψυχή") == "athina psychi"
    assert ask(text.transliterated, "Øresund Łódź") == "oresund lodz"
    assert ask(text.roman_core, "टाटा प्राइवेट लि") == "tata" and ask(text.phonetic, "दिल्ली") == ask(text.phonetic, "dilli")


def test_records_of_other_scripts_share_keys(spark):
    """A name in Devanagari and its spelling in Latin letters meet under a sound key."""
    rows = [("a", "मुंबई बेकरी", "1 x road", "India"), ("b", "munbi bekri", "2 y road", "India")]
    from namesake.sources import records

    made = records.entities(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    found = {r["eid"]: {k for k in r["k"] if "|s|" in k} for r in made.select("eid", keys.extra_keys(F.col("core"), F.col("address"), F.col("country")).alias("k")).collect()}
    assert found["a"] & found["b"]


def test_core(ask):
    assert ask(text.core, "acme private limited") == "acme" and ask(text.core, "co llc") == "co llc" and ask(text.core, "") == ""


def test_addresses(ask):
    assert ask(text.abbreviated, "5 long street suite 3") == "5 long st ste 3"
    assert ask(text.numbers, "007 a1 12 12 5th") == ["007", "12", "12"]
    assert ask(text.numeric_tokens, "007 7 0 12 a1") == ["7", "0", "12"]
    assert ask(text.digit_runs, "007 a1") == ["7", "1"]
    assert ask(text.postal_tokens, "1234 12345 123456 1234567") == ["12345", "123456"]
    assert ask(text.joined_digits, "0a1 2") == "012" and ask(text.letters_only, "a1b 22") == "ab "
    assert ask(text.canonical_address, "1st ave 007 new york", "us") == "1 ave 7 ny"
    assert ask(text.canonical_address, "maharashtra west bengal 000", "india") == "mh wb 0"
    assert ask(text.canonical_address, "west virginia virginia", "us") == "wv va" and ask(text.canonical_address, "texas", "france") == "texas"


def test_names(ask):
    assert ask(text.phonetic, "Phillip wagner") == "flfbknr" and ask(text.roman_core, "o'neil praivet ltd söhne") == "oneil sohne"
    assert ask(text.canonical_name, "acme sarl net") == "acme" and ask(text.context_name, "a b c") == "abc"
    assert ask(text.comparison_name, "dupont sarl", "france") == "dupont" and ask(text.comparison_name, "dupont sarl", "us") == "dupont sarl"
    assert ask(text.initials, "a big cat") == "abc" and ask(text.sorted_tokens, "b a b") == "a b b" and ask(text.initials, "") == ""


def test_ids(ask):
    valid = lambda e: text.id_valid(e, 2)
    assert [ask(valid, v) for v in ("S2-0", "S2-17", "S2-017", "S3-1", "S2-1073741823", "S2-1073741824", "S2-", "S2-99999999999")] == [True, True, False, False, True, False, False, False]
    assert [ask(text.target_code, v) for v in ("S2-5", "S3-5", "S1-5")] == [5, 2**30 + 5, None]
    assert ask(text.id_list, "") == [] and ask(text.id_list, "a,,b") == ["a", "b"]


def test_buckets(ask):
    assert ask(lambda v: text.bucket_blake2(v, 10000), "x") == int.from_bytes(hashlib.blake2b(b"x", digest_size=8).digest(), "big") % 10000
    assert ask(lambda v: text.bucket(v, 97), "x") == int(hashlib.md5(b"x").hexdigest()[:15], 16) % 97


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()[:16]


def test_primary_keys(ask):
    got = ask(keys.primary_keys, "golden crane", "12 long 12345 null", "us")
    want = ["us|t|golde", "us|t|crane", "us|n|goldencr", "us|h|12|gol", "us|p|12345|go", f"us|e|{sha('crane golden')}", f"us|a|{sha('12 long 12345 null')}", "us|at|12|long", "us|at|12345|long"]
    assert got == sorted(want)
    assert ask(keys.primary_keys, "", "", "us") == []


def test_extra_keys(ask):
    got = ask(keys.extra_keys, "golden crane", "012 meadow lane", "us")
    assert got == sorted(["us|f|golden", "us|f|crane", "us|w|meadow", "us|w|lane", "us|s|kltn", "us|s|krn", "us|d|12|meadow", "us|d|12|lane"])


def test_keys_take_the_longest_tokens(ask):
    got = ask(keys.name_tokens, "aaa bbbb cc ddddd aaa eeeeee fffffff ggggggg hhhhhhhh")
    assert got == ["hhhhhhhh", "fffffff", "ggggggg", "eeeeee", "ddddd", "bbbb"]


def test_empty_address_keys(ask):
    assert ask(keys.empty_address_keys, "acme tools sarl", "france") == sorted([f"france|exact|{sha('acme tools')}", "france|word|acme", "france|word|tools", "france|prefix|acmetools"])
    assert ask(keys.reference_address_key, "", "us") == "" and ask(keys.reference_name_key, "", "us") == f"us|{sha('')}"
