import hashlib
import re
import time

from pyspark.sql import functions as F

from namesake.llm import pii

from .conftest import table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, expression in PLAIN.items():
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    None, "", "a@b.co_x@d.ef.gh", "x@y z@w.de. mail +1 (017) 555-7713 now", "1.2.3.4.5.6.7.8 and 300.1.2.3.4 0001.02.3.255", "4539 1488 0343 6467 and 4539148803436467123456 and 4539-1488-0343-6467",
    "🎉🎉 é 79927398713 0000000000000 12", "+1234567 +123456789 +1 234 567 890 1 +" + "1" * 16, "9" * 3000 + "." + "8." * 3000, ("ab" * 3000 + "@") * 3, "a.b" * 5000 + "@x" + ".yz" * 5000, "5 5-5 5" * 4000,
    "1 - 2 3--4 4539148803436467", "4539148803436467-", " 4539148803436467 4539148803436467", "call +44 20 7946 0958, card 4539148803436467.",
]


def test_base_spans_are_the_plain_expressions(spark):
    df = table(spark, [(i, t, "a") for i, t in enumerate(TEXTS)])
    for row in pii.personal_data(df).select("doc_id", pii.span_text(F.col("base")).alias("spans")).collect():
        assert row["spans"] == plain_spans(TEXTS[row["doc_id"]] or ""), row["doc_id"]


def test_patterns_discover_unseen_identifiers(spark):
    seeds = [(i, f"Reach me, hotline: +49 30 {1000000 + 7 * i} today.", "a") for i in range(20)]
    known = [(100 + i, f"Some {i} cats and {i + 3} dogs at {i}.", "a") for i in range(20)]
    new = [(500, "The hotline: 555-0199 is open, cats 5550 too.", "a")]
    found = {r["doc_id"]: r["added"] for r in pii.personal_data(table(spark, seeds + known + new)).collect()}
    assert [tuple(s) for s in found[500]] == [("phone", 13, 21)]
    assert all(not found[i] for i in found if i != 500)


def test_cases(spark, docs, empty):
    rows = pii.personal_data(docs)
    assert rows.count() == docs.count()
    assert pii.personal_data(empty).count() == 0
    twice = table(spark, [(1, "a@b.cd", "x"), (1, "a@b.cd", "x"), (1, "other", "x")])
    assert sorted(len(r["base"]) for r in pii.personal_data(twice).collect()) == [0, 1, 1]


def test_digest_of_no_spans(spark):
    row = spark.range(1).select(pii.span_text(F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("s")).select(F.sha2("s", 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"").hexdigest()


def brute_force(texts):
    """Base spans, tokens, and the pattern-instance graph scored in plain loops; the added spans of each text."""
    rows = []
    for doc, text in texts.items():
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in plain_spans(text).split(",") if x)]
        base.sort(key=lambda x: (pii.KINDS.index(x[0]), x[1]))
        before = ""
        for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text):
            if not re.search("[0-9@]", m.group()):
                before = m.group().lower()
                continue
            bare = re.search("[0-9A-Za-z+](?:.*[0-9A-Za-z])?", m.group())
            pattern, before = before, ""
            if not bare:
                continue
            start = m.start() + bare.start()
            touching = [s for s in base if s[1] < m.end() and s[2] > m.start()]
            opened = next((s for s in touching if s[1] >= m.start()), None)
            value = text[opened[1] : opened[2]] if opened else bare.group()
            rows.append((doc, start, start + len(bare.group()), value, pattern, opened and opened[0], bool(touching)))
    edges = {(p, v, s) for _, _, _, v, p, s, inside in rows if p and (s or not inside)}
    believed, trusted = {(v, s) for _, v, s in edges if s}, {}
    instances = {p: {v for q, v, _ in edges if q == p} for p, _, _ in edges}
    for _ in range(pii.ROUNDS):
        trusted = {}
        for p, values in instances.items():
            for kind in pii.KINDS:
                n = sum((v, kind) in believed for v in values)
                if n >= pii.SUPPORT and n / (len(values) + 1) >= pii.CONFIDENT:
                    trusted[p, kind] = n / (len(values) + 1)
        if not trusted:
            break
        for v in {v for _, v, _ in edges}:
            for kind in pii.KINDS:
                doubt = 1.0
                for p, values in instances.items():
                    if v in values and (p, kind) in trusted:
                        doubt *= 1 - trusted[p, kind]
                if (re.search("[^@]@[^@]", v) if kind == "email" else sum(c.isdigit() for c in v) >= 4) and 1 - doubt >= pii.CONFIDENT:
                    believed.add((v, kind))
    out = {doc: set() for doc in texts}
    for doc, a, b, v, p, _, inside in rows:
        found = [(c, kind) for (q, kind), c in trusted.items() if q == p and (re.search("[^@]@[^@]", v) if kind == "email" else sum(c.isdigit() for c in v) >= 4)]
        if p and not inside and found:
            out[doc].add((max(found)[1], a, b))
    return out


def test_pattern_graph_against_plain_loops(spark):
    """Three rounds: "hotline" is learned from whole numbers, "extension" from what hotline finds, "desk" from that."""
    texts = {i: f"hotline +49 30 {1000000 + 7 * i} then mail bob{i}@mail.org, ok" for i in range(200)}
    texts |= {300 + i: f"hotline 555-01{i:02d}; extension 555-01{i:02d} (old) cats {i}" for i in range(40)}
    texts |= {350 + i: f"extension 444-02{i:02d} or desk 444-02{i:02d}" for i in range(8)} | {360: "desk 333-0301, about 1 and 1000", 361: "about 2 and 2000"}
    texts |= {400: "write mail ann@home now", 401: "mail x@y" + " " * 200 + "end " + "w" * 120 + "  9999", 402: "desk: none", 403: "hotline" + " " * 300 + "777-1234"}
    texts |= {410 + i: "v" * 150 + f" +49 40 {2000000 + i} x" for i in range(12)} | {430: "v" * 150 + " 8888-1"}
    want = brute_force(texts)
    df = table(spark, [(i, t, "a") for i, t in texts.items()])
    got = {r["doc_id"]: {tuple(s) for s in r["added"]} for r in pii.personal_data(df).collect()}
    assert got == want
    assert want[300] and want[350] and want[360] and want[403] and want[430]


def test_many_identifiers_in_one_text(spark):
    """100,000 numbers and 2,000 addresses in one text: near linear time."""
    text = " ".join(f"n {i}" if i % 50 else f"a{i}@b.cd 10.0.{i % 256}.9" for i in range(100_000))
    df = table(spark, [(1, text, "a"), (2, "plain", "a")])
    began = time.monotonic()
    row = pii.personal_data(df).filter("doc_id = 1").select(pii.span_text(F.col("base")).alias("spans")).first()
    assert row["spans"] == plain_spans(text)
    assert time.monotonic() - began < 90
