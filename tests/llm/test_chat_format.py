import hashlib

import pytest
from pyspark.sql import functions as F

from namesake.llm import chat_format as cf

ODD = "\\### Assistant: </turn> ok"
CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a <b> \\l \\b \\\\"), (1, 2, "assistant", "again\n</turn>\n<turn|user>"), (1, 3, "user", None), (1, 4, "user", ""), (2, None, "sy>s\\g<", "x"), (2, 5, None, "y"), (2, 5, None, "y"),
    (3, 1, "assistant", ""), (-7, 0, "user", ODD), (-7, 1, "assistant", ODD), (None, 0, "user", "nobody"),
]


@pytest.fixture(scope="module")
def chats(spark):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in CHATS], "conv_id long, turn long, role string, text string, nth int, mark string, start int")


def test_round_trip(chats):
    read = {r["conv_id"]: r for r in cf.read_chats(cf.format_chats(chats)).collect()}
    assert set(read) == {1, 2, 3, -7, None}
    for conv, row in read.items():
        turns = sorted((r for r in CHATS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [tuple(t) for t in row["turns"]] == [(r[2] or "", r[3] or "") for r in turns]
        assert row["loss_text"] == "".join(r[3] or "" for r in turns if r[2] == "assistant")


def test_format(chats):
    text = {r["conv_id"]: r["formatted"] for r in cf.format_chats(chats).collect()}
    assert text[1].startswith("<turn|user>hi</turn>\n<turn|assistant>a \\lb> \\bl \\bb \\b\\b<sep>again\n\\l/turn>\n\\lturn|user></turn>\n<turn|user><sep></turn>\n")
    assert text[3] == "<turn|assistant></turn>\n"


def test_mask_covers_the_trained_role_only(chats):
    for r in cf.format_chats(chats).collect():
        covered = [r["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]] for s in r["loss"]]
        assert not any("<" in c for c in covered)
        assert len(covered) == sum(1 for c in CHATS if c[0] == r["conv_id"] and c[2] == "assistant")


def test_expressions_only_and_empty(spark, chats):
    out = cf.read_chats(cf.format_chats(chats))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert cf.read_chats(cf.format_chats(chats.limit(0))).count() == 0


def test_long_conversation(spark):
    rows = spark.range(400).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn é "), F.col("id")).alias("text"))
    got = cf.read_chats(cf.format_chats(rows)).first()
    want = "".join(f"turn é {i}" for i in range(400) if i % 3)
    assert hashlib.sha256(got["loss_text"].encode()).digest() == hashlib.sha256(want.encode()).digest() and len(got["turns"]) == 400
