"""Exact deduplication: a tree merge of sorted digest runs, in DataFrame operations only.

Rows are dealt into runs by a hash of their id.  A run has its digests once each, with the identifier that stays so far
and the number of rows, as sorted lists: one row for each segment of the digests' range.  Runs are merged as in a
binomial tree: in each round the runs whose numbers differ in the next bits meet, segment by segment, and their sorted
lists become one.  An exchange carries BITS binomial rounds, so 2 ** BITS lists are merged at once: they are put one
behind another, sorted, and the first of each digest is retained with the counts of its equals added.  A segment is
SEGMENT digests in the end, whatever the table, so no list grows with the data.

A group of copies, however large, is one entry a run from the start and never meets in one place.  Equality is verified at
each level: entries merge only if SHA-256, a second hash and the length all agree.  Winners go back to the rows by way
of the first level's runs, so no join key is hot either.

Cases: null text is empty; texts are equal when identical after lower-casing A-Z; rows that repeat an id and a text
are one group whose rows all name that id, and `deduplicated` leaves one of them; an empty table gives an empty
result; null ids lose to any other; a very long text is only hashed; further columns of any name stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import ascii_lower, let, materialise, shuffle_parts, unused

#: Binomial rounds of one exchange, and the entries that a segment of the last run has, about.
BITS, SEGMENT = 3, 2048
KEY = ["digest", "check", "size"]
ENTRY = [*KEY, "unnamed", "order", "doc_id", "copies", "n"]


def digest_rows(df: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """run, doc_id, digest (SHA-256), check (a second hash), size of every row's normalised text."""
    text = ascii_lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int").alias("run"), "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("check"), F.length("text").alias("size"))


def first_of_each(entries: Column, most: int) -> Column:
    """Of sorted entries the first of each key, with the counts of those behind it that have the same key.

    A list has a key once, so no more than `most` lists' worth of equals stand side by side.
    """
    same = lambda x, y: (x["digest"] == y["digest"]) & (x["check"] == y["check"]) & (x["size"] == y["size"])

    def marked(found: Column) -> Column:
        first = lambda x, i: F.coalesce(~same(x, F.get(found, i - 1)), F.lit(True))
        equals = lambda x, i: F.aggregate(F.slice(found, i + 1, F.lit(most)), F.lit(0).cast("long"), lambda n, y: n + F.when(same(x, y), y["n"]).otherwise(0))
        entry = lambda x, n: F.struct(*[x[f].alias(f) for f in ENTRY[:-1]], n.alias("n"))
        return F.filter(F.transform(found, lambda x, i: F.when(first(x, i), entry(x, equals(x, i)))), lambda x: x.isNotNull())

    return let(entries, marked)


def merge_runs(rows: DataFrame, runs: int, keep: str) -> DataFrame:
    """digest, check, size, best (struct of the id that stays and its rows), n: one row for each text, by rounds.

    The order in a list is that of the key, then of preference: ids before null, and of ids the greatest (or least)
    first, so the entry to retain is the first of its key.
    """
    order = F.bitwise_not("doc_id") if keep == "max" else F.col("doc_id")
    level = rows.groupBy("run", *KEY, "doc_id").agg(F.count(F.lit(1)).alias("copies")).withColumns({"unnamed": F.col("doc_id").isNull(), "order": order})
    best = F.min(F.struct("unnamed", "order", "doc_id", "copies"))
    level = level.groupBy("run", *KEY).agg(best.alias("best"), F.sum("copies").alias("n")).select("run", *KEY, "best.*", "n")
    segments = max(1, -(-rows.count() // SEGMENT))
    segment = F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(segments)).alias("segment")
    level = level.groupBy("run", segment).agg(F.array_sort(F.collect_list(F.struct(*ENTRY))).alias("entries"))
    while runs > 1:
        met = level.groupBy(F.shiftright("run", BITS).alias("run"), "segment").agg(F.array_sort(F.flatten(F.collect_list("entries"))).alias("entries"))
        level = met.withColumn("entries", first_of_each(F.col("entries"), 1 << BITS))
        runs = (runs - 1 >> BITS) + 1
    return level.select(F.explode("entries").alias("e")).select(*[f"e.{k}" for k in KEY], F.struct("e.doc_id", "e.copies").alias("best"), "e.n")


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", runs: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, copies for every row; keep: "max" or "min" of the ids stays."""
    if keep not in ("max", "min"):
        raise ValueError(keep)
    runs = runs or max(1 << BITS, shuffle_parts(df.sparkSession))
    rows = materialise(digest_rows(df, id_col, text_col, runs), "digests")
    winners = merge_runs(rows, runs, keep)
    shared = materialise(winners.filter("n > 1"), "winners")
    there = rows.select("run", *KEY).distinct()
    placed = there.join(shared, KEY)
    out = rows.join(placed, ["run", *KEY], "left")
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.coalesce("best.copies", F.lit(1)).cast("long").alias("copies"),
    )


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", runs: int | None = None) -> DataFrame:
    """The rows of df that stay, one for each text, with all their columns."""
    groups = materialise(duplicate_groups(df, id_col, text_col, keep, runs), "groups")
    one, two = unused(df, "id", "digest")
    lost = groups.filter("NOT kept").select(F.col("doc_id").alias(one), F.unhex("text_sha256").alias(two)).distinct()
    text = ascii_lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    keyed = df.withColumns({one: F.col(f"`{id_col}`").cast("long"), two: F.unhex(F.sha2(text, 256))})
    left = keyed.join(lost, keyed[one].eqNullSafe(lost[one]) & (keyed[two] == lost[two]), "left_anti")
    if groups.filter("kept AND copies > 1").limit(1).count():
        left = left.dropDuplicates([one, two])
    return left.drop(one, two)
