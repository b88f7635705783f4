"""Mixing sources to target weights by temperature, in DataFrame operations only.

The share p of each source in the tokens is raised to an exponent a in [0, 1] and normalised again.  a = 1 leaves the
shares, a = 0 makes them equal.  The exponent is bisected: the largest that reaches a target entropy, or the smallest
that holds a repetition limit.  The weights then become a stream for a token budget.  Each source is a number of blocks,
dealt by a hash of the id.  Every epoch has a seeded permutation of the source's blocks and of the documents in each
block of its own; a source's stream is one epoch after another, cut where its quota is reached.  Every copy of a
document has its epoch and its position there, and the sources' streams run side by side through the mixture.

The default budget is the smallest that takes every document once: nothing is lost and rare sources repeat.  The
running sums are over blocks (at most BLOCKS a source and epoch) and within one block of one epoch, so a source with a
third of all rows is not summed in one place.  The table of blocks has at most BLOCKS rows a source and epoch, and
never more than the mixture has rows.

Cases: null text is empty; a document counts as its words and one more, so that empty ones have a place; null is a
source of its own; rows that repeat an id are taken together; an empty table gives none; null ids are ordered first;
a very long text is one document, and a quota may be passed by part of the last one; further columns of any name stay as
they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namesake.llm.common import materialise, shuffle_parts, unused

BLOCKS = 1024
#: Bisection steps that one pass evaluates, and passes: 20 steps, an exponent to one part in a million.
STEPS, PASSES = 5, 4


def tokens(text: Column) -> Column:
    """Words and one more: what a document takes from the budget."""
    return (F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")) + 1).cast("long")


def bisect_exponent(shares: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent for a table of source, tokens.

    target_entropy: share of the greatest possible entropy that the weights must reach (largest such exponent).
    max_repeats: how often the most repeated source may be passed while the least repeated one is passed once (smallest
    such exponent).  Both limits grow or fall steadily with the exponent, so bisection finds them; each pass asks all
    the midpoints that its five steps could come to, in one aggregation, and the driver sees their 31 answers.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("state either target_entropy or max_repeats")
    total = shares.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total[0] or total[1] < 2:
        return 1.0
    logs = shares.select(F.log(F.col("tokens") / F.lit(float(total[0]))).alias("log_p"))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / 2**STEPS
        asked = [low + step * i for i in range(1, 2**STEPS)]
        spread = logs.select("log_p", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(asked)])).alias("at"))
        weight = F.exp(F.col("at.a") * F.col("log_p"))
        found = spread.groupBy("at.i").agg(
            F.sum(weight).alias("z"), F.sum(weight * F.col("at.a") * F.col("log_p")).alias("e"), F.max((F.col("at.a") - 1) * F.col("log_p")).alias("most"), F.min((F.col("at.a") - 1) * F.col("log_p")).alias("least"),
        )
        entropy = F.log("z") - F.col("e") / F.col("z")
        flat = entropy >= F.lit(target_entropy) * F.log(F.lit(float(total[1]))) if target_entropy is not None else F.exp(F.col("most") - F.col("least")) > F.lit(max_repeats)
        ok = {i: bool(x) for i, x in found.select("i", flat).collect()}
        for _ in range(STEPS):  # flat means that the exponent sought is larger
            mid = (low + high) / 2
            if ok[min(range(len(asked)), key=lambda i: abs(asked[i] - mid))]:
                low = mid
            else:
                high = mid
    return low if target_entropy is not None else high


def mixing_weights(rows: DataFrame, exponent: float) -> DataFrame:
    """source, tokens, weight, quota for rows of source, tokens a source; quota: of the smallest budget that loses nothing."""
    power = F.exp(F.lit(exponent) * F.log(F.col("tokens").cast("double")))
    z, scale = rows.agg(F.sum(power), F.max(F.col("tokens") / power)).first()
    return rows.select("source", "tokens", (power / F.lit(z)).alias("weight"), F.round(power * F.lit(scale)).cast("long").alias("quota"))


def mixing_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", target_entropy: float | None = None, max_repeats: float | None = 2.0, budget: int | None = None, seed: int = 0) -> DataFrame:
    """doc_id, source, tokens, epoch, position, quota: a row for every copy of a document in the mixture.

    position: tokens of the source's stream before this copy, epoch after epoch.  budget: tokens of the mixture; None:
    the smallest with which each source is passed at least once.  The copy at which a quota is reached is the last one.
    """
    d = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), tokens(F.col(f"`{text_col}`")).alias("tokens"))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    d = d.withColumn("order", order).withColumn("block", F.pmod(F.conv(F.substring("order", 1, 8), 16, 10).cast("long"), F.lit(BLOCKS)).cast("int"))
    d = materialise(d.groupBy("doc_id", "source", "order", "block").agg(F.sum("tokens").alias("tokens")), "mix-rows")
    blocks = materialise(d.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sources = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    exponent = bisect_exponent(sources, target_entropy, max_repeats)
    quotas = mixing_weights(sources, exponent)
    if budget is not None:
        quotas = quotas.withColumn("quota", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    epochs = F.sequence(F.lit(0).cast("long"), F.expr("(quota - 1) div tokens"))
    quotas = quotas.filter("quota > 0").select(F.col("source").alias("of"), F.col("tokens").alias("total"), "quota", F.explode(epochs).alias("epoch"))
    nth = F.md5(F.concat_ws("|", F.lit(f"{seed} block"), F.col("epoch"), F.col("block")))
    ranked = blocks.join(quotas, F.col("source").eqNullSafe(F.col("of"))).withColumn("nth", nth)
    ahead = lambda *within: F.coalesce(F.sum("tokens").over(Window.partitionBy("source", *within).orderBy("nth", *LAST[within]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranked.withColumn("before", F.col("epoch") * F.col("total") + ahead("epoch")).filter("before < quota")
    ranked = materialise(ranked.select("of", F.col("block").alias("at"), "epoch", "quota", "before"), "mix-order")
    placed = d.join(ranked, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).withColumn("nth", F.md5(F.concat_ws("|", "epoch", "order")))
    placed = placed.withColumn("position", F.col("before") + ahead("block", "epoch")).filter("position < quota")
    return placed.select("doc_id", "source", "tokens", "epoch", "position", "quota")


#: What decides between equal hashes, by what a running sum is within.
LAST = {("epoch",): ["block"], ("block", "epoch"): ["doc_id"]}


def mixing_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """doc_id, source, tokens, copies: how often the mixture takes each document that it takes."""
    found = mixing_order(df, id_col, text_col, source_col, **how)
    return found.groupBy("doc_id", "source", "tokens").agg(F.count(F.lit(1)).alias("copies"))


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The rows of df as often as the mixture takes them, with all their columns, in its order.

    A copy's place is the share of its source's stream before it, so every stretch of the mixture has the sources in
    their weights.  Places are even, so equal ranges of them are the partitions and rows are sorted within each.
    """
    one, two, place = unused(df, "id", "from", "place")
    order = mixing_order(df, id_col, text_col, source_col, **how).select(F.col("doc_id").alias(one), F.col("source").alias(two), (F.col("position") / F.col("quota")).alias(place))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(one)) & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(two))
    parts = shuffle_parts(df.sparkSession)
    dealt = df.join(order, same).repartitionById(parts, F.floor(F.col(place) * parts).cast("int"))
    return dealt.sortWithinPartitions(place, two, one).drop(one, two, place)
