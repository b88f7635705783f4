"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base spans are found by fixed expressions.  They are the seeds.  Every token that could be an identifier (it has a digit
or an @) is an instance, and the word before it is its lexical pattern.  The pattern-instance graph is scored in
rounds: a pattern's confidence for a kind is the share of its distinct instances that are believed to be of that kind;
an instance's is the noisy-or over its patterns.  Instances that reach CONFIDENT join the seeds of the next round.  At
the end patterns of high confidence mark their remaining instances, which no base expression has found.

Expressions are written so that they run in linear time and without recursion on any text: starts inside a run that has
failed are not tried, and group repetitions are possessive.  Positions are running sums of the lengths of matches and of
the gaps between them, and tokens meet spans by one sorted pass over both, so a text with many identifiers takes near
linear time too.  Positions are code points, ends exclusive.

Cases: null text is empty and has no spans; rows that repeat an id are told apart by their text's hash, and rows that
repeat both give a row each with equal spans; an empty table gives none; null ids stay null; the word before an
identifier is taken whole, however long it is or far away, unless another identifier comes between; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namesake.llm.common import let, materialise, running_sums

KINDS = ["email", "ip", "card", "phone"]
#: Each gives the matches of the kind's plain expression, from left to right without overlap.
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    # only whole runs of 13 to 19 digits: shorter and longer ones are matched and dropped by the plain expression
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for an expression to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
SPACE = r"\x20\x09-\x0D"
CANDIDATE = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
LAST_WORD = rf"(?<![^{SPACE}])([^{SPACE}]++)[{SPACE}]*+$"
#: Rounds, the confidence from which patterns and instances are believed, and the distinct seeds a pattern needs.
ROUNDS, CONFIDENT, SUPPORT = 3, 0.8, 5
SPAN = "array<struct<start:bigint,end:bigint,value:string,gap:string>>"


def located(text: Column, expression: str) -> Column:
    """Array of start, end, value of the matches, and the gap before each."""

    def spans(found: Column, gaps: Column) -> Column:
        size = F.transform(found, lambda value, i: (F.length(F.get(gaps, i)) + F.length(value)).cast("long"))

        def at(before: Column) -> Column:
            start = lambda i: F.get(before, i) + F.length(F.get(gaps, i))
            return F.transform(found, lambda value, i: F.struct(start(i).alias("start"), (start(i) + F.length(value)).alias("end"), value.alias("value"), F.get(gaps, i).alias("gap")))

        return let(running_sums(size), at)

    some = lambda found: F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(let(F.split(text, expression, -1), lambda gaps: spans(found, gaps)))
    return let(F.regexp_extract_all(text, F.lit(expression), F.lit(0)), some)


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card":
        n = F.length(digits)

        def step(total: Column, i: Column) -> Column:
            d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
            return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

        return n.between(13, 19) & (F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0)
    return F.lit(True)


def kind_spans(*more: str) -> Column:
    """One array of kind, start, end (and further fields of the spans) from the columns of the kinds."""

    def of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.named_struct(F.lit("kind"), F.lit(kind), *[x for f in ("start", "end", *more) for x in (F.lit(f), s[f])]))

    return F.flatten(F.array(*map(of, KINDS)))


def base_spans(text: Column, kind: str) -> Column:
    none = F.array().cast(SPAN)
    may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
    return F.filter(F.when(may & text.rlike("[0-9@]"), located(text, EXPRESSIONS[kind])).otherwise(none), lambda s: valid(kind, s["value"]))


def core(value: Column) -> Column:
    """A token without the punctuation around it."""
    return F.regexp_extract(value, r"[0-9A-Za-z+](?:.*[0-9A-Za-z])?", 0)


def shaped(kind: Column, value: Column) -> Column:
    """Whether a value could be of a kind at all: an @ inside for email, four digits for the others."""
    return F.when(kind == "email", value.rlike("[^@]@[^@]")).otherwise(F.length(F.regexp_replace(value, "[^0-9]", "")) >= 4)


def occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, base (kind -> spans), candidates: one pass over the texts, written to the shared folder."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    left = lambda gap: F.lower(F.regexp_extract(gap, LAST_WORD, 1))
    candidates = F.when(F.col("text").rlike("[0-9@]"), located(F.col("text"), CANDIDATE)).otherwise(F.array().cast(SPAN))
    found = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), *[bare(base_spans(F.col("text"), k)).alias(k) for k in KINDS], candidates.alias("tokens"))
    token = lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), core(t["value"]).alias("value"), (t["start"] + F.instr(t["value"], core(t["value"])) - 1).alias("at"), left(t["gap"]).alias("pattern"))
    return materialise(found.withColumn("tokens", F.filter(F.transform("tokens", token), lambda t: t["value"] != "")), "pii-base")


def instances(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, end, value, pattern, seed (kind of the base span that starts in the token, or null),
    inside (the token overlaps a base span).  The value of a seed is its whole span, that of others the bare token.

    Tokens and spans of a text are read in the order of their starts: a span belongs to the last token that starts at or
    before it, and a token is inside if an earlier span reaches beyond its start or one starts in it.
    """
    text = ["doc_id", "text_hash"]
    none = lambda kind: F.lit(None).cast(kind)
    tokens = found.select(*text, F.explode("tokens").alias("t")).select(*text, F.col("t.start").alias("from"), F.lit(0).alias("is_span"), F.col("t.end").alias("to"), "t", none("struct<rank:int,from:bigint,kind:string,value:string>").alias("span"))
    ranked = F.array_position(F.array(*map(F.lit, KINDS)), F.col("s.kind")).cast("int")
    spans = found.select(*text, F.explode(kind_spans("value")).alias("s")).select(*text, F.col("s.start").alias("from"), F.lit(1).alias("is_span"), F.col("s.end").alias("to"), none(tokens.schema["t"].dataType).alias("t"), F.struct(ranked.alias("rank"), F.col("s.start").alias("from"), F.col("s.kind").alias("kind"), F.col("s.value").alias("value")).alias("span"))
    so_far = Window.partitionBy(*text).orderBy("from", "is_span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = tokens.unionByName(spans).withColumns({
        "token": F.last(F.when(F.col("is_span") == 0, F.struct("from", "to")), ignorenulls=True).over(so_far),
        "reach": F.max(F.when(F.col("is_span") == 1, F.col("to"))).over(so_far),
    })
    one = swept.filter("token IS NOT NULL").groupBy(*text, F.col("token.from").alias("token")).agg(
        F.first("t", ignorenulls=True).alias("t"), F.min(F.when(F.col("span.from") < F.col("token.to"), F.col("span"))).alias("opened"), F.max(F.when(F.col("is_span") == 0, F.col("reach"))).alias("reach"),
    )
    return one.select(
        *text, F.col("t.at").alias("start"), (F.col("t.at") + F.length("t.value")).alias("end"), F.coalesce("opened.value", "t.value").alias("value"), F.col("t.pattern").alias("pattern"),
        F.col("opened.kind").alias("seed"), (F.col("opened").isNotNull() | F.coalesce(F.col("reach") > F.col("token"), F.lit(False))).alias("inside"),
    )


def trusted_patterns(edges: DataFrame) -> DataFrame:
    """pattern, kind, confidence >= CONFIDENT, from edges pattern, value, seed (distinct)."""
    patterns = None
    believed = edges.filter("seed IS NOT NULL").select("value", F.col("seed").alias("kind")).distinct()
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("size"))
    for _ in range(ROUNDS):
        support = edges.select("pattern", "value").distinct().join(believed, "value").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("support"))
        scored = support.filter(F.col("support") >= SUPPORT).join(sizes, "pattern").withColumn("confidence", F.col("support") / (F.col("size") + 1))
        patterns = materialise(scored.filter(F.col("confidence") >= CONFIDENT).select("pattern", "kind", "confidence"), "pii-patterns")
        if not patterns.limit(1).count():
            break
        reached = edges.select("pattern", "value").distinct().join(patterns, "pattern").filter(shaped(F.col("kind"), F.col("value")))
        doubt = F.exp(F.sum(F.log1p(-F.col("confidence"))))
        raised = reached.groupBy("value", "kind").agg((1 - doubt).alias("confidence")).filter(F.col("confidence") >= CONFIDENT).select("value", "kind")
        believed = materialise(believed.unionByName(raised).distinct(), "pii-believed")
    return patterns


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, added: arrays of kind, start, end (code points), base spans and those that patterns discovered."""
    found = occurrences(df, id_col, text_col)
    seen = materialise(instances(found), "pii-instances")
    edges = seen.filter("pattern != '' AND (seed IS NOT NULL OR NOT inside)").select("pattern", "value", "seed").distinct()
    patterns = trusted_patterns(materialise(edges, "pii-edges"))
    new = seen.filter("NOT inside AND pattern != ''").join(patterns, "pattern").filter(shaped(F.col("kind"), F.col("value")))
    new = new.groupBy("doc_id", "text_hash", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"), F.count(F.lit(1)).alias("n"))
    added = new.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    added = added.withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    rows = found.select("doc_id", "text_hash", kind_spans().alias("base"))
    rows = rows.join(added, rows["doc_id"].eqNullSafe(added["__doc"]) & (rows["text_hash"] == added["__hash"]), "left")
    return rows.select("doc_id", "base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, by kind as listed and then by start, joined by commas."""
    order = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(order(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
