"""What the text operators share: reading columns, work folders, ordered buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namesake.sources.shared import clear_work, materialise, work_dir  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Most buckets an order is cut into; what the driver holds of an order is one number for each.
MAX_BUCKETS = 4096


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that further columns cannot clash; null text is empty."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone.  Texts of ASCII only take the quick whole-string path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that df does not have: those given, with as many underscores before them as it takes."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Elements that running_sums adds in one go, and how often it groups them: 32 ** 4 elements cost 64 additions each.
SUMMED, LEVELS = 32, 3


def running_sums(numbers: Column, levels: int = LEVELS) -> Column:
    """For an array of longs the sums of what stands before each element.

    An array that grows by one element a step is copied each time, which takes the square of its length.  Here groups
    of SUMMED are summed, the sums before each group come from the same way over the groups' sums, and each element
    adds only those before it in its own group.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x)
    before = lambda xs: F.transform(xs, lambda x, i: total(F.slice(xs, F.lit(1), i)))

    def grouped(groups: Column) -> Column:
        each = lambda starts: F.flatten(F.transform(groups, lambda g, k: F.transform(before(g), lambda s: s + F.get(starts, k))))
        return let(running_sums(F.transform(groups, total), levels - 1), each)

    def cut(xs: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / SUMMED).cast("int")), lambda g: F.slice(xs, g * SUMMED + 1, F.lit(SUMMED)))
        return F.when(F.size(xs) <= SUMMED, before(xs)).otherwise(let(groups, grouped))

    return let(numbers, cut if levels else before)


def joined_back(rows: DataFrame, facts: DataFrame, key: str, spread: str) -> DataFrame:
    """rows with the one row of facts that has their key, where many rows may have the same key.

    Rows are dealt into parts by another column; each part has a key once, so facts meet at most one row a part, and the
    rows of a common key are joined in as many tasks as there are parts.
    """
    part, = unused(rows, "part")
    dealt = rows.withColumn(part, F.pmod(F.xxhash64(spread), F.lit(shuffle_parts(rows.sparkSession))))
    placed = dealt.select(part, key).distinct().join(facts, key)
    return dealt.join(placed, [part, key]).drop(part)


def ordered_bucket(df: DataFrame, col: str, n: int) -> Column:
    """A bucket number that rises with col (nulls first), from about n equal parts of the rows.

    The bounds are quantiles that Spark sketches in one pass over this column; they are constants of the plan
    from then on, so a task that runs again deals its rows out as before.
    """
    n = max(1, min(n, MAX_BUCKETS))
    if n == 1:
        return F.lit(0)
    bounds = sorted({int(x) for x in df.stat.approxQuantile(col, [i / n for i in range(1, n)], 1 / (4 * n))})
    if not bounds:
        return F.lit(0)
    at = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.coalesce(F.size(F.filter(at, lambda b: b <= F.col(col))), F.lit(0)).cast("int")
