"""Candidate retrieval: an inverted index as a table of keys, bounded joins on it, and a ranking in three lanes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namesake.functions import keys, text
from namesake.functions.similarity import jaccard, pool_measures, ratio, token_set_ratio, token_sort_ratio
from namesake.sources.shared import materialise, materialise_each

#: Most targets of a key that is used alone, and of one that is used in an intersection; candidates kept.
MAX_BLOCK, MAX_BROAD, TOP_K = 1000, 50000, 80
NAME_LANE, ADDRESS_LANE = 10, 15
#: Pairs, those of several keys counted as often, that references of one slice make in about.
SLICE_PAIRS = 40_000_000


def key_rows(entities: DataFrame, extra: bool = False, both: bool = False) -> DataFrame:
    """eid, key: one row for each blocking key of each entity, of one set of families or of both (no key is in both)."""
    of = lambda make: make(F.col("core"), F.col("address"), F.col("country"))
    made = F.concat(of(keys.primary_keys), of(keys.extra_keys)) if both else of(keys.extra_keys if extra else keys.primary_keys)
    return entities.select("eid", F.explode(made).alias("key"))


def stored_keys(refs: DataFrame, targets: DataFrame, extra: bool = False, both: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys of references and of targets and the counts of the latter, each written once for all the joins that read it.

    The expressions of the keys are the largest of the engine: a plan that repeats them for every join costs the driver
    more memory than the rest of it together.
    """
    rk, tk = materialise(key_rows(refs, extra, both), "reference-keys"), materialise(key_rows(targets, extra, both), "target-keys")
    return rk, tk, materialise(key_counts(tk), "key-counts")


def key_counts(rows: DataFrame) -> DataFrame:
    """key, n.  Counts are partial before they are exchanged, so heavy keys cost a row a task."""
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def large_keys(counts: DataFrame, over: int = 100) -> DataFrame:
    return counts.filter(F.col("n") > over)


def blocked_pairs(ref_keys: DataFrame, target_keys: DataFrame, counts: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """ref_id, target_id: targets that share a key with a reference, by keys of at most max_block targets.

    Heavy keys are taken out before the join, so no key makes more than max_block rows a reference.
    """
    usable = counts.filter(F.col("n") <= max_block).select("key")
    left = ref_keys.join(usable, "key", "left_semi").select(F.col("eid").alias("ref_id"), "key")
    right = target_keys.select(F.col("eid").alias("target_id"), "key")
    return left.join(right, "key").select("ref_id", "target_id").distinct()


def broad_keys(ref_keys: DataFrame, counts: DataFrame, max_block: int, max_broad: int = MAX_BROAD) -> DataFrame:
    """ref_id, key, n, family of keys too heavy to be used alone and light enough to be intersected."""
    wide = counts.filter((F.col("n") > max_block) & (F.col("n") <= max_broad))
    return ref_keys.join(wide, "key").select(F.col("eid").alias("ref_id"), "key", "n", keys.family(F.col("key")).alias("family"))


PAIRS = "array<struct<first:string,second:string,first_n:bigint,second_n:bigint>>"


def _chosen(broad: DataFrame, *choices: Callable[[Column], Column]) -> DataFrame:
    """ref_id, pair, first, second and their counts: what the choices make of the broad keys of a reference, rarest first.

    One aggregation a reference: its broad keys are few, as every reference has a bounded number of keys.
    """
    own = broad.groupBy("ref_id").agg(F.array_sort(F.collect_list(F.struct("n", "key", "family"))).alias("own"))
    found = own.select("ref_id", F.posexplode(F.concat(*[choose(F.col("own")) for choose in choices])).alias("pair", "keys"))
    return found.filter("keys IS NOT NULL").select("ref_id", "pair", "keys.*")


def _pair(a: Column, b: Column) -> Column:
    """The pair of two keys, or null if there is not either."""
    both = F.struct(a["key"].alias("first"), b["key"].alias("second"), a["n"].alias("first_n"), b["n"].alias("second_n"))
    return F.when(a.isNotNull() & b.isNotNull(), both)


def _of(own: Column, *families: str) -> Callable[[int], Column]:
    found = F.filter(own, lambda k: k["family"].isin(*families))
    return lambda i: F.get(found, F.lit(i))


def _primary(own: Column) -> Column:
    named, placed, token = _of(own, "t", "e", "n"), _of(own, "at"), _of(own, "t")
    number = lambda k: F.get(F.split(k["key"], r"\|"), F.lit(2))
    other = F.get(F.filter(own, lambda k: (k["family"] == "at") & (number(k) != number(placed(0)))), F.lit(0))
    pairs = F.filter(F.array(_pair(named(0), placed(0)), _pair(placed(0), other)), lambda p: p.isNotNull())
    last = F.filter(F.array(_pair(token(0), token(1))), lambda p: p.isNotNull())
    return F.when(F.size(pairs) > 0, pairs).otherwise(last).cast(PAIRS)


def _extra(own: Column) -> Column:
    word, name = _of(own, "w"), _of(own, "f")
    return F.array(_pair(word(0), word(1)), _pair(name(0), name(1)), _pair(word(0), name(0))).cast(PAIRS)


def primary_intersections(broad: DataFrame) -> DataFrame:
    """ref_id, pair, first, second and their counts: at most two pairs of broad keys of a reference.

    The rarest name key with the rarest address key; the rarest address key with the next of another number; if there
    is neither, the two rarest name tokens.
    """
    return _chosen(broad, _primary)


def extra_intersections(broad: DataFrame) -> DataFrame:
    """ref_id, pair, first, second and their counts: two words, two full names, and a word with a full name."""
    return _chosen(broad, _extra)


def _wanted(pairs: DataFrame) -> DataFrame:
    """ref_id, rare and wide: the rarer key of each pair and the other."""
    rarer = F.struct(F.col("first_n").alias("n"), F.col("first").alias("key")) <= F.struct(F.col("second_n").alias("n"), F.col("second").alias("key"))
    return pairs.select("ref_id", F.when(rarer, F.col("first")).otherwise(F.col("second")).alias("rare"), F.when(rarer, F.col("second")).otherwise(F.col("first")).alias("wide"))


def _met(wanted: DataFrame, target_keys: DataFrame, max_block: int) -> DataFrame:
    """rare, wide, eid: the targets that have both keys of a pair, of pairs that find at most max_block."""
    a = target_keys.select(F.col("key").alias("rare"), "eid")
    b = target_keys.select(F.col("key").alias("wide"), "eid")
    found = wanted.select("rare", "wide").distinct().join(a, "rare").join(b, ["wide", "eid"], "left_semi")
    found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("rare", "wide"))).filter(F.col("n") <= max_block)
    return found.select("rare", "wide", "eid")


def intersect(pairs: DataFrame, target_keys: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """ref_id, target_id: targets that have both keys of a pair; pairs that find more than max_block are dropped whole.

    Distinct pairs of keys are intersected once for all references that ask for them.  The rarer key of a pair brings
    its targets, and each is looked up under the other, so a pair makes as many rows as its rarer key has targets.
    """
    wanted = _wanted(pairs)
    return wanted.join(_met(wanted, target_keys, max_block), ["rare", "wide"]).select("ref_id", F.col("eid").alias("target_id")).distinct()


def usable_keys(refs: DataFrame, targets: DataFrame, max_block: int = MAX_BLOCK, extra: bool = True) -> tuple[DataFrame, DataFrame]:
    """eid, ids, id of references and of targets, each written once: a row for each key that retrieval may join by, with
    all of its record's in order.  These are single keys of at most max_block targets, and pairs of broad keys that find
    as few; both sets of families are one table.  An id is a number, as long keys would make the arrays large."""
    rk, tk, counts = stored_keys(refs, targets, both=extra)
    pairs = materialise(_chosen(broad_keys(rk, counts, max_block), *([_primary, _extra] if extra else [_primary])), "broad-pairs")
    wanted = _wanted(pairs)
    met = materialise(_met(wanted, tk, max_block), "intersections")
    single = counts.filter(F.col("n") <= max_block).select("key", F.lit("").alias("wide"))
    both = met.select(F.col("rare").alias("key"), "wide").distinct()
    ids = materialise(single.unionByName(both).withColumn("id", F.monotonically_increasing_id()), "key-ids")

    def listed(rows: DataFrame, more: DataFrame, name: str) -> DataFrame:
        every = rows.select("eid", "key", F.lit("").alias("wide")).unionByName(more.select("eid", F.col("rare").alias("key"), "wide"))
        own = every.join(ids, ["key", "wide"]).groupBy("eid").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        return materialise(own.select("eid", "ids", F.explode("ids").alias("id")), name)

    return listed(rk, wanted.withColumnRenamed("ref_id", "eid"), "reference-ids"), listed(tk, met, "target-ids")


def keyed_pairs(own: DataFrame, other: DataFrame, a: DataFrame | None = None, b: DataFrame | None = None) -> DataFrame:
    """ref_id, target_id, and as structs a and b what is given of both records (eid and more), for rows of usable_keys.

    A pair is made under the first key that its records share and under no other, so no pair is exchanged to find
    repeated ones.
    """
    left, right = own.select(F.col("eid").alias("ref_id"), F.col("ids").alias("__own"), "id"), other.select(F.col("eid").alias("target_id"), F.col("ids").alias("__other"), "id")
    if a is not None:
        left = left.join(a.select(F.col("eid").alias("ref_id"), F.struct("*").alias("a")), "ref_id")
    if b is not None:
        right = right.join(b.select(F.col("eid").alias("target_id"), F.struct("*").alias("b")), "target_id")
    first = (F.get("__own", F.lit(0)) == F.col("id")) | (F.get(F.array_intersect("__own", "__other"), F.lit(0)) == F.col("id"))
    return left.join(right, "id").filter(first).drop("__own", "__other", "id")


def slices(own: DataFrame, other: DataFrame) -> Iterator[DataFrame]:
    """Rows of references, by hash, so that those of one slice make about SLICE_PAIRS pairs."""
    n = own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(other.groupBy("id").agg(F.count(F.lit(1)).alias("m")), "id").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    count = 1 + n // SLICE_PAIRS
    return (own.filter(F.pmod(F.xxhash64("eid"), F.lit(count)) == i) if count > 1 else own for i in range(count))


def sliced_pairs(refs: DataFrame, targets: DataFrame, make: Callable[[DataFrame], DataFrame], name: str, a: DataFrame | None = None, b: DataFrame | None = None, max_block: int = MAX_BLOCK, extra: bool = True) -> DataFrame:
    """What `make` makes of the pool, a slice of whole references at a time, written: the pool itself is nowhere on disk,
    and what a slice exchanges is gone before the next."""
    own, other = usable_keys(refs, targets, max_block, extra)
    return materialise_each((make(keyed_pairs(part, other, a, b)) for part in slices(own, other)), name)


def candidate_pool(refs: DataFrame, targets: DataFrame, max_block: int = MAX_BLOCK, extra: bool = True) -> DataFrame:
    """ref_id, target_id: the union of what single keys and intersections of broad keys find in both key sets."""
    return keyed_pairs(*usable_keys(refs, targets, max_block, extra))


def prepared(entities: DataFrame) -> DataFrame:
    """What retrieval compares of a record, once a record: eid, core and roman with their tokens in order, address, its
    tokens in order, and numbers."""
    core, roman = F.col("core"), text.roman_core(F.col("core"))
    return entities.select("eid", text.sorted_tokens(core).alias("core"), text.sorted_tokens(roman).alias("roman"), "address", text.sorted_tokens(F.col("address")).alias("sorted"), text.numeric_tokens(F.col("address")).alias("numbers"))


def attached(pairs: DataFrame, refs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with both records as structs a and b."""
    a = refs.select(F.col("eid").alias("ref_id"), F.struct("*").alias("a"))
    b = targets.select(F.col("eid").alias("target_id"), F.struct("*").alias("b"))
    return pairs.join(a, "ref_id").join(b, "target_id")


def scored_pool(pool: DataFrame, refs: DataFrame, targets: DataFrame) -> DataFrame:
    """ref_id, target_id, names, addresses, numbers and the three ranking scores, all out of 100."""
    return measured(attached(pool, materialise(prepared(refs), "reference-texts"), materialise(prepared(targets), "target-texts")))


def measured(rows: DataFrame) -> DataFrame:
    """scored_pool of rows that have both prepared records as structs a and b."""
    both = lambda f: (F.col(f"a.{f}"), F.col(f"b.{f}"))
    found = rows.select("ref_id", "target_id", pool_measures(*both("core"), *both("roman"), *both("sorted"), *both("address")).alias("m"), (100 * jaccard(*both("numbers"))).alias("numbers"))
    return rank_scores(found.select("ref_id", "target_id", (100 * F.col("m.names")).alias("names"), (100 * F.col("m.addresses")).alias("addresses"), "numbers"))


def rank_scores(rows: DataFrame) -> DataFrame:
    n, a, m = F.col("names"), F.col("addresses"), F.col("numbers")
    return rows.withColumns({
        "score": F.greatest(0.6 * n + 0.3 * a + 0.1 * m, 0.35 * n + 0.5 * a + 0.15 * m),
        "name_score": 0.85 * n + 0.1 * a + 0.05 * m,
        "address_score": 0.8 * a + 0.15 * m + 0.05 * n,
    })


def top_candidates(scored: DataFrame, top_k: int = TOP_K) -> DataFrame:
    """ref_id, target_id, cand_pos and the scores: the best by name, then by address, then by score, at most top_k.

    The address lane looks at its best ADDRESS_LANE; those that the name lane has use up their slots.  Ties go to the
    smaller target id.  One exchange by reference serves all the windows.
    """
    by = lambda c: Window.partitionBy("ref_id").orderBy(F.desc(c), "target_id")
    first = min(NAME_LANE, top_k)
    ranked = scored.withColumns({"by_name": F.row_number().over(by("name_score")), "by_address": F.row_number().over(by("address_score"))})
    size = F.count(F.lit(1)).over(Window.partitionBy("ref_id"))
    room = F.least(F.lit(ADDRESS_LANE), F.lit(top_k) - F.least(F.lit(first), size))
    lane = F.when(F.col("by_name") <= first, 1).when(F.col("by_address") <= room, 2).otherwise(3)
    ranked = ranked.withColumn("lane", lane)
    inside = F.when(F.col("lane") == 1, F.col("name_score")).when(F.col("lane") == 2, F.col("address_score")).otherwise(F.col("score"))
    place = F.row_number().over(Window.partitionBy("ref_id").orderBy("lane", F.desc(inside), "target_id"))
    return ranked.withColumn("cand_pos", place - 1).filter(F.col("cand_pos") < top_k).drop("by_name", "by_address", "lane")


def candidates(refs: DataFrame, targets: DataFrame, top_k: int = TOP_K, max_block: int = MAX_BLOCK, extra: bool = True, columns: list[str] | None = None) -> DataFrame:
    """The pool's best, ranked a slice of references at a time and written; columns: those that are kept, all by default."""
    a, b = materialise(prepared(refs), "reference-texts"), materialise(prepared(targets), "target-texts")
    best = lambda rows: top_candidates(measured(rows), top_k).select(*(columns or ["*"]))
    return sliced_pairs(refs, targets, best, "candidates", a, b, max_block, extra)


#: Candidates that a search among targets without an address ranks, and those it adds for a reference.
EMPTY_RANKED, EMPTY_ADDED = 30, 8


def empty_address_pairs(refs: DataFrame, targets: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """ref_id, target_id among targets without an address, by keys of at most max_block of them."""
    own = lambda e, name: materialise(e.select("eid", F.explode(keys.empty_address_keys(F.col("core"), F.col("country"))).alias("key")), name)
    tk = own(targets.filter("address = ''"), "target-keys")
    return blocked_pairs(own(refs, "reference-keys"), tk, key_counts(tk), max_block)


def empty_address_candidates(refs: DataFrame, targets: DataFrame, seen: DataFrame, max_block: int = MAX_BLOCK, limit: int = EMPTY_ADDED) -> DataFrame:
    """ref_id, target_id, score, nth: of the best 30 by name, those not seen yet, at most `limit`."""
    name = lambda e, of: materialise(e.select("eid", text.canonical_name(F.col("core")).alias("name")), of)
    rows = attached(empty_address_pairs(refs, targets, max_block), name(refs, "reference-names"), name(targets, "target-names"))
    a, b = F.col("a.name"), F.col("b.name")
    score = 100 * (0.6 * token_sort_ratio(a, b) + 0.25 * ratio(text.compact(a), text.compact(b)) + 0.15 * token_set_ratio(a, b))
    best = Window.partitionBy("ref_id").orderBy(F.desc("score"), "target_id")
    ranked = rows.select("ref_id", "target_id", score.alias("score")).withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= EMPTY_RANKED)
    new = ranked.join(seen.select("ref_id", "target_id"), ["ref_id", "target_id"], "left_anti")
    return new.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= limit)


def frequency(rows: DataFrame, key: Column, counts: DataFrame, name: str) -> DataFrame:
    """Adds log1p of how many targets have a key; none: 0."""
    found = counts.select(F.col("key").alias("__key"), F.col("n").alias("__n"))
    return rows.join(found, key == F.col("__key"), "left").withColumn(name, F.log1p(F.coalesce("__n", F.lit(0)))).drop("__key", "__n")
