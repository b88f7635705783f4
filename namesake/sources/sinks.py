"""Sinks: result lists, feature tables, indexes and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_lists(references: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """source1_entity_id and a comma list of targets in candidate order, one row for every reference (it may be empty).

    references: ref_id, ref_idx; pairs: ref_id, target_id, cand_pos.  A list is at most as long as the candidate cap.
    """
    lists = pairs.groupBy("ref_id").agg(F.array_sort(F.collect_list(F.struct("cand_pos", "target_id"))).alias("found"))
    joined = references.join(lists, "ref_id", "left")
    ids = F.array_join(F.transform("found", lambda s: s["target_id"]), ",")
    return joined.select("ref_idx", F.col("ref_id").alias("source1_entity_id"), F.coalesce(ids, F.lit("")).alias(name))


def score_lists(references: DataFrame, pairs: DataFrame) -> DataFrame:
    """Scores as 32-bit floats in the order of the lists."""
    lists = pairs.groupBy("ref_id").agg(F.array_sort(F.collect_list(F.struct("cand_pos", F.col("score").cast("float").alias("score")))).alias("found"))
    return references.join(lists, "ref_id", "left").select("ref_idx", "ref_id", F.coalesce(F.transform("found", lambda s: s["score"]), F.array().cast("array<float>")).alias("scores"))


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Tab-separated with a header.  Spark's commit protocol publishes whole outputs only."""
    (df.coalesce(1) if one_file else df).write.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="overwrite")


def write_ordered_tsv(df: DataFrame, path: str, order: str = "ref_idx") -> None:
    """In source order over many files: ranges of the order, each sorted."""
    ranged = df.repartitionByRange(order).sortWithinPartitions(order).drop(order)
    ranged.write.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="overwrite")


def write_features(df: DataFrame, path: str, names: list[str]) -> None:
    """Features as 32-bit floats, one column each, beside the pair's ids."""
    ids = [c for c in df.columns if c not in names]
    df.select(*ids, *[F.col(n).cast("float").alias(n) for n in names]).write.mode("overwrite").parquet(path)


def write_index(keys: DataFrame, table: str, buckets: int = 64) -> None:
    """An inverted index bucketed by key, so that joins on the key need no exchange of it."""
    keys.write.bucketBy(buckets, "key").sortBy("key").mode("overwrite").saveAsTable(table)


def report(df: DataFrame) -> str:
    """A one-row table as JSON."""
    return json.dumps(json.loads(df.select(F.to_json(F.struct("*"))).first()[0]), indent=2, sort_keys=True)


def escaped_payload(payload: str) -> str:
    """JSON that cannot close the element it is put into."""
    for char in "<>&":
        payload = payload.replace(char, f"\\u{ord(char):04x}")
    return payload


def render_html(payload: str, template: str, mark: str = "__REPORT_JSON__") -> str:
    return template.replace(mark, escaped_payload(payload))
