"""Checks of inputs and outputs: each is a table of offenders that must be empty; `check` raises on the first."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesake.functions import text
from namesake.sources.records import FIELDS


def invalid_ids(records: DataFrame, source: int) -> DataFrame:
    return records.filter(~text.id_valid(F.col("entity_id"), source)).select("entity_id")


def duplicate_ids(records: DataFrame, key: str = "entity_id") -> DataFrame:
    return records.groupBy(key).count().filter(F.col("count") > 1).select(key)


def check_header(columns: list[str]) -> None:
    if columns != FIELDS:
        raise ValueError(f"header must be {FIELDS}, not {columns}")


def check(offenders: DataFrame, message: str) -> None:
    row = offenders.first()
    if row is not None:
        raise ValueError(f"{message}: {row.asDict()}")


def check_inputs(references: DataFrame, targets: dict[int, DataFrame]) -> None:
    """Headers, ids and their ranges, repeated ids; at least one reference and one target in all."""
    for source, records in {1: references, **targets}.items():
        check_header(records.columns[: len(FIELDS)])
        check(invalid_ids(records, source), f"invalid entity ID in source {source}")
        check(duplicate_ids(records), f"duplicate entity ID in source {source}")
    if not references.limit(1).count() or not any(t.limit(1).count() for t in targets.values()):
        raise ValueError("at least one reference and one target are needed")


def repeated_targets(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("ref_id", "target_id").count().filter(F.col("count") > 1).select("ref_id", "target_id")


def outside(pairs: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """Pairs that are not among the allowed ones: a subset check."""
    return pairs.select(*on).join(allowed.select(*on), on, "left_anti")


def shared_targets(pairs: DataFrame) -> DataFrame:
    """Targets of more than one reference."""
    return pairs.groupBy("target_id").agg(F.count_distinct("ref_id").alias("n")).filter(F.col("n") > 1).select("target_id")


def out_of_order(expected: DataFrame, rows: DataFrame) -> DataFrame:
    """Positions at which two numbered lists of references differ, one being longer included (ref_idx, ref_id)."""
    a, b = expected.select("ref_idx", F.col("ref_id").alias("expected")), rows.select("ref_idx", F.col("ref_id").alias("found"))
    return a.join(b, "ref_idx", "full").filter(~F.col("expected").eqNullSafe(F.col("found")))


def check_outputs(references: DataFrame, targets: DataFrame, links: DataFrame, candidates: DataFrame, unique: bool = True) -> None:
    """Coverage, repeats, subsets and ownership of links and candidates (ref_id, target_id)."""
    for name, pairs in (("matching", links), ("candidate", candidates)):
        check(repeated_targets(pairs), f"{name}: duplicate target")
        check(outside(pairs, references, ["ref_id"]), f"{name}: unknown reference")
    check(outside(links, candidates, ["ref_id", "target_id"]), "matches outside the candidate set")
    check(outside(candidates, targets, ["target_id"]), "unknown target")
    if unique:
        check(shared_targets(links), "target assigned to several references")


def file_hash(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def manifest(inputs: list[str], settings: dict) -> dict:
    """What a stage's result depends on: size, time and hash of its input files, and its settings."""
    files = {str(p): {"size": p.stat().st_size, "mtime": int(p.stat().st_mtime), "sha256": file_hash(p)} for p in map(Path, inputs)}
    return {"inputs": files, "settings": settings}


def stale(path: str | Path, now: dict) -> bool:
    """Whether a stored manifest is missing or differs."""
    path = Path(path)
    return not path.exists() or json.loads(path.read_text()) != json.loads(json.dumps(now))


def same_selection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Links that only one of two selections has: must be empty after rescoring."""
    on = ["ref_id", "target_id"]
    return a.select(*on).exceptAll(b.select(*on)).unionByName(b.select(*on).exceptAll(a.select(*on)))
