"""Matching references as they arrive against a fixed target index: a stateless stream with resumable micro-batches.

Each batch is retrieved, scored and written with its batch id; the checkpoint remembers what was read, and a batch that
runs again overwrites its own output, so a restart neither loses nor repeats a reference.  Ownership of targets is over
all references and stays a last batch pass.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from namesake.sources.records import SCHEMA, entities


def arriving(spark: SparkSession, path: str, schema: StructType = SCHEMA, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of records as a stream, a bounded number of files in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def match_stream(records: DataFrame, match: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Runs `match` (entities -> scored pairs) on every batch and ends when all that is there is read.

    Returns the finished query; its checkpoint lets a later call go on with what has come since.
    """

    def run(batch: DataFrame, number: int) -> None:
        match(entities(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def matched(spark: SparkSession, out: str) -> DataFrame:
    """All batches' pairs."""
    return spark.read.parquet(out).withColumn("batch", F.col("batch").cast("long"))


def depends(spark: SparkSession, inputs: list[str], settings: dict) -> dict:
    """What a stage's result depends on: its settings, and size and time of all its input files, wherever Spark reads
    them.  The files are listed, not read; the list is the driver's, as that of any scan is."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inputs).select("path", "length", F.unix_millis("modificationTime").alias("time")) if inputs else None
    return {"inputs": sorted(map(list, files.collect())) if files else [], "settings": settings}


def stage(spark: SparkSession, path: str, make: Callable[[], DataFrame], on: dict | None = None) -> DataFrame:
    """A stage's result, taken up again if it was written whole and depends on the same as now.

    Spark marks a finished write, and what it depends on (`on`, of `depends`) is written beside it after that; a result
    that was made of other files or settings is made again.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now, beside = json.dumps(on, sort_keys=True), f"{path}.depends"
    whole = system.exists(hadoop(f"{path}/_SUCCESS"))
    same = on is None or (system.exists(hadoop(f"{beside}/_SUCCESS")) and spark.read.text(beside, wholetext=True).first()[0].strip() == now)
    if not (whole and same):
        system.delete(hadoop(beside), True)
        make().write.mode("overwrite").parquet(path)
        if on is not None:
            spark.createDataFrame([(now,)], "value string").coalesce(1).write.mode("overwrite").text(beside)
    return spark.read.parquet(path)
