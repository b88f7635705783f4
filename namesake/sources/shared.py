"""Work files in the folder that a cluster shares: where lineage is cut, and what is read again."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares.  Only a local session without one gets a folder of its own."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        import tempfile

        top = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/namesake/{spark.conf.get('spark.app.id', 'app')}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Deletes what this application's operators have written to the shared folder: once their results are read, as
    results read these files when they are used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark, "x")).getParent()
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Whether Spark removes the shuffle files of a write when the write is done; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("append").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs no more than its tasks."""
    return materialise_each([df], name)


def materialise_each(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Writes parts of one table one after another, and reads them as one: what a part exchanges is gone before the next."""
    path = ""
    for df in parts:
        path = path or work_dir(df.sparkSession, name)
        _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
