"""Tables that a plan reads several times, written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
#: Releases the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; of our own where that is unset and all runs on one machine (tests)."""
    found = spark.conf.get(SHARED, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SHARED} must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set(SHARED, found)
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table in the shared folder."""
    return f"{root(spark)}/quire/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd", group_rows: int | None = None) -> DataFrame:
    """Cut lineage: write df as a table in the shared folder and return its rereading.

    The shuffle files of the write are released as soon as it ends; a lost executor costs nothing, since the
    table is whole and outside of any executor. A reader holds a row group's columns at once, and writers look at a group's
    bytes only after its first hundred rows; group_rows bounds it for tables whose rows are megabytes.
    """
    spark, at = df.sparkSession, path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        out = df.write.option("compression", codec)
        (out.option("parquet.block.row.count.limit", group_rows) if group_rows else out).parquet(at)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(at)
    out._scratch = at
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that written() made, once nothing reads it any more."""
    at = getattr(df, "_scratch", None)
    if at:
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(at)
        place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
