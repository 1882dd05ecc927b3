"""What the operators of this folder share: scratch tables in the cluster's shared folder, and column helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.sources import files, scratch

#: Rows in one Arrow batch handed to Python; documents are long, so it is far below Spark's 10,000.
ARROW_ROWS = 512
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession, n_bytes: int | None = None) -> None:
    """Keep Arrow batches small enough for long documents, or for rows of megabytes by their bytes, unless the session asks for smaller ones already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(ARROW_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    most = re.match(r"(\d+)([bkmgtp]?)", spark.conf.get(key).lower())
    if n_bytes and int(most[1]) << 10 * "bkmgtp".index(most[2] or "b") > n_bytes:
        spark.conf.set(key, f"{n_bytes}b")


def write_table(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Cut lineage: df as a table in the folder that driver and executors share, reread; with group_rows, that many rows at most in a row group."""
    return scratch.written(df, name, group_rows=group_rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input; one whose files have fewer parts than there are tasks at once is dealt out, since its rows are long."""
    return files.spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name like wish that df does not have, whatever the case of its columns' names."""
    have = {c.lower() for c in df.columns}
    while wish.lower() in have:
        wish += "_"
    return wish


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def remainder(c: Column, by: int) -> Column:
    """crc32 of a column's text, modulo by; null stays null."""
    return F.crc32(c.cast("string").cast("binary")) % by


def labelled_sample(docs: DataFrame, known: DataFrame, per_label: int) -> list[dict]:
    """At most per_label texts for each label of known(doc_id, label), drawn by hash over all rows, as the driver's rows in hash order.

    The choice is made on ids (each once, with its smallest label), so that it moves no text. A label's count
    sets how small a hash must be for about twice per_label rows to have such; only those are ranked. Counts
    and chosen ids, bounded like the result, are broadcast, the ids to fetch docs(doc_id, text). Rows with a null id or label take no
    part; of rows that repeat an id, the smallest text is taken.
    """
    once = known.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    once = once.withColumn("hash", F.xxhash64(F.col("doc_id"), F.lit(8)))
    counts = once.groupBy("label").agg(F.count("*").alias("of_label"))
    share = F.pmod("hash", F.lit(1 << 40)) / float(1 << 40)
    few = once.join(F.broadcast(counts), "label").where(share <= (2 * per_label + 100) / F.col("of_label"))
    order = Window.partitionBy("label").orderBy(share, "doc_id")
    chosen = few.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_label).select("doc_id", "label", "nth")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "label", "nth").agg(F.min("text").alias("text")).toArrow().to_pylist()
    return sorted(rows, key=lambda r: (r["nth"], r["label"]))
