"""Sources and sinks: byte-exact texts and their profile, strict JSON, page lists of either form, and guarded writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = b"\xef\xbb\xbf"
PAGE = "page_index INT, printed_page_number INT, char_start INT, char_end INT, evidence STRING, confidence DOUBLE"
PAGES = f"ARRAY<STRUCT<{PAGE}>>"
PDF_PAGE = "text STRING, height DOUBLE, lines ARRAY<STRUCT<bbox: ARRAY<DOUBLE>, text: STRING>>"
TXT_LINE = "char_start INT, char_end INT, page_index INT, line INT, score DOUBLE, cover DOUBLE, n INT"


def spread(df: DataFrame) -> DataFrame:
    """df, the scan of a table, dealt over at least as many parts as the session has tasks at once; one with enough parts stays as it is.

    Only for scans: their parts are known from the files, while those of other plans are known only by running them.
    """
    at_once = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= at_once else df.repartition(at_once)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, path, content): whole files as bytes, so that offsets count what is on disk. book_id is the file's name."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("book_id"), "path", "content")


def profile(rows: DataFrame, key: str, content: Column) -> DataFrame:
    """(key, text, n_chars, n_bytes, sha256, crlf, bom) of byte contents; broken UTF-8 gives a null text."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    return rows.select(key, text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("sha256"), F.contains(text, F.lit("\r\n")).alias("crlf"), F.startswith(content, F.lit(BOM)).alias("bom"))


def json_problem(content: Column) -> Column:
    """What is wrong with a JSON file's bytes: encoding, json, bom, crlf, or null."""
    text = content.cast("string")
    broken = F.try_parse_json(F.regexp_replace(text, "^﻿", "")).isNull()
    return F.when(~F.is_valid_utf8(text), "encoding").when(broken, "json").when(F.startswith(content, F.lit(BOM)), "bom").when(F.contains(text, F.lit("\r\n")), "crlf")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, value, problem): one document per file; problem is null, encoding, bom, json, or crlf, and value is then null but for bom and crlf."""
    found = spark.read.format("binaryFile").load(path).withColumn("problem", json_problem(F.col("content")))
    value = F.from_json(F.regexp_replace(F.col("content").cast("string"), "^﻿", ""), schema)
    return found.select("path", F.when(F.col("problem").isNull() | F.col("problem").isin("bom", "crlf"), value).alias("value"), "problem")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, pages, txt_lines) of a page list in either form: an array, or an object with pages and txt_lines."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.ltrim("value").alias("value"))
    as_object = F.from_json("value", f"pages {PAGES}, txt_lines ARRAY<STRUCT<{TXT_LINE}>>")
    is_list = F.startswith("value", F.lit("["))
    return whole.select("path", F.when(is_list, F.from_json("value", PAGES)).otherwise(as_object["pages"]).alias("pages"), F.when(~is_list, as_object["txt_lines"]).alias("txt_lines"))


def read_pdf_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, height, line, bbox, text) of pre-extracted page texts, a list of pages per file; lines ordered from the top and from the right."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.posexplode(F.from_json("value", f"ARRAY<STRUCT<{PDF_PAGE}>>")).alias("page", "p"))
    order = F.array_sort("p.lines", lambda a, b: F.when(a["bbox"][1] < b["bbox"][1], -1).when(a["bbox"][1] > b["bbox"][1], 1).when(a["bbox"][2] > b["bbox"][2], -1).when(a["bbox"][2] < b["bbox"][2], 1).otherwise(0))
    return whole.select("path", "page", "p.height", F.posexplode(order).alias("line", "l")).select("path", "page", "height", "line", "l.bbox", "l.text")


def listed(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(path, name, number, place): the files of a folder with an ending, sorted by name, with the first run of digits in each and its place."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(folder).select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    from quire.operators import spans

    placed = spans.placed(found, [F.col("name"), F.col("path")], "place")
    return placed.select("path", "name", F.regexp_extract("name", "[0-9]+", 0).try_cast("int").alias("number"), F.col("place").cast("int").alias("place"))


def write_json(df: DataFrame, path: str, partition: str | None = None) -> None:
    """UTF-8 without a byte order mark, LF line ends, non-ASCII characters as they are."""
    writer = df.write.mode("overwrite").option("lineSep", "\n")
    (writer.partitionBy(partition) if partition else writer).json(path)


def approve(snapshot: DataFrame, errors: DataFrame, path: str) -> None:
    """Replace a stored snapshot only if there are no errors."""
    if not errors.isEmpty():
        raise ValueError("a snapshot with errors is not approved")
    snapshot.write.mode("overwrite").parquet(path)


def create_database(spark: SparkSession, name: str) -> bool:
    """Create a database unless it exists; tells whether it did not."""
    missing = not spark.catalog.databaseExists(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return missing
