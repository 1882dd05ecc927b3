"""The files that a build leaves, as one relation (book_id, name, content) of JSON texts, and the tables of the archive."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import records
from quire.sources import scratch

#: Tables of the archive, their columns, and what must be unique: fixed values.
TABLES = {
    "books": ("id INT, slug STRING, title STRING, total_pages INT, created_at TIMESTAMP", ("slug",), {}),
    "raw_pages": ("id INT, book_id INT, page_number INT, hadith_number INT, raw_text STRING, ocr_confidence STRING, ocr_model STRING, created_at TIMESTAMP", ("book_id", "page_number"), {"book_id": "books"}),
    "knowledge_objects": ("id INT, book_id INT, page_number INT, hadith_number INT, original_text STRING, extracted_idea STRING, topic STRING, confidence DECIMAL(4,2), model_used STRING, status STRING, created_at TIMESTAMP", ("id",), {"book_id": "books"}),
    "relationships": ("id INT, source_object_id INT, target_object_id INT, relation_type STRING, confidence DECIMAL(4,2), created_at TIMESTAMP", ("id",), {"source_object_id": "knowledge_objects", "target_object_id": "knowledge_objects"}),
}


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the archive's tables unless they exist; their names. Keys are checked by table_violations."""
    prefix = f"{database}." if database else ""
    for name, (columns, _, _) in TABLES.items():
        parts = " PARTITIONED BY (book_id)" if name == "raw_pages" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet{parts}")
    return [f"{prefix}{name}" for name in TABLES]


def table_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, severity, key, message) of rows that break the archive's unique keys or refer to nothing."""
    from functools import reduce

    from quire.operators import constraints as C

    found = []
    for name, (_, unique, refers) in TABLES.items():
        found.append(C.violations(C.duplicates(tables[name], list(unique)), "unique", "error", F.lit(name), F.concat_ws(" ", *unique)))
        for column, target in refers.items():
            found.append(C.violations(C.orphans(tables[name], tables[target], column, "id"), "refs", "error", F.lit(name), F.col(column)))
    return reduce(DataFrame.unionByName, found)


def pages_file(pages: DataFrame, placed: DataFrame | None = None, printed: DataFrame | None = None) -> DataFrame:
    """(book_id, name, content): a page model as pages.json.

    With printed lines (book_id, page_index, height, line, bbox, text) a page has its height and lines; with placed lines
    (book_id, line_no, char_start, char_end, page_index, line, score, cover, n) the file is an object of both, else a list.
    """
    fields = ["page_index", "char_start", "char_end", "evidence", "confidence"]
    if printed is not None:
        lines = printed.groupBy("book_id", "page_index").agg(F.max("height").alias("height"), F.transform(F.array_sort(F.collect_list(F.struct("line", F.struct("bbox", "text").alias("x")))), lambda r: r["x"]).alias("lines"))
        pages, fields = pages.join(lines, ["book_id", "page_index"], "left"), [*fields, "height", "lines"]
    own = pages.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("pages"))
    if placed is None:
        return own.select("book_id", F.lit("pages.json").alias("name"), F.to_json("pages").alias("content"))
    lines = placed.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.struct("char_start", "char_end", "page_index", "line", "score", "cover", "n").alias("x")))), lambda r: r["x"]).alias("txt_lines"))
    return own.join(lines, "book_id", "left").select("book_id", F.lit("pages.json").alias("name"), F.to_json(F.struct("pages", "txt_lines")).alias("content"))


def report_file(report: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """(name, content): a report of constraints as validation_report.json: status, counts, checks by severity with examples.

    With stats, as validate.summary gives them, the report has those of every book by its id; books must then be few enough for one file.
    """
    side = lambda s: F.filter("checks", lambda x: x["severity"] == s)
    count = lambda s: F.aggregate(side(s), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    whole = report.agg(F.array_sort(F.collect_list(F.struct("severity", "check", "n", "examples"))).alias("checks"))
    fields = [F.when(count("error") > 0, "fail").otherwise("pass").alias("status"), count("error").alias("error_count"), count("warn").alias("warning_count"), side("error").alias("errors"), side("warn").alias("warnings")]
    if stats is not None:
        roles = F.from_json("segment_roles", "map<string, int>").alias("segment_roles")
        each = F.struct(F.col("n_chars").alias("source_length_chars"), "nodes", "units", "issues", F.col("noises").alias("noise_spans"), "pages", roles, F.col("body_role_share"), F.col("covered").alias("covered_non_whitespace_chars"), F.col("visible").alias("non_whitespace_chars"))
        own = stats.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("book_id", F.to_json(each).alias("x"))))).alias("by_book"))
        whole = whole.crossJoin(own.select(F.transform_values("by_book", lambda _, x: F.from_json(x, stats.select(each.alias("x")).schema["x"].dataType)).alias("stats")))
        fields.append(F.col("stats"))
    return whole.select(F.lit("validation_report.json").alias("name"), F.to_json(F.struct(*fields)).alias("content"))


def write_named(rows: DataFrame, folder: str, keys: tuple[str, ...] = ("book_id",)) -> int:
    """Write (keys, name, content) as files folder/keys/name, UTF-8 without a byte order mark, LF line ends; how many. For one machine: rows stream through the driver."""
    n = 0
    for row in rows.toLocalIterator():
        path = Path(folder).joinpath(*(str(row[k]) for k in keys), row["name"])
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(row["content"].encode())
        n += 1
    return n


def upsert_table(rows: DataFrame, table: str, keys: list[str], seq: list[str], partition: str) -> None:
    """Write rows into a stored table: the last row of every key, by seq, takes the place of the stored one; other stored rows stay.

    The table is made, partitioned by one column, if it is not there. Only partitions that rows touch are read; what they
    shall hold is written to the shared folder first and then takes their place in one commit, so that a failure
    leaves the old rows. Two writers at a time must be kept apart by the caller. No rows change nothing.
    """
    spark = rows.sparkSession
    latest = records.upsert(rows, keys, seq)
    if not spark.catalog.tableExists(table):
        latest.write.format("parquet").partitionBy(partition).saveAsTable(table)
        return
    columns = spark.table(table).columns
    fresh = scratch.written(latest.select(*columns), "upserted")
    touched = fresh.select(partition).distinct()
    old = spark.table(table).join(touched, partition, "left_semi").join(fresh.select(*keys), keys, "left_anti").select(*columns)
    whole = scratch.written(old.unionByName(fresh), "partitions")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        whole.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    scratch.discard(fresh)
    scratch.discard(whole)


def save_pages(pages: DataFrame, folder: str, table: str | None = None) -> bool:
    """One JSON file per page of (book_id, page_number, raw_text) and, where the table can be reached, its row there by book and page; whether it could.

    A page that is written again replaces its file and its row.
    """
    content = pages.select("book_id", F.format_string("page-%03d.json", "page_number").alias("name"), F.to_json(F.struct(*pages.columns)).alias("content"))
    write_named(content, folder)
    if table is None or not pages.sparkSession.catalog.tableExists(table):
        return False
    upsert_table(pages, table, ["book_id", "page_number"], [c for c in ("created_at",) if c in pages.columns] or ["raw_text"], "book_id")
    return True
