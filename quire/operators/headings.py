"""Headings of books as relations: where each occurs and how it stands there, and which occurrence of each begins its unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T

#: How an occurrence stands, worst first, and how sure a unit is that begins with it: fixed values.
STANDS = ("glued", "glued", "standalone_with_page_number", "standalone")
CONFIDENCE = (0.8, 0.8, 0.85, 0.95)


def grade(before: Column, after: Column) -> Column:
    """How a span stands on its line, by what is around it there: 3 alone, 2 alone but for digits, 1 at an edge of the line, 0 within it."""
    return F.when(T.standalone(before, after), 3).when(T.standalone(before, after, True), 2).when(T.at_line_edge(before, after), 1).otherwise(0)


def occurrences(books: DataFrame, headings: DataFrame) -> DataFrame:
    """(book_id, ordinal, char_start, char_end, grade): every place of every heading in its book's text, none within another of the same heading.

    books(book_id, text), headings(book_id, ordinal, heading). A text is cut at the heading, and its parts tell places and lines, so no text
    is copied to its occurrences. Null texts, null and empty headings have none; repeated books have theirs each.
    """
    asked = books.where("text is not null").join(headings.where("heading is not null and heading <> ''"), "book_id").withColumn("_row", F.monotonically_increasing_id())
    quoted = F.concat(F.lit("\\Q"), F.replace("heading", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    parts = asked.select("book_id", "ordinal", "_row", F.length("heading").alias("_n"), F.posexplode(F.split("text", quoted)).alias("_k", "_part"))
    # of a part only its ends on the lines of the headings around it move on; what stands for a heading there is no white space
    has_line = F.contains("_part", F.lit("\n"))
    tail, head = F.substring_index("_part", "\n", -1), F.substring_index("_part", "\n", 1)
    ends = parts.select("book_id", "ordinal", "_row", "_n", "_k", F.length("_part").alias("_size"), F.when(has_line | (F.col("_k") == 0), tail).otherwise(F.concat(F.lit("x"), "_part")).alias("_tail"), head.alias("_head"), has_line.alias("_line"))
    by = Window.partitionBy("_row").orderBy("_k")
    start = F.sum(F.col("_size") + F.col("_n")).over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    last = F.lead("_k", 2).over(by).isNull()
    after = F.lead("_head").over(by)
    after = F.when(F.lead("_line").over(by) | last, after).otherwise(F.concat(after, F.lit("x")))
    placed = ends.withColumn("_start", start).withColumn("_after", after).where("_after is not null")
    return placed.select("book_id", "ordinal", F.col("_start").cast("int").alias("char_start"), (F.col("_start") + F.col("_n")).cast("int").alias("char_end"), grade(F.col("_tail"), F.col("_after")).alias("grade"))


def chosen(found: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """(book_id, ordinal, char_start, char_end, grade, stands, confidence): the occurrence at which each heading's unit begins.

    From the last heading of a book back, each takes its best-standing occurrence that ends before the one chosen after it, the last
    of equals; limits(book_id, char_end) are ends of the main parts. Headings for which none is left have no row. A book's
    occurrences are one ordered array over which one aggregate walks with the limit as its state; it holds a few numbers each.
    """
    spot = F.struct(F.col("grade").alias("grade"), F.col("char_start").alias("char_start"), F.col("char_end").alias("char_end"))
    each = found.groupBy("book_id", "ordinal").agg(F.collect_list(spot).alias("spots"))
    books = each.groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "spots")), asc=False).alias("headings"))
    books = books.join(limits.select("book_id", F.col("char_end").alias("limit")), "book_id", "left") if limits is not None else books.withColumn("limit", F.lit(None).cast("int"))
    one = "struct<ordinal: int, grade: int, char_start: int, char_end: int>"
    zero = F.struct(F.coalesce("limit", F.lit(2**31 - 1)).alias("limit"), F.array().cast(f"array<{one}>").alias("out"))

    def step(state: Column, heading: Column) -> Column:
        best = F.array_max(F.filter(heading["spots"], lambda s: s["char_end"] <= state["limit"]))
        row = F.struct(heading["ordinal"].cast("int").alias("ordinal"), best["grade"].alias("grade"), best["char_start"].alias("char_start"), best["char_end"].alias("char_end"))
        return F.when(best.isNull(), state).otherwise(F.struct(best["char_start"].alias("limit"), F.array_append(state["out"], row).alias("out")))

    rows = books.select("book_id", F.inline(F.aggregate("headings", zero, step)["out"]))
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("grade") + 1)
    return rows.withColumn("stands", of(STANDS)).withColumn("confidence", of(CONFIDENCE))
