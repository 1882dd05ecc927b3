"""What a new text offers to the settings of its book: repeated lines, heading candidates, markers, marks, headings not found.

All work on the line table, keyed by book, and count by plain aggregations; limits are those of the report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import spans as S

#: Fewest repeats of a header, most of a heading, most words of a heading, its highest ratio of marks, lines looked ahead, ratio of marked text behind it, and words of a line whose marks count: fixed values.
LEAST_REPEATS, MOST_REPEATS, MOST_WORDS, BARE, AHEAD, MARKED, LONG_LINE = 3, 5, 8, 0.05, 3, 0.3, 4
#: Rows of the report: most common lines, strong and weak heading candidates.
COMMON, STRONG, WEAK = 40, 200, 120


@dataclass(frozen=True)
class Script:
    """Which characters are letters and marks, what a footnote marker is, what no heading has, and what a line of a number alone is."""

    letters: str = T.ARABIC
    marks: str = T.MARKS
    marker: str = r"\(\s*[0-9٠-٩۰-۹]{1,2}\s*\)"
    unlike: str = r"[«»:\[\]0-9٠-٩۰-۹]"
    number: str = r"^[\s•\-–—.]*[0-9٠-٩۰-۹]{1,3}[\s•\-–—.]*$"

    def words(self, line: Column) -> Column:
        return F.size(T.words_with(line, self.letters))

    def ratio(self, line: Column) -> Column:
        return T.mark_ratio(line, self.marks, self.letters)


def common_lines(lines: DataFrame, script: Script = Script(), key: str = "book_id") -> DataFrame:
    """(key, line, n, first_at): of each book's most common lines those that repeat, have a word, and are no number; ties by first place."""
    counted = lines.select(key, "line_no", F.trim("line").alias("line")).where("line <> ''").groupBy(key, "line").agg(F.count("*").alias("n"), F.min("line_no").alias("first_at"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first_at"))
    top = counted.withColumn("_n", rank).where(F.col("_n") <= COMMON).drop("_n")
    return top.where((F.col("n") >= LEAST_REPEATS) & (script.words(F.col("line")) >= 1) & ~F.col("line").rlike(script.number))


def heading_candidates(lines: DataFrame, script: Script = Script(), key: str = "book_id") -> DataFrame:
    """(key, line_no, line, following, strong): short bare rare lines, with the ratio of marks of the next line with words; at most STRONG and WEAK a book, in order."""
    by = Window.partitionBy(key).orderBy("line_no")
    n_words = script.words(F.col("line"))
    ahead = [F.when(script.words(F.lead("line", k).over(by)) >= 1, script.ratio(F.lead("line", k).over(by))) for k in range(1, AHEAD + 1)]
    seen = lines.select(key, "line_no", F.trim("line").alias("stripped"), F.round(F.coalesce(*ahead, F.lit(0.0)), 2).alias("following"), n_words.alias("n_words"), script.ratio(F.col("line")).alias("ratio"))
    often = seen.groupBy(key, "stripped").agg(F.count("*").alias("n")).where(F.col("n") < MOST_REPEATS)
    short = seen.where(F.col("n_words").between(1, MOST_WORDS) & (F.col("ratio") < BARE) & ~F.col("stripped").rlike(script.unlike))
    marked = short.join(often, [key, "stripped"]).withColumn("strong", F.col("following") > MARKED)
    place = F.row_number().over(Window.partitionBy(key, "strong").orderBy("line_no"))
    kept = marked.withColumn("_n", place).where(F.col("_n") <= F.when(F.col("strong"), STRONG).otherwise(WEAK))
    return kept.select(key, "line_no", F.col("stripped").alias("line"), "following", "strong")


def figures(lines: DataFrame, script: Script = Script(), key: str = "book_id") -> DataFrame:
    """(key, lines, footnote_start_lines, marker_occurrences, quartiles): quartiles are steps of the sorted ratios of marks of longer lines; none for fewer than four."""
    ratio = F.when(script.words(F.col("line")) >= LONG_LINE, script.ratio(F.col("line")))
    return lines.groupBy(key).agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("line").rlike(rf"^\s*{script.marker}\s*\S")).alias("footnote_start_lines"),
        F.sum(F.regexp_count("line", F.lit(script.marker))).alias("marker_occurrences"),
        S.quarter_steps(ratio).alias("quartiles"),
    )


def missing_headings(books: DataFrame, headings: str = "headings", key: str = "book_id") -> DataFrame:
    """(key, heading) of the configured headings (an array of texts) that a book's normalized text does not have."""
    asked = books.select(key, T.ENGINE.apply(F.col("text")).alias("_flat"), F.explode(headings).alias("heading"))
    return asked.where(~F.coalesce(F.contains("_flat", T.ENGINE.apply(F.col("heading"))), F.lit(False))).select(key, "heading")
