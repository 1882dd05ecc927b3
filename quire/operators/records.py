"""Records: folding issues, scoring confidence, gating drafts, comparing snapshots, and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fold(rows: DataFrame, keys: list[str], seq: list[str], occurrence: Column, confidence: str, severity: str, flag: str) -> DataFrame:
    """One issue per group: occurrences in order, mean confidence to two places, the first row's severity, whether any is flagged."""
    order = F.struct(*seq)
    return rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*seq, occurrence.alias("_o")))), lambda x: x["_o"]).alias("occurrences"),
        F.round(F.avg(confidence), 2).alias("confidence"),
        F.min_by(severity, order).alias("severity"),
        F.bool_or(flag).alias("needs_visual_check"),
    )


def unit_confidence(head: Column, displaced: Column, medium: Column, high: Column, trailing: Column, manual: Column) -> Column:
    """Confidence by rule, in decimals: at most .95, .8 if displaced, .85 if set by hand; .05, .15 and .03 off per issue; at least .3."""
    d = lambda x: F.lit(x).cast("decimal(6,4)")
    base = F.least(d("0.95"), head.cast("decimal(6,4)"))
    base = F.when(displaced, F.least(base, d("0.8"))).otherwise(base)
    base = F.when(manual, F.least(base, d("0.85"))).otherwise(base)
    off = medium.cast("decimal(10,0)") * d("0.05") + high.cast("decimal(10,0)") * d("0.15") + trailing.cast("decimal(10,0)") * d("0.03")
    return F.greatest(d("0.3"), base - off).cast("decimal(6,4)")


def pieces(rows: DataFrame, keys: list[str], order: list[str], text: str, start: str) -> DataFrame:
    """Join a group's texts in order with one space, line ends as spaces, and tell where each part begins in the whole."""
    one = F.regexp_replace(F.col(text), "\n", " ")
    sized = rows.withColumn("_text", one)
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("piece_start", F.coalesce(F.sum(F.length("_text") + 1).over(by), F.lit(0)))
    whole = F.array_sort(F.collect_list(F.struct(*order, "piece_start", F.col(start).alias("char_start"), "_text")))
    return placed.groupBy(*keys).agg(whole.alias("_w")).select(
        *keys,
        F.array_join(F.transform("_w", lambda x: x["_text"]), " ").alias("text"),
        F.transform("_w", lambda x: F.struct(x["piece_start"].alias("piece_start"), x["char_start"].alias("char_start"))).alias("spans"),
    )


def reasons(checks: list[tuple[str, Column]]) -> Column:
    """Codes of all checks that fail, in order; a null condition counts as not failed."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in checks]))


def repeats(rows: DataFrame, keys: list[str], same: list[str], order: list[str]) -> DataFrame:
    """Rows marked repeat if an earlier row of the group says the same."""
    return rows.withColumn("repeat", F.row_number().over(Window.partitionBy(*keys, *same).orderBy(*order)) > 1)


def least_confidence(base: Column, sheet: Column) -> Column:
    """min(base, sheet) to two places; a sheet of 0 or null does not count."""
    return F.round(F.least(base, F.coalesce(F.nullif(sheet, F.lit(0.0)), base)), 2)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, old, new, change) of every key that was added, removed or changed; equal nulls are equal."""
    a = old.select(*keys, F.col(value).alias("old"), F.lit(True).alias("_in_old"))
    b = new.select(*keys, F.col(value).alias("new"), F.lit(True).alias("_in_new"))
    both = a.join(b, keys, "full_outer")
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.withColumn("change", change).where("change is not null").drop("_in_old", "_in_new")


def upsert(rows: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The last write of every key wins."""
    by = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in seq])
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, each once, with side a or b."""
    left = a.distinct().join(b.distinct(), a.columns, "left_anti").withColumn("side", F.lit("a"))
    return left.unionByName(b.distinct().join(a.distinct(), a.columns, "left_anti").withColumn("side", F.lit("b")))


def upsert_returning(old: DataFrame, rows: DataFrame, keys: list[str], seq: list[str], id_column: str) -> DataFrame:
    """The last write of every key with its id: the stored one, or for new keys the next ids in the order of the keys.

    Places of new keys come from a range sort and counts of its parts, so that no task sees them all.
    """
    from quire.operators.spans import placed

    last = upsert(rows, keys, seq)
    known = last.join(old.select(*keys, id_column), keys, "left")
    top = old.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    fresh = placed(known.where(F.col(id_column).isNull()).drop(id_column), [F.col(k) for k in keys], "_nth").join(top).withColumn(id_column, F.col("_top") + F.col("_nth")).drop("_top", "_nth")
    return known.where(F.col(id_column).isNotNull()).unionByName(fresh)
