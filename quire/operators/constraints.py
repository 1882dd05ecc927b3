"""Integrity constraints: each yields rows (check, severity, key, message); a report counts and quotes them.

Constraints are declared over DataFrames and combined by union, so that one plan evaluates all and each
scan is shared by Catalyst where it can be.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import spans
from quire.sources import scratch

VIOLATION = ("check", "severity", "key", "message")
#: Examples that a report quotes per check.
EXAMPLES = 40


def violations(rows: DataFrame, check: str, severity: str, key: Column, message: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), message.cast("string").alias("message"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count n."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key is not null and not in parent."""
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.where(F.col(child_key).isNotNull()).join(known, F.col(child_key) == F.col("_known"), "left_anti")


def outside(rows: DataFrame, start: str, end: str, length: str) -> DataFrame:
    """Spans that break 0 <= start < end <= length, or have a null bound."""
    good = (F.col(start) >= 0) & (F.col(start) < F.col(end)) & (F.col(end) <= F.col(length))
    return rows.where(~F.coalesce(good, F.lit(False)))


def differing_text(rows: DataFrame, source: str, start: str, end: str, stored: str) -> DataFrame:
    """Spans whose stored text is not the source's."""
    return rows.where(~F.substr(F.col(source), F.col(start) + 1, F.col(end) - F.col(start)).eqNullSafe(F.col(stored)))


def numbering(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Groups whose numbers are null, repeated, or leave gaps: (keys, n, lowest, highest, distinct, n_null)."""
    each = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(number).alias("lowest"), F.max(number).alias("highest"), F.countDistinct(number).alias("n_distinct"), F.count_if(F.col(number).isNull()).alias("n_null"))
    return each.where("n_null > 0 or n_distinct < n or highest - lowest + 1 <> n_distinct")


def out_of_order(rows: DataFrame, keys: list[str], number: str, place: str) -> DataFrame:
    """Rows whose rank by number is not their rank by place."""
    by = Window.partitionBy(*keys)
    ranked = rows.withColumn("by_number", F.row_number().over(by.orderBy(number, place))).withColumn("by_place", F.row_number().over(by.orderBy(place, number)))
    return ranked.where("by_number <> by_place")


def unmirrored(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either side without an equal of the other, by keys; side says which."""
    left = a.select(*keys).join(b.select(*keys), keys, "left_anti").withColumn("side", F.lit("a"))
    return left.unionByName(b.select(*keys).join(a.select(*keys), keys, "left_anti").withColumn("side", F.lit("b")))


def unreachable(nodes: DataFrame, roots: DataFrame, keys: list[str], key: str, parent: str) -> DataFrame:
    """Nodes that no chain of parents leads to one of the roots: of other trees, of cycles, or below a parent that is not there."""
    above = spans.trees(nodes, keys, key, parent)
    return above.join(roots.select(*keys, F.col(key).alias("root")), [*keys, "root"], "left_anti")


def inexact(places: DataFrame, parts: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Places that begin where a part of the same keys does, but end where none does that begins there."""
    begin = [*keys, start]
    return places.join(parts.select(*begin).distinct(), begin, "left_semi").join(parts.select(*begin, end).distinct(), [*begin, end], "left_anti")


def misplaced(rows: DataFrame, span: tuple[str, str], host: tuple[str, str], placement: str) -> DataFrame:
    """Rows whose placement is not in_span where their span lies in its host's, or not displaced elsewhere."""
    inside = (F.col(host[0]) <= F.col(span[0])) & (F.col(span[1]) <= F.col(host[1]))
    return rows.where(F.when(inside, "in_span").otherwise("displaced") != F.coalesce(placement, F.lit("")))


def unpaired(notes: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """(problem, keys): notes that several anchors share, and bare notes that no anchor leads to."""
    shared = duplicates(anchors, keys).select(F.lit("shared").alias("problem"), *keys)
    bare = notes.select(*keys).distinct().join(anchors.select(*keys).distinct(), keys, "left_anti")
    return shared.unionByName(bare.select(F.lit("bare").alias("problem"), *keys))


def all_alike(rows: DataFrame, keys: list[str], value: str, more: list[Column] = (), least: int = 3) -> DataFrame:
    """(keys, n): groups of more than least rows that have one value only."""
    each = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct(value).alias("_kinds"), *more)
    return each.where((F.col("n") > least) & (F.col("_kinds") == 1)).drop("_kinds")


def gathered(found: list[DataFrame], at_once: int = 5) -> DataFrame:
    """All violations as one table, some checks at a time: the planning of a union of many joins grows faster than their number."""
    parts = [scratch.written(reduce(DataFrame.unionByName, found[i : i + at_once]), "violations") for i in range(0, len(found), at_once)]
    return reduce(DataFrame.unionByName, parts)


def report(found: Iterable[DataFrame], examples: int = EXAMPLES) -> DataFrame:
    """(check, severity, n, examples): counts, and the first examples in order of their keys.

    Counting is an aggregation; the examples come from a ranked window whose rank limit each task applies
    before the shuffle, so no check's violations meet in one task as a list.
    """
    all_ = reduce(DataFrame.unionByName, found)
    counts = all_.groupBy("check", "severity").agg(F.count("*").alias("n"))
    by = Window.partitionBy("check", "severity").orderBy("key", "message")
    first = all_.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= examples)
    quoted = first.groupBy("check", "severity").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "message"))), lambda x: x["message"]).alias("examples"))
    return counts.join(quoted, ["check", "severity"])
