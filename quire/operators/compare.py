"""Two builds of the same books compared: labels, issues, pages, units, and whole files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import records as R
from quire.operators import spans as S
from quire.operators import validate as V

#: Changes of one kind that are closer than this are one run: fixed value.
GAP = 40


def labels(built: DataFrame) -> DataFrame:
    """(book_id, label, char_start, char_end): what each stretch of a book is, units over noise over nodes; neighbours of one label joined."""
    segments, noise, units = V.relation(built, "segment"), V.relation(built, "noise"), V.relation(built, "unit")
    number = units.select("book_id", F.col("id").alias("owner"), F.col("ordinal").alias("_ordinal")).distinct()
    footnote = F.when(F.col("ref").isNotNull(), F.concat(F.lit(" "), "ref")).otherwise("")
    of_units = segments.where("kind = 'unit'").drop("ordinal").join(number, ["book_id", "owner"]).select("book_id", F.concat(F.lit("unit "), "_ordinal", F.lit(" "), "role", footnote).alias("label"), "char_start", "char_end", F.lit(2).alias("layer"))
    of_nodes = segments.where("kind = 'node'").select("book_id", F.concat(F.lit("node "), "owner", F.lit(" "), "role").alias("label"), "char_start", "char_end", F.lit(0).alias("layer"))
    of_noise = noise.select("book_id", F.concat(F.lit("noise "), "owner").alias("label"), "char_start", "char_end", F.lit(1).alias("layer"))
    return S.overlay(of_nodes.unionByName(of_noise).unionByName(of_units), ["book_id"], "char_start", "char_end", ["layer", "char_start", "label"], "label").select("book_id", "label", "char_start", "char_end")


def changed_spans(old: DataFrame, new: DataFrame, keys: list[str], label: str, start: str, end: str) -> DataFrame:
    """(keys, old, new, start, end): stretches that two labellings, each without overlaps, label differently; null where one has no label.

    Both sides' break points cut the axis into cells, and an as-of pass over the ordered cells tells what either side
    says there, so no span meets any other.
    """
    edges = [
        rows.select(*keys, F.explode(F.array(F.struct(F.col(start).alias("at"), F.struct(F.col(label).alias("label")).alias("x")), F.struct(F.col(end).alias("at"), F.struct(F.lit(None).cast("string").alias("label")).alias("x")))).alias("e")).select(*keys, "e.at", F.col("e.x").alias(side))
        for rows, side in ((old.where(F.col(start) < F.col(end)), "_a"), (new.where(F.col(start) < F.col(end)), "_b"))
    ]
    both = edges[0].unionByName(edges[1], allowMissingColumns=True)
    # where one span ends and the next begins, the beginning counts
    points = both.groupBy(*keys, "at").agg(*[F.max_by(side, F.when(F.col(side).isNotNull(), F.col(f"{side}.label").isNotNull())).alias(side) for side in ("_a", "_b")])
    by = Window.partitionBy(*keys).orderBy("at")
    says = points.select(*keys, F.col("at").alias(start), F.lead("at").over(by).alias(end), *[F.last(side, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))["label"].alias(name) for side, name in (("_a", "old"), ("_b", "new"))])
    return says.where(F.col(end).isNotNull() & ~F.col("old").eqNullSafe(F.col("new"))).select(*keys, "old", "new", start, end)


def label_runs(changes: DataFrame, keys: list[str], start: str, end: str, gap: int = GAP) -> DataFrame:
    """Changes of one (old, new) pair joined while the next begins less than gap behind the last character of the one before, and no other pair comes between."""
    by = Window.partitionBy(*keys).orderBy(start)
    same = F.lag("old").over(by).eqNullSafe(F.col("old")) & F.lag("new").over(by).eqNullSafe(F.col("new"))
    joins = same & (F.row_number().over(by) > 1) & (F.col(start) - (F.lag(end).over(by) - 1) < gap)
    marked = changes.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_run", "old", "new").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def visible_changes(old: DataFrame, new: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, old, new, char_start, char_end): runs of visible text that two builds label differently."""
    changes = V.with_text(changed_spans(labels(old), labels(new), ["book_id"], "label", "char_start", "char_end"), books)
    seen = changes.where(V.seen(F.col("span_text")) > 0)
    left = F.length("span_text") - F.length(F.ltrim(F.regexp_replace("span_text", r"\s", " ")))
    right = F.length("span_text") - F.length(F.rtrim(F.regexp_replace("span_text", r"\s", " ")))
    trimmed = seen.withColumn("char_end", F.col("char_end") - right).withColumn("char_start", F.col("char_start") + left)
    return label_runs(trimmed.drop("span_text"), ["book_id"], "char_start", "char_end")


def _side(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return rows.select(*keys, value.alias("value"))


def differences(old: DataFrame, new: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, what, key, old, new): everything that a reader of two builds would want to know; empty if they say the same.

    what is label, issue, page, unit or detail; detail tells that a relation's rows differ where nothing else does.
    """
    found = visible_changes(old, new, books).select("book_id", F.lit("label").alias("what"), F.concat_ws("-", "char_start", "char_end").alias("key"), "old", "new")
    place = F.concat_ws(" ", "kind", "char_start", "char_end", "ref")
    pages = F.concat_ws(" ", "char_start", "kind", "note")
    units = F.concat_ws(" ", "char_start", "char_end", "confidence", "note", "ref")
    for what, name, key, value in (("issue", "occurrence", place, F.lit("")), ("page", "page", F.col("id"), pages), ("unit", "unit", F.col("ordinal").cast("string"), units)):
        a, b = (V.relation(x, name).select("book_id", key.alias("key"), value.alias("value")).distinct() for x in (old, new))
        met = R.snapshot_diff(a, b, ["book_id", "key"], "value")
        found = found.unionByName(met.select("book_id", F.lit(what).alias("what"), "key", *[F.when(F.col("change") == gone, change).otherwise(F.col(side)).alias(side) for side, gone, change in (("old", "added", "(nothing)"), ("new", "removed", "(nothing)"))]))
    uneven = unequal(old, new)
    quiet = uneven.join(found.select("book_id").distinct(), "book_id", "left_anti")
    return found.unionByName(quiet.select("book_id", F.lit("detail").alias("what"), F.col("relation").alias("key"), F.lit("").alias("old"), F.lit("").alias("new")))


def unequal(old: DataFrame, new: DataFrame) -> DataFrame:
    """(book_id, relation) whose rows are not the same on both sides, repeats counted: by their count and the sum of their hashes, so that nothing is collected."""
    def digest(rows: DataFrame, side: str) -> DataFrame:
        whole = F.to_json(F.struct(*[c for c in rows.columns if c != "book_id"]))
        return rows.groupBy("book_id", "relation").agg(F.struct(F.count("*").alias("n"), F.sum(F.xxhash64(whole).cast("decimal(38,0)")).alias("h")).alias(side))

    both = digest(old, "a").join(digest(new, "b"), ["book_id", "relation"], "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("book_id", "relation")
