"""Spans on an axis: islands, lookups, overlaps, coverage, overlays and ordered repairs.

Every operator takes its grouping columns (a book, a user), so that range conditions are residuals of an
equi-join and windows are partitioned. Starts are inclusive, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.window import Window

from quire.sources import scratch


#: Bytes of text that one step in Python takes from a batch.
AT_ONCE = 1 << 20


def numbered_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line) as line_table has them, for what needs no offsets: texts are cut in the scan itself and never go to Python."""
    return docs.select(key, F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("line_no", "line"))


def portions(batch: pa.RecordBatch, column: int, most: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch as runs of rows with some most bytes in a column, a longer row alone; so memory follows neither the rows of a batch nor their length."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = [*(np.flatnonzero(np.diff(upto // most)) + 1).tolist(), batch.num_rows]
    for start, end in zip([0, *ends], ends):
        if start < end:
            yield batch.slice(start, end - start)


def line_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, char_start, char_end, line): lines split at LF, the LF left out; null texts have none, rows that repeat a key have theirs each.

    Lines, lengths and their running sums come from whole columns of a portion of a batch where the texts stand, so that nothing is shuffled.
    """
    rows = docs.select(key, F.col(text).cast("string").alias("_text")).where("_text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in portions(whole, 1)):
            lists = pc.split_pattern(b.column(1), "\n")
            lines, row = lists.flatten(), pc.list_parent_indices(lists)
            size = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.searchsorted(row.to_numpy(), np.arange(b.num_rows))[row.to_numpy()]
            upto = np.cumsum(size + 1) - size - 1
            start = upto - upto[first] if len(upto) else upto
            ints = [pa.array(x.astype(np.int32)) for x in (np.arange(len(size)) - first, start, start + size)]
            yield pa.record_batch([b.column(0).take(row), *ints, lines], [key, "line_no", "char_start", "char_end", "line"])

    ints = [StructField(n, IntegerType()) for n in ("line_no", "char_start", "char_end")]
    return rows.mapInArrow(cut, StructType([StructField(key, docs.schema[key].dataType), *ints, StructField("line", StringType())]))


def runs(rows: DataFrame, keys: list[str], order: list[str], label: str, aggregates: list[Column]) -> DataFrame:
    """Gaps and islands: one row per longest run of equal labels in order (nulls are equal to each other)."""
    by = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(by) == 1
    change = F.when(first | ~F.lag(label).over(by).eqNullSafe(F.col(label)), 1).otherwise(0)
    marked = rows.withColumn("_change", change).withColumn("run", F.sum("_change").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run", label).agg(*aggregates)


def runs_within(rows: DataFrame, keys: list[str], order: str, gap, aggregates: list[Column]) -> DataFrame:
    """Runs of rows whose distance from the row before is less than gap."""
    by = Window.partitionBy(*keys).orderBy(order)
    change = F.when(F.coalesce(F.col(order) - F.lag(order).over(by) < gap, F.lit(False)), 0).otherwise(1)
    marked = rows.withColumn("_change", change).withColumn("run", F.sum("_change").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run").agg(*aggregates)


def last_before(rows: DataFrame, keys: list[str], at: str, mark: Column, value: Column, name: str, inclusive: bool = False) -> DataFrame:
    """As-of lookup in one pass: on every row the value of the last marked row before it."""
    by = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return rows.withColumn(name, F.last(F.when(mark, value), ignorenulls=True).over(by))


def two_sided(rows: DataFrame, keys: list[str], at: str, value: Column, name: str) -> DataFrame:
    """The last value before and the first after each row, nulls skipped, as name_before and name_after."""
    by = Window.partitionBy(*keys).orderBy(at)
    before = F.last(value, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(value, ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn(f"{name}_before", before).withColumn(f"{name}_after", after)


def containing(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, bucket: int) -> DataFrame:
    """Point in span: both sides meet on keys and on a bucket of the axis, so a long book spreads over tasks."""
    left = points.withColumn("_bucket", F.floor(F.col(at) / bucket))
    return left.join(bucketed(spans, start, end, bucket), [*keys, "_bucket"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bucket")


def bucketed(spans: DataFrame, start: str, end: str, bucket: int) -> DataFrame:
    """Spans once for every stretch of the axis that they touch, named _bucket; empty spans are left out."""
    return spans.where(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor((F.col(end) - 1) / bucket))))


def intersections(a: DataFrame, b: DataFrame, keys: list[str], a_span: tuple[str, str], b_span: tuple[str, str], bucket: int = 4096) -> DataFrame:
    """Pairs of spans that overlap, with the part they share as char_start and char_end.

    Both sides meet on keys and on a stretch of the axis; a pair comes from the stretch in which its shared part begins.
    """
    lo, hi = F.greatest(a_span[0], b_span[0]), F.least(a_span[1], b_span[1])
    met = bucketed(a, *a_span, bucket).join(bucketed(b, *b_span, bucket), [*keys, "_bucket"]).where((lo < hi) & (F.floor(lo / bucket) == F.col("_bucket")))
    return met.drop("_bucket").withColumn("char_start", lo).withColumn("char_end", hi)


def overlapping_neighbours(rows: DataFrame, keys: list[str], start: str, end: str, tie: str) -> DataFrame:
    """Spans that begin before the span ahead of them in order has ended, with that end as previous_end."""
    by = Window.partitionBy(*keys).orderBy(start, tie)
    return rows.withColumn("previous_end", F.lag(end).over(by)).where(F.col("previous_end") > F.col(start))


def coverage(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Sweep line: per group how much of the axis some span covers and how much more than one does."""
    edges = spans.where(F.col(start) < F.col(end)).select(*keys, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.at", "e.d")
    steps = edges.groupBy(*keys, "at").agg(F.sum("d").alias("d"))
    by = Window.partitionBy(*keys).orderBy("at")
    depth = steps.select(*keys, F.sum("d").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"), (F.lead("at").over(by) - F.col("at")).alias("width"))
    return depth.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("depth") > 0, F.col("width"))), F.lit(0)).cast("long").alias("covered"),
        F.coalesce(F.sum(F.when(F.col("depth") > 1, F.col("width"))), F.lit(0)).cast("long").alias("overlapped"),
        F.max("depth").cast("long").alias("deepest"),
    )


def overlay(spans: DataFrame, keys: list[str], start: str, end: str, layer: list[str], label: str, bucket: int = 4096) -> DataFrame:
    """Paint spans over each other, later layers on top: (keys, label, char_start, char_end), neighbours of one label joined.

    Break points cut the axis into elementary spans; each takes the label of the highest layer that
    covers it, met on the stretch of the axis in which it begins. Nothing is expanded to characters.
    """
    spans = spans.where(F.col(start) < F.col(end))
    points = spans.select(*keys, F.explode(F.array(start, end)).alias("_a")).distinct()
    cells = points.withColumn("_b", F.lead("_a").over(Window.partitionBy(*keys).orderBy("_a"))).where("_b is not null")
    painted = cells.withColumn("_bucket", F.floor(F.col("_a") / bucket)).join(bucketed(spans, start, end, bucket), [*keys, "_bucket"]).where((F.col(start) <= F.col("_a")) & (F.col("_b") <= F.col(end)))
    top = painted.groupBy(*keys, "_a", "_b").agg(F.max_by(label, F.struct(*layer)).alias(label))
    by = Window.partitionBy(*keys).orderBy("_a")
    joins = (F.lag("_b").over(by) == F.col("_a")) & F.lag(label).over(by).eqNullSafe(F.col(label))
    marked = top.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_run", label).agg(F.min("_a").alias("char_start"), F.max("_b").alias("char_end")).drop("_run")


def extents(rows: DataFrame, keys: list[str], order: str, start: str, last_end: Column, name: str = "end") -> DataFrame:
    """Each row ends where the next begins, the last at last_end."""
    return rows.withColumn(name, F.coalesce(F.lead(start).over(Window.partitionBy(*keys).orderBy(order)), last_end))


def nested(rows: DataFrame, keys: list[str], order: str, level: str, windows: int = 16) -> DataFrame:
    """Sections: section_end is the next section of the same or a higher rank (smaller level), parent the last one before of a smaller level.

    At any depth; a null level holds nothing, is held by nothing and ends nothing. Few levels need a window each, so no section
    meets all others; where the table has more than so many, a stack of open sections walks over each key's sections instead.
    """
    levels = sorted(r[0] for r in rows.select(level).where(F.col(level).isNotNull()).distinct().limit(windows + 1).collect())
    if len(levels) > windows:
        return _nested_by_stack(rows, keys, order, level)
    by = Window.partitionBy(*keys).orderBy(order)
    after, before = by.rowsBetween(1, Window.unboundedFollowing), by.rowsBetween(Window.unboundedPreceding, -1)
    out = rows
    for i, k in enumerate(levels):
        out = out.withColumn(f"_next_{i}", F.min(F.when(F.col(level) <= k, F.col(order))).over(after)).withColumn(f"_prev_{i}", F.max(F.when(F.col(level) < k, F.col(order))).over(before))
    pick = lambda side: F.coalesce(F.lit(None), *[F.when(F.col(level) == k, F.col(f"_{side}_{i}")) for i, k in enumerate(levels)])
    kind = rows.schema[order].dataType
    return out.withColumn("section_end", pick("next").cast(kind)).withColumn("parent", pick("prev").cast(kind)).drop(*[f"_{s}_{i}" for s in ("next", "prev") for i in range(len(levels))])


def _nested_by_stack(rows: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    def walk(t: pa.Table) -> pa.Table:
        t = t.sort_by(order)
        at, levels = t[order].to_pylist(), t[level].to_pylist()
        ends, parents, open_ = [None] * len(at), [None] * len(at), []
        for i, k in enumerate(levels):
            if k is None:
                continue
            while open_ and levels[open_[-1]] >= k:
                ends[open_.pop()] = at[i]
            parents[i] = at[open_[-1]] if open_ else None
            open_.append(i)
        kind = t.schema.field(order).type
        return t.append_column("section_end", pa.array(ends, kind)).append_column("parent", pa.array(parents, kind))

    kind = rows.schema[order].dataType
    schema = StructType([*rows.schema.fields, StructField("section_end", kind), StructField("parent", kind)])
    return rows.groupBy(*keys).applyInArrow(walk, schema)


def trees(rows: DataFrame, keys: list[str], key: str, parent: str) -> DataFrame:
    """(keys, key, root, depth): the topmost ancestor of every row, itself if it has no parent, and how far above it is.

    Both are null below a parent that is not there and on and below a cycle. Paths double in every round: a row's pointer is replaced
    by its target's, so that a depth of d takes log2(d) joins, each over a table. Ids must be unique within keys; null ids have no
    row. An empty table gives an empty one.
    """
    step = [*keys, key]
    own = rows.where(F.col(key).isNotNull()).select(*step, F.coalesce(parent, key).alias("root"), F.when(F.col(parent).isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col(parent).isNull().alias("_there"))
    now = scratch.written(own, "trees")
    most = now.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(max(1, int(most)).bit_length() + 1):
        if now.where(~F.col("_there")).isEmpty():
            break
        above = now.select(*keys, F.col(key).alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("_there").alias("_reached"))
        open_ = now.where(~F.col("_there")).join(above, [*keys, "root"])
        moved = open_.select(*step, F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_reached").alias("_there"))
        after = scratch.written(now.where("_there").unionByName(moved), "trees")
        scratch.discard(now)
        now = after
    found = now.where("_there").select(*step, "root", F.col("depth").cast("int").alias("depth"))
    return rows.where(F.col(key).isNotNull()).select(*step).join(found, step, "left")


def clamp_rising(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Make values rise by 1 or more from row to row: s[k] = max(s[k], s[k-1] + 1), in closed form."""
    by = Window.partitionBy(*keys).orderBy(order)
    k = F.row_number().over(by)
    ranked = rows.withColumn("_k", k)
    top = F.max(F.col(value) - F.col("_k")).over(Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn(name, top + F.col("_k")).drop("_k")


def interpolated(rows: DataFrame, keys: list[str], at: str, value: str, name: str) -> DataFrame:
    """Fill nulls between known neighbours in proportion to their place, by integer division; at the ends they stay null."""
    by = Window.partitionBy(*keys).orderBy(at)
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("p"), F.col(value).alias("v")))
    out = rows.withColumn("_a", F.last(known, ignorenulls=True).over(before)).withColumn("_b", F.first(known, ignorenulls=True).over(after))
    filled = F.expr(f"_a.v + ((_b.v - _a.v) * ({at} - _a.p)) div (_b.p - _a.p)")
    return out.withColumn(name, F.coalesce(F.col(value), filled)).drop("_a", "_b")


def best_window(hits: DataFrame, keys: list[str], at: str, weight: str, width: int) -> DataFrame:
    """The start of the heaviest window of a width per group; ties to the first."""
    by = Window.partitionBy(*keys).orderBy(at).rangeBetween(0, width - 1)
    heavy = hits.withColumn("heft", F.sum(weight).over(by))
    return heavy.groupBy(*keys).agg(F.max_by(F.struct(at, "heft"), F.struct(F.col("heft"), -F.col(at))).alias("w")).select(*keys, F.col(f"w.{at}").alias("window_start"), F.col("w.heft").alias("heft"))


def upper_median(values: Column) -> Column:
    """sorted[n // 2], no interpolation."""
    return F.element_at(F.array_sort(F.collect_list(values)), (F.floor(F.count(values) / 2) + 1).cast("int"))


def quarter_steps(values: Column) -> Column:
    """sorted[n // 4 :: n // 4], the first three; empty for fewer than four values."""
    ordered = F.array_sort(F.collect_list(values))
    step = F.floor(F.count(values) / 4)
    return F.slice(F.filter(ordered, lambda x, i: (step > 0) & (i >= step) & (i % F.greatest(step, F.lit(1)) == 0)), 1, 3)


def nth(rows: DataFrame, keys: list[str], order: list[str], which: int) -> DataFrame:
    """The which-th row of each group, counted from 1, or from the end if negative."""
    by = Window.partitionBy(*keys).orderBy(*(order if which > 0 else [F.col(c).desc() for c in order]))
    return rows.withColumn("_n", F.row_number().over(by)).where(F.col("_n") == abs(which)).drop("_n")


def numbered(rows: DataFrame, keys: list[str], order: list[str], pattern: str, name: str) -> DataFrame:
    """Identifiers by order, as in pattern (unit_%03d)."""
    return rows.withColumn(name, F.format_string(pattern, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))))


def far_from(places: DataFrame, marks: DataFrame, keys: list[str], at: str, reach: int) -> DataFrame:
    """Places further than reach from every mark of their keys, with the distance as far; groups without marks have none.

    One ordered pass over both carries the nearest mark before and after along, so no place meets a mark.
    """
    both = places.withColumn("_mark", F.lit(None).cast("long")).withColumn("_place", F.lit(True)).unionByName(marks.select(*keys, at, F.col(at).cast("long").alias("_mark")), allowMissingColumns=True)
    by = Window.partitionBy(*keys).orderBy(at)
    before = F.last("_mark", ignorenulls=True).over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("_mark", ignorenulls=True).over(by.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    far = F.least(F.col(at) - before, after - F.col(at))
    return both.withColumn("far", far).where("_place").where(F.col("far") > reach).drop("_mark", "_place")


def trailing(rows: DataFrame, keys: list[str], mark: Column, asked: Column, start: str, end: str) -> DataFrame:
    """Rows asked for that begin at or behind the last end of the marked rows of their group, with that end as last_end."""
    last = F.max(F.when(mark, F.col(end))).over(Window.partitionBy(*keys))
    return rows.withColumn("last_end", last).where(asked & (F.col(start) >= F.col("last_end")))


def placed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The place of every row in one order of the whole table, from 1.

    A range sort numbers the rows of each part, and the parts before it give what to add; no task sees all
    rows. The sorted rows are written once, so that both passes see the same parts. Only a count for
    each part goes to the driver.
    """
    within = (1 << 33) - 1  # monotonically_increasing_id has the part above the row's 33 bits
    ordered = scratch.written(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "placed")
    counts = ordered.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count("*").alias("n")).collect()
    before, total = [], 0
    for part, n in sorted(map(tuple, counts)):
        before.append((part, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "_part long, _before long")
    met = ordered.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(offsets), "_part")
    return met.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit(within)) + 1).drop("_id", "_part", "_before")
