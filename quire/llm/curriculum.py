"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target in words and a schedule, a piecewise-linear weight over training time [0, 1].
The schedule is integrated to a cumulative demand D(t) of the source's words; the word at cumulative
count c of a source (documents in hash order, the source repeated as often as its target needs) is due
at the time t with D(t) = c. Documents are range-sorted by that position.

Cumulative counts within a source come from two short window passes, over hash buckets and within a
bucket, so that a source with a third of all rows spreads over as many tasks as it has buckets. Only
(id, source, size) moves; texts stay where they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm._shared import table, write_table

#: Base weights of sources in code point order, repeating, and the most passes over any source.
WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
#: Schedules of sources in the same order, repeating: (time, weight) knots, times from 0 to 1.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)
#: Rows for which one hash bucket of all sources is made, and the least number of buckets.
ROWS_PER_BUCKET, LEAST_BUCKETS = 4096, 256
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def integrate(schedule) -> list[tuple[float, float, float, float, float]]:
    """Per piece of a schedule: start time, width, weight at its start, slope, demand before it; scaled to a total demand of 1."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        pieces.append((t0, t1 - t0, w0, (w1 - w0) / (t1 - t0), total))
        total += (w0 + w1) / 2 * (t1 - t0)
    return [(t, d, w / total, s / total, before / total) for t, d, w, s, before in pieces]


def invert(schedule, y: Column) -> Column:
    """The time at which the integrated schedule reaches y: per piece, the root of w*x + s*x^2/2 = y - before."""
    found = None
    for t, width, w, s, before in reversed(integrate(schedule)):
        rest = y - F.lit(before)
        if abs(s) < 1e-12:
            x = rest / F.lit(w)
        else:
            x = (F.sqrt(F.greatest(F.lit(w * w) + F.lit(2 * s) * rest, F.lit(0.0))) - F.lit(w)) / F.lit(s)
        at = F.lit(t) + F.least(F.greatest(x, F.lit(0.0)), F.lit(width))
        found = at if found is None else F.when(y < F.lit(following), at).otherwise(found)
        following = before
    return found


def source_targets(sized: DataFrame, weights=WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """Per source: its rank by code point (null last), size and target.

    Targets share the total by weight; a target above most_passes times its source's size stops there
    and the excess is reshared by weight until none is above. That is one level: sources are capped in
    order of size/weight, and the first level that caps no further source is the answer. The frame has
    a row per source, so its windows run over a summary, never over documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most_passes)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    below, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = capped.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))).alias("open_weight"),
        F.coalesce(F.sum("cap").over(below), F.lit(0)).alias("closed"),
    ).withColumn("fits", (F.col("total") - F.col("closed")) * F.col("weight") <= F.col("cap") * F.col("open_weight"))
    first = F.min_by(F.struct("closed", "open_weight"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"))).over(Window.partitionBy("fits"))
    answer = level.withColumn("at", F.max(F.when(F.col("fits"), first)).over(everything))
    share = (F.col("total") - F.col("at.closed")).cast("double") * F.col("weight") / F.col("at.open_weight")
    return answer.select("source", "rank", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def _position(schedules) -> Column:
    """Training time of a pass: the inverse of its source's integrated schedule at its first word."""
    y = F.col("begin") / F.col("target")
    n = F.col("rank") % len(schedules)
    at = invert(schedules[-1], y)
    for k, schedule in enumerate(schedules[:-1]):
        at = F.when(n == k, invert(schedule, y)).otherwise(at)
    return at


def _identity(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> list[Column]:
    """What tells rows apart, up to rows that are the same in all of it."""
    return [F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.xxhash64(F.col(text_column)).alias("content")]


def _numbered(rows: DataFrame) -> DataFrame:
    """Number the rows of the same id, source and content."""
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "source", "content").orderBy(F.lit(0))))


def _plan(docs: DataFrame, weights, most_passes, schedules, id_column, text_column, source_column) -> DataFrame:
    """The curriculum without its order, with the columns of _identity."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")).cast("binary"))
    sized = docs.select(*_identity(docs, id_column, text_column, source_column), size_of(F.col(text_column)).alias("size"))
    sized = write_table(sized.withColumn("key", key), "curriculum-sizes")
    n = sized.count()
    bits = max(math.ceil(math.log2(n / ROWS_PER_BUCKET)) if n else 0, int(math.log2(LEAST_BUCKETS)))
    digits = -(-bits // 4)  # a bucket is a prefix of the hexadecimal key
    targets = source_targets(sized, weights, most_passes).withColumnRenamed("source", "of_source")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    totals = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("in_bucket"))
    ahead = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("rank", "bucket", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("rank", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "content").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(totals, ["rank", "bucket"])
    full = F.floor(F.col("target") / F.col("source_size"))
    placed = placed.withColumn("before", F.col("ahead") + F.col("inside")).withColumn("full", F.when(F.col("source_size") > 0, full).otherwise(0).cast("long"))
    rest = F.floor(F.col("target")).cast("long") - F.col("full") * F.col("source_size")
    placed = placed.withColumn("last", F.greatest(F.lit(0).cast("long"), F.least(rest - F.col("before"), F.col("size"))))
    for k in range(most_passes):
        words = F.when(F.col("full") > k, F.col("size")).when(F.col("full") == k, F.col("last")).otherwise(0).cast("long")
        placed = placed.withColumn("begin", (F.col("before") + F.lit(k) * F.col("source_size")).cast("double"))
        placed = placed.withColumn(f"pass_{k}", F.when(words > 0, F.struct(F.lit(k + 1).alias("pass"), words.alias("words"), _position(schedules).alias("position"))))
    passes = F.array_compact(F.array(*[F.col(f"pass_{k}") for k in range(most_passes)]))
    placed = placed.withColumn("passes", passes)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return placed.withColumn("taken", taken).withColumn("position", F.get("passes", F.lit(0))["position"])


def curriculum(docs: DataFrame, weights=WEIGHTS, most_passes: int = MOST_PASSES, schedules=SCHEDULES, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Words of each document that the mix takes, and when.

    Returns (doc_id, size, source_size, target, taken, position, passes), one row per row of docs,
    range-sorted by position; passes is an array of (pass, words, position) structs. Documents of a
    source are taken in order of md5(doc_id), whole passes first, the last pass until the target's
    whole words are taken; so a source takes floor(target) words and no document more than most_passes
    times its size. Documents that the mix does not take have a null position and come last, by id.

    Null texts count as empty, a null source is a source of its own, null ids are kept and are ordered
    last; repeated rows are documents of their own. Columns other than the three named are left out.
    An empty table gives an empty one.
    """
    plan = _plan(docs, weights, most_passes, schedules, id_column, text_column, source_column)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "position", "passes").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mix(docs: DataFrame, weights=WEIGHTS, most_passes: int = MOST_PASSES, schedules=SCHEDULES, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The documents as the mix reads them: a row per pass, range-sorted by position, with the columns of docs.

    The last pass of a source ends inside a document; that document's pass stays if at least half of
    its words are taken. Documents without a taken word go. Nulls, empty texts and repeated rows: as
    curriculum. Texts move twice: to meet their passes, and to be sorted.
    """
    plan = _plan(docs, weights, most_passes, schedules, id_column, text_column, source_column)
    plan = _numbered(plan.select("doc_id", "source", "content", "size", "passes"))
    plan = plan.where(F.size("passes") > 0).select(F.struct("doc_id", "source", "content", "copy").alias("planned"), "size", "passes")
    whole = docs.select(*_identity(docs, id_column, text_column, source_column), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = _numbered(whole).join(plan, F.struct("doc_id", "source", "content", "copy").eqNullSafe(F.col("planned")))
    each = found.select("row", "size", F.explode("passes").alias("taken_pass")).where(F.col("taken_pass.words") * 2 >= F.col("size"))
    return each.orderBy("taken_pass.position").select("row.*")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """passes is written as text, pass:words by comma."""
    passes = F.array_join(F.transform("passes", lambda p: F.concat_ws(":", p["pass"], p["words"])), ",")
    return curriculum(table(spark, sf_dir, "documents")).withColumn("passes", passes)


def _sql_position(k: int) -> str:
    """The position of pass k, as _position has it."""
    y = f"((before + {k} * source_size)::DOUBLE / target)"

    def piece(t, width, w, s, before):
        rest = f"({y} - {before!r}::DOUBLE)"
        x = f"({rest} / {w!r}::DOUBLE)" if abs(s) < 1e-12 else f"((sqrt(greatest({w * w!r}::DOUBLE + {2 * s!r}::DOUBLE * {rest}, 0::DOUBLE)) - {w!r}::DOUBLE) / {s!r}::DOUBLE)"
        return f"{t!r}::DOUBLE + least(greatest({x}, 0::DOUBLE), {width!r}::DOUBLE)"

    cases = []
    for n, schedule in enumerate(SCHEDULES):
        pieces = integrate(schedule)
        for this, following in zip(pieces, [*pieces[1:], None]):
            cases.append(f"WHEN rk % {len(SCHEDULES)} = {n}" + (f" AND {y} < {following[4]!r}::DOUBLE" if following else "") + f" THEN {piece(*this)}")
    return "CASE " + " ".join(cases) + " END"


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '~')) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk FROM per),
capped AS (SELECT *, 1 + rk % 3 AS w, 3 * source_size AS cap FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
         (sum(w) OVER () - coalesce(sum(w) OVER below, 0))::BIGINT AS open_weight,
         coalesce(sum(cap) OVER below, 0)::BIGINT AS closed
  FROM capped WINDOW below AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pick AS (
  SELECT closed, open_weight, total FROM levels
  WHERE (total - closed) * w <= cap * open_weight ORDER BY cap / w, rk LIMIT 1),
targets AS (
  SELECT c.source, c.rk, c.source_size,
         least(c.cap::DOUBLE, (p.total - p.closed)::DOUBLE * c.w / p.open_weight) AS target
  FROM capped c, pick p),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rk,
         coalesce(sum(s.size) OVER (PARTITION BY t.rk ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
full_passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS n FROM placed),
done AS (
  SELECT *, greatest(0, least(floor(target)::BIGINT - n * source_size - before, size))::BIGINT AS last FROM full_passes),
each AS (
  SELECT *,
         CASE WHEN n > 0 THEN size WHEN n = 0 THEN last ELSE 0 END AS p1,
         CASE WHEN n > 1 THEN size WHEN n = 1 THEN last ELSE 0 END AS p2,
         CASE WHEN n > 2 THEN size WHEN n = 2 THEN last ELSE 0 END AS p3
  FROM done)
SELECT doc_id, size, source_size, target, (p1 + p2 + p3)::BIGINT AS taken,
       concat_ws(',', CASE WHEN p1 > 0 THEN '1:' || p1 END, CASE WHEN p2 > 0 THEN '2:' || p2 END, CASE WHEN p3 > 0 THEN '3:' || p3 END) AS passes,
       CASE WHEN p1 > 0 THEN {_sql_position(0)} END AS position
FROM each
"""
