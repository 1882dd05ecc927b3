"""Interval overlap join of sales with click sessions, on whole slots of time.

1. Clicks become sessions by lag and cumulative sum. A client's clicks are cut at every hour first, so that a
   window never holds more than a client's hour; sums over a client then see one row an hour. What an hour
   holds is numbered within it, and the client's hours before it add the rest.
2. Only slots are compared, so sessions of one client with equal slots are one class, with their number and
   the sum of their checksums; so are its sales. A client has a bounded number of classes in a bounded time,
   however many rows it has.
3. Classes meet in an equi-join on the client, with slots that overlap as further condition. Clients of many
   sale classes are dealt over salts; their session classes are copied to each.
4. A CASE names the relation of each pair of classes; sums per sale class and relation go back to its sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.llm._shared import table, write_table

MINUTE, HOUR = 60_000_000, 3_600_000_000
GAP, SLOT = 10 * MINUTE, HOUR
#: Sale classes of a client for each of its salts.
CLASSES = 2_000
#: Parts that a client's classes are dealt over to learn whether it is hot.
DEALS = 64
#: The end of what is open: later than any slot of a timestamp.
OPEN = 1 << 60
RELATIONS = {
    ("<", "<"): "overlaps", ("<", "="): "finished_by", ("<", ">"): "contains",
    ("=", "<"): "starts", ("=", "="): "equals", ("=", ">"): "started_by",
    (">", "<"): "during", (">", "="): "finishes", (">", ">"): "overlapped_by",
}


def micros(rows: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without a zone is taken as it stands, whatever the session's zone."""
    c = F.col(name)
    if not isinstance(rows.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    day = F.unix_date(c.cast("date")).cast("long")
    seconds = F.extract(F.lit("SECOND"), c)
    return ((day * 24 + F.hour(c)) * 60 + F.minute(c)) * MINUTE + (seconds * 1_000_000).cast("long")


def floored(c: Column, by: int) -> Column:
    """Whole division towards minus infinity, in 64 bits."""
    return F.call_function("div", c - F.pmod(c, F.lit(by)), F.lit(by).cast("long"))


def sessions(clicks: DataFrame, gap: int = GAP) -> DataFrame:
    """(client_id, first, last, open): sessions of each client, first and last in microseconds.

    A click later than gap after the client's previous one begins another session. A session is open if any click
    at its last timestamp is a purchase. Clicks with a null client or timestamp take no part; a null kind is no
    purchase; repeated clicks and ties change nothing. An empty table gives an empty one.
    """
    rows = clicks.where("client_id is not null and ts is not null").select("client_id", micros(clicks, "ts").alias("at"), F.coalesce(F.col("kind") == "purchase", F.lit(False)).alias("bought"))
    rows = rows.withColumn("hour", floored(F.col("at"), HOUR))
    by = Window.partitionBy("client_id", "hour").orderBy("at")
    begins = F.when(F.col("at") - F.lag("at").over(by) > gap, 1).otherwise(0)
    numbered = rows.withColumn("begins", begins).withColumn("nth", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max(F.struct("at", "bought")).alias("end")
    pieces = write_table(numbered.groupBy("client_id", "hour", "nth").agg(F.min("at").alias("first"), last), "session-pieces")

    hours = pieces.groupBy("client_id", "hour").agg(F.min("first").alias("first"), F.max("end.at").alias("last"), F.max("nth").alias("inner"))
    along = Window.partitionBy("client_id").orderBy("hour")
    fresh = F.when(F.col("first") - F.lag("last").over(along) <= gap, 0).otherwise(1)
    hours = hours.withColumn("fresh", fresh).withColumn("base", F.sum(F.col("fresh") + F.col("inner")).over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("inner"))
    met = pieces.join(hours.select("client_id", "hour", "base"), ["client_id", "hour"])
    whole = met.groupBy("client_id", (F.col("base") + F.col("nth")).alias("session")).agg(F.min("first").alias("first"), F.max("end").alias("end"))
    return whole.select("client_id", "first", F.col("end.at").alias("last"), F.col("end.bought").alias("open"))


def sale_intervals(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """(sale_id, client_id, first, last, open): from sold_at through the latest of it and the lines' shipped_at; open with a line not shipped.

    Sales with a null client or sold_at are left out; one without lines, or with a null id, ends when it is sold.
    """
    shipped = lines.where("sale_id is not null").groupBy("sale_id").agg(F.max(micros(lines, "shipped_at")).alias("shipped"), F.bool_or(F.col("shipped_at").isNull()).alias("open"))
    rows = sales.where("client_id is not null and sold_at is not null").select("sale_id", "client_id", micros(sales, "sold_at").alias("first"))
    met = rows.join(shipped, "sale_id", "left")
    return met.select("sale_id", "client_id", "first", F.greatest("first", "shipped").alias("last"), F.coalesce("open", F.lit(False)).alias("open"))


def slots(rows: DataFrame, slot: int) -> DataFrame:
    """rows with begin and end in whole slots, both inclusive; what is open ends at OPEN."""
    return rows.withColumn("begin", floored(F.col("first"), slot)).withColumn("end", F.when(F.col("open"), F.lit(OPEN)).otherwise(floored(F.col("last"), slot)))


def relation(begin: tuple[Column, Column], end: tuple[Column, Column]) -> Column:
    """The name of how an interval lies to another, from both begins and both ends."""
    compare = {"<": lambda a, b: a < b, "=": lambda a, b: a == b, ">": lambda a, b: a > b}
    out = None
    for (first, last), name in RELATIONS.items():
        fits = compare[first](*begin) & compare[last](*end)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def overlaps(sales: DataFrame, found: DataFrame, slot: int = SLOT, classes: int = CLASSES) -> DataFrame:
    """(sale_id, relation, n_pairs, overlap_slots, sessions_crc) of sale intervals with the sessions of the same client that share a slot.

    One row per sale and relation: the number of sessions, the slots shared, summed (null if both are open), and
    the sum of crc32 of the sessions' first timestamps as decimal text. Sales that repeat an id add up to one;
    sales that meet no session have no row. Empty tables give an empty one.
    """
    sales = write_table(slots(sales, slot), "sale-slots")
    crc = F.crc32(F.col("first").cast("string").cast("binary"))
    right = slots(found, slot).groupBy("client_id", "begin", "end").agg(F.count("*").alias("n"), F.sum(crc).alias("crc"))
    left = write_table(sales.groupBy("client_id", "begin", "end").agg(F.count("*").alias("n_sales")), "sale-classes")
    hot = left.groupBy("client_id").agg(F.ceil(F.count("*") / classes).cast("int").alias("salts")).where("salts > 1")
    hot = hot.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    hashed, salts = F.xxhash64("begin", "end"), F.coalesce("salts", F.lit(1))
    deal = F.pmod(hashed, F.lit(DEALS)).cast("int").alias("deal")
    dealt = left.select("*", deal).join(hot, ["client_id", "deal"], "left").select("client_id", "begin", "end", F.pmod(F.shiftright(hashed, 8), salts).cast("int").alias("salt"))
    copied = right.select("*", deal).join(hot, ["client_id", "deal"], "left").select("client_id", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("begin").alias("s_begin"), F.col("end").alias("s_end"), "n", "crc")
    pairs = dealt.join(copied, ["client_id", "salt"]).where((F.col("begin") <= F.col("s_end")) & (F.col("s_begin") <= F.col("end")))
    shared = F.least("end", "s_end") - F.greatest("begin", "s_begin") + 1
    shared = F.when((F.col("end") < OPEN) | (F.col("s_end") < OPEN), shared * F.col("n"))
    named = relation((F.col("begin"), F.col("s_begin")), (F.col("end"), F.col("s_end"))).alias("relation")
    sums = pairs.groupBy("client_id", "begin", "end", named).agg(F.sum("n").alias("n_pairs"), F.sum(shared).alias("overlap_slots"), F.sum("crc").alias("sessions_crc"))
    back = sales.select("sale_id", "client_id", "begin", "end").join(sums, ["client_id", "begin", "end"])
    return back.groupBy("sale_id", "relation").agg(*(F.sum(c).alias(c) for c in ("n_pairs", "overlap_slots", "sessions_crc")))


def op12_interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the shop with their clients' click sessions, in slots of an hour."""
    read = lambda name: table(spark, sf_dir, name)
    return overlaps(sale_intervals(read("sales"), read("sale_lines")), sessions(read("clicks")))


SQL = """
WITH c AS (SELECT client_id, epoch_us(ts) AS us, coalesce(kind = 'purchase', false) AS bought FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
b AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY client_id ORDER BY us) <= 600000000 THEN 0 ELSE 1 END AS begins FROM c),
d AS (SELECT *, sum(begins) OVER (PARTITION BY client_id ORDER BY us, begins DESC ROWS UNBOUNDED PRECEDING) AS session FROM b),
e AS (SELECT client_id, session, min(us) AS first, max(us) AS last FROM d GROUP BY ALL),
o AS (SELECT e.client_id, e.session, e.first, e.last, bool_or(d.bought) AS open FROM e JOIN d ON d.client_id = e.client_id AND d.session = e.session AND d.us = e.last GROUP BY ALL),
bits AS (SELECT *, flatten(list_transform(range(length(first::VARCHAR)), lambda i: list_transform(range(8), lambda j: (ascii(substr(first::VARCHAR, (i + 1)::INT, 1)) >> j::INT) & 1)))::BIGINT[] AS w FROM o),
s AS (SELECT client_id, first // 3600000000 AS b, CASE WHEN open THEN 1152921504606846976 ELSE last // 3600000000 END AS e,
        xor(list_reduce(list_prepend(4294967295::BIGINT, w), lambda x, y: xor(x >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295) AS crc FROM bits),
l AS (SELECT sale_id, max(epoch_us(shipped_at)) AS shipped, bool_or(shipped_at IS NULL) AS open FROM sale_lines GROUP BY 1),
v AS (SELECT sales.sale_id, client_id, epoch_us(sold_at) // 3600000000 AS b,
        CASE WHEN coalesce(open, false) THEN 1152921504606846976 ELSE greatest(epoch_us(sold_at), coalesce(shipped, epoch_us(sold_at))) // 3600000000 END AS e
      FROM sales LEFT JOIN l ON sales.sale_id = l.sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
p AS (SELECT v.sale_id, v.b AS vb, v.e AS ve, s.b AS sb, s.e AS se, s.crc FROM v JOIN s ON v.client_id = s.client_id AND v.b <= s.e AND s.b <= v.e)
SELECT sale_id,
  CASE WHEN vb < sb THEN CASE WHEN ve < se THEN 'overlaps' WHEN ve = se THEN 'finished_by' ELSE 'contains' END
       WHEN vb = sb THEN CASE WHEN ve < se THEN 'starts' WHEN ve = se THEN 'equals' ELSE 'started_by' END
       ELSE CASE WHEN ve < se THEN 'during' WHEN ve = se THEN 'finishes' ELSE 'overlapped_by' END END AS relation,
  count(*) AS n_pairs,
  sum(CASE WHEN least(ve, se) < 1152921504606846976 THEN least(ve, se) - greatest(vb, sb) + 1 END)::BIGINT AS overlap_slots,
  sum(crc)::BIGINT AS sessions_crc
FROM p GROUP BY 1, 2
"""
