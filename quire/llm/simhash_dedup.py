"""SimHash near-duplicates found by multi-index hashing.

A fingerprint is cut into SEGMENTS halves. Two fingerprints at distance RADIUS or less differ by
RADIUS // SEGMENTS bits or less in one of them, so the table of each segment is asked for every value of
the small Hamming ball around a fingerprint's segment; the complete distance of what it returns is
verified. Segments of 32 bits keep buckets short: a bucket holds fingerprints that share half of their bits.
Where many do, the other half's four bytes cut the bucket further: two halves that differ in RADIUS bits or less
have at least one byte in common.

Equal fingerprints are one node, so copies cost nothing. Links join into components by alternating
large-star and small-star steps on tables in the shared folder; neither links nor labels ever reach
the driver.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm._shared import small_batches, table, write_table
from quire.sources import scratch

SEED, SHINGLE = 42, 3
SEGMENTS, SEGMENT_BITS, RADIUS = 2, 32, 3
#: Fingerprints of a bucket beyond which it is cut by the bytes of the other segment.
CROWD = 512
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: one is set if more than half of the shingles' hashes have it; 0 without words.

    Words are runs of other than ASCII white space, A-Z lower-cased; shingles are runs of words joined
    by a space, repeats included, or all words if there are fewer.
    """
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    ends = np.cumsum(sizes) - 1
    begins = ends - sizes + 1
    width = min(shingle, n)
    h = xxhash.xxh64_intdigest
    hashes = [h(joined[a:b], SEED) for a, b in zip(begins[: n - width + 1].tolist(), ends[width - 1 :].tolist())]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(values), BLOCK):
        bits = np.unpackbits(values[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_column: str = "text") -> Column:
    """The fingerprint of a text column as a signed 64-bit integer."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))

    return hashed(F.col(text_column))


def ball(value: Column, bits: int, radius: int) -> Column:
    """Every value at distance radius or less from a segment's value, as an array."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ (1 << b) for m in masks for b in range(bits)} | set(masks))
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, k * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1).cast("long"))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct values of nodes(fp) at distance radius or less.

    The tables are joined on (segment number, segment value) and, in crowded buckets, on a byte of the other
    segment; each pair is verified in full. A pair that several keys find comes once. The radius must be less
    than the number of such bytes.
    """

    def keys(k: int, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(k).alias("k"), v.alias("v")))

    asked = F.explode(F.concat(*[keys(k, ball(segment(F.col("fp"), k), SEGMENT_BITS, radius // SEGMENTS)) for k in range(SEGMENTS)]))
    held = F.explode(F.concat(*[keys(k, F.array(segment(F.col("fp"), k))) for k in range(SEGMENTS)]))
    probes = nodes.select(F.col("fp").alias("a"), asked.alias("key")).select("a", "key.k", "key.v")
    index = nodes.select(F.col("fp").alias("b"), held.alias("key")).select("b", "key.k", "key.v")
    crowd = write_table(index.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("k", "v", F.lit(True).alias("crowded")), "crowded-buckets")
    on = ["k", "v"]
    if not crowd.isEmpty():
        probes, index = (_cut(rows, crowd, fp) for rows, fp in ((probes, "a"), (index, "b")))
        on = [*on, "byte", "value"]
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return probes.join(index, on).where(close).select("a", "b").distinct()


def _cut(rows: DataFrame, crowd: DataFrame, fp: str) -> DataFrame:
    """Rows (k, v, fp) with the bytes of the other segment as (byte, value), a row each, in crowded buckets; elsewhere one row as it was."""
    other = F.when(F.col("k") == 0, segment(F.col(fp), 1)).otherwise(segment(F.col(fp), 0))
    pieces = F.array(*[F.struct(F.lit(j).alias("byte"), F.shiftrightunsigned(other, 8 * j).bitwiseAND(F.lit(255).cast("long")).alias("value")) for j in range(SEGMENT_BITS // 8)])
    whole = F.array(F.struct(F.lit(-1).alias("byte"), F.lit(0).cast("long").alias("value")))
    met = rows.join(crowd, ["k", "v"], "left")
    return met.select(fp, "k", "v", F.inline(F.when(F.col("crowded"), pieces).otherwise(whole)))


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): for every node of pairs(a, b), the smallest node that links lead to.

    Large-star joins the larger neighbours of a node to the smallest of its neighbourhood, small-star
    the smaller ones; both keep components. Rounds go on until no edge changes, which takes about the
    logarithm of the longest chain. Each round is a table and the one before it is deleted; the smallest
    neighbour of a node is a partial aggregation, and joins on a node with many neighbours are left to adaptive
    execution to split.
    """
    edges = write_table(pairs.select("a", "b").where("a <> b").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select(F.col("e.u").alias("b"), F.col("e.m").alias("a"))
        before, edges = edges, write_table(small.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        scratch.discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now


def _rooted(docs: DataFrame, radius: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row of docs, and (fp, first_id, root) per fingerprint: its smallest id and its component."""
    marked = write_table(docs.select(F.col(id_column).alias("doc_id"), fingerprints(docs, text_column).alias("fp")), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = write_table(nodes, "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), radius))
    return marked, nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per row of docs, and what classes() of it means.

    fp is the fingerprint as a signed integer, component_id the smallest doc_id reachable over links,
    the row's own included. Null and empty texts share fingerprint 0 and so one component. Rows with a
    null id take part as nodes, and get the smallest id of their component, null if it has none.
    Repeated rows stay. Other columns are left out. An empty table gives an empty one.
    """
    marked, rooted = _rooted(docs, radius, id_column, text_column)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    lookup = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(lookup, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of docs per component: that of its smallest id and, of that id's rows in it, of the smallest fingerprint. Rows with a null id stay only if their component has no id, once per component.

    An id that occurs with different texts may be kept once in each of their components. The decision is made
    on ids and fingerprints; texts move once, to meet it, and only those of ids with several fingerprints are
    marked again. Repeated rows are thinned to one by a window over the few that there are.
    """
    marked, rooted = _rooted(docs, radius, id_column, text_column)
    chosen = rooted.groupBy("root").agg(F.min(F.when(F.col("first_id").isNotNull(), F.struct("first_id", "fp"))).alias("k"), F.min("fp").alias("fp"))
    kept = chosen.where("k is not null").select(F.col("k.first_id").alias("kept_id"), F.col("k.fp").alias("kept_fp"))
    mixed = marked.where("doc_id is not null").groupBy(F.col("doc_id").alias("kept_id")).agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("kept_id")
    mixed = write_table(mixed, "mixed-ids")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(F.col(id_column).alias("own_id"), F.xxhash64(F.col(text_column)).alias("content"), row)
    one = whole.join(kept.join(mixed, "kept_id", "left_anti"), F.col("own_id") == F.col("kept_id"))
    first = F.row_number().over(Window.partitionBy("own_id").orderBy("content"))
    named = one.withColumn("nth", first).where("nth = 1").select("row")
    pieces = [named.select("row.*")]
    if not mixed.isEmpty():
        again = whole.join(mixed, F.col("own_id") == F.col("kept_id"), "left_semi").withColumn("text", F.col(f"row.`{text_column}`"))
        again = again.withColumn("fp", fingerprints(again)).join(kept, (F.col("own_id") == F.col("kept_id")) & (F.col("fp") == F.col("kept_fp")))
        pieces.append(again.withColumn("nth", F.row_number().over(Window.partitionBy("own_id", "fp").orderBy("content"))).where("nth = 1").select("row.*"))
    nameless = whole.where("own_id is null")
    lost = chosen.where("k is null").select("fp")
    if not lost.isEmpty():
        marked = nameless.withColumn("text", F.col(f"row.`{text_column}`"))
        marked = marked.withColumn("fp", fingerprints(marked))
        pieces.append(marked.join(lost, "fp").withColumn("nth", F.row_number().over(Window.partitionBy("fp").orderBy("content"))).where("nth = 1").select("row.*"))
    return reduce(DataFrame.unionByName, pieces)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint and a component per document, as classes states it; a text of any length is one row's work."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
