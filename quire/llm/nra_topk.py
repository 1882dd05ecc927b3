"""Exact top-k search by no-random-access aggregation.

Every dimension of a block of candidates is a list sorted by value, read from the end that a query's weight
for the dimension prefers. Reading goes in stages, all lists in step and whole ties at once. A candidate's
lower bound adds the worst entry of each list in which it has not been seen to what has been seen of it, its
upper bound adds the entry that the list stands at. The first stage's bounds are two matrix products for a batch of
queries; from then on a query carries its live candidates from stage to stage and adds only what is newly read. It stops when no
candidate outside a few can reach the k-th lower bound; the scores of those few are then completed.

Queries and candidates meet in square cells of a grid (query block, candidate block), a bounded number of
rows on both sides each, so a row is copied once for every BLOCK rows of the other side. The cells of the first
candidate block run first; a query's k-th score there is a floor, below which later cells drop candidates at
once and return nothing. A last step keeps the k best per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm._shared import table, write_table

K = 10
#: Vectors of a candidate block at most, and of a query block; small tables are cut finer, for at least PARTS candidate blocks of LEAST rows.
BLOCK, LEAST, PARTS = 1 << 15, 1 << 12, 16
#: Share of every list that has been read after each stage. Those still open after the last have their scores completed, however many they are.
STAGES = (27 / 32, 7 / 8, 29 / 32, 15 / 16, 31 / 32)
#: Reading stops early once no more than this many times k candidates are left; their scores are then completed.
RESOLVE = 4
#: Queries whose bounds are computed together: a task holds as many bounds of every candidate of a block.
BATCH = 128
SCALE = 1024
FOUND = "query_id long, vec_id long, score long"
_LONG = 2**63


def integers(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): every vector as floor(1024 * x) per component; vectors null or with null or non-finite components left out."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & sound)
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


class Lists:
    """The sorted lists of a block of candidates of one width."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.order = np.argsort(ids, kind="stable")
        self.own = ids[self.order]
        self.v = values.astype(np.float64)
        self.rising = np.sort(self.v, axis=0)

    def limits(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists stand when this share of them is read: from the top, and from the bottom."""
        last = int((len(self.v) - 1) * share)
        return self.rising[len(self.v) - 1 - last], self.rising[last]

    def _selves(self, query_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, candidate) places of equal ids."""
        a, b = np.searchsorted(self.own, query_ids), np.searchsorted(self.own, query_ids, side="right")
        many = b - a
        who = np.repeat(np.arange(len(query_ids)), many)
        return who, self.order[np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)]

    def bounds(self, weights: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries, candidates) of all candidates after the first share of all lists.

        An entry that is read counts as itself; another counts as its list's worst entry in the lower bound, and as the
        entry the list stands at in the upper. What is read is the same for all queries of a sign, so this is two matrix products.
        """
        top, bottom = self.limits(share)
        down, up = self.v >= top, self.v <= bottom
        both = np.maximum(weights, 0), np.minimum(weights, 0)
        w = np.concatenate(both, axis=1)
        low = w @ np.concatenate([np.where(down, self.v, self.rising[0]), np.where(up, self.v, self.rising[-1])], axis=1).T
        gap = np.concatenate([both[0] * (top - self.rising[0]), both[1] * (bottom - self.rising[-1])], axis=1)
        return low, low + gap @ np.concatenate([~down, ~up], axis=1).T.astype(np.float64)

    def advance(self, weight: np.ndarray, alive: np.ndarray, low: np.ndarray, before: float, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of one query's live candidates when its lists are read on: only entries between the two depths are added."""
        (top, bottom), (old_top, old_bottom) = self.limits(share), self.limits(before)
        rising, scale = weight >= 0, np.abs(weight)
        # turned, so that every list is read from its greatest entry
        v = self.v[alive] * np.where(rising, 1.0, -1.0)
        at, old, worst = np.where(rising, top, -bottom), np.where(rising, old_top, -old_bottom), np.where(rising, self.rising[0], -self.rising[-1])
        low = low + np.where((v >= at) & (v < old), v - worst, 0) @ scale
        return low, low + (v < at) @ (scale * (at - worst))

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray | None = None, stopped: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query ids and scores of its k best candidates, ties to smaller ids, its own id left out; those under its floor may be left out.

        The first stage's bounds come for a batch of queries at once. From then on every query has its own live candidates, whose bounds
        grow by what a stage newly reads, and it stops when few enough are left. stopped gets (share read, candidates left) of each query.
        """
        n = len(self.ids)
        w = queries.astype(np.float64)
        # rounding of a bound; without any if all sums are whole numbers that floats hold
        slack = 1e-9 * (np.abs(w) @ np.maximum(np.abs(self.rising[0]), np.abs(self.rising[-1])))
        least = np.full(len(w), -np.inf) if floors is None else floors.astype(np.float64)
        out: list = []
        for i in range(0, len(w), BATCH):
            some = np.arange(i, min(i + BATCH, len(w)))
            lows, highs = self.bounds(w[some], STAGES[0])
            own = self._selves(query_ids[some])
            lows[own] = highs[own] = -np.inf
            if n > k:
                least[some] = np.maximum(least[some], np.partition(lows, n - k, axis=1)[:, n - k])
            for q, low, high in zip(some.tolist(), lows, highs):
                alive = np.flatnonzero((high >= least[q] - slack[q]) & (high > -np.inf))
                low, share = low[alive], STAGES[0]
                for following in STAGES[1:]:
                    if len(alive) <= RESOLVE * k:
                        break
                    low, high = self.advance(w[q], alive, low, share, following)
                    share = following
                    # the k-th lower bound of those alive holds for all, as the k best of all are among them
                    least[q] = max(least[q], np.partition(low, len(low) - k)[len(low) - k])
                    keep = high >= least[q] - slack[q]
                    alive, low = alive[keep], low[keep]
                if stopped is not None:
                    stopped.append((share if len(alive) <= RESOLVE * k else 1.0, len(alive)))
                out.append(self._resolve(alive, queries[q], k))
        return out

    def _resolve(self, who: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some candidates by their exact scores."""
        some = self.values[who]
        largest = float(np.abs(some.astype(np.float64)).max(initial=0)) * float(np.abs(query.astype(np.float64)).max(initial=0)) * len(query)
        if largest < 2**62:
            scores = some @ query
        else:  # beyond 64 bits: exact, then held at the ends of the type
            exact = [sum(a * b for a, b in zip(row, query.tolist())) for row in some.tolist()]
            scores = np.array([min(max(x, -_LONG), _LONG - 1) for x in exact], np.int64)
        best = sorted(range(len(who)), key=lambda i: (-int(scores[i]), int(self.ids[who[i]])))[:k] if len(who) <= 256 else np.lexsort((self.ids[who], ~scores))[:k]
        return self.ids[who][best], scores[best]


def _by_width(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (vec_id, v, floor) by the width of v: places, ids and vectors."""
    ids = rows["vec_id"].to_numpy().astype(np.int64)
    v = rows["v"].combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    offsets, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    out = {}
    for width in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == width)
        out[width] = at, ids[at], flat[offsets[at][:, None] + np.arange(width)]
    return out


def search_cell(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best of a candidate block for every query of a query block."""
    found: tuple[list, list, list] = ([], [], [])
    if candidates.num_rows and queries.num_rows:
        floors = queries["floor"].to_numpy(zero_copy_only=False).astype(np.float64)
        floors = np.where(np.isnan(floors), -np.inf, floors)
        asked = _by_width(queries)
        for width, (_, ids, values) in _by_width(candidates).items():
            if width in asked:
                at, query_ids, vectors = asked[width]
                for q, (who, scores) in zip(query_ids, Lists(ids, values).top(query_ids, vectors, k, floors[at])):
                    for column, value in zip(found, (np.full(len(who), q), who, scores)):
                        column.append(value)
    return pa.table([pa.array(np.concatenate(c).astype(np.int64) if c else [], pa.int64()) for c in found], ["query_id", "vec_id", "score"])


def top_k(embeddings: DataFrame, k: int = K, every: int = 100, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k highest integer inner products of every query row with all other rows.

    Queries are the rows whose id is divisible by every. Returns (query_id, rank, vec_id, score), rank
    from 1, ties to the smaller vec_id; fewer than k rows where there are fewer candidates. Vectors that
    are null or hold null or non-finite components take no part, nor do null ids and empty vectors;
    vectors of different lengths do not meet. Of rows that repeat an id, each is a candidate, none for
    its own id; a repeated query is asked once, with its smallest vector. Components beyond 2**63 / 1024 and
    scores beyond 64 bits are held at the ends of the type. Other columns are left out. An empty table
    gives an empty one.
    """
    # blocks are dealt by a row number, so that rows of one id or one vector spread like any others; the table makes it lasting
    rows = integers(embeddings, id_column, vector_column).withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    rows = write_table(rows, "top-k-vectors")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = write_table(asked.withColumn("deal", F.xxhash64("vec_id")), "top-k-queries")
    n, n_queries = rows.count(), asked.count()
    across, down = max(1, -(-n // BLOCK), min(PARTS, n // LEAST)), max(1, -(-n_queries // BLOCK))

    def cells(first: int, last: int, queries: DataFrame) -> DataFrame:
        """What the cells of some candidate blocks find."""
        block, q_block = F.pmod("deal", F.lit(across)).cast("int"), F.pmod("deal", F.lit(down)).cast("int")
        left = rows.withColumn("c", block).where(F.col("c").between(first, last)).select("c", F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("q"), "vec_id", "v")
        right = queries.select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("c"), q_block.alias("q"), "vec_id", "v", "floor")
        return left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(lambda a, b: search_cell(a, b, k), FOUND)

    found = cells(0, 0, asked.withColumn("floor", F.lit(None).cast("long")))
    if across > 1:
        found = write_table(found, "top-k-first")
        floors = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("least").alias("floor"))
        found = found.union(cells(1, across - 1, asked.join(floors, "vec_id", "left")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of every hundredth vector among all others, as top_k states it: equal scores go by the smaller id."""
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INT AS rank, vec_id, score FROM r WHERE n <= 10
"""
