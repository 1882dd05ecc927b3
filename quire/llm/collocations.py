"""Phrase collocations: contiguous phrases that are more frequent than their parts let expect.

1. Lots of texts are cut into words once, each word coded by a dictionary of its lot (table of lots).
2. Words are counted over all lots; the frequent ones of a language get numbers, and every lot gets the
   numbers of its own words back by a join. A rarer word breaks a piece, as no frequent phrase holds it.
3. Every place of a lot with two numbers in a row gives a key, six bytes a number. A radix sort and a run-length count
   leave each key of a lot once, with its count. Keys are dealt by ranges, whose limits come from a bounded sample and
   decide balance only. Each range is radix-sorted, its runs are the counts of pairs, and each lot hears which of its pairs are frequent.
4. Where two frequent pairs follow each other, the next four numbers give a longer key, zero from the first rare pair on. These go
   the same way; the runs of equal first three and four numbers are the counts of the phrases. A range's first and last runs may
   go on in its neighbours, so they are passed on whatever their count, and added up.
5. Cuts, containment and ranks are joins and sums over the frequent phrases.

A key that is everywhere comes once from each lot, and ranges cut between any two keys, so no phrase is hot.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm._shared import small_batches, table, write_table
from quire.operators import spans
from quire.sources import scratch

LEAST, LONGEST, TOP, CONTAINED, SCALE = 30, 4, 2000, 80, 2_000_000
NONE = "und"
#: Bytes of text of one lot, and words of one range, about.
LOT, RANGE = 16 << 20, 1 << 19
#: Lots and keys of each that the limits of ranges are taken from, at most.
SAMPLED, KEYS = 64, 1024
#: Bytes of a word's number in a key, and scores that count as one step when the best are cut off.
WIDE, STEP = 6, 50
_FROM = bytes([*range(65, 91), 9, *b".,;:!?", *range(10, 14)])
_TO = bytes([*range(97, 123), 32, *b"\n\n\n\n\n\n", *b"\n\n\n\n"])
_PLAIN = bytes.maketrans(_FROM, _TO)


def words(text: bytes) -> list[bytes]:
    """The words of a text in order, with a line end for each end of a piece."""
    return [w for w in text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ") if w]


class _Codes(dict):
    """Words by number in the order of their coming; the end of a piece is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


LOTS = "lot long, lang string, words array<binary>, counts array<long>, codes binary"


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lots of texts (lang, text as bytes): the words of each language in a lot, their counts, and the texts as codes."""
    first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    n = size = 0
    open_: dict = defaultdict(lambda: (_Codes({b"\n": 0}), []))

    def lots():
        nonlocal n, size
        for lang, (known, codes) in open_.items():
            every = np.concatenate(codes)
            yield pa.record_batch([pa.array([first + n], pa.int64()), pa.array([lang]), pa.array([list(known)], pa.list_(pa.binary())), pa.array([np.bincount(every, minlength=len(known))], pa.list_(pa.int64())), pa.array([every.tobytes()], pa.binary())], ["lot", "lang", "words", "counts", "codes"])
            n += 1
        open_.clear()
        size = 0

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            found = words(text.as_py())
            known, codes = open_[lang]
            codes.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
            codes.append(np.zeros(1, np.int32))
            size += len(text.as_py())
            if size > LOT:
                yield from lots()
    yield from lots()


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of bytes (an even number each): least significant digit first, 16 bits a digit."""
    digits = keys.view(">u2").astype(np.uint16)
    order = np.arange(len(keys))
    for d in range(digits.shape[1] - 1, -1, -1):
        column = digits[:, d]
        if len(column) and column.min() != column.max():
            order = order[np.argsort(column[order], kind="stable")]
    return order


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and where each distinct one begins in it."""
    order = radix_order(keys)
    some = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], (some[1:] != some[:-1]).any(axis=1)])) if len(some) else np.zeros(0, np.int64)


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes in order, and the sum of counts of each."""
    order, begin = runs_of(keys)
    return keys[order[begin]], np.add.reduceat(counts[order], begin) if len(begin) else counts


def _packed(columns: list[np.ndarray]) -> np.ndarray:
    """Numbers side by side, WIDE bytes each, the most significant first."""
    parts = [np.ascontiguousarray(c).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDE :] for c in columns]
    return np.ascontiguousarray(np.concatenate(parts, axis=1))


def pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of two numbers in a row, and their keys."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, _packed([ids[at], ids[at + 1]])


def longer(ids: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Keys of LONGEST numbers for the places where two pairs in a row are frequent, with zeros from the first pair on that is not.

    flags tells it of each distinct pair in order.
    """
    at, keys = pairs(ids)
    order, begin = runs_of(keys)
    good = np.zeros(len(ids) + LONGEST, bool)
    good[at[order]] = np.repeat(flags, np.diff(np.concatenate([begin, [len(at)]])))
    padded = np.concatenate([ids, np.zeros(LONGEST, np.int64)])
    at = np.flatnonzero(good[:-1] & good[1:])
    columns, on = [padded[at], padded[at + 1]], np.ones(len(at), bool)
    for k in range(2, LONGEST):
        on = on & good[at + k - 1]
        columns.append(np.where(on, padded[at + k], 0))
    return _packed(columns)


def phrases(keys: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of three numbers or more, as rows of bytes, and their counts, from the distinct sorted keys of one range.

    Those under least are left out, but for the first and the last of each length: these may have more in a neighbour.
    """
    for n in range(3, LONGEST + 1):
        some = keys[:, (n - 1) * WIDE : n * WIDE].any(axis=1)
        heads, sums = keys[some][:, : n * WIDE], counts[some]
        if len(heads):
            begin = np.flatnonzero(np.concatenate([[True], (heads[1:] != heads[:-1]).any(axis=1)]))
            total = np.add.reduceat(sums, begin)
            keep = total >= least
            keep[[0, -1]] = True
            yield heads[begin[keep]], total[keep]


def encoded(lots: DataFrame, known: DataFrame, kind: str) -> DataFrame:
    """(lot, ids): the numbers of the words of every lot, 0 for rarer words and ends of pieces."""
    each = lots.select("lot", "lang", F.posexplode("words").alias("code", "word")).where("code > 0")
    back = write_table(each.join(known.select("lang", "word", "id"), ["lang", "word"]).groupBy("lot").agg(F.collect_list(F.struct("code", "id")).alias("to")), "codes-to-numbers")

    def ids(batches):
        for b in batches:
            for lot, codes, to in zip(b.column(0), b.column(1), b.column(2)):
                codes = np.frombuffer(codes.as_py(), np.int32)
                number = np.zeros(int(codes.max(initial=0)) + 1, kind)
                found = to.values
                number[found.field("code").to_numpy()] = found.field("id").to_numpy()
                yield pa.record_batch([pa.array([lot.as_py()], pa.int64()), pa.array([number[codes].tobytes()], pa.binary())], ["lot", "ids"])

    found = write_table(lots.select("lot", "codes").join(back, "lot").mapInArrow(ids, "lot long, ids binary"), "lots-as-numbers")
    scratch.discard(back)
    return found


class _Ranges:
    """Keys of a width in words, dealt by limits that a bounded sample of lots gives."""

    def __init__(self, words_: int, of: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]]):
        self.size, self.of, self.limits = words_ * WIDE, of, None

    def rows(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, np.uint8).reshape(-1, self.size)

    def _ordered(self, keys: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(keys).view(f"S{self.size}").ravel()

    def fit(self, lots: DataFrame, ranges: int) -> None:
        def some(batches):
            for b in batches:
                for _, keys in self.of(b):
                    yield pa.record_batch([pa.array([keys[:: max(1, len(keys) // KEYS)][:KEYS].tobytes()], pa.binary())], ["keys"])

        # the lots are chosen by their numbers alone, so that no task gathers their contents
        chosen = [r[0] for r in lots.select("lot").orderBy(F.xxhash64("lot")).limit(SAMPLED).collect()]
        few = lots.where(F.col("lot").isin(chosen)).mapInArrow(some, "keys binary").collect()
        keys = np.sort(self._ordered(np.concatenate([self.rows(r["keys"]) for r in few] or [self.rows(b"")])))
        self.limits = np.unique(keys[[len(keys) * i // ranges for i in range(1, ranges)]]) if len(keys) else keys

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct keys of each lot, in order, and their counts, by range."""
        for b in batches:
            for lot, keys in self.of(b):
                keys, counts = counted(keys, np.ones(len(keys), np.int32))
                place = np.concatenate([[0], np.searchsorted(self._ordered(keys), self.limits), [len(keys)]])
                full = np.flatnonzero(np.diff(place)).tolist()
                sides = [[x[place[i] : place[i + 1]].tobytes() for i in full] for x in (keys, counts.astype(np.int32))]
                if full:
                    yield pa.record_batch([pa.array(full, pa.int32()), pa.array([lot] * len(full), pa.int64()), *(pa.array(x, pa.binary()) for x in sides)], ["range", "lot", "keys", "counts"])

    def read(self, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([self.rows(x.as_py()) for x in t["keys"]]), np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in t["counts"]]).astype(np.int64)


_DEALT = "range int, lot long, keys binary, counts binary"


def frequent(ids: DataFrame, kind: str, ranges: int, least: int) -> DataFrame:
    """(gram, f): phrases of two or more words, as packed numbers, with at least so many places."""

    def numbers(raw: pa.Scalar) -> np.ndarray:
        return np.frombuffer(raw.as_py(), kind).astype(np.int64)

    two = _Ranges(2, lambda b: ((lot.as_py(), pairs(numbers(raw))[1]) for lot, raw in zip(b.column("lot"), b.column("ids"))))
    two.fit(ids, ranges)

    def met(t: pa.Table) -> pa.Table:
        """Of a range: for each lot which of its pairs are frequent, and these pairs with their counts."""
        keys, counts = two.read(t)
        order, begin = runs_of(keys)
        total = np.add.reduceat(counts[order], begin)
        flags = np.empty(len(keys), np.uint8)
        flags[order] = np.repeat(total >= least, np.diff(np.concatenate([begin, [len(keys)]])))
        ends = np.cumsum([len(x.as_buffer()) // two.size for x in t["keys"]])
        good = total >= least
        grams = [k.tobytes() for k in keys[order[begin[good]]]]
        n = len(t)
        return pa.table(
            [pa.array([*t["range"].to_pylist(), None], pa.int32()), pa.array([*t["lot"].to_pylist(), None], pa.int64()), pa.array([*(x.tobytes() for x in np.split(flags, ends[:-1])), None], pa.binary()),
             pa.array([None] * n + [grams], pa.list_(pa.binary())), pa.array([None] * n + [total[good]], pa.list_(pa.int64()))],
            ["range", "lot", "flags", "grams", "f"],
        )

    sent = ids.mapInArrow(two.deal, _DEALT)
    found = write_table(sent.groupBy("range").applyInArrow(met, "range int, lot long, flags binary, grams array<binary>, f array<long>"), "frequent-pairs")
    short = found.where("lot is null").select(F.explode(F.arrays_zip("grams", "f")).alias("g")).select(F.col("g.grams").alias("gram"), "g.f")
    flags = found.where("lot is not null").groupBy("lot").agg(F.array_sort(F.collect_list(F.struct("range", "flags"))).alias("flags"))
    flagged = ids.join(flags.select("lot", "flags.flags"), "lot")

    def rest(batches):
        for b in batches:
            for lot, raw, parts in zip(b.column("lot"), b.column("ids"), b.column("flags")):
                keys = longer(numbers(raw), np.frombuffer(b"".join(parts.as_py()), np.uint8).astype(bool))
                yield pa.record_batch([pa.array([lot.as_py()], pa.int64()), pa.array([keys.tobytes()], pa.binary())], ["lot", "keys"])

    long_keys = write_table(flagged.mapInArrow(rest, "lot long, keys binary"), "longer-keys")
    scratch.discard(ids)
    more = _Ranges(LONGEST, lambda b: ((lot.as_py(), np.frombuffer(raw.as_py(), np.uint8).reshape(-1, LONGEST * WIDE)) for lot, raw in zip(b.column("lot"), b.column("keys"))))
    more.fit(long_keys, ranges)

    def summed(t: pa.Table) -> pa.Table:
        out = list(phrases(*counted(*more.read(t)), least))
        return pa.table([pa.array([row.tobytes() for heads, _ in out for row in heads], pa.binary()), pa.array(np.concatenate([c for _, c in out]), pa.int64())], ["gram", "f"])

    sums = long_keys.mapInArrow(more.deal, _DEALT).groupBy("range").applyInArrow(summed, "gram binary, f long")
    return short.union(sums.groupBy("gram").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def _part(first: int, many: int) -> F.Column:
    return F.substring("gram", first * WIDE + 1, many * WIDE)


def scored(grams: DataFrame, known: DataFrame, contained: int) -> DataFrame:
    """(gram, a, l, r, score): candidates that no longer one covers, each with its worst cut."""
    n = F.length("gram") / WIDE
    single = known.select(F.col("key").alias("gram"), "f")
    every = grams.union(single)
    cuts = grams.select("gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), (n - 1).cast("int"))).alias("k"))
    cuts = cuts.withColumn("left", F.expr(f"substring(gram, 1, k * {WIDE})")).withColumn("right", F.expr(f"substring(gram, k * {WIDE} + 1)"))
    met = cuts.join(every.select(F.col("gram").alias("left"), F.col("f").alias("l")), "left").join(every.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr(f"cast({SCALE} as decimal(7, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = met.groupBy("gram", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inside = [(i, m, longer) for longer in range(3, LONGEST + 1) for m in range(2, longer) for i in range(longer - m + 1)]
    parts = F.filter(F.array(*(F.when(n == longer, _part(i, m)) for i, m, longer in inside)), lambda x: x.isNotNull())
    over = grams.where(n > 2).select(F.explode(parts).alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("longer"))
    free = best.join(over, "gram", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained))
    return free.select("gram", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, contained: int = CONTAINED, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to four words.

    Words are runs of other than space and tab in the pieces between .,;:!? and line ends, A-Z lower-cased; a phrase
    is counted at all its places within pieces. Candidates have at least so many places; one that lies in a longer
    candidate with contained percent of its places is dropped. A phrase's score is that of its lowest-scoring cut,
    ties of cuts to the earliest; ranks go by score, places, and the phrase's bytes. Null texts have no words, a
    null language is "und". Repeated rows count each. Texts of any length go whole; a task holds one. Other columns
    are left out. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(NONE)).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"))
    lots = write_table(rows.mapInArrow(cut, LOTS), "word-lots")
    each = lots.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).where(F.col("w.words") != b"\n")
    counts = write_table(each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= least), "frequent-words")
    totals = lots.select("lang", (F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x) - F.col("counts")[0]).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = write_table(totals, "words-by-language")
    known = spans.placed(counts, [F.col("lang"), F.col("word")], "id")
    known = write_table(known.withColumn("key", F.unhex(F.lpad(F.hex("id"), 2 * WIDE, "0"))), "word-numbers")
    kind = "<u4" if known.count() < 1 << 32 else "<i8"
    ids = encoded(lots, known, kind)
    scratch.discard(lots)
    total = totals.agg(F.sum("n")).first()[0] or 0
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE)
    grams = write_table(frequent(ids, kind, ranges, least), "frequent-phrases")
    best = scored(grams, known, contained).withColumn("key", _part(0, 1))
    best = write_table(best.join(known.select("key", "lang"), "key").drop("key").withColumn("step", F.call_function("div", "score", F.lit(STEP).cast("long"))), "scored-phrases")
    # the steps of scores down to that of the last phrase wanted; a language has a bounded number of steps
    steps = best.groupBy("lang", "step").agg(F.count("*").alias("many"))
    down = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    wanted = steps.withColumn("above", F.coalesce(F.sum("many").over(down), F.lit(0))).where(F.col("above") < top).select("lang", "step")
    few = best.join(wanted, ["lang", "step"])
    numbers = F.transform(F.sequence(F.lit(0), (F.length("gram") / WIDE - 1).cast("int")), lambda i: F.substring("gram", i * WIDE + 1, F.lit(WIDE)))
    spelt = few.select("gram", F.posexplode(numbers).alias("place", "key")).join(known.select("key", F.col("word").cast("string").alias("word")), "key")
    spelt = spelt.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    named = few.join(spelt, "gram").withColumn("phrase", F.array_join("words.word", " ")).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, row_number() OVER () AS piece, w FROM (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d)),
u AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
v AS (SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3, lead(w1, 3) OVER x AS w4 FROM u WINDOW x AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS k, w1 AS phrase FROM v UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM v WHERE w2 IS NOT NULL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM v WHERE w3 IS NOT NULL
      UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM v WHERE w4 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
c AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.lang, words, c.phrase, a, i AS k, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
      FROM c JOIN range(1, 4) y(i) ON i < words
      JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:i], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[i + 1:words], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM c JOIN range(2, 4) y(m) ON m < words JOIN range(1, 4) z(i) ON i + m - 1 <= words GROUP BY 1, 2),
e AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT q.lang, rank, phrase, a, l, r, n, score FROM q JOIN t ON t.lang = q.lang WHERE rank <= 2000
"""
