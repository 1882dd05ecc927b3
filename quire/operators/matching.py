"""Matching by n-grams, by multisets of letter pairs, and by evidence."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ty
from pyspark.sql.window import Window

from quire.functions.text import let
from quire.sources import scratch


def word_grams(text: Column, n: int) -> Column:
    """Runs of n words, joined by a space, with their place: array<struct<p, gram>>; shorter texts have none."""

    def grams(words: Column) -> Column:
        last = F.size(words) - n
        each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(i.alias("p"), F.array_join(F.slice(words, i + 1, n), " ").alias("gram")))
        return F.when(last >= 0, each).otherwise(F.array().cast("array<struct<p:int,gram:string>>"))

    return let(F.filter(F.split(text, r"\s+"), lambda w: w != ""), grams)


def gram_hits(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_text: Column, right_text: Column, n: int) -> DataFrame:
    """Inverted index lookup: (left_key, right_key, p, q) for every gram that both sides have.

    The right side, the smaller one, is indexed by gram; a gram that fills it repeats nothing, as each
    of its places is a row of its own.
    """
    a = left.select(left_key, F.explode(word_grams(left_text, n)).alias("g")).select(left_key, "g.p", "g.gram")
    b = right.select(right_key, F.explode(word_grams(right_text, n)).alias("g")).select(right_key, F.col("g.p").alias("q"), "g.gram")
    return a.join(b, "gram").select(left_key, right_key, "p", "q")


def quote_places(texts: DataFrame, quotes: DataFrame, text_key: str, quote_key: str, text: str, quote: str, n: int = 3) -> DataFrame:
    """Verbatim quotes: (text_key, quote_key, char_start, char_end) of the first place of each quote in each text that has it.

    A quote's inner grams (those without its first and last word, which may be parts of words in the text) find
    the candidates, one equi-join instead of every text against every quote. Quotes too short to have an
    inner gram are searched for in every text; there must be few of them. The candidates are written as a table, so
    that they meet the texts by broadcast where they are few, and no text moves.
    """
    words = F.filter(F.split(F.trim(F.col(quote)), r"\s+"), lambda w: w != "")
    keyed = quotes.withColumn("_gram", F.when(F.size(words) >= n + 2, F.array_join(F.slice(words, 2, n), " ")))
    asked = keyed.where("_gram is not null").select(quote_key, quote, "_gram")
    grams = texts.select(text_key, F.explode(F.array_distinct(F.transform(word_grams(F.col(text), n), lambda g: g["gram"]))).alias("_gram"))
    few = scratch.written(grams.join(asked, "_gram").select(text_key, quote_key, quote).distinct(), "quote-candidates")
    candidates = texts.select(text_key, text).join(few, text_key)
    short = keyed.where("_gram is null").select(quote_key, quote)
    everywhere = texts.select(text_key, text).join(short, F.contains(F.col(text), F.col(quote)))
    both = candidates.select(text_key, text, quote_key, quote).unionByName(everywhere.select(text_key, text, quote_key, quote))
    place = F.instr(F.col(text), F.col(quote)) - 1
    return both.withColumn("char_start", place).where("char_start >= 0").select(text_key, quote_key, "char_start", (F.col("char_start") + F.length(quote)).alias("char_end"))


def best_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in a total order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def multiset_lack(left: DataFrame, right: DataFrame, keys: list[str], item: str, n: str = "n") -> DataFrame:
    """(keys, lacking): how many items of the left multiset of a key (rows of keys, item, n) the right one lacks; 0 if it holds them all."""
    met = left.join(right.select(*keys, item, F.col(n).alias("_have")), [*keys, item], "left")
    return met.groupBy(*keys).agg(F.sum(F.greatest(F.col(n) - F.coalesce("_have", F.lit(0)), F.lit(0))).alias("lacking"))


#: White space as Java's and DuckDB's \s has it; what str.split() takes besides may be part of a term.
SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
#: Words whose terms one task remembers at most, and the longest of them.
KNOWN_WORDS, KNOWN_LENGTH = 200_000, 64


def term_shares(texts: DataFrame, items: DataFrame, item_key: str, text: str, item_text: str, least: float = 0.5) -> DataFrame:
    """(item_key, n_docs, best): how many texts contain a share of least or more of an item's words, and the highest share.

    A word counts as often as the item has it, and is contained if it occurs anywhere, also within a longer
    word. It has no white space, so it lies within one word of the text: each text is read once, and the
    parts of its distinct words are looked up among the words of all items. Texts stay where they are; a task
    returns one row per item. Items must be few: they are held on the driver and sent to each task. Null
    texts have no share, null items no row.
    """
    spelled: dict = {}
    for key, line in items.where(F.col(item_text).isNotNull()).select(item_key, item_text).collect():
        spelled.setdefault(key, []).extend(SPACE.split(line))
    keys, sizes = list(spelled), np.array([len(x) for x in spelled.values()])
    places: dict[str, list[int]] = {}
    for k, terms in enumerate(spelled.values()):
        for t in terms:
            places.setdefault(t, []).append(k)
    of = {t: np.array(x) for t, x in places.items()}
    lengths = sorted({len(t) for t in of} - {0})

    def parts(word: str) -> list[str]:
        return [w for n in lengths if n <= len(word) for i in range(len(word) - n + 1) if (w := word[i : i + n]) in of]

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, best, n_rows, n_texts, known = np.zeros(len(keys), np.int64), np.zeros(len(keys)), 0, 0, {}
        for batch in batches:
            n_rows += batch.num_rows
            for line in batch.column(0):
                if (value := line.as_py()) is None:
                    continue
                n_texts += 1
                met = {""} & of.keys()
                for word in set(SPACE.split(value)):
                    found = known.get(word)
                    if found is None:
                        found = parts(word)
                        if len(word) <= KNOWN_LENGTH:
                            if len(known) >= KNOWN_WORDS:
                                known.clear()
                            known[word] = found
                    met.update(found)
                if met:
                    shares = np.bincount(np.concatenate([of[t] for t in met]), minlength=len(keys)) / sizes
                    n_docs += shares >= least
                    np.maximum(best, shares, out=best)
        if n_rows and keys:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(keys)), pa.int64()), pa.array(n_docs), pa.array(best if n_texts else [None] * len(keys), pa.float64())], ["_k", "n_docs", "best"])

    found = texts.select(text).mapInArrow(share, "_k long, n_docs long, best double").groupBy("_k").agg(F.sum("n_docs").alias("n_docs"), F.max("best").alias("best"))
    names = items.sparkSession.createDataFrame(list(enumerate(keys)), ty.StructType([ty.StructField("_k", ty.LongType()), items.schema[item_key]]))
    return found.join(F.broadcast(names), "_k").select(item_key, "n_docs", "best")


def pair_counts(text: str) -> np.ndarray:
    """How often each pair of adjacent letters a-z occurs: 676 counts, aa first."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64) - 97
    inside = (c >= 0) & (c < 26)
    return np.bincount((c[:-1] * 26 + c[1:])[inside[:-1] & inside[1:]], minlength=676)


def closest_by_pairs(rows: DataFrame, lines: DataFrame, keys: list[str], line_key: str, text: str, line: str) -> DataFrame:
    """For each row the line with the most letter pairs a-z in common: (keys, line_key, common, score = common / row's pairs, cover = common / line's pairs).

    Whole texts, lower-cased here; ties go to the higher cover, then to the smaller line_key. Rows that share no pair with any line
    are left out; rows that repeat keys stay rows of their own. Lines must be few: their counts (676 each) are
    held on the driver and sent to each task, and rows stay where they are.
    """
    known = [(k, pair_counts(t)) for k, t in lines.where(F.col(line).isNotNull()).select(line_key, F.lower(line)).collect()]
    known = sorted(((k, c) for k, c in known if c.any()), key=lambda x: (x[1].sum(), x[0]))  # the first of the best wins its ties
    names, table = [k for k, _ in known], np.array([c for _, c in known]).reshape(-1, 676).T.copy()
    sizes = table.sum(axis=0)
    out = ty.StructType([*(rows.schema[k] for k in keys), lines.schema[line_key], ty.StructField("common", ty.LongType()), ty.StructField("score", ty.DoubleType()), ty.StructField("cover", ty.DoubleType())])
    name_type = lines.select(line_key).limit(0).toArrow().schema.field(0).type

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, won = [], []
            for i, value in enumerate(batch.column(len(keys))):
                if names and (value := value.as_py()):
                    mine = pair_counts(value)
                    has = np.flatnonzero(mine)
                    common = np.minimum(table[has], mine[has, None]).sum(axis=0)
                    k = int(common.argmax())
                    if common[k]:
                        at.append(i)
                        won.append((names[k], int(common[k]), common[k] / mine.sum(), common[k] / sizes[k]))
            taken = batch.take(pa.array(at, pa.int64()))
            columns = [pa.array([w[j] for w in won], t) for j, t in enumerate((name_type, pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*taken.columns[: len(keys)], *columns], out.names)

    return rows.select(*keys, F.lower(text).alias("_text")).mapInArrow(closest, out)


def assigned(pairs: DataFrame, keys: list[str], asks: str, gives: str, order: list[Column]) -> DataFrame:
    """One to one: in the order of asks, everyone takes the first of what is still free by order; (keys, asks, gives) of those that got one.

    pairs(keys, asks, gives, ...) are all that may come together, each once; order, with gives as its last, ranks what one may take. The result is that of
    going through asks one by one, yet comes in rounds of all at once: everyone names the first left to them, and whoever
    is named by several goes to the least of them for now and is closed to all greater ones. Later rounds may give it to a lesser one still. It
    ends when no one is named twice; each round closes pairs, so long chains of rivals take as many rounds as they have
    links, but only keys with rivals go through them. Nulls in asks or gives take no part. An empty table gives an empty one.
    """
    by = Window.partitionBy(*keys, asks).orderBy(*order, gives)
    left = pairs.where(F.col(asks).isNotNull() & F.col(gives).isNotNull()).select(*keys, asks, gives, F.row_number().over(by).alias("_rank"))
    done: list[DataFrame] = []
    left = scratch.written(left, "pairs-left")
    while True:
        # a key that has no rivals any more is finished and leaves
        first = left.groupBy(*keys, asks).agg(F.min_by(gives, "_rank").alias(gives))
        named = scratch.written(first.groupBy(*keys, gives).agg(F.min(asks).alias(asks), F.count("*").alias("_rivals")), "named")
        rivals = named.where("_rivals > 1").select(*keys).distinct()
        done.append(named.join(rivals, keys, "left_anti").select(*keys, asks, gives))
        if rivals.isEmpty():
            return reduce(DataFrame.unionByName, done)
        held = named.join(rivals, keys, "left_semi").select(*keys, gives, F.col(asks).alias("_least"))
        met = left.join(rivals, keys, "left_semi").join(held, [*keys, gives], "left")
        after = scratch.written(met.where(F.col("_least").isNull() | (F.col(asks) <= F.col("_least"))).drop("_least"), "pairs-left")
        scratch.discard(left)
        left = after
