"""URL filters by a Bloom filter cascade.

A cascade answers membership exactly for every key of a universe known in advance: level 0 encodes
the listed keys, level 1 the unlisted keys that level 0 lets through, level 2 the listed keys that
level 1 lets through, and so on until none is left. The first level that refuses a key decides.
The universe here holds every host of the pages and every parent domain of it that has no more labels than
the longest listed domain, so a host is judged without a join: its suffixes are tested against bit arrays.

Bits are set by ``groupBy(word).agg(bit_or)``, so no task holds more than the words it reduces. Keys are
dealt to shards by their hash, as many as keep the bit arrays of one shard under SHARD_BITS; each shard has a
cascade of its own, and they are broadcast and asked one after the other, so what a task holds is
bounded at any size of listing and universe.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._shared import ascii_lower, table, write_table

#: Rules as (verdict, host, path): fixed values of the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Domains listed in production: fixed values.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_UNDER = ("example.com", "example.net", "example.org")
LISTED = tuple(f"{n}.{d}" for n in LISTED_NAMES for d in LISTED_UNDER)
#: Bits of the cascade of one shard, about (64 MB).
SHARD_BITS = 64 * 8 * 1024 * 1024
#: About two keys in a hundred pass a level that does not hold them, so this many levels are left only by keys with equal hashes.
MAX_LEVELS = 64
BITS_PER_KEY, PROBES = 10, 6
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, ADDRESS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def suffixes(parts: Column, most: int) -> Column:
    """A host, given by its labels, and its parent domains that have most labels or fewer, as an array; a long host costs no more than a short one."""
    n = F.size(parts)
    return F.transform(F.sequence(F.greatest(F.lit(1), n - most + 1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))


def hashes(key: Column) -> Column:
    """Two independent 64-bit hashes of a key, packed for Arrow."""
    return F.array(F.xxhash64(key), F.xxhash64(key, F.lit("second")))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's path. Ties in
    length go to the longer host, then to the text.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def positions(h: np.ndarray, level: int, n_bits: int) -> np.ndarray:
    """Bit positions of keys (n, 2) at a level: (n, PROBES)."""
    a, b = _mix(h[:, 0], 2 * level + 1), _mix(h[:, 1], 2 * level + 2) | np.uint64(1)
    with np.errstate(over="ignore"):
        steps = a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)
    return ((steps >> np.uint64(11)) % np.uint64(n_bits)).astype(np.int64)


@dataclass(frozen=True)
class Cascade:
    """Bit arrays by level. Exact for keys of the universe it was built over; of no level, it holds nothing."""

    levels: tuple[np.ndarray, ...]

    def survives(self, h: np.ndarray) -> np.ndarray:
        """The number of levels that a key passes before the first that refuses it."""
        n = np.zeros(len(h), np.int64)
        alive = np.arange(len(h))
        for level, words in enumerate(self.levels):
            at = positions(h[alive], level, 64 * len(words))
            hit = ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)
            alive = alive[hit]
            n[alive] = level + 1
        return n

    def contains(self, h: np.ndarray) -> np.ndarray:
        """Refused by an odd level, or by none after an odd number of levels: listed."""
        return self.survives(h) % 2 == 1


def _hash_matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)


def build(universe: DataFrame) -> Cascade:
    """Build over universe(h array<bigint>, listed boolean), one row per key."""
    spark = universe.sparkSession
    levels: list[np.ndarray] = []
    while len(levels) < MAX_LEVELS:
        level, done = len(levels), spark.sparkContext.broadcast(tuple(levels))

        def alive(batches, done=done, level=level):
            cascade = Cascade(done.value)
            for b in batches:
                keep = cascade.survives(_hash_matrix(b.column(0))) == level
                yield b.filter(pa.array(keep))

        side = universe.where(F.col("listed") == F.lit(level % 2 == 0)).select("h")
        left = side.mapInArrow(alive, "h array<bigint>") if level else side
        n = left.count()
        if not n:
            return Cascade(tuple(levels))
        n_bits = 64 * max(2, -(-n * BITS_PER_KEY // 64))

        def marks(batches, level=level, n_bits=n_bits):
            for b in batches:
                at = np.unique(positions(_hash_matrix(b.column(0)), level, n_bits))
                yield pa.record_batch([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["word", "mask"])

        words = np.zeros(n_bits // 64, np.uint64)
        found = left.mapInArrow(marks, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        levels.append(words)
    raise ValueError("a listed and an unlisted key have equal hashes")


def _asks(shared, k: int, n_shards: int):
    """A function of hash lists: whether shard k's cascade holds any of a row's keys that are its own."""

    @F.arrow_udf("boolean")
    def on_list(h: pa.Array) -> pa.Array:
        matrix = _hash_matrix(h.flatten())
        own = matrix[:, 0] % n_shards == k
        inside = np.zeros(len(matrix), bool)
        inside[own] = shared.value.contains(matrix[own])
        owner = np.repeat(np.arange(len(h)), np.diff(h.offsets.to_numpy()))
        return pa.array(np.bincount(owner, weights=inside, minlength=len(h)) > 0)

    return on_list


def covered(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """hosts(row, host) with the column listed: whether a domain of listed(key) is the host or a parent of it."""
    spark = hosts.sparkSession
    most = listed.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 1
    hosts = hosts.withColumn("parts", F.split("host", r"\.")).withColumn("h", F.transform(suffixes(F.col("parts"), most), hashes)).drop("parts")
    keys = hosts.select(F.explode("h").alias("h")).distinct()
    names = listed.select(hashes(F.col("key")).alias("h")).distinct().withColumn("on_list", F.lit(True))
    universe = write_table(keys.join(names, "h", "left").select("h", F.coalesce("on_list", F.lit(False)).alias("listed")), "url-universe")
    # unlisted keys that pass level 0 fill the odd levels; all levels together hold a few listed keys' worth more
    n_listed, n = universe.where("listed").count(), universe.count()
    n_shards = max(1, -(-int((n_listed + 0.02 * n) * 1.1 * BITS_PER_KEY) // SHARD_BITS))
    shard = F.pmod(F.col("h")[0], F.lit(n_shards))
    out = hosts.withColumn("listed", F.lit(False))
    for k in range(n_shards):
        shared = spark.sparkContext.broadcast(build(universe.where(shard == k).select("h", "listed")))
        out = out.withColumn("listed", F.col("listed") | _asks(shared, k, n_shards)("h"))
        if n_shards > 1:  # one shard's bit arrays in a task at a time
            out = write_table(out, "url-shard")
    return out.drop("h")


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """A verdict for every page: its longest fitting rule's, else block if a listed domain covers its host, else allow.

    pages needs id_column and url_column; other columns are left out, so their names cannot clash.
    listed has one column of domains; null and repeated ones are ignored. Returns (page_id, host, path,
    rule, verdict, listed), one row per row of pages, repeated rows included. Null urls and urls without
    :// have empty host and path and are allowed, as are those whose host is longer than any listed one unless a
    listed domain ends it; ties between rules go to the longer host. An empty table gives an empty one; an empty
    listing blocks by rules alone.
    """
    url = F.col(url_column)
    base = pages.select(F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    names = listed.select(ascii_lower(F.col(listed.columns[0])).alias("key")).where("key is not null and key <> ''").distinct()
    marked = covered(base, names)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(rule["verdict"], F.when(F.col("listed"), "block").otherwise("allow"))
    return marked.select("page_id", "host", "path", rule["rule"].alias("rule"), verdict.alias("verdict"), "listed")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url, as judge_urls states it, with LISTED as listed domains."""
    listed = spark.createDataFrame([(d,) for d in LISTED], "domain string")
    return judge_urls(table(spark, sf_dir, "pages"), listed)


SQL = r"""
WITH a AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
b AS (
  SELECT *,
         CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule,
         regexp_matches(host, '^(.*\.)?(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$') AS listed
  FROM a)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM b
"""
