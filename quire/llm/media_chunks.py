"""Media columns: payloads kept as content-defined chunks, each distinct chunk once.

A payload is held as a sound file of 8-bit samples (RIFF/WAVE, mono). Its bytes are cut where a rolling
gear hash of the last 32 bytes has zeros in its top bits, so equal passages give equal chunks wherever
they stand. Three tables make up a store:

* ``entries``: per row its id, size, media digest and the ordered chunk digests (no bytes);
* ``packs``: per media that has them, its chunks that occur once in the corpus, written where they are cut;
* ``shared``: every chunk that occurs more often, once.

Bytes of chunks that occur once never move. Which chunks those are is told by a Bloom filter over the
digests that occur more often; its size is bounded, so it can be broadcast at any scale, and what it takes
for shared by mistake is stored as shared and costs a move, not a wrong result: where far more digests are
shared than it has room for, every chunk moves once, as in a plain shuffle of the payloads. A media with shared
chunks is put together by joins on digest, whose large side adaptive execution splits where one digest is
in many media; every media is verified against its digest when read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm._shared import small_batches, table, write_table

#: Payloads are filled up with zeros to a positive multiple of this.
UNIT = 64
RATE = 8000
HEADER = struct.Struct("<4sI4s4sIHHIIHH4sI")
#: Chunks: least and most bytes, and top bits of the hash that are zero at a cut (one position in 2**BITS).
LEAST, MOST, BITS = 512, 8192, 10
#: The gear table: 32 random bits per byte value, from a fixed seed.
GEAR = np.random.default_rng(20240607).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bits of the Bloom filter at most (32 MB, which is enough for some 20 million shared digests) and probes.
FILTER_BITS, PROBES = 1 << 28, 5
#: Digests that a task remembers so as not to send a shared chunk twice.
REMEMBERED = 100_000


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes filled up to a positive multiple of UNIT, and how many there were."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT)), len(raw)


def header(n: int) -> bytes:
    return HEADER.pack(b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n)


def samples(media: bytes) -> bytes:
    """The samples of a sound file, that is the payload."""
    n = HEADER.unpack_from(media)[-1]
    if len(media) != HEADER.size + n or media[: HEADER.size] != header(n):
        raise ValueError("not a sound file of this store")
    return media[HEADER.size :]


def gear(data: bytes) -> np.ndarray:
    """The gear hash at every byte: sum of GEAR[byte] << age over the last 32 bytes, by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for k in range(5):
        w = 1 << k
        if len(h) > w:
            h[w:] += h[:-w] << np.uint32(w)
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of data: the first cut position LEAST bytes or more on, else MOST bytes on."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    places = np.flatnonzero(gear(data) >> np.uint32(32 - BITS) == 0) + 1
    ends, at = [], 0
    while n - at > LEAST:
        i = np.searchsorted(places, at + LEAST)
        end = int(places[i]) if i < len(places) else n
        at = min(end, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


class Filter:
    """A Bloom filter over digests, whose bytes serve as hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(digests: list[bytes], n_bits: int) -> np.ndarray:
        h = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 4)
        with np.errstate(over="ignore"):
            return ((h[:, :1] + (h[:, 1:2] | np.uint64(1)) * np.arange(PROBES, dtype=np.uint64)) % np.uint64(n_bits)).astype(np.int64)

    def __call__(self, digests: list[bytes]) -> list[bool]:
        if not digests or not len(self.words):
            return [False] * len(digests)
        at = self.places(digests, 64 * len(self.words))
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1).tolist()

    @classmethod
    def over(cls, found: DataFrame) -> Filter:
        """The filter of found(digest); every task marks its own, and bit_or joins the marks."""
        n = found.count()
        if not n:
            return cls(np.zeros(0, np.uint64))
        n_bits = min(FILTER_BITS, 1 << max(6, (16 * n).bit_length()))

        def marks(batches):
            for b in batches:
                if b.num_rows:
                    at = np.unique(cls.places(b.column(0).to_pylist(), n_bits))
                    yield pa.record_batch([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["word", "mask"])

        words = np.zeros(n_bits // 64, np.uint64)
        got = found.mapInArrow(marks, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        words[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
        return cls(words)


def _each(batches, column: int) -> Iterator[tuple[int, pa.RecordBatch, str | None]]:
    for b in batches:
        for i, t in enumerate(b.column(column)):
            yield i, b, t.as_py()


def store(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> dict[str, DataFrame]:
    """Write the store of every row of docs and return its tables: entries, packs and shared.

    Null texts are empty; an empty payload is UNIT zeros. Rows with a null id and repeated rows have
    entries of their own and share their chunks. Other columns are left out, so their names cannot
    clash. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = docs.schema["doc_id"].dataType
    id_kind = to_arrow_type(id_type)

    def enter(batches):
        for b in batches:
            rows = []
            for t in b.column(1):
                data, n = payload_of(t.as_py())
                rows.append((n, digest(header(len(data)) + data), [digest(c) for c in chunks(data)]))
            yield pa.record_batch([b.column(0).cast(id_kind), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.binary()))], ["doc_id", "n_bytes", "media", "chunks"])

    entries = write_table(docs.mapInArrow(enter, f"doc_id {id_type.simpleString()}, n_bytes long, media binary, chunks array<binary>"), "media-entries")
    often = entries.select(F.explode("chunks").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    is_shared = spark.sparkContext.broadcast(Filter.over(write_table(often, "media-often")).words)

    def pack(batches):
        """Chunks that occur once, in the rows of the media they belong to."""
        shared, press = Filter(is_shared.value), zstandard.ZstdCompressor(level=3)
        for b in batches:
            rows = []
            for t in b.column(0):
                data, _ = payload_of(t.as_py())
                parts = chunks(data)
                flags = shared([digest(c) for c in parts])
                own = [i for i, s in enumerate(flags) if not s]
                if own:
                    rows.append((digest(header(len(data)) + data), len(data), len(parts), own, [press.compress(parts[i]) for i in own]))
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary())))], ["media", "n", "n_chunks", "places", "bytes"])

    def share(batches):
        shared, press, sent = Filter(is_shared.value), zstandard.ZstdCompressor(level=3), set()
        for b in batches:
            out = []
            for t in b.column(0):
                parts = chunks(payload_of(t.as_py())[0])
                digests = [digest(c) for c in parts]
                for d, c, s in zip(digests, parts, shared(digests)):
                    if s and d not in sent:
                        out.append((d, press.compress(c)))
                        sent.add(d)
                if len(sent) > REMEMBERED:
                    sent.clear()
            yield pa.record_batch([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary())], ["digest", "bytes"])

    texts = docs.select("text")
    packs = write_table(texts.mapInArrow(pack, "media binary, n long, n_chunks int, places array<int>, bytes array<binary>"), "media-packs")
    shared = write_table(texts.mapInArrow(share, "digest binary, bytes binary").dropDuplicates(["digest"]), "media-shared")
    return {"entries": entries, "packs": packs, "shared": shared}


def features(payload: bytes) -> str:
    """What the samples are like, as JSON: their number, sum and sum of squares about the middle, extremes and zero crossings."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return json.dumps({"n": len(x), "sum": int(x.sum()), "squares": int((x * x).sum()), "low": int(x.min()), "high": int(x.max()), "crossings": int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))})


READ = "media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _read(media: bytes, parts: list[bytes]) -> tuple:
    """Decode the stored form, verify it, and describe it."""
    body = b"".join(zstandard.ZstdDecompressor().decompress(p) for p in parts)
    whole = header(len(body)) + body
    if digest(whole) != media:
        raise ValueError(f"media {media.hex()} does not match its digest")
    payload = samples(whole)
    return media, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(whole), hashlib.sha256(whole).hexdigest(), features(payload)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [c.split()[0] for c in READ.split(", ")])


def describe(stored: dict[str, DataFrame]) -> DataFrame:
    """Read every distinct media back from a store: its digests, sizes and features.

    Media whose chunks all stand in their pack are read in place. The others meet their shared chunks:
    chunk lists join the chunks on digest, and a sort by (media, place) streams each media's parts in
    order, so a task holds one media at a time.
    """
    whole = F.size("places") == F.col("n_chunks")

    def alone(batches):
        for b in batches:
            yield _rows([_read(m.as_py(), parts.as_py()) for m, parts in zip(b.column(0), b.column(1))])

    def joined(batches):
        media, parts = None, []
        for b in batches:
            out = []
            for m, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if m != media:
                    if parts:
                        out.append(_read(media, parts))
                    media, parts = m, []
                parts.append(part)
            yield _rows(out)
        if parts:
            yield _rows([_read(media, parts)])

    packs = stored["packs"]
    lists = stored["entries"].dropDuplicates(["media"]).select("media", F.posexplode("chunks").alias("place", "digest"))
    met = lists.join(stored["shared"], "digest").select("media", "place", "bytes")
    rest = packs.where(~whole).select("media", F.explode(F.arrays_zip("places", "bytes")).alias("p")).select("media", F.col("p.places").alias("place"), F.col("p.bytes").alias("bytes"))
    ordered = met.union(rest).repartition("media").sortWithinPartitions("media", "place").select("media", "bytes")
    return packs.where(whole).select("media", "bytes").mapInArrow(alone, READ).union(ordered.mapInArrow(joined, READ))


def read_media(stored: dict[str, DataFrame]) -> DataFrame:
    """A row per row of the stored table: doc_id, n_bytes and what describe() says of its media."""
    read = describe(stored)
    return stored["entries"].select("doc_id", "n_bytes", "media").join(read, "media").drop("media")


def op1_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's media stored and read back, as store and read_media state it; a text of any length is one payload."""
    return read_media(store(table(spark, sf_dir, "documents")))
