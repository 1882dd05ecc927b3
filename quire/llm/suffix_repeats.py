"""Repeats between documents by sparse enhanced suffix arrays; what an earlier document has is removed.

Texts lie as bytes in lots (a table). A place is known by the window of `length` bytes that begins there.

1. Lots are cut into units where a rolling hash says so; a unit reaches length - 1 bytes into the next, so each window
   lies in one unit. Equal units meet by digest and belong to the document of the smallest id that has one. In all
   others the whole unit is a repeat, so copies and near copies leave little to do.
2. The windows that are left are known by the least hash of the GRAM-grams in them. Hashes are counted over all lots, and
   windows whose hash one document has alone are left out: they cannot repeat.
3. Windows in a row with one hash are a string. Each lot sends a string once, with the smallest id that has it there,
   to the bucket of its hash. Where very many documents share a hash, each window goes by itself to the bucket of its
   own bytes, so no bucket grows with a common passage.
   A string has a bounded number of windows: only a text that repeats itself has more in a row, and is cut, each part with what follows.
4. A bucket builds the suffix array of its strings, for suffixes of length bytes or more, with the common prefixes of
   neighbours. A scan with a stack gives the tree of common-prefix intervals. An interval whose suffixes have
   different bytes on their left is a maximal repeat in its bucket. At a string's first place any left side counts as different,
   since the window before is in another bucket; a repeat that is longer than a string is a chain of groups that overlap.
5. Groups go back to the lots of their strings, and each lot expands them to all their places.

A lot, a bucket of strings and a bucket of hashes are bounded; no document but the one at hand is ever whole in memory with its
group, and nothing but counts reaches the driver. What is computed for every byte is computed for BLOCK bytes at a time, what is computed
for every window of a bucket for some BLOCK windows at a time, and tables of lots are read and handed to Python a few lots at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._shared import small_batches, table, write_table
from quire.sources import scratch

LENGTH, GRAM = 50, 24
#: Bytes of one lot about; a unit begins where this many low bits of the hash are zero.
LOT, CUT_BITS = 4 << 20, 8
#: Places that are hashed, and windows that are sorted, at a time.
BLOCK = 1 << 17
#: Lots in one row group, and bytes in one Arrow batch beyond which no further lot joins it: a reader holds a row group's texts at once, and a row of some megabytes is no row for Spark's own bounds.
GROUP_LOTS, BATCH_BYTES = 4, 8 << 20
#: Windows that begin in one string, and windows beyond its first that any suffix holds; documents that share a hash beyond which its windows go by themselves.
STRING, CROWD = 64, 20_000
#: A left side that differs from any other.
ANY = 256
_LOTS = "lot long, ids array<long>, ends array<long>, body binary"
_SENT = "bucket int, lot long, a array<long>, b array<long>, v array<long>"
_BACK = "lot long, a array<long>, b array<long>, v array<long>"

_RNG = np.random.default_rng(50)
_BYTES = _RNG.integers(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BACKWARD = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base to the power 0, 1, ... n - 1, modulo 2**64."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        _powers[str(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def _hashed(body: np.ndarray, width: int) -> np.ndarray:
    """A hash of each width bytes in a row; equal bytes, equal hashes. For a block: it takes 40 bytes for each of body."""
    n = len(body)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[body] * _power(_STEP, n), out=sums[1:])
    h = (sums[width:] - sums[:-width]) * _power(_BACKWARD, n - width + 1)
    h ^= h >> np.uint64(32)
    h *= _ODD
    h ^= h >> np.uint64(29)
    return h


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    """From and to of the blocks of n places."""
    return ((i, min(i + BLOCK, n)) for i in range(0, n, BLOCK))


def hashes(body: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """A hash of the width bytes that begin at each of the places, which ascend; equal bytes, equal hashes."""
    out = np.empty(len(at), np.uint64)
    for i, j in _blocks(len(body) - width + 1):
        low, high = np.searchsorted(at, (i, j))
        if low < high:
            out[low:high] = _hashed(body[i : j + width - 1], width)[at[low:high] - i]
    return out


class Lot:
    """Texts of one lot, one after the other."""

    def __init__(self, ids: pa.Scalar, ends: pa.Scalar, body: pa.Scalar, length: int):
        self.ids = ids.values.to_numpy(zero_copy_only=False)
        self.known = ids.values.is_valid().to_numpy(zero_copy_only=False)
        self.ids = np.where(self.known, self.ids, 0).astype(np.int64)
        self.ends = ends.values.to_numpy().astype(np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.body = np.frombuffer(body.as_buffer(), np.uint8)
        self.length = length
        self.text = np.repeat(np.arange(len(self.ends), dtype=np.int32), self.ends - self.begins)

    def inside(self, width: int) -> np.ndarray:
        """Whether width bytes from each place stay in its text."""
        fits = np.ones(len(self.body), bool)
        last = np.minimum(self.ends - self.begins, width - 1)
        fits[np.repeat(self.ends - np.cumsum(last), last) + np.arange(last.sum())] = False
        return fits

    def unit_begins(self) -> np.ndarray:
        """Places where units begin: those of texts that are not empty, and those that the bytes choose."""
        cut = np.zeros(len(self.body), bool)
        for i, j in _blocks(len(self.body) - GRAM + 1):
            cut[i:j] = _hashed(self.body[i : j + GRAM - 1], GRAM) & np.uint64((1 << CUT_BITS) - 1) == 0
        cut[1:] &= ~cut[:-1]
        cut &= self.inside(GRAM)
        cut[self.begins[self.ends > self.begins]] = True
        return np.flatnonzero(cut)

    def unit_ends(self, begins: np.ndarray) -> np.ndarray:
        """How far the windows of each unit reach."""
        return np.minimum(np.concatenate([begins[1:], [len(self.body)]]) + self.length - 1, self.ends[self.text[begins]])

    def anchors(self, begins: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the windows of units that belong to their own document, and the least hash in each, block by block."""
        mine = (firsts == self.ids[self.text[begins]]) & self.known[self.text[begins]]
        own = np.repeat(mine, np.diff(np.concatenate([begins, [len(self.body)]]))) & self.inside(self.length)
        many = self.length - GRAM + 1
        for i, j in _blocks(len(self.body) - self.length + 1):
            at = np.flatnonzero(own[i:j])
            if not len(at):
                continue
            least, reach = _hashed(self.body[i : j + self.length - 1], GRAM), 1
            while reach * 2 <= many:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            if reach < many:
                least = np.minimum(least[: len(least) - (many - reach)], least[many - reach :])
            yield at + i, least[at]


def lots(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts as bytes, several in a row of about LOT bytes; a longer text has its own."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def row():
            ends = np.cumsum([len(t) for t in texts])
            return pa.record_batch([pa.array([first + n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())], ["lot", "ids", "ends", "body"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if texts and size + len(text) > LOT:
                    yield row()
                    ids, texts, size, n = [], [], 0, n + 1
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield row()

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"))
    return write_table(rows.mapInArrow(packed, _LOTS), "repeat-lots", GROUP_LOTS)


def _longs(values) -> pa.Array:
    return pa.array([np.asarray(values, np.int64)], pa.list_(pa.int64()))


def _sent(lot: int, bucket: np.ndarray, a: np.ndarray, b: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket that gets anything."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    offsets = pa.array(np.concatenate([at, [len(bucket)]]).astype(np.int32))
    if len(at):
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order].astype(np.int64))) for x in (a, b, v)]
        yield pa.record_batch([pa.array(bucket[at], pa.int32()), pa.array(np.full(len(at), lot), pa.int64()), *lists], ["bucket", "lot", "a", "b", "v"])


def _met(sums: bool) -> Callable[[pa.Table], pa.Table]:
    """What a bucket answers to each lot: the keys (a, b) that it shares with others, with the sum of v, or those with a v below the lot's, with the least."""

    def answer(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        lists = [t[c].chunk(0) for c in ("a", "b", "v")]
        a, b, v = (x.flatten().to_numpy() for x in lists)
        row = np.repeat(np.arange(len(t)), np.diff(lists[0].offsets.to_numpy()))
        order = np.lexsort((b, a))
        a, b, v, row = a[order], b[order], v[order], row[order]
        begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        many = np.diff(np.concatenate([begin, [len(a)]]))
        all_ = np.repeat((np.add if sums else np.minimum).reduceat(v, begin), many)
        keep = all_ > 1 if sums else all_ < v
        keep = np.flatnonzero(keep)
        keep = keep[np.argsort(row[keep], kind="stable")]
        bounds = pa.array(np.searchsorted(row[keep], np.arange(len(t) + 1)).astype(np.int32))
        return pa.table([t["lot"], *(pa.ListArray.from_arrays(bounds, pa.array(x[keep])) for x in (a, b, all_))], ["lot", "a", "b", "v"])

    return answer


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Least hashes are small, so they are mixed again."""
    return (((h.astype(np.uint64) * _STEP) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _answers(sent: DataFrame, sums: bool) -> DataFrame:
    """(lot, a, b, v): all that buckets answer, one row a lot."""
    back = sent.groupBy("bucket").applyInArrow(_met(sums), _BACK)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("a", "b", "v")]
    return back.where(F.size("a") > 0).groupBy("lot").agg(*lists)


def units(stored: DataFrame, buckets: int, length: int, collapse: bool) -> DataFrame:
    """(lot, begins, firsts): where the units of a lot begin, and the smallest id of a document with an equal unit.

    Without collapse every unit belongs to its own document.
    """

    def cut(batches):
        for b in batches:
            for lot_id, ids, ends, body in zip(*(b.column(c) for c in ("lot", "ids", "ends", "body"))):
                lot = Lot(ids, ends, body, length)
                begins = lot.unit_begins()
                to = lot.unit_ends(begins)
                raw = memoryview(lot.body)
                digest = b"".join(hashlib.blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(begins.tolist(), to.tolist()))
                a, d = np.frombuffer(digest, np.int64).reshape(-1, 2).T
                yield pa.record_batch([pa.array([lot_id.as_py()], pa.int64()), pa.array([begins], pa.list_(pa.int32())), _longs(lot.ids[lot.text[begins]]), pa.array([(to - begins >= length) & lot.known[lot.text[begins]]], pa.list_(pa.bool_())), _longs(a), _longs(d)], ["lot", "begins", "ids", "full", "a", "b"])

    def own(batches):
        for b in batches:
            for lot, begins, ids, full, a, d in zip(*(b.column(c) for c in ("lot", "begins", "ids", "full", "a", "b"))):
                a, d, ids, full = (x.values.to_numpy(zero_copy_only=False) for x in (a, d, ids, full))
                a, d, ids = a[full], d[full], ids[full]
                order = np.lexsort((ids, d, a))
                a, d, ids = a[order], d[order], ids[order]
                first = np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])]) if len(a) else np.zeros(0, bool)
                yield from _sent(lot.as_py(), _bucket(a[first], buckets), a[first], d[first], ids[first])

    def firsts(batches):
        for b in batches:
            for lot, begins, ids, full, a, d, ka, kb, kv in zip(*(b.column(c) for c in ("lot", "begins", "ids", "full", "a", "b", "ka", "kb", "kv"))):
                a, d, ids, full = (x.values.to_numpy(zero_copy_only=False) for x in (a, d, ids, full))
                more = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int64) for x in (ka, kb, kv)]
                every = [np.concatenate([x[full], y]) for x, y in zip((a, d, ids), more)]
                order = np.lexsort(every[::-1])
                sa, sd, sv = (x[order] for x in every)
                out = ids.copy()
                if len(sa):
                    begin = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sd[1:] != sd[:-1])])
                    least = sv[np.flatnonzero(begin)][np.cumsum(begin) - 1]
                    place = np.empty(len(order), np.int64)
                    place[order] = np.arange(len(order))
                    out[full] = least[place[: int(full.sum())]]
                yield pa.record_batch([pa.array([lot.as_py()], pa.int64()), pa.array([begins.values], pa.list_(pa.int32())), _longs(out)], ["lot", "begins", "firsts"])

    found = write_table(stored.mapInArrow(cut, "lot long, begins array<int>, ids array<long>, full array<boolean>, a array<long>, b array<long>"), "repeat-units", 8 * GROUP_LOTS)
    if not collapse:
        return found.select("lot", "begins", F.col("ids").alias("firsts"))
    back = _answers(found.mapInArrow(own, _SENT), False).select("lot", F.col("a").alias("ka"), F.col("b").alias("kb"), F.col("v").alias("kv"))
    return write_table(found.join(back, "lot", "left").mapInArrow(firsts, "lot long, begins array<int>, firsts array<long>"), "repeat-owners", 8 * GROUP_LOTS)


def shared_anchors(owned: DataFrame, buckets: int, length: int) -> DataFrame:
    """(lot, a, b, v): the hashes of each lot's own windows that several documents have, with the number of these."""

    def sent(batches):
        for b in batches:
            for lot_id, lot, begins, firsts in _opened(b, length):
                changes = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                for at, h in lot.anchors(begins, firsts):
                    new = np.concatenate([[True], (h[1:] != h[:-1]) | (lot.text[at[1:]] != lot.text[at[:-1]])])
                    changes.append((h[new].view(np.int64), lot.ids[lot.text[at[new]]]))
                h, ids = (np.concatenate(x) for x in zip(*changes))
                order = np.lexsort((ids, h))
                h, ids = h[order], ids[order]
                fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])]) if len(h) else np.zeros(0, bool)
                h = h[fresh]
                begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                many = np.diff(np.concatenate([begin, [len(h)]]))
                yield from _sent(lot_id, _bucket(h[begin], buckets), h[begin], np.zeros(len(begin), np.int64), many)

    return _answers(owned.mapInArrow(sent, _SENT), True)


def _opened(b: pa.RecordBatch, length: int):
    for lot_id, ids, ends, body, begins, firsts in zip(*(b.column(c) for c in ("lot", "ids", "ends", "body", "begins", "firsts"))):
        yield lot_id.as_py(), Lot(ids, ends, body, length), begins.values.to_numpy().astype(np.int64), firsts.values.to_numpy()


def strings(owned: DataFrame, anchors: DataFrame, buckets: int, length: int, crowd: int, every: bool) -> DataFrame:
    """Per bucket and lot the lot's strings, each once with the smallest id that has it; and per lot (bucket null) all places of its strings.

    With every, a string that several documents of the lot have is there again, with the largest id and a number below zero, so that they make a group.
    """

    def cut(batches):
        for b in batches:
            for (lot_id, lot, begins, firsts), a, v in zip(_opened(b, length), b.column("a"), b.column("v")):
                keys, many = a.values.to_numpy().view(np.uint64), v.values.to_numpy()
                order = np.argsort(keys)
                keys, many = keys[order], many[order]
                met = []
                for at, h in lot.anchors(begins, firsts):
                    place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    shared = keys[place] == h
                    met.append((at[shared].astype(np.int32), h[shared], (many[place] > crowd)[shared]))
                at, h, alone = (np.concatenate(x) for x in zip(*met)) if met else ((), (), ())
                del met
                if not len(at):
                    continue
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (at[1:] != at[:-1] + 1)]) | alone
                run = np.flatnonzero(new).astype(np.int32)[np.cumsum(new, dtype=np.int32) - 1]
                new |= (np.arange(len(at), dtype=np.int32) - run) % STRING == 0
                begin = np.flatnonzero(new)
                from_ = at[begin].astype(np.int64)
                last = np.searchsorted(run[begin], run[begin], side="right")
                to = np.minimum(at[np.concatenate([begin, [len(at)]])[last] - 1], from_ + 2 * (STRING - 1)) + length
                raw = lot.body.tobytes()
                known: dict[bytes, int] = {}
                entry = np.array([known.setdefault(raw[i:j], len(known)) for i, j in zip(from_.tolist(), to.tolist())], np.int64)
                ids = lot.ids[lot.text[from_]]
                least = np.full(len(known), np.iinfo(np.int64).max)
                np.minimum.at(least, entry, ids)
                one = np.zeros(len(known), np.int64)
                one[entry[::-1]] = np.arange(len(entry))[::-1]
                mixed, apart = h[begin], alone[begin]
                mixed[apart] = hashes(lot.body, length, from_[apart])
                mixed = mixed[one]
                bucket, number, who = _bucket(mixed, buckets), np.arange(len(known)), least
                if every:
                    most = np.full(len(known), np.iinfo(np.int64).min)
                    np.maximum.at(most, entry, ids)
                    more = np.flatnonzero(most > least)
                    bucket, number, who = np.concatenate([bucket, bucket[more]]), np.concatenate([number, -1 - more]), np.concatenate([least, most[more]])
                order = np.argsort(bucket, kind="stable")
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
                offsets = pa.array(cuts.astype(np.int32))
                texts = list(known)
                rows = len(cuts) - 1
                yield pa.record_batch(
                    [pa.array(bucket[order][cuts[:-1]], pa.int32()), pa.array(np.full(rows, lot_id), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array([texts[i if i >= 0 else -1 - i] for i in number[order].tolist()], pa.binary())),
                     pa.ListArray.from_arrays(offsets, pa.array(who[order])), pa.ListArray.from_arrays(offsets, pa.array(number[order].astype(np.int32))), pa.nulls(rows, pa.list_(pa.int32())), pa.nulls(rows, pa.list_(pa.int32()))],
                    names,
                )
                yield pa.record_batch([pa.nulls(1, pa.int32()), pa.array([lot_id], pa.int64()), pa.nulls(1, pa.list_(pa.binary())), _longs(least), pa.array([entry], pa.list_(pa.int32())), pa.array([from_], pa.list_(pa.int32())), pa.array([to], pa.list_(pa.int32()))], names)

    names = ["bucket", "lot", "strings", "least", "entry", "begin", "end"]
    found = owned.join(anchors.select("lot", "a", "v"), "lot").mapInArrow(cut, "bucket int, lot long, strings array<binary>, least array<long>, entry array<int>, begin array<int>, end array<int>")
    return write_table(found, "repeat-strings", buckets)


def suffix_array(body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes body[begin:end], and the length of the common prefix of each with the one before (0 for the first)."""
    size = end - begin
    most = int(size.max(initial=1))
    fits = begin + most <= len(body)
    rows = np.zeros((len(begin), most), np.uint8)
    if fits.any():
        rows[fits] = np.lib.stride_tricks.sliding_window_view(body, most)[begin[fits]]
    for k in np.flatnonzero(~fits).tolist():
        rows[k, : size[k]] = body[begin[k] : end[k]]
    rows[np.arange(most) >= size[:, None]] = 0
    order = np.argsort(size, kind="stable")
    order = order[np.argsort(rows[order].view(f"S{most}").ravel(), kind="stable")]
    rows, size = rows[order], size[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    return order, np.concatenate([[0], np.minimum(np.minimum(size[1:], size[:-1]), common)])


def intervals(common: np.ndarray, left: np.ndarray, ids: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of least bytes or more as (first, last, length, smallest id) over an enhanced suffix array.

    One scan with a stack: an interval is open as long as neighbours have its prefix in common. It is a repeat that
    cannot be longer on the left if its suffixes' left sides are not all one byte, or if it has the longest length.
    """
    out: list[tuple[int, int, int, int]] = []
    stack: list[list] = []  # depth, first, left side, smallest id, largest id
    before = (int(left[0]), int(ids[0])) if len(left) else None
    for i, depth in enumerate([*common[1:].tolist(), 0], 1):
        depth = depth if depth >= least else 0
        first, side, low, high = i - 1, before[0], before[1], before[1]
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            side = side if side == top[2] != ANY else ANY
            low, high, first = min(low, top[3]), max(high, top[4]), top[1]
            if (side == ANY or top[0] == longest) and low < high:
                out.append((first, i - 1, top[0], low))
        if depth:
            if stack and stack[-1][0] == depth:
                top = stack[-1]
                top[2] = side if side == top[2] != ANY else ANY
                top[3], top[4] = min(low, top[3]), max(high, top[4])
            else:
                stack.append([depth, first, side, low, high])
        if i < len(left):
            before = (int(left[i]), int(ids[i]))
    found = np.array(out, np.int64).reshape(-1, 4)
    return found[:, 0], found[:, 1], found[:, 2], found[:, 3]


def _groups(t: pa.Table, length: int, every: bool) -> tuple[np.ndarray, ...]:
    """Of one bucket's strings: (row of the string, offset, length, smallest id, digest) of each place of each maximal repeat.

    Without every, only places in documents after the smallest, and of these one per reach.
    """
    texts = t["strings"].combine_chunks().flatten().to_pylist()
    ids = t["least"].combine_chunks().flatten().to_numpy()
    if every:
        return _repeats(texts, ids, length, True)
    # equal strings of several lots are one, with the smallest id; in lots with greater ones the whole string goes
    known: dict[bytes, int] = {}
    one = np.array([known.setdefault(x, len(known)) for x in texts], np.int64)
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, one, ids)
    first = np.flatnonzero(ids == least[one])
    late = np.flatnonzero(ids > least[one])
    string, offset, size, small, _ = _repeats(list(known), least, length, False)
    place, answer = _expanded(one[first], string)
    whole = np.fromiter((len(texts[i]) for i in late.tolist()), np.int64, len(late))
    return np.concatenate([first[place], late]), np.concatenate([offset[answer], np.zeros(len(late), np.int64)]), np.concatenate([size[answer], whole]), np.concatenate([small[answer], least[one[late]]]), []


def _repeats(texts: list[bytes], ids: np.ndarray, length: int, every: bool) -> tuple[np.ndarray, ...]:
    """What _groups gives, of strings that all count.

    Windows with one hash are in one part; a repeat's places all have the same first window, so each part has its repeats whole.
    """
    raw = b"".join(texts)
    body = np.frombuffer(raw, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    windows = np.minimum(sizes - length + 1, STRING)
    string = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
    begin = np.arange(len(string)) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
    h = hashes(body, length, begin)
    parts = len(h) // BLOCK + 1
    part = ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    empty = np.zeros(0, np.int64)
    found = [(empty, empty, empty, empty)]
    digest: list = []
    for p in range(parts):
        some = order[bounds[p] : bounds[p + 1]]
        *places, more = _repeats_of(raw, body, starts, sizes, ids, string[some], begin[some], h[some], length, every)
        found.append(tuple(places))
        digest += more
    string, offset, size, small = (np.concatenate(x) for x in zip(*found))
    if not every:
        reach = offset + size
        order = np.lexsort((-reach, offset, string))
        base = string[order] * (1 << 20)
        far = np.maximum.accumulate(base + reach[order])
        fresh = np.concatenate([[True], far[1:] > np.maximum(far[:-1], base[1:])]) if len(far) else np.zeros(0, bool)
        string, offset, size, small = (x[order[fresh]] for x in (string, offset, size, small))
    return string, offset, size, small, digest


def _repeats_of(raw: bytes, body: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, string: np.ndarray, begin: np.ndarray, h: np.ndarray, length: int, every: bool) -> tuple[np.ndarray, ...]:
    """Of the windows of one part, by their strings, places and hashes: the places of the maximal repeats that begin with them."""
    order = np.argsort(h, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
    many = np.diff(np.concatenate([start, [len(h)]]))
    some = np.sort(order[np.repeat(many > 1, many)])
    empty = np.zeros(0, np.int64)
    if not len(some):
        return empty, empty, empty, empty, []
    begin, string = begin[some], string[some].astype(np.int64)
    end = np.minimum((starts + sizes)[string], begin + length + STRING - 1)
    order, common = suffix_array(body, begin, end)
    begin, string = begin[order], string[order]
    offset = begin - starts[string]
    left = np.where(offset > 0, body[begin - 1].astype(np.int64), ANY)
    # an interval whose neighbours all have one length in common is a tree of one node; the others are scanned
    bound = np.concatenate([np.flatnonzero(common < length), [len(common)]])
    a, b = bound[:-1], bound[1:]
    inner = common.copy()
    inner[a] = np.iinfo(np.int64).max
    low = np.minimum.reduceat(inner, a)
    inner[a] = 0
    high = np.maximum.reduceat(inner, a)
    who = ids[string]
    least, most = np.minimum.reduceat(who, a), np.maximum.reduceat(who, a)
    same = (np.minimum.reduceat(left, a) == np.maximum.reduceat(left, a)) & (left[a] != ANY)
    longest = length + STRING - 1
    real = (b - a > 1) & (least < most) & (~same | (high == longest))
    plain = real & (low == high)
    nodes = [np.stack([a[plain], b[plain] - 1, low[plain], least[plain]])]
    mixed = np.flatnonzero(real & ~plain)
    if len(mixed):
        at = np.concatenate([np.arange(a[k], b[k]) for k in mixed.tolist()])
        first, last, deep, small = intervals(common[at], left[at], who[at], length, longest)
        nodes.append(np.stack([at[first], at[last], deep, small]))
    first, last, deep, small = np.concatenate(nodes, axis=1)
    if not every:
        member, node = _deepest(first, last, small, who, int(plain.sum()))
        return string[member], offset[member], deep[node], small[node], []
    many = last - first + 1
    node = np.repeat(np.arange(len(first)), many)
    member = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many) + first[node]
    digest = [hashlib.blake2b(raw[i : i + n], digest_size=16).digest() for i, n in zip(begin[first].tolist(), deep.tolist())]
    return string[member], offset[member], deep[node], small[node], [digest[k] for k in node.tolist()]


def _deepest(first: np.ndarray, last: np.ndarray, small: np.ndarray, who: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that are in an interval with an id smaller than theirs, and of each the longest such.

    The first intervals, as many as apart, overlap no other; of the others each comes before what holds it. A suffix may lie in an
    interval for each of its lengths, so one number a suffix is kept, and not one for each pair.
    """
    best = np.full(len(who), -1, np.int64)
    many = last[:apart] - first[:apart] + 1
    node = np.repeat(np.arange(apart), many)
    member = np.arange(len(node)) - np.repeat(np.cumsum(many) - many - first[:apart], many)
    later = who[member] > small[node]
    best[member[later]] = node[later]
    for k in range(len(first) - 1, apart - 1, -1):
        held = slice(first[k], last[k] + 1)
        best[held][who[held] > small[k]] = k
    member = np.flatnonzero(best >= 0)
    return member, best[member]


_FOUND = "lot long, entry array<int>, offset array<int>, size array<int>, id array<binary>"


def groups(sent: DataFrame, length: int, every: bool) -> DataFrame:
    """(lot, entry, offset, size, id): the maximal repeats of every bucket, for each lot the places in its strings."""

    def scan(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        string, offset, size, _, digest = _groups(t, length, every)
        entry = t["entry"].chunk(0).flatten().to_numpy()
        real = np.flatnonzero(entry[string] >= 0)
        string, offset, size, digest = string[real], offset[real], size[real], [digest[i] for i in real.tolist()] if every else digest
        offsets = t["entry"].chunk(0).offsets.to_numpy()
        row = np.searchsorted(offsets, string, side="right") - 1
        order = np.argsort(row, kind="stable")
        bounds = pa.array(np.searchsorted(row[order], np.arange(len(t) + 1)).astype(np.int32))
        entry = entry[string[order]]
        lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (entry, offset[order], size[order])]
        ids = pa.ListArray.from_arrays(bounds, pa.array([digest[i] for i in order.tolist()], pa.binary())) if every else pa.nulls(len(t), pa.list_(pa.binary()))
        return pa.table([t["lot"], *lists, ids], ["lot", "entry", "offset", "size", "id"])

    asked = sent.where("bucket is not null").select("bucket", "lot", "strings", "least", "entry")
    found = asked.groupBy("bucket").applyInArrow(scan, _FOUND).where(F.size("entry") > 0)
    return found.groupBy("lot").agg(*(F.flatten(F.collect_list(F.coalesce(c, F.array()))).alias(c) for c in ("entry", "offset", "size", "id")))


def _expanded(entry: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, answer) of equal entries."""
    order = np.argsort(entry, kind="stable")
    low, high = np.searchsorted(entry[order], asked), np.searchsorted(entry[order], asked, side="right")
    many = high - low
    answer = np.repeat(np.arange(len(asked)), many)
    return order[np.arange(len(answer)) - np.repeat(np.cumsum(many) - many, many) + low[answer]], answer


def _prepared(docs: DataFrame, length: int, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    small_batches(docs.sparkSession, BATCH_BYTES)
    stored = lots(docs, id_column, text_column)
    total = stored.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    return stored, max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // LOT)


def repeat_groups(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(repeat, length, doc_id, start): groups of repeats between documents with all their places, as byte offsets.

    repeat is the digest of the repeated bytes. Each group is a maximal repeat of its bucket (see above), so
    one that is longer than a string comes as a chain of groups that overlap. Repeats within one document alone are no
    group. Null ids take no part; null texts are empty. Documents that repeat an id are one. An empty table gives an empty one.
    """
    stored, buckets = _prepared(docs, length, id_column, text_column)
    owned = stored.join(units(stored, buckets, length, False), "lot")
    sent = strings(owned, shared_anchors(owned, buckets, length), buckets, length, crowd, True)
    found = groups(sent, length, True)

    def placed(batches):
        for b in batches:
            for ids, ends, own, begin, entry, offset, size, digest in zip(*(b.column(c) for c in ("ids", "ends", "own", "begin", "entry", "offset", "size", "id"))):
                own, begin, entry, offset, size = (x.values.to_numpy().astype(np.int64) for x in (own, begin, entry, offset, size))
                place, answer = _expanded(own, entry)
                start = begin[place] + offset[answer]
                ends = ends.values.to_numpy()
                text = np.searchsorted(ends, start, side="right")
                yield pa.record_batch([digest.values.take(pa.array(answer)), pa.array(size[answer], pa.int32()), ids.values.take(pa.array(text)), pa.array(start - np.concatenate([[0], ends[:-1]])[text])], ["repeat", "length", "doc_id", "start"])

    own = sent.where("bucket is null").select("lot", F.col("entry").alias("own"), "begin")
    met = stored.select("lot", "ids", "ends").join(own, "lot").join(found, "lot")
    return met.mapInArrow(placed, "repeat binary, length int, doc_id long, start long")


def without_repeats(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text, kept, removed): every text as bytes, what is left of it, and the (start, end) runs that were removed.

    A byte goes if a string of length bytes over it also begins in a document with a smaller id, judged on the input.
    One row per row of docs. Null texts are empty. A null id takes no part: nothing of its text goes, and nothing goes because of it.
    Rows that repeat an id are judged each against smaller ids only. Texts shorter than length stay. Other columns are
    left out. An empty table gives an empty one.
    """
    stored, buckets = _prepared(docs, length, id_column, text_column)
    owners = units(stored, buckets, length, True)
    owned = stored.join(owners, "lot")
    sent = strings(owned, shared_anchors(owned, buckets, length), buckets, length, crowd, False)
    found = groups(sent, length, False).drop("id")

    def judged(batches):
        for b in batches:
            for (_, lot, begins, firsts), own, begin, end, least, entry, offset, size in zip(_opened(b, length), *(b.column(c) for c in ("own", "begin", "end", "least", "entry", "offset", "size"))):
                later = (firsts < lot.ids[lot.text[begins]]) & lot.known[lot.text[begins]]
                from_, to = [begins[later]], [lot.unit_ends(begins)[later]]
                if own.is_valid:
                    own, begin, end, least = (x.values.to_numpy().astype(np.int64) for x in (own, begin, end, least))
                    first = least[own] == lot.ids[lot.text[begin]]
                    from_.append(begin[~first])
                    to.append(end[~first])
                    if entry.is_valid:
                        entry, offset, size = (x.values.to_numpy().astype(np.int64) for x in (entry, offset, size))
                        own, begin = own[first], begin[first]
                        place, answer = _expanded(own, entry)
                        from_.append(begin[place] + offset[answer])
                        to.append(begin[place] + offset[answer] + size[answer])
                n = len(lot.body)
                steps = np.zeros(n + 1, np.int32)
                np.add.at(steps, np.concatenate(from_), 1)
                np.subtract.at(steps, np.concatenate(to), 1)
                gone = np.cumsum(steps[:n], dtype=np.int32) > 0
                edge = np.diff(np.concatenate([[False], gone]).astype(np.int8))
                edge[lot.begins[lot.ends > lot.begins]] = gone[lot.begins[lot.ends > lot.begins]]
                starts = np.flatnonzero(edge == 1)
                stop = np.concatenate([[False], gone[:-1] & ~gone[1:], [True]])
                stop[lot.ends] = True
                stops = np.flatnonzero(stop)
                stops = stops[np.searchsorted(stops, starts, side="right")]
                raw = lot.body.tobytes()
                rows = np.searchsorted(starts, np.concatenate([lot.begins, [n]]))
                whole, left, removed = [], [], []
                for i in range(len(lot.ends)):
                    x, y = int(lot.begins[i]), int(lot.ends[i])
                    some = slice(int(rows[i]), int(np.searchsorted(starts, y)))
                    runs = [{"start": int(s) - x, "end": int(e) - x} for s, e in zip(starts[some], stops[some])] if y > x else []
                    whole.append(raw[x:y])
                    left.append(lot.body[x:y][~gone[x:y]].tobytes() if runs else raw[x:y])
                    removed.append(runs)
                yield pa.record_batch([pa.array(lot.ids, pa.int64(), mask=~lot.known), pa.array(whole, pa.binary()), pa.array(left, pa.binary()), pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "text", "kept", "removed"])

    own = sent.where("bucket is null").select("lot", F.col("entry").alias("own"), "begin", "end", "least")
    met = owned.join(own, "lot", "left").join(found, "lot", "left")
    return met.mapInArrow(judged, "doc_id long, text binary, kept binary, removed array<struct<start: long, end: long>>")


def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without what earlier documents have, as counts and a digest."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
