"""Phrase collocations, interval overlaps and repeats between documents against plain versions."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quire.llm import collocations, interval_overlap, registry, suffix_repeats
from tests.llm.test_operators import rows
from tests.llm.test_queries import shop, tables  # noqa: F401


# ---- phrases ----------------------------------------------------------------


def brute_phrases(docs, least=30, top=2000, contained=80):
    f, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        some = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = {s for p, a in some.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) for s in [p[i : i + k]] if 100 * a >= contained * count[s]}
        found = []
        for p, a in some.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for i, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def phrase_texts():
    r = np.random.default_rng(3)
    vocabulary = ["The", "new", "york", "City", "é́ß", "a\x00b", "\x1f", "of", "rare1", "rare2", "naïve", "　", "x" * 300]
    out = []
    for i in range(160):
        words = [vocabulary[j] for j in r.zipf(1.4, 120) % len(vocabulary)]
        marks = [(" ", "  ", "\t", ". ", ",", "\r\n", "\x0b", " ")[j] for j in r.integers(0, 8, 120)]
        out.append((("en", "fr", None)[i % 3], "".join(w + m for w, m in zip(words, marks)) + " new york city" * (i % 4)))
    return out + [("en", None), ("de", ""), ("de", " \t"), *[("en", "New York City!")] * 40, ("fr", "one two " * 5000)]


@pytest.mark.parametrize("small", [False, True])
def test_phrases(spark, monkeypatch, small):
    if small:  # many lots, many ranges
        monkeypatch.setattr(collocations, "LOT", 3000)
        monkeypatch.setattr(collocations, "RANGE", 200)
        monkeypatch.setattr(collocations, "STEP", 1)
    texts = phrase_texts()
    docs = spark.createDataFrame([(*t, "clash", 1) for t in texts], "lang string, text string, word string, id long").repartition(3)
    for top in (2000, 7):
        got = sorted(tuple(r) for r in collocations.collocations(docs, top=top).collect())
        want = brute_phrases(texts, top=top)
        assert got == want and len(want) > 10


def test_phrases_of_odd_documents(spark, tables):  # noqa: F811
    got = sorted(tuple(r) for r in registry.QUERIES["op11_collocations"](spark, tables[0]).collect())
    assert got == brute_phrases([(lang, t) for _, t, lang, *_ in rows()])


def test_radix_sort_and_counts():
    r = np.random.default_rng(0)
    keys = r.integers(0, 3, (5000, 24), np.uint8)
    keys[:, :20] = 0
    found, n = collocations.counted(keys, np.ones(5000, np.int64))
    assert dict(zip(map(bytes, found), n.tolist())) == Counter(map(bytes, keys)) and [bytes(k) for k in found] == sorted(map(bytes, found))


# ---- intervals --------------------------------------------------------------


def brute_overlaps(clicks, sales, lines):
    zero = datetime(1970, 1, 1)
    us = lambda t: (t - zero) // (datetime.resolution)
    by = defaultdict(list)
    for _, ts, _, client, kind, *_ in clicks:
        if ts is not None and client is not None:
            by[client].append((us(ts), kind == "purchase"))
    sessions = defaultdict(list)
    for client, some in by.items():
        some.sort()
        for at, bought in some:
            if sessions[client] and at - sessions[client][-1][1] <= 600_000_000:
                x = sessions[client][-1]
                x[2] = bought or (x[2] if x[1] == at else False)
                x[1] = at
            else:
                sessions[client].append([at, at, bought])
    shipped = defaultdict(list)
    for sale, _, at, *_ in lines:
        if sale is not None:
            shipped[sale].append(at)
    out, hour = {}, 3_600_000_000
    for sale, client, _, _, sold, *_ in sales:
        if client is None or sold is None:
            continue
        whole = None in shipped[sale]
        b, e = us(sold) // hour, float("inf") if whole else max(us(x) for x in [sold, *shipped[sale]]) // hour
        for first, last, bought in sessions[client]:
            sb, se = first // hour, float("inf") if bought else last // hour
            if b <= se and sb <= e:
                name = interval_overlap.RELATIONS["<=>"[(b > sb) - (b < sb) + 1], "<=>"[(e > se) - (e < se) + 1]]
                n, slots, crc = out.get((sale, name), (0, None, 0))
                both = min(e, se) == float("inf")
                out[sale, name] = n + 1, slots if both else (slots or 0) + int(min(e, se) - max(b, sb)) + 1, crc + zlib.crc32(str(first).encode())
    return Counter({(*k, *v): 1 for k, v in out.items()})


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_intervals(spark, tables, zone):  # noqa: F811
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = registry.QUERIES["op12_interval_overlap"](spark, tables[0]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = brute_overlaps(*shop())
    assert Counter(map(tuple, got)) == want and {r["relation"] for r in got} == set(interval_overlap.RELATIONS.values())


def test_hot_clients_are_salted_without_change(spark, tables):  # noqa: F811
    read = lambda n: spark.read.parquet(f"{tables[0]}/{n}.parquet")
    got = interval_overlap.overlaps(interval_overlap.sale_intervals(read("sales"), read("sale_lines")), interval_overlap.sessions(read("clicks")), classes=3)
    assert Counter(map(tuple, got.collect())) == brute_overlaps(*shop())


# ---- repeats ----------------------------------------------------------------


def brute_removed(docs, length=50):
    first = {}
    for d, t in docs:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if d is not None and d < first.get(s, d + 1):
                first[s] = d
    out = []
    for d, t in docs:
        gone = np.zeros(len(t) + length, bool)
        for i in range(len(t) - length + 1):
            if d is not None and first[t[i : i + length]] < d:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return Counter(out)


def repeating_texts():
    r = np.random.default_rng(8)
    noise = lambda n: r.integers(97, 123, n).astype(np.uint8).tobytes()
    passage, line = noise(400), noise(49)
    out = [(i, noise(int(r.integers(0, 300))) + passage[int(r.integers(0, 200)) : int(r.integers(200, 400))] + noise(60)) for i in range(60)]
    long = noise(6000)
    for i in range(60, 90):  # near copies of one document, and exact ones
        t = bytearray(long)
        for at in r.integers(0, len(long), i % 4):
            t[at] ^= 1
        out.append((i, bytes(t)))
    out += [(90, b"ab" * 900), (91, b"ab" * 300 + noise(3)), (92, b"\0" * 700), (93, noise(9) + b"\0" * 51), (94, line), (95, line), (96, line + b"!"), (97, b"x" + line), (98, b"x" + line + b"!")]
    out += [(None, long), (60, long[:500]), (60, long[:500]), (99, b""), (100, (noise(30) + b"same old sentence, ") * 70), (101, passage[:50]), (-5, passage[100:160])]
    return [out[i] for i in r.permutation(len(out))]


@pytest.mark.parametrize("lot,crowd,length", [(4 << 20, 20_000, 50), (5000, 3, 50), (700, 1, 33)])
def test_removed_repeats(spark, monkeypatch, lot, crowd, length):
    monkeypatch.setattr(suffix_repeats, "LOT", lot)
    texts = repeating_texts()
    docs = spark.createDataFrame([(d, t.decode(), 1) for d, t in texts], "doc_id long, text string, lot long").repartition(3)
    got = suffix_repeats.without_repeats(docs, length=length, crowd=crowd).collect()
    found = Counter((r["doc_id"], len(r["text"]), sum(e - s for s, e in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got)
    assert found == brute_removed(texts, length)


def test_removed_repeats_of_odd_documents(spark, tables):  # noqa: F811
    got = registry.QUERIES["op13_suffix_repeats"](spark, tables[0]).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_removed([(d, (t or "").encode()) for d, t, *_ in rows()])


@pytest.mark.parametrize("lot,crowd", [(4 << 20, 20_000), (5000, 3)])
def test_groups_hold_all_places(spark, monkeypatch, lot, crowd):
    monkeypatch.setattr(suffix_repeats, "LOT", lot)
    texts = [(d, t) for d, t in repeating_texts() if d is not None and d not in range(64, 90)]
    docs = spark.createDataFrame([(d, t.decode()) for d, t in texts], "doc_id long, text string").repartition(3)
    found = defaultdict(set)
    for r in suffix_repeats.repeat_groups(docs, crowd=crowd).collect():
        found[r["repeat"], r["length"]].add((r["doc_id"], r["start"]))
    by = defaultdict(list)
    for d, t in texts:
        by[d].append(t)
    covered = defaultdict(set)
    for (_, n), places in found.items():
        some = {t[s : s + n] for d, s in places for t in by[d] if len(t) >= s + n and hashlib.blake2b(t[s : s + n], digest_size=16).digest() == _}
        assert len(some) == 1
        text = some.pop()
        every = {(d, i) for d, t in texts for i in range(len(t) - n + 1) if t[i : i + n] == text}
        assert places == every and len({d for d, _ in places}) > 1
        for d, s in places:
            if d > min(places)[0]:
                covered[d].update(range(s, s + n))
    once = {d: t for d, t in texts if len(by[d]) == 1}
    want = {(x[0], x[2]) for x in brute_removed(texts)}
    assert {(d, len(covered[d])) for d in once} <= want


def test_intervals_of_a_suffix_array():
    """Every maximal repeat of a text over two documents, by trying all strings."""
    r = np.random.default_rng(4)
    for _ in range(40):
        parts = [r.integers(97, 99, int(n)).astype(np.uint8) for n in r.integers(1, 25, 3)]
        body = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        text = np.repeat(np.arange(3), [len(p) for p in parts])
        begin = np.arange(len(body))
        order, common = suffix_repeats.suffix_array(body, begin, ends[text])
        left = np.where(np.isin(begin, [0, *ends]), 256, np.concatenate([[0], body[:-1]]).astype(np.int64))
        first, last, size, _ = suffix_repeats.intervals(common, left[order], text[order], 2, 1000)
        got = {(bytes(body[order[a] : order[a] + n]), tuple(sorted(order[a : b + 1].tolist()))) for a, b, n in zip(first.tolist(), last.tolist(), size.tolist())}
        places = defaultdict(list)
        for i in begin.tolist():
            for j in range(i + 2, int(ends[text[i]]) + 1):
                places[bytes(body[i:j])].append(i)
        follows = lambda s, at: {(int(body[i + len(s)]) if i + len(s) < ends[text[i]] else 1000 + i) for i in at}
        want = {(s, tuple(at)) for s, at in places.items() if len({int(text[i]) for i in at}) > 1 and len(follows(s, at)) > 1 and (len({int(left[i]) for i in at}) > 1 or any(left[i] == 256 for i in at))}
        assert got == want


def traced(work):
    """What work() gives, and the bytes that it held at most."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_lot_takes_a_few_times_its_bytes():
    body = np.random.default_rng(1).integers(97, 123, 4 << 20).astype(np.uint8).tobytes()
    ends = np.arange(4096, len(body) + 1, 4096)
    of = [pa.array([x], pa.list_(pa.int64()))[0] for x in (np.arange(len(ends)), ends)]

    def cut():
        lot = suffix_repeats.Lot(*of, pa.scalar(body, pa.binary()), 50)
        begins = lot.unit_begins()
        return lot, sum(len(at) for at, _ in lot.anchors(begins, lot.ids[lot.text[begins]]))

    (lot, windows), peak = traced(cut)
    assert windows == len(ends) * (4096 - 49) and lot.inside(50).sum() == windows
    # 7 times here; with arrays of eight bytes for every byte of the lot it is 43 times
    assert peak < 16 * len(body)


def test_hashes_by_blocks_are_those_of_the_bytes(monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BLOCK", 64)
    body = np.frombuffer(b"some bytes that come again, and " * 20, np.uint8)
    h = suffix_repeats.hashes(body, 50, np.arange(len(body) - 49))
    assert len(set(h.tolist())) == 32 and (h[:-32] == h[32:]).all()
    assert (suffix_repeats.hashes(body, 50, np.array([3, 63, 64, 200])) == h[[3, 63, 64, 200]]).all()
    assert len(suffix_repeats.hashes(body[:49], 50, np.zeros(0, np.int64))) == 0


def test_blocks_change_no_anchor_and_no_repeat(monkeypatch):
    texts = [t for _, t in repeating_texts()]
    ends = np.cumsum([len(t) for t in texts])
    of = [pa.array([x], pa.list_(pa.int64()))[0] for x in (np.arange(len(ends)), ends)]
    lot = suffix_repeats.Lot(*of, pa.scalar(b"".join(texts), pa.binary()), 50)
    strings = [t[i : i + 176] for t in texts for i in range(0, len(t) - 49, 64)]
    asked = pa.table({"strings": pa.array([strings], pa.list_(pa.binary())), "least": pa.array([np.arange(len(strings))], pa.list_(pa.int64()))})

    def all_of():
        begins = lot.unit_begins()
        at, h = (np.concatenate(x) for x in zip(*lot.anchors(begins, lot.ids[lot.text[begins]])))
        found = suffix_repeats._groups(asked, 50, False)
        every = suffix_repeats._groups(asked, 50, True)
        return begins.tolist(), at.tolist(), h.tolist(), sorted(zip(*(x.tolist() for x in found[:4]))), sorted(zip(*(x.tolist() for x in every[:4]), every[4]))

    whole = all_of()
    monkeypatch.setattr(suffix_repeats, "BLOCK", 512)
    assert all_of() == whole and len(whole[3]) > 100 and len(whole[4]) > len(whole[3])


def test_nested_repeats_keep_one_answer_a_place():
    """Many strings that have beginnings of one passage, each of another length: a place is in an interval for every shorter one."""
    rng = np.random.default_rng(2)
    passage = rng.integers(97, 123, 113).astype(np.uint8).tobytes()
    more, ids = np.arange(6000) % 63, rng.permutation(6000)
    # the byte after the passage's differs among strings that have as much of it
    texts = [passage[: 50 + m] + bytes([128 + i // 63]) + rng.integers(1, 30, 112 - m).astype(np.uint8).tobytes() for i, m in enumerate(more.tolist())]
    asked = pa.table({"strings": pa.array([texts], pa.list_(pa.binary())), "least": pa.array([ids], pa.list_(pa.int64()))})
    (string, offset, size, *_), peak = traced(lambda: suffix_repeats._groups(asked, 50, False))
    reach = np.zeros(6000, np.int64)
    np.maximum.at(reach, string, offset + size)
    assert offset.max() == 0
    longest, want = -1, np.zeros(6000, np.int64)
    for i in np.argsort(ids).tolist():
        want[i] = 50 + min(more[i], longest) if longest >= 0 else 0
        longest = max(longest, more[i])
    assert (reach == want).all()
    # 41 MB here; with a row for each pair of place and interval it is 137
    assert peak < 80e6


def test_few_lots_are_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "LOT", 1 << 20)
    suffix_repeats.small_batches(spark, suffix_repeats.BATCH_BYTES)
    docs = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(uuid(), 29000)").alias("text"))
    stored = suffix_repeats.lots(docs, "doc_id", "text")
    files = [pq.ParquetFile(x.removeprefix("file:")).metadata for x in stored.inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == 40 and max(groups) <= suffix_repeats.GROUP_LOTS
    held = stored.coalesce(1).mapInArrow(lambda batches: (pa.record_batch([pa.array([len(b)], pa.int64())], ["n"]) for b in batches), "n long").collect()
    assert sum(r["n"] for r in held) == 40 and max(r["n"] for r in held) <= 10
