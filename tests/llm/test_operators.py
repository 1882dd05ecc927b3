"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash

from quire.llm import curriculum, language_gru, licence_scan, media_chunks, nra_topk, piece_sampling, quality_ftrl, simhash_dedup, token_counts, url_cascade

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, size long"
LONG = " ".join(f"word{i % 977} " + "x" * (i % 13) for i in range(6000))
TEXTS = [None, "", " ", "\n", "a", "a b", "A B c d e f g h", "a b c d e f g h", LONG, LONG + " end", "é😀 ▁x  y\n\nz", "123 456", "Released under the MIT License.", "x" * 5000]


def rows():
    random.seed(3)
    out = [(i, t, ["en", None, "fr"][i % 3], ["s1", None, "s2", ""][i % 4], 1, 0.5, 7, "r", 9) for i, t in enumerate(TEXTS)]
    out += [out[5], out[5], (None, "no id", None, None, None, None, None, None, None), (None, None, "en", "s1", 0, 0.0, 0, "", 0)]
    words = ["the", "of", "and", "licence", "apache", "license", "version", "2", "cc", "by", "nc", "mit", "under"]
    out += [(100 + i, " ".join(random.choice(words) for _ in range(random.randint(1, 60))), "en", "hot", 1, 0.1, 1, "q", 2) for i in range(40)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return (x is None, x or 0)


# --- media


def test_media_round_trip(spark, docs):
    found = sorted(((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"]) for r in media_chunks.read_media(media_chunks.store(docs)).collect()), key=lambda r: (key(r[0]), r[3]))
    want = []
    for d, t, *_ in rows():
        raw = (t or "").encode()
        p = raw + b"\0" * ((-len(raw)) % 64 if raw else 64)
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(p) + 44))
    assert found == sorted(want, key=lambda r: (key(r[0]), r[3]))


def test_media_chunks_are_kept_once_and_cut_by_content(spark, docs):
    stored = media_chunks.store(docs)
    digests = [bytes(d) for r in stored["shared"].collect() for d in [r["digest"]]]
    assert len(digests) == len(set(digests))
    assert len(digests) > 0
    data = random.Random(1).randbytes(60_000)
    plain, moved = media_chunks.chunks(data), media_chunks.chunks(b"some bytes in front" + data)
    assert b"".join(plain) == data
    assert len(set(plain) & set(moved)) > 0.8 * len(plain)
    assert all(media_chunks.LEAST <= len(c) <= media_chunks.MOST for c in plain[:-1])


def test_gear_is_the_rolling_hash():
    data = random.Random(2).randbytes(300)
    h, rolling = 0, []
    for b in data:
        h = ((h << 1) + int(media_chunks.GEAR[b])) % 2**32
        rolling.append(h)
    assert media_chunks.gear(data).tolist() == rolling


def test_media_empty(empty):
    assert media_chunks.read_media(media_chunks.store(empty)).count() == 0


def test_media_tampering_is_noticed():
    with pytest.raises(ValueError):
        media_chunks._read(b"x" * 32, [])


# --- language


def test_gradients_match_differences():
    net = language_gru.Network.fresh(["a", "b", "c"], 4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    codes = np.random.default_rng(1).integers(0, 256, (5, 3)).astype(np.uint8)
    mask, target = language_gru._mask(np.array([5, 3, 5]), 5), np.array([0, 1, 2])
    _, grads = net.gradients(codes, mask, target)
    for k, g in grads.items():
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        net.w[k][i] += 1e-3
        up, _ = net.gradients(codes, mask, target)
        net.w[k][i] -= 2e-3
        down, _ = net.gradients(codes, mask, target)
        net.w[k][i] += 1e-3
        assert abs((up - down) / 2e-3 - g[i]) < 0.02 * abs(g[i]) + 1e-4


def test_language_held_out(spark):
    r = random.Random(5)
    say = {"en": "the of and that with this from have".split(), "de": "der die und nicht über schön für auch".split()}
    data = [(i, " ".join(r.choice(say[x]) for _ in range(60)), x) for i in range(160) for x in [["en", "de"][i % 2]]]
    data += [(900, None, "en"), (901, "123 ...", "de"), (902, "", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    net = language_gru.train(docs)
    got = {x["doc_id"]: x["p"] for x in language_gru.identify(docs, net, "p").collect()}
    held = [i for i, _, _ in data[:160] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["lang_pred"] == ["en", "de"][i % 2] for i in held]) > 0.95
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    kept = {x["doc_id"] for x in language_gru.keep_known(docs, net).collect()}
    assert kept == set(range(160))


def test_long_text_pools_every_position():
    net = language_gru.Network.fresh(["a", "b"])
    sizes = np.array([0, 1, 255, 256, 257, 1000])
    owner, begin, own, stop, end = language_gru.stretches(sizes)
    ends = np.cumsum(sizes)
    assert [x for a, b in zip(own, stop) for x in range(a, b)] == list(range(sizes.sum()))
    for o, a, s, t, e in zip(owner, begin, own, stop, end):
        assert a == max(s - language_gru.CONTEXT, ends[o] - sizes[o]) and e == min(t + language_gru.CONTEXT, ends[o]) and s < t
    text = "abc déf " * 3000
    whole = net.label(np.frombuffer(text.encode(), np.uint8)[:, None].copy())
    assert np.abs(language_gru.pooled(net, [text, None, "", "x"])[0] - whole.mean(axis=(0, 1))).max() < 0.02
    alone = [language_gru.pooled(net, [t])[0] for t in (text, "", "x")]
    assert np.allclose(language_gru.pooled(net, [text, "", "x"]), alone, atol=1e-6)


def test_texts_in_no_learned_language_are_rejected(spark):
    r = random.Random(4)
    say = {"en": "the of and that with this from have which their about people would there could river garden".split(), "de": "der die und nicht über schön für auch werden einer durch haben zwischen wieder große Häuser".split()}
    data = [(i, " ".join(r.choice(say[x]) for _ in range(80)), x) for i in range(200) for x in [["en", "de"][i % 2]]]
    odd = ["Все люди рождаются свободными и равными в своем достоинстве", "人人生而自由在尊严和权利上一律平等", "xqzt vbnk wpqr zzkj qwxv bnmk ttrq plkj hgfd", "..! 12"]
    short = ["the river", "durch die Häuser", "that"]
    docs = spark.createDataFrame(data + [(1000 + i, t, None) for i, t in enumerate([*odd, *short, None])], "doc_id long, text string, lang string")
    net = language_gru.train(docs)
    kept = Counter(x["doc_id"] for x in language_gru.keep_known(docs.union(docs.where("doc_id = 1004")), net).collect())
    assert set(kept) == {*range(200), 1004, 1005, 1006} and kept[1004] == 2
    with pytest.raises(ValueError):
        language_gru.identify(docs.withColumn("Language", docs["lang"]), net)
    assert language_gru.identify(docs.limit(0), net).count() == 0


def test_language_without_training_rows(spark, empty):
    net = language_gru.train(empty)
    assert language_gru.judge(net, ["hello"]) == (["und"], [0.0], [1.0])


# --- mixing


def shares(sizes: dict, weights=(1, 2, 3), most=3):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, closed = {}, set()
    total = sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in closed)
        open_ = [s for s in names if s not in closed]
        weight = sum(w[s] for s in open_)
        target = {s: most * sizes[s] if s in closed else rest * w[s] / weight for s in names}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        closed |= above


def test_mix_meets_targets(spark, docs):
    got = curriculum.curriculum(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for d, t, _, s, *_ in rows():
        sizes[s] += size(t)
    target = shares(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, size(t)) for d, t, *_ in rows())
    by_target = defaultdict(int)
    for r in got:
        by_target[round(r["target"], 6)] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(p["words"] for p in r["passes"])
    want = defaultdict(int)
    for s, t in target.items():
        want[round(t, 6)] += math.floor(t + 1e-9)
    assert by_target == want
    at = [r["position"] for r in got if r["position"] is not None]
    assert at == sorted(at) and all(0 <= x <= 1 for x in at)
    assert sorted(map(str, got)) == sorted(map(str, curriculum.curriculum(docs).collect()))


def test_mix_repeats_rows_and_keeps_columns(spark, docs, empty):
    out = curriculum.mix(docs)
    assert out.columns == docs.columns
    plan = Counter()
    for r in curriculum.curriculum(docs).collect():
        plan[(r["doc_id"], r["size"])] += sum(2 * p["words"] >= r["size"] for p in r["passes"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], size(r["text"])) for r in out.collect()) == Counter({k: n for k, n in plan.items() if n})
    assert curriculum.mix(empty).count() == 0 and curriculum.curriculum(empty).count() == 0


def test_inverse_of_integrated_schedules(spark):
    for schedule in curriculum.SCHEDULES:
        pieces = curriculum.integrate(schedule)
        ys = [i / 50 for i in range(50)]
        got = spark.createDataFrame([(y,) for y in ys], "y double").select(curriculum.invert(schedule, __import__("pyspark").sql.functions.col("y")).alias("t")).collect()
        for y, r in zip(ys, got):
            t, _, w, s, before = max((p for p in pieces if p[0] <= r["t"] + 1e-12), key=lambda p: p[0])
            x = r["t"] - t
            assert abs(before + w * x + s * x * x / 2 - y) < 1e-9


# --- simhash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def group(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_classes(spark, docs):
    got = simhash_dedup.classes(docs).collect()
    prints = [(d, brute_fingerprint(t)) for d, t, *_ in rows()]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    assert Counter((r["doc_id"], r["fp"]) for r in got) == Counter((d, signed(f)) for d, f in prints)
    distinct = sorted({f for _, f in prints})
    root = group(distinct, lambda a, b: (a ^ b).bit_count() <= 3)
    first = defaultdict(lambda: None)
    for d, f in prints:
        if d is not None:
            first[root[f]] = d if first[root[f]] is None else min(d, first[root[f]])
    want = {signed(f): first[root[f]] for f in distinct}
    assert all(r["component_id"] == want[r["fp"]] for r in got)


def test_links_are_complete(spark):
    r = random.Random(9)
    values = set()
    while len(values) < 400:
        x = r.getrandbits(64)
        values.add(x)
        for _ in range(r.randint(0, 3)):
            y = x
            for b in r.sample(range(64), r.randint(1, 5)):
                y ^= 1 << b
            values.add(y)
    signed = [x - 2**64 if x >= 2**63 else x for x in values]
    got = {(p["a"], p["b"]) for p in simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    assert got == want and want


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 4000), (4000, 3000), (7, 7)]
    got = {r["node"]: r["root"] for r in simhash_dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 200))
    assert got[5000] == got[4000] == 3000


def test_keep_one(spark, docs, empty):
    out = simhash_dedup.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    want = {r["component_id"] for r in simhash_dedup.classes(docs).collect()}
    assert Counter(ids) == Counter(want)
    assert simhash_dedup.keep_one(empty).count() == 0 and simhash_dedup.classes(empty).count() == 0


# --- sentencepiece


@pytest.fixture(scope="module")
def vocabulary():
    return piece_sampling.Vocabulary.open(token_counts.model_path())


def test_samples_follow_the_distribution(vocabulary):
    n, text = 6000, "then é\nab"
    keys = np.random.default_rng(0).integers(0, 2**63, n).tolist()
    first, pairs, p, seen = Counter(), Counter(), {}, {}
    for i, rank, ids, log_p, g, inside in piece_sampling.samples([text] * n, keys, vocabulary, 3):
        k = tuple(ids.tolist())
        p[k] = math.exp(log_p)
        first[k] += rank == 1
        seen.setdefault(i, []).append((g, k))
        assert inside <= 0
    assert abs(sum(p.values()) - 1) < 1e-3
    for k, x in p.items():
        assert abs(first[k] / n - x) < 5 * math.sqrt(x / n) + 2 / n
    for got in seen.values():
        assert len({k for _, k in got}) == len(got) and [g for g, _ in got] == sorted((g for g, _ in got), reverse=True)
        pairs[got[0][1], got[1][1]] += 1
    for (a, b), x in pairs.items():
        want = p[a] * p[b] / (1 - p[a])
        assert abs(x / n - want) < 6 * math.sqrt(want / n) + 3 / n


def test_samples_decode_to_the_text(spark, docs, empty):
    out = piece_sampling.sample_pieces(docs, k=3)
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    got = piece_sampling.decode_pieces(out).collect()
    texts = defaultdict(set)
    for d, t, *_ in rows():
        texts[d].add((t or "").replace("▁", " "))
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["round_trip"] and r["decoded"] in texts[r["doc_id"]]
        assert model.decode(r["ids"]) == r["decoded"]
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(tuple(r["ids"]))
    assert len(by_id[8]) == 3
    assert sorted(map(str, out.collect())) == sorted(map(str, piece_sampling.sample_pieces(docs.repartition(2), k=3).collect()))
    assert piece_sampling.sample_pieces(empty).count() == 0


# --- urls


def brute_verdict(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h, p, v) for v, h, p in url_cascade.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, h, p, v = max(fits)
        return host, path, h + p, v
    return host, path, None, "block" if any(host == d or host.endswith("." + d) for d in listed) else "allow"


def test_urls(spark, empty):
    urls = [None, "", "no scheme", "://", "http://A.Example.NET/en/x?y", "http://x.example.net/de", "http://example.com/de/?q", "https://b.org/fr/#a", "http://net/", "http://xnet/", "http://a.net", "ftp://spam-farm.example.org/en", "http://m.casino-win.example.com?x", "http://notspam-farm.example.org/", "a://b://c/d", "http://x\n.org/fr/\ny", "http://org/fr/"] * 2
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([(d,) for d in (*url_cascade.LISTED, None, "")], "d string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_cascade.judge_urls(pages, listed).collect()}
    assert got == {i: brute_verdict(u, url_cascade.LISTED) for i, u in enumerate(urls)}
    assert url_cascade.judge_urls(pages.limit(0), listed).count() == 0
    assert url_cascade.judge_urls(pages, listed.limit(0)).where("listed").count() == 0


def test_cascade_is_exact(spark):
    f = __import__("pyspark").sql.functions
    universe = spark.range(20_000).select(f.concat(f.lit("k"), "id").alias("key"), (f.col("id") % 7 == 0).alias("listed"))
    universe = universe.select(url_cascade.hashes(f.col("key")).alias("h"), "listed").cache()
    cascade = url_cascade.build(universe)
    assert len(cascade.levels) > 2
    all_ = universe.toPandas()
    assert (cascade.contains(np.stack(all_["h"].to_numpy())) == all_["listed"].to_numpy()).all()


def test_shards_of_a_cascade_answer_alike(spark, monkeypatch):
    r = random.Random(11)
    hosts = [".".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.randint(1, 6))) for _ in range(400)] + ["x" + ".a" * 3000, "a." * 5 + "b", ""]
    listed = r.sample(hosts[:400], 25) + ["a.a.a", "A.B"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    names = spark.createDataFrame([(d,) for d in listed], "d string")
    lower = [d.lower() for d in listed]
    want = {i: any(h == d or h.endswith("." + d) for d in lower) for i, h in enumerate(hosts)}
    assert {x["page_id"]: x["listed"] for x in url_cascade.judge_urls(pages, names).collect()} == want
    monkeypatch.setattr(url_cascade, "SHARD_BITS", 200)
    assert {x["page_id"]: x["listed"] for x in url_cascade.judge_urls(pages, names).collect()} == want


# --- licences


def test_licence_places(spark, docs, empty):
    got = sorted(licence_scan.scan_files(docs).collect(), key=lambda r: (key(r["doc_id"]), r["n_words"]))
    want = []
    for d, t, *_ in rows():
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        hits = [(i, label) for label, phrase in licence_scan.PHRASES for n in [len(phrase.split())] for i in range(len(words) - n + 1) if words[i : i + n] == phrase.split()]
        want.append((d, len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))))
    want.sort(key=lambda r: (key(r[0]), r[1]))
    assert [tuple(r)[:6] for r in got] == want
    assert any(r["n_base"] for r in got)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert licence_scan.scan_files(empty).count() == 0


def test_matching_statistics():
    r = random.Random(4)
    templates = [[r.choice("abc") for _ in range(30)] for _ in range(4)]
    a = licence_scan.build((), [(str(i), " ".join(t)) for i, t in enumerate(templates)])
    text = [r.choice("abcd") for _ in range(400)]
    ids = [a.vocabulary.get(w.encode(), -1) for w in text]

    def inside(x):
        return any(x == t[i : i + len(x)] for t in templates for i in range(len(t)))

    for i, (state, length) in enumerate(licence_scan.statistics(a, ids)):
        want = max((n for n in range(i + 2) if inside(text[i + 1 - n : i + 1])), default=0)
        assert length == want
        if length:
            places = {(k, p) for k, t in enumerate(templates) for p in range(length, len(t) + 1) if t[p - length : p] == text[i + 1 - length : i + 1]}
            assert {x for x in a.places[state] if x[1] >= length} == places


def test_licence_labels_by_cover():
    a = licence_scan.build()
    gpl = licence_scan.scan(a, "Text before. This work is licensed under the GNU General Public License, version 3. After")
    assert gpl["labels"] == "gpl-3" and gpl["base_labels"] == "" and gpl["score"] == 1
    broken = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the program without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the program"
    assert licence_scan.scan(a, broken)["labels"] == "mit"
    assert licence_scan.scan(a, "the license of this file is not under any version of the law")["labels"] == ""


# --- quality


def test_quality_held_out(spark):
    r = random.Random(6)
    good, bad = "meadow river stone cloud winter garden letter".split(), "buy now!! click $$$ win ### free".split()
    data = [(i, " ".join(r.choice(good + (bad if i % 2 else [])) for _ in range(50))) for i in range(200)] + [(500, None), (501, ""), (None, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(200)] + [(None, 1, 0), (501, None, 0)], "doc_id long, quality int, toxic int")
    weights = quality_ftrl.train(docs, labels)
    got = {x["doc_id"]: x["score"] for x in quality_ftrl.scores(docs, weights).collect()}
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == (i % 2 == 0) for i in held]) > 0.95
    assert got[500] == got[501] and all(0 <= s <= 1 for s in got.values())
    assert set(quality_ftrl.keep_quality(docs, weights).columns) == {"doc_id", "text"}


def test_quality_score_is_the_dot_product():
    weights = np.random.default_rng(0).standard_normal((1 << quality_ftrl.BITS) + 1).astype(np.float32)
    for text in ["a b, c", "word !! word " * 3000, "", None]:
        ids, x = quality_ftrl.features(text)
        want = 1 / (1 + math.exp(-(float(weights[ids].astype(np.float64) @ x) + float(weights[-1]))))
        assert abs(quality_ftrl.score(text, weights) - want) < 1e-4


def test_quality_without_labels(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_ftrl.score("x", quality_ftrl.train(empty, labels)) == 0.5


# --- top-k


def test_top_k(spark):
    r = random.Random(8)
    vectors = [[r.choice([-1, 1]) * r.random() for _ in range(8)] for _ in range(300)]
    data = [(i, v, 1, 2) for i, v in enumerate(vectors)] + [(400, None, 0, 0), (401, [1.0, None] + [0.5] * 6, 0, 0), (402, [float("nan")] * 8, 0, 0), (403, [float("inf")] * 8, 0, 0), (None, vectors[0], 0, 0), (500, vectors[3], 0, 0), (501, vectors[3], 0, 0), (502, vectors[3], 0, 0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int, score int")
    ok = {i: np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64) for i, v, *_ in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in ok if i % 100 == 0):
        best = sorted(((-int(ok[q] @ ok[c]), c) for c in ok if c != q))[:10]
        want |= {(q, n, c, -s) for n, (s, c) in enumerate(best, 1)}
    assert {tuple(x) for x in nra_topk.top_k(table).collect()} == want
    assert nra_topk.top_k(table.limit(0)).count() == 0
    few = nra_topk.top_k(table.where("vec_id in (0, 5, 6)"))
    assert few.count() == 2


def test_reading_stops_early_and_stays_exact():
    r = np.random.default_rng(2)
    values = r.integers(-1000, 1000, (3000, 6))
    values[:40] *= 20
    values[100:400] = values[100]
    lists = nra_topk.Lists(np.arange(3000), values)
    queries = np.stack([values[0], values[77], np.zeros(6, np.int64), values[5] * 10**6, values[100]])
    ids = np.array([0, 77, 2, 5, 100])
    want = [sorted((-int(s), i) for i, s in enumerate(values @ q) if i != own)[:10] for own, q in zip(ids, queries)]
    got = lists.top(ids, queries, 10)
    assert [list(zip((-scores).tolist(), who.tolist())) for who, scores in got] == want
    floors = np.array([float(-w[4][0]) for w in want])
    for (who, scores), w, floor in zip(lists.top(ids, queries, 10, floors), want, floors):
        assert list(zip((-scores).tolist(), who.tolist()))[: sum(-s >= floor for s, _ in w)] == [x for x in w if -x[0] >= floor]
    for share in (0.1, 0.75):
        low, high = lists.bounds(queries.astype(float), share)
        assert (low <= queries @ values.T).all() and (high >= queries @ values.T).all()
    low, high = lists.bounds(queries.astype(float), 0.9)
    for q, weight in enumerate(queries.astype(float)):
        some = np.arange(0, 3000, 7)
        on = lists.advance(weight, some, lists.bounds(weight[None], 0.6)[0][0][some], 0.6, 0.9)
        assert np.allclose(on[0], low[q][some]) and np.allclose(on[1], high[q][some])


def test_queries_stop_by_their_bounds():
    """On vectors of 64 independent dimensions no query reads its lists to the end, and few candidates are completed."""
    r = np.random.default_rng(11)
    values = np.floor(1024 * r.standard_normal((3000, 64)) / 8).astype(np.int64)
    ids, stopped = np.arange(3000), []
    got = nra_topk.Lists(ids, values).top(ids[::100], values[::100], 10, None, stopped)
    for q, (who, scores) in zip(ids[::100], got):
        exact = values @ values[q]
        want = sorted((i for i in ids if i != q), key=lambda i: (-exact[i], i))[:10]
        assert who.tolist() == want and scores.tolist() == exact[want].tolist()
    assert max(share for share, _ in stopped) <= nra_topk.STAGES[-1] and max(n for _, n in stopped) <= nra_topk.RESOLVE * 10
    # one dimension that outweighs all others is decided by the first stage
    values[:, 0] *= 1000
    stopped.clear()
    nra_topk.Lists(ids, values).top(ids[:300:50], values[:300:50], 10, None, stopped)
    assert {share for share, _ in stopped} == {nra_topk.STAGES[0]}


def test_top_k_in_several_cells(spark, monkeypatch):
    monkeypatch.setattr(nra_topk, "BLOCK", 64)
    r = np.random.default_rng(5)
    vectors = np.floor(r.standard_normal((1000, 5)) * 64) / 1024
    vectors[300:330] = vectors[300]
    rows = [(int(i) % 997 * 10, v.tolist()) for i, v in enumerate(vectors)] + [(100, [1e300, -1e300, 1.0, 0.0, 0.0])]
    got = nra_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50)
    held = lambda x: max(-(2**63), min(2**63 - 1, x))
    whole = [(i, [held(math.floor(1024 * x)) for x in v]) for i, v in rows]
    want = []
    for q in {i for i, _ in whole if i % 50 == 0}:
        vector = min(v for i, v in whole if i == q)
        best = sorted((-held(sum(a * b for a, b in zip(vector, v))), i) for i, v in whole if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


# --- token counts


def test_token_counts(spark, docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    got = token_counts.token_counts(docs).collect()
    want = Counter((d, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t, *_ in rows())
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.token_counts(empty).count() == 0


def test_token_counts_without_head(spark, docs, monkeypatch):
    monkeypatch.setattr(token_counts, "HEAD", 5)
    monkeypatch.setattr(token_counts, "HELD", 3)
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    got = token_counts.token_counts(docs).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((d, len(model.encode(t or ""))) for d, t, *_ in rows())
