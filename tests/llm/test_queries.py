"""Every query of the folder on small tables with nulls, empty and long texts, ties, repeated rows, empty tables and further columns whose names clash; and the pipeline's stages."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from quire.llm import language_gru, licence_scan, piece_sampling, quality_ftrl, registry, simhash_dedup, token_counts, url_cascade
from tests.llm.test_operators import brute_fingerprint, brute_verdict, group, key, rows, shares

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, size long"
LABELS = "doc_id long, quality int, toxic int, label string, hash long"
PAGES = "page_id long, url string, html string, host string, verdict string"
VECTORS = "vec_id long, embedding array<float>, label int, rank int, score long"
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, hour long, first long, open boolean"
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, begin long, salt int, relation string"
LINES = "sale_id long, line_no int, shipped_at timestamp_ntz, open boolean, client_id long"
URLS = [None, "", "no scheme", "://", "http://A.Example.NET/en/x?y", "http://x.example.net/de", "https://b.org/fr/#a", "http://m.casino-win.example.com?x", "http://org/fr/", "http://net", "http://a..b.net/"]


def vectors():
    r = np.random.default_rng(6)
    out = [(i, [float(x) for x in np.float32(r.standard_normal(6))], 0, 1, 2) for i in range(260)]
    out += [(300, None, 0, 0, 0), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, 0, 0), (302, [float("nan")] * 6, 0, 0, 0), (None, out[0][1], 0, 0, 0), (500, out[3][1], 0, 0, 0), (501, out[3][1], 0, 0, 0)]
    return out


def shop():
    """Clicks, sales and lines of a hot client, some others and none; with ties, repeated rows, gaps of just ten minutes, and times before 1970."""
    r = np.random.default_rng(12)
    at = lambda s: datetime(2024, 1, 30) + timedelta(microseconds=int(s * 1e6))
    clicks = [(i, at(r.integers(0, 200) * 600 + i % 2 * 0.000001), None, int(c), ("view", "purchase", None)[i % 3], 0.0, "{}", 1, 2, True) for i, c in enumerate(r.choice([7, 7, 7, 1, 2, 3], 400))]
    clicks += [*clicks[:9], (900, None, None, 7, "purchase", 0.0, "{}", 0, 0, False), (901, at(5), None, None, "view", 0.0, "{}", 0, 0, False), (902, datetime(1969, 12, 31, 23, 59, 1), None, 5, "view", 0.0, "{}", 0, 0, False)]
    sales = [(i, int(c), "done", 1.0, at(r.integers(0, 150_000)), 1, 1, "clash") for i, c in enumerate(r.choice([7, 7, 1, 2, 4], 150))]
    sales += [(200, None, "x", 1.0, at(5), 0, 0, ""), (201, 7, "x", 1.0, None, 0, 0, ""), (None, 7, "x", 1.0, at(9), 0, 0, ""), (203, 5, "x", 1.0, datetime(1969, 12, 31, 22), 0, 0, "")]
    lines = [(int(i), 1, None if r.random() < 0.1 else at(r.integers(0, 400_000)), True, 1) for i in r.choice(150, 300)]
    return clicks, sales, [*lines, *lines[:5], (None, 1, at(9_000_000), True, 7), (203, 1, datetime(1970, 1, 1, 0, 30), False, 0)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of odd tables and one of empty ones."""
    odd, none = str(tmp_path_factory.mktemp("odd")), str(tmp_path_factory.mktemp("none"))
    labels = [(i, i % 2, 0, "x", 1) for i in (*range(14), *range(100, 140))] + [(None, 1, 0, "x", 1), (3, None, 0, "x", 1), (5, 1, 0, "x", 1)]
    data = {"documents": (rows(), DOCUMENTS), "labels": (labels, LABELS), "pages": ([(i % 13, u, "h", "clash", "clash") for i, u in enumerate(URLS * 2)], PAGES), "embeddings": (vectors(), VECTORS)}
    data |= {name: (some, schema) for name, some, schema in zip(("clicks", "sales", "sale_lines"), shop(), (CLICKS, SALES, LINES))}
    for name, (some, schema) in data.items():
        spark.createDataFrame(some, schema).repartition(3).write.parquet(f"{odd}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{none}/{name}.parquet")
    return odd, none


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, tables, name):
    assert registry.QUERIES[name](spark, tables[1]).count() == 0


def plain(found, columns):
    return sorted(tuple("~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in (r[columns.index(c)] for c in sorted(columns))) for r in found)


@pytest.mark.parametrize("name", ["op3_mix_sources", "op6_url_filter"])
def test_queries_equal_their_sql(spark, tables, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables[0]}/{t}.parquet/*.parquet')")
    want = c.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    df = registry.QUERIES[name](spark, tables[0])
    assert sorted(columns) == sorted(df.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), columns)


def text_of(t):
    return (t or "").encode()


def test_media(spark, tables):
    want = Counter()
    for d, t, *_ in rows():
        p = text_of(t) + b"\0" * ((-len(text_of(t))) % 64 if text_of(t) else 64)
        want[d, len(text_of(t)), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(p) + 44] += 1
    got = registry.QUERIES["op1_media_chunks"](spark, tables[0]).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"]) for r in got) == want
    same = defaultdict(set)
    for r in got:
        same[r["payload_sha256"]].add((r["media_sha256"], r["feature"]))
    assert all(len(x) == 1 for x in same.values())


def test_language(spark, tables):
    got = registry.QUERIES["op2_language_id"](spark, tables[0]).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in rows())
    letters = {(d, bool(t and language_gru.LETTER.search(t))) for d, t, *_ in rows()}
    for r in got:
        assert r["held_out"] == (None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in ("en", "fr", "und") and 0 <= r["score"] <= 1
        assert (r["doc_id"], r["lang_pred"] != "und") in letters


def test_simhash(spark, tables):
    prints = [(d, brute_fingerprint(t)) for d, t, *_ in rows()]
    root = group(sorted({f for _, f in prints}), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for d, f in prints:
        if d is not None:
            first[root[f]] = min(d, first.get(root[f], d))
    got = registry.QUERIES["op4_simhash_dedup"](spark, tables[0]).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter((d, f"{f:016x}", first.get(root[f])) for d, f in prints)


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "CROWD", 5)
    r = np.random.default_rng(1)
    values = {int(x) << 32 | int(y) for x in (0, 0xDEADBEEF) for y in r.integers(0, 1 << 12, 120)} | {int(y) << 32 | 77 for y in r.integers(0, 1 << 10, 60)}
    signed = [x - 2**64 if x >= 2**63 else x for x in values]
    got = {(p["a"], p["b"]) for p in simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3} and len(got) > 100


def test_sampled_pieces(spark, tables):
    v = piece_sampling.Vocabulary.open(token_counts.model_path())
    texts = defaultdict(set)
    for d, t, *_ in rows():
        texts[d].add((t or "").replace("▁", " "))
    got = registry.QUERIES["op5_sentencepiece"](spark, tables[0]).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["round_trip"] and v.decode(np.array(r["ids"], np.int64)) in texts[r["doc_id"]] and r["n_pieces"] == len(r["ids"])


def test_many_samples_of_one_word(spark):
    """More samples than there are near sets: every segmentation of a short word comes, in order of its perturbed log-probability."""
    v = piece_sampling.Vocabulary.open(token_counts.model_path())
    for far in (-100.0, 5.0):  # with 5 no set is near at first
        before, piece_sampling.NEAR = piece_sampling.NEAR, far
        try:
            got = [(tuple(ids.tolist()), log_p, g, inside) for _, _, ids, log_p, g, inside in piece_sampling.samples(["then"], [9], v, 60)]
        finally:
            piece_sampling.NEAR = before
        assert len({x[0] for x in got}) == len(got) and abs(sum(math.exp(x[1]) for x in got) - 1) < 1e-9
        assert [x[2] for x in got] == sorted((x[2] for x in got), reverse=True) and all(x[3] == 0.0 for x in got)


def test_inclusion_scores_against_the_threshold():
    for log_p, limit in ((-3.0, -2.0), (-50.0, 1.0), (-0.1, -9.0), (-1.0, -math.inf)):
        want = 0.0 if limit == -math.inf else math.log(-math.expm1(-math.exp(log_p - limit)))
        assert abs(piece_sampling.inclusion(log_p, limit) - want) < 1e-9


def test_urls(spark, tables):
    got = registry.QUERIES["op6_url_filter"](spark, tables[0]).collect()
    want = Counter((i % 13, *brute_verdict(u, url_cascade.LISTED)) for i, u in enumerate(URLS * 2))
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want


def test_licences(spark, tables):
    a = licence_scan.build()
    want = Counter()
    for d, t, *_ in rows():
        x = licence_scan.scan(a, t)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        hits = [i for _, phrase in licence_scan.PHRASES for n in [len(phrase.split())] for i in range(len(words) - n + 1) if words[i : i + n] == phrase.split()]
        want[d, len(words), len(hits), min(hits, default=None), max(hits, default=None), x["labels"], x["score"]] += 1
    got = registry.QUERIES["op7_licence_scan"](spark, tables[0]).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"], r["score"]) for r in got) == want


def plain_ftrl(texts, labels):
    """Follow-the-regularised-leader with dictionaries, coordinate by coordinate."""
    z, n, share = defaultdict(float), defaultdict(float), [max(1, labels.count(0)), max(1, labels.count(1))]

    def weight(i):
        if abs(z[i]) <= quality_ftrl.L1:
            return 0.0
        return -(z[i] - math.copysign(quality_ftrl.L1, z[i])) / ((quality_ftrl.BETA + math.sqrt(n[i])) / quality_ftrl.ALPHA + quality_ftrl.L2)

    for _ in range(quality_ftrl.EPOCHS):
        for t, y in zip(texts, labels):
            ids, values = quality_ftrl.features(t)
            x = [*zip(ids.tolist(), values.tolist()), (1 << quality_ftrl.BITS, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - y) * v * len(labels) / (2 * share[y])
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality_ftrl.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_training_is_ftrl():
    texts = ["a b c", "d e f g", "", None, "a b !!", "the same the same the same"]
    labels = [1, 0, 1, 0, 1, 0]
    got = quality_ftrl.fit(texts, labels)
    want = plain_ftrl(texts, labels)
    assert all(abs(got[i] - w) < 1e-5 for i, w in want.items()) and np.count_nonzero(got) == sum(w != 0 for w in want.values())


def test_quality(spark, tables):
    docs, labels = (spark.read.parquet(f"{tables[0]}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality_ftrl.train(docs, labels)
    got = registry.QUERIES["op8_quality"](spark, tables[0]).collect()
    want = Counter((d, round(quality_ftrl.score(t, weights), 6)) for d, t, *_ in rows())
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in got) == want
    assert all(r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert quality_ftrl.scores(docs.limit(0), weights, "other").count() == 0
    with pytest.raises(ValueError):
        quality_ftrl.scores(docs, weights, "Score")


def test_top_k(spark, tables):
    sound = {i: np.floor(1024 * np.float32(v).astype(np.float64)).astype(np.int64) for i, v, *_ in vectors() if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in sound if i % 100 == 0):
        best = sorted((-int(sound[q] @ sound[c]), c) for c in sound if c != q)[:10]
        want += [(q, n, c, -s) for n, (s, c) in enumerate(best, 1)]
    assert sorted(map(tuple, registry.QUERIES["op9_topk"](spark, tables[0]).collect())) == sorted(want)


def test_tokens(spark, tables):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    want = Counter((d, len(text_of(t)), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t, *_ in rows())
    assert Counter(map(tuple, registry.QUERIES["op10_token_counts"](spark, tables[0]).collect())) == want


# --- the pipeline's stages


def test_stages_on_odd_tables(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    columns, at = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, tables[0])
        assert at.columns == columns, name
        found = at.collect()
        assert {r["doc_id"] for r in found} <= {d for d, *_ in rows()}, name
        at = spark.createDataFrame(found, DOCUMENTS)
    assert corpus_pipeline.run(spark, tables[0]).count() == 2 * len(found) - sum(1 for r in found if not r["text"])
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables[1]).count() == 0, name


def test_each_stage_decides_by_its_rule(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    net = language_gru.train(docs.select("doc_id", "text", "lang"))
    names, _, none = language_gru.judge(net, [t for _, t, *_ in rows()])
    want = Counter(d for (d, *_), n, x in zip(rows(), names, none) if n != "und" and x <= 0.5)
    assert Counter(r["doc_id"] for r in stages["language_id"](spark, docs, tables[0]).collect()) == want
    weights = quality_ftrl.train(docs, spark.read.parquet(f"{tables[0]}/labels.parquet"))
    want = Counter(d for d, t, *_ in rows() if quality_ftrl.score(t, weights) >= 0.5)
    assert Counter(r["doc_id"] for r in stages["quality"](spark, docs, tables[0]).collect()) == want
    kept = stages["near_duplicates"](spark, docs, tables[0]).collect()
    root = group(sorted({brute_fingerprint(t) for _, t, *_ in rows()}), lambda a, b: (a ^ b).bit_count() <= 3)
    assert Counter(root[brute_fingerprint(r["text"])] for r in kept) == Counter(set(root.values()))
    sizes = defaultdict(int)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for _, t, _, s, *_ in rows():
        sizes[s] += size(t)
    got = defaultdict(int)
    for r in stages["mix_sources"](spark, docs, tables[0]).collect():
        got[r["source"]] += size(r["text"])
    longest = max(size(t) for _, t, *_ in rows())
    assert all(abs(got[s] - target) <= longest / 2 + 1 for s, target in shares(sizes).items())
    assert key(None) > key(5)
