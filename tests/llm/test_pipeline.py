"""The pipeline's stages, one after the other, against plain versions of what each decides."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from quire.llm import curriculum, language_gru, piece_sampling, quality_ftrl, token_counts
from quire.llm._shared import write_table
from tests.llm.test_operators import brute_fingerprint, group, shares

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, DATA), f"test-{name}")
        out[name] = docs
    return {k: (v, [r.asDict() for r in v.collect()]) for k, v in out.items()}


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_columns(results):
    assert all(results[n][0].columns == COLUMNS for n, _ in corpus_pipeline.STAGES[:-1])


def test_language_stage(results):
    df, rows = results["documents"]
    net = language_gru.train(df.select("doc_id", "text", "lang"))
    names, _, none = language_gru.judge(net, [r["text"] for r in rows])
    want = Counter(r["doc_id"] for r, n, x in zip(rows, names, none) if n != "und" and x <= 0.5)
    assert ids(results["language_id"][1]) == want


def test_quality_stage(spark, results):
    df, rows = results["language_id"]
    weights = quality_ftrl.train(df, spark.read.parquet(f"{DATA}/labels.parquet"))
    want = Counter(r["doc_id"] for r in rows if quality_ftrl.score(r["text"], weights) >= corpus_pipeline.QUALITY_AT_LEAST)
    assert ids(results["quality"][1]) == want and len(want) < len(rows)


def test_near_duplicate_stage(results):
    rows = results["quality"][1]
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    root = group(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for d, f in prints.items():
        first[root[f]] = min(d, first.get(root[f], d))
    assert ids(results["near_duplicates"][1]) == Counter(first.values())


def test_mixing_stage(results):
    rows = results["near_duplicates"][1]
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows}
    sizes: Counter = Counter()
    for r in rows:
        sizes[r["source"]] += size[r["doc_id"]]
    target = shares(sizes)
    got: Counter = Counter()
    for r in results["mix_sources"][1]:
        got[r["source"]] += size[r["doc_id"]]
    longest = max(size.values())
    assert all(abs(got[s] - t) <= longest for s, t in target.items())
    assert max(ids(results["mix_sources"][1]).values()) <= curriculum.MOST_PASSES


def test_piece_stage(results):
    rows = results["mix_sources"][1]
    texts = {r["doc_id"]: r["text"] for r in rows}
    v = piece_sampling.Vocabulary.open(token_counts.model_path())
    got = results["sentencepiece"][1]
    assert ids(got) == Counter({d: n * piece_sampling.K for d, n in ids(rows).items()})
    import numpy as np

    assert all(v.decode(np.array(r["ids"])) == texts[r["doc_id"]] for r in got)


def test_run_is_the_stages(spark, results):
    got = Counter((r["doc_id"], r["rank"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, DATA).collect())
    assert got == Counter((r["doc_id"], r["rank"], tuple(r["ids"])) for r in results["sentencepiece"][1])
