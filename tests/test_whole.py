"""Registered queries answer for whole tables and whole texts: brute force over small tables of our own."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import spans
from quire.plans import catalog


@pytest.fixture
def run(spark, tmp_path):
    def answer(name: str, **tables):
        for table, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
        return catalog.QUERIES[name](spark, str(tmp_path))

    return answer


ITEMS = [(0, "one two three four five six seven"), (1, "two  two\nthree late lat\xa0er x y z"), (2, " lead none0 none1 none2"), (3, "Zzzz"), (4, None)]
TEXTS = ["six seven five", "two threes", "", None, "lat\xa0er late xyz", "one two three four five", "twothree late", "Q\x1cx y\tz seven", "none0none1none2 lead", "ONE TWO THREE", "six seven five four"]


def test_term_share_reads_every_text_and_term(run):
    docs = [(i, t) for i, t in enumerate(TEXTS, 1)]
    want = {}
    for k, item in ITEMS:
        if item is not None:
            terms = re.split(r"[ \t\n\x0b\f\r]+", item)
            shares = [sum(x in t for x in terms) / len(terms) for _, t in docs if t is not None]
            want[k] = (sum(s >= 0.5 for s in shares), max(shares))
    got = run("term_share", documents=(docs, "doc_id long, text string"), benchmark=(ITEMS, "item_id long, text string"))
    assert {r["item_id"]: (r["n_docs"], r["best"]) for r in got.collect()} == want
    assert want[0] == (2, 5 / 7)


def test_line_similarity_reads_whole_texts_of_every_turn(run):
    r = random.Random(5)
    line = lambda n: "".join(r.choice("abcdeABé \n-") for _ in range(n))
    items = [(i, line(r.randint(20, 400))) for i in range(12)] + [(12, "a"), (13, None), (14, ""), (-1, "zz")]
    items.append((20, items[3][1]))
    turns = [(c, t, line(r.randint(0, 500))) for c in range(6) for t in range(4)] + [(7, 0, None), (7, 1, ""), (7, 2, "é"), (7, 3, "Qq"), (7, 4, "x" * 130 + "ZZ"), (7, 4, items[3][1]), (None, 0, "ab")]

    def pairs(text):
        return Counter(p for i in range(len(text or "") - 1) if re.fullmatch("[a-z]{2}", p := text.lower()[i : i + 2]))

    want = []
    for c, t, text in turns:
        mine, met = pairs(text), []
        for k, other in items:
            if n := (mine & pairs(other)).total():
                met.append((-n / mine.total(), -n / pairs(other).total(), k, n))
        if met:
            score, cover, k, n = min(met)
            want.append((c, t, k, n, -score, -cover))
    got = run("line_similarity_top", conversations=(turns, "conv_id long, turn long, text string"), benchmark=(items, "item_id long, text string"))
    assert got.columns == ["conv_id", "turn", "item_id", "common", "score", "cover"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert (7, 4, -1, 1, 1 / 131, 1.0) in want


EVENTS = "event_id long, user_id long, event_type string, value double"


def events(seed):
    r = random.Random(seed)
    return [(i, r.randint(0, 3), r.choice(["purchase", "click", "view"]), float(r.randint(0, 500))) for i in sorted(r.sample(range(2000), 160))]


def test_span_overlaps_takes_every_span(run):
    rows = events(6)
    got = run("span_overlaps", events=(rows, EVENTS))
    asked = [(u, i, i, i + 3 * int(value)) for i, u, _, value in rows]
    hosts = [(u, i, i, i + 400) for i, u, kind, _ in rows if kind == "purchase"]
    want = [(u, i, h, max(s, hs), min(e, he), hs <= s and e <= he) for u, i, s, e in asked for v, h, hs, he in hosts if u == v and max(s, hs) < min(e, he)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {x[1] % 5 for x in want} == set(range(5))


def test_overlay_labels_paints_every_event(run):
    rows, paint = events(7), {}
    for i, u, label, _ in sorted(rows, key=lambda x: (x[3], x[0])):
        paint |= {(u, p): label for p in range(i, i + 150)}
    edges = sorted(k for k in paint if paint.get((k[0], k[1] - 1)) != paint[k])
    ends = sorted((u, p + 1) for u, p in paint if paint.get((u, p + 1)) != paint[u, p])
    want = [(u, paint[u, a], a, b) for (u, a), (_, b) in zip(edges, ends, strict=True)]
    got = run("overlay_labels", events=(rows, EVENTS)).select("user_id", "label", "char_start", "char_end")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_every_page_has_its_place(run):
    r = random.Random(8)
    pages = [(i, f"http://{r.choice('abc')}.example/{r.randint(0, 99)}{r.choice(['', '?page=2'])}") for i in range(700)] + [(700, "http://none.example/"), (701, None)]
    r.shuffle(pages)
    ordered = sorted(pages, key=lambda x: (x[1] is None, x[1] or "", x[0]))
    want = [(i, None if url is None else "".join(re.findall("[0-9]+", url)[:1]), place) for place, (i, url) in enumerate(ordered, 1)]
    got = run("first_pages_by_name", pages=(pages, "page_id long, url string"))
    assert dict(got.dtypes)["place"] == "int"
    assert sorted(map(tuple, got.collect()), key=lambda x: x[2]) == want
    empty = spans.placed(got.where("false"), [F.col("page_id")], "nth")
    assert empty.columns[-1] == "nth" and empty.count() == 0
