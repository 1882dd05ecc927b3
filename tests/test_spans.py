"""Span operators against per-character painting and plain loops."""

import random

from pyspark.sql import functions as F

from quire.operators import spans as S


def test_line_table_counts_code_points(spark):
    rows = spark.createDataFrame([(1, "ab\n😀c\n\nd"), (2, ""), (3, None), (4, "x\r\ny")], "k int, t string")
    got = {(r["k"], r["line_no"]): (r["char_start"], r["char_end"], r["line"]) for r in S.line_table(rows, "k", "t").collect()}
    assert got == {(1, 0): (0, 2, "ab"), (1, 1): (3, 5, "😀c"), (1, 2): (6, 6, ""), (1, 3): (7, 8, "d"), (2, 0): (0, 0, ""), (4, 0): (0, 2, "x\r"), (4, 1): (3, 4, "y")}


def test_overlay_is_painting(spark):
    r = random.Random(1)
    spans = [(b, r.randint(0, 40), i % 7, i, r.choice("abc")) for b in range(6) for i in range(25)]
    spans = [(b, s, s + r.randint(0, 12), layer, i, lab) for b, s, layer, i, lab in spans]
    want = set()
    for b in range(6):
        paint = {}
        for _, s, e, layer, i, lab in sorted((x for x in spans if x[0] == b), key=lambda x: (x[3], x[4])):
            for p in range(s, e):
                paint[p] = lab
        start = None
        for p in range(0, 60):
            if paint.get(p) != paint.get(p - 1):
                if start is not None:
                    want.add((b, paint[p - 1], start, p))
                start = p if p in paint else None
    got = {tuple(x) for x in S.overlay(spark.createDataFrame(spans, "b int, s int, e int, layer int, i int, lab string"), ["b"], "s", "e", ["layer", "i"], "lab").select("b", "lab", "char_start", "char_end").collect()}
    assert got == want


def test_coverage(spark):
    rows = spark.createDataFrame([(1, 0, 5), (1, 3, 8), (1, 10, 10), (1, 10, 12), (2, 4, 4), (3, 1, 2), (3, 1, 2)], "b int, s int, e int")
    got = {r["b"]: (r["covered"], r["overlapped"], r["deepest"]) for r in S.coverage(rows, ["b"], "s", "e").collect()}
    assert got == {1: (10, 2, 2), 3: (1, 1, 2)}


def test_nested(spark):
    r = random.Random(2)
    rows = [(b, i, r.randint(1, 4)) for b in range(5) for i in range(30)]
    got = {(x["b"], x["i"]): (x["section_end"], x["parent"]) for x in S.nested(spark.createDataFrame(rows, "b int, i int, lv int"), ["b"], "i", "lv", 4).collect()}
    for b, i, lv in rows:
        mine = [x for x in rows if x[0] == b]
        assert got[b, i] == (min((x[1] for x in mine if x[1] > i and x[2] <= lv), default=None), max((x[1] for x in mine if x[1] < i and x[2] < lv), default=None))


def test_clamp_and_interpolation(spark):
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate([5, 3, 4, 20, 9])], "b int, i int, v int")
    assert [r["c"] for r in S.clamp_rising(rows, ["b"], "i", "v", "c").orderBy("i").collect()] == [5, 6, 7, 20, 21]
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, 10, None, None, 20, None])], "b int, i int, v int")
    assert [r["f"] for r in S.interpolated(rows, ["b"], "i", "v", "f").orderBy("i").collect()] == [None, 10, 13, 16, 20, None]


def test_ordered_statistics(spark):
    for values in ([3, 1, 2], [4, 1, 3, 2], list(range(10)), [7]):
        row = spark.createDataFrame([(v,) for v in values], "v int").agg(S.upper_median(F.col("v")).alias("m"), S.quarter_steps(F.col("v")).alias("q")).first()
        ordered, step = sorted(values), len(values) // 4
        assert row["m"] == ordered[len(values) // 2]
        assert row["q"] == (ordered[step::step][:3] if step else [])


def test_containing_matches_a_loop(spark):
    r = random.Random(3)
    points = [(b, r.randint(0, 900)) for b in range(3) for _ in range(60)]
    spans = [(b, i, s, s + r.randint(0, 300)) for b in range(3) for i in range(20) for s in [r.randint(0, 900)]]
    got = sorted((x["b"], x["p"], x["i"]) for x in S.containing(spark.createDataFrame(points, "b int, p int"), spark.createDataFrame(spans, "b int, i int, s int, e int"), ["b"], "p", "s", "e", 128).collect())
    assert got == sorted((b, p, i) for b, p in points for b2, i, s, e in spans if b == b2 and s <= p < e)


def test_runs_treat_nulls_as_equal(spark):
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate([None, None, "a", "a", None, "b"])], "b int, i int, x string")
    got = [(r["x"], r["n"]) for r in S.runs(rows, ["b"], ["i"], "x", [F.count("*").alias("n")]).orderBy("run").collect()]
    assert got == [(None, 2), ("a", 2), (None, 1), ("b", 1)]


def test_extents_nth_and_ids(spark):
    rows = spark.createDataFrame([(1, 5), (1, 9), (1, 2)], "b int, s int")
    assert [r["end"] for r in S.extents(rows, ["b"], "s", "s", F.lit(100)).orderBy("s").collect()] == [5, 9, 100]
    assert S.nth(rows, ["b"], ["s"], -1).first()["s"] == 9 and S.nth(rows, ["b"], ["s"], 2).first()["s"] == 5
    assert [r["u"] for r in S.numbered(rows, ["b"], ["s"], "unit_%03d", "u").orderBy("s").collect()] == ["unit_001", "unit_002", "unit_003"]
