"""Trees by doubling paths, sections at any depth, and one-to-one matching in turn."""

import random

from pyspark.sql import functions as F

from quire.operators import constraints, matching, spans


def test_trees(spark):
    chain = [("c", i, i - 1 if i else None) for i in range(300)]
    odd = [("o", 1, None), ("o", 2, 1), ("o", 3, 9), ("o", 4, 3), ("o", 5, 6), ("o", 6, 5), ("o", 7, 6), ("o", 8, 8), ("o", None, 1)]
    rows = spark.createDataFrame(chain + odd, "book string, id long, parent long")
    got = {(r["book"], r["id"]): (r["root"], r["depth"]) for r in spans.trees(rows, ["book"], "id", "parent").collect()}
    assert all(got["c", i] == (0, i) for i in range(300)) and len(got) == 308
    assert {k[1]: v for k, v in got.items() if k[0] == "o"} == {1: (1, 0), 2: (1, 1), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None)}
    roots = spark.createDataFrame([("c", 5), ("o", 1)], "book string, id long")
    lost = {(r["book"], r["id"]) for r in constraints.unreachable(rows.where("book = 'o' or id < 3"), roots, ["book"], "id", "parent").collect()}
    assert lost == {("c", 0), ("c", 1), ("c", 2), *(("o", i) for i in range(3, 9))}
    assert spans.trees(rows.limit(0), ["book"], "id", "parent").count() == 0


def test_sections_at_any_depth(spark):
    r = random.Random(5)
    rows = [(b, i, r.choice([None, *range(60)])) for b in "ab" for i in range(120)]
    want = {}
    for b, i, level in rows:
        own = [x for x in rows if x[0] == b and x[2] is not None]
        if level is not None:
            after = [x[1] for x in own if x[1] > i and x[2] <= level]
            before = [x[1] for x in own if x[1] < i and x[2] < level]
            want[b, i] = (min(after, default=None), max(before, default=None))
        else:
            want[b, i] = (None, None)
    frame = spark.createDataFrame(rows, "b string, at int, level int")
    for windows in (16, 100):
        found = spans.nested(frame, ["b"], "at", "level", windows)
        assert {(x["b"], x["at"]): (x["section_end"], x["parent"]) for x in found.collect()} == want
    assert spans.nested(frame.limit(0), ["b"], "at", "level").count() == 0


def in_turn(pairs):
    """Everyone in order takes the cheapest that is free."""
    out, used = [], set()
    for key, asks in sorted({(k, a) for k, a, _, _ in pairs}):
        free = [(cost, g) for k, a, g, cost in pairs if (k, a) == (key, asks) and (k, g) not in used]
        if free:
            out.append((key, asks, min(free)[1]))
            used.add((key, min(free)[1]))
    return sorted(out)


def test_matching_in_turn(spark):
    r = random.Random(2)
    pairs = [(k, a, g, r.randint(0, 4)) for k in range(6) for a in range(9) for g in range(8) if r.random() < 0.5]
    pairs += [(100, a, g, g) for a in range(12) for g in range(12)]  # all want the same: a chain of rivals
    pairs += [(101, a, g, (g - a) % 10) for a in range(10) for g in range(10)] + [(102, 1, 1, 0)]
    frame = spark.createDataFrame([*pairs, (103, 1, None, 0)], "book int, fn int, an int, cost int")
    got = matching.assigned(frame, ["book"], "fn", "an", [F.col("cost")]).select("book", "fn", "an").collect()
    assert sorted(map(tuple, got)) == in_turn(pairs)
    assert matching.assigned(frame.limit(0), ["book"], "fn", "an", [F.col("cost")]).count() == 0
