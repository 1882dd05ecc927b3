"""Headings: places, how they stand, and the choice from the last one back, against plain versions."""

import random
import re

from quire.operators import headings as E

FREE = r"[\s\-–—•·*_|.:،؛,;!?؟«»()\[\]{}\"'/\\]*"


def plain_places(text, heading):
    out, at = [], text.find(heading) if heading else -1
    while at >= 0:
        end = at + len(heading)
        before, after = text[:at].rsplit("\n", 1)[-1], text[end:].split("\n", 1)[0]
        whole = before + after
        g = 3 if re.fullmatch(FREE, whole) else 2 if re.fullmatch(FREE, re.sub(r"[0-9]+", "", whole)) else int(bool(re.fullmatch(FREE, before) or re.fullmatch(FREE, after)))
        out.append((at, end, g))
        at = text.find(heading, end)
    return out


def plain_chosen(places, limit):
    out = {}
    for ordinal in sorted(places, reverse=True):
        fits = [(g, s, e) for s, e, g in places[ordinal] if e <= limit]
        if fits:
            g, s, e = max(fits)
            out[ordinal], limit = (s, e, g), s
    return out


def test_headings(spark):
    r = random.Random(9)
    words = ["ab", "cd", "ef.g", "12", "\n", "\n", " ", " - ", "xx", "ab cd", "(", "\\E"]
    texts = {f"b{i}": "".join(r.choice(words) for _ in range(r.randint(0, 60))) for i in range(60)} | {"none": None, "empty": "", "one": "ab", "tail": "ab\n", "same": "ab ab\nabab\n ab 7"}
    heads = ["ab", "cd", "ef.g", "", None, "\\E", "ab"]
    books = spark.createDataFrame(list(texts.items()), "book_id string, text string")
    asked = spark.createDataFrame([(b, k, h) for b in texts for k, h in enumerate(heads, 1)], "book_id string, ordinal int, heading string")
    found = E.occurrences(books, asked)
    got: dict = {}
    for x in found.collect():
        got.setdefault(x["book_id"], {}).setdefault(x["ordinal"], []).append((x["char_start"], x["char_end"], x["grade"]))
    want = {b: {k: p for k, h in enumerate(heads, 1) if (p := plain_places(t or "", h))} for b, t in texts.items()}
    assert {b: {k: sorted(v) for k, v in x.items()} for b, x in got.items()} == {b: x for b, x in want.items() if x}
    assert {g for x in want.values() for p in x.values() for *_, g in p} == {0, 1, 2, 3}
    for limits in (None, {b: 40 for b in texts}):
        frame = limits and spark.createDataFrame(list(limits.items()), "book_id string, char_end int")
        chosen: dict = {}
        for x in E.chosen(found, frame).collect():
            chosen.setdefault(x["book_id"], {})[x["ordinal"]] = (x["char_start"], x["char_end"], x["grade"])
            assert (x["stands"], x["confidence"]) == (E.STANDS[x["grade"]], E.CONFIDENCE[x["grade"]])
        assert chosen == {b: c for b, p in want.items() if (c := plain_chosen(p, limits[b] if limits else 10**9))}
