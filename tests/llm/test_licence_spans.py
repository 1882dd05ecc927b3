"""Places of licence templates, against texts whose notices were put at known words and against all chains."""

import random
from itertools import combinations

from quire.llm import licence_scan

WORDS = [(label, [w.decode() for w in licence_scan.words_of(text)]) for label, text in (*licence_scan.PHRASES, *licence_scan.TEMPLATES)]


def found(spans, label):
    return [(x["template"], x["first_word"], x["last_word"], x["cover"]) for x in spans if x["label"] == label]


def test_every_notice_has_its_place(spark):
    which = {label: k for k, (label, _) in enumerate(WORDS)}  # the last of a label is its template, if it has one
    isc, unlicense, gpl = (WORDS[which[x]][1] for x in ("isc", "unlicense", "gpl-3"))
    broken = [*isc[:9], "oops", *isc[10:]]
    text = ["x"] * 5 + isc + ["y"] * 3 + unlicense + unlicense + ["z"] * 90 + broken + gpl + "zz under the mit license under the mit license".split()
    docs = spark.createDataFrame([(1, " ".join(text)), (2, None), (3, " ".join(["x"] * 5 + isc[:9]))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licence_scan.scan_files(docs).collect()}
    spans = got[1]["spans"]
    n, u, g = len(isc), len(unlicense), len(gpl)
    at = 5 + n + 3
    late = at + 2 * u + 90
    assert found(spans, "isc") == [(which["isc"], 5, 4 + n, 1.0), (which["isc"], late, late + n - 1, (n - 1) / n)]
    assert found(spans, "unlicense") == [(which["unlicense"], at, at + u - 1, 1.0), (which["unlicense"], at + u, at + 2 * u - 1, 1.0)]
    assert (which["gpl-3"], late + n, late + n + g - 1, 1.0) in found(spans, "gpl-3")
    mit = late + n + g + 1
    assert [x[1:] for x in found(spans, "mit") if x[0] == 0] == [(mit, mit + 3, 1.0), (mit + 4, mit + 7, 1.0)]
    assert got[1]["n_base"] == 2 and got[1]["labels"] == ",".join(sorted({x["label"] for x in spans}))
    assert got[2]["spans"] == got[3]["spans"] == []


def test_chains_are_the_best_of_all():
    r = random.Random(9)
    for _ in range(200):
        matches = [(e, p, min(n, p, e)) for e, p, n in ((r.randint(3, 130), r.randint(3, 20), r.randint(3, 6)) for _ in range(7))]
        best = 0
        for size in range(1, 8):
            for chain in combinations(sorted(set(matches)), size):
                steps = list(zip(chain, chain[1:]))
                if all(e0 < e and p0 < p and e - n - e0 <= licence_scan.MAX_GAP for (e0, p0, _), (e, p, n) in steps):
                    best = max(best, chain[0][2] + sum(min(n, e - e0, p - p0) for (e0, p0, _), (e, p, n) in steps))
        assert max(have for have, _, _ in licence_scan.chains(matches)) == best
        spans = licence_scan.covered_spans(matches, 5)
        assert all(b0 <= a for (_, _, b0), (_, a, _) in zip(spans, spans[1:])) and max((x[0] for x in spans), default=best) == best


def diagonals(text, template, least):
    """All matches of least words or more that neither side can extend, as (text end, template end, length)."""
    out = []
    for i in range(len(text)):
        for j in range(len(template)):
            if text[i] == template[j] and (i == 0 or j == 0 or text[i - 1] != template[j - 1]):
                n = 0
                while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                    n += 1
                if n >= least:
                    out.append((i + n, j + n, n))
    return out


def test_a_template_is_found_whatever_the_others_are():
    templates = [("a", "p q r s t u v"), ("b", "z y x w s t u")]
    for some in (templates[1:], templates):
        got = licence_scan.scan(licence_scan.build((), some), "z y x w r s t u")
        assert got["labels"] == "b" and got["score"] == 1.0


def test_scores_and_labels_against_all_matches():
    r = random.Random(12)
    for _ in range(60):
        templates = [(f"l{k}", " ".join(r.choice("abcdef") for _ in range(r.randint(4, 14)))) for k in range(5)]
        pieces = [t.split() for _, t in templates]
        text = []
        for _ in range(8):
            t = r.choice(pieces)
            a = r.randint(0, len(t) - 1)
            text += t[a : a + r.randint(1, 9)] + [r.choice("abcxyz")] * r.randint(0, 2)
        got = licence_scan.scan(licence_scan.build((), templates), " ".join(text))
        best = {}
        for (label, _), words in zip(templates, pieces):
            found = diagonals(text, words, licence_scan.MIN_MATCH)
            best[label] = max((have for have, _, _ in licence_scan.chains(found)), default=0) / len(words)
        assert abs(got["score"] - min(1, max(best.values()))) < 1e-12
        assert got["labels"] == ",".join(sorted(k for k, x in best.items() if x >= licence_scan.COVER))
