"""Folds over books and checks of drafts on small books of our own."""

import json
import random

from quire.operators import knowledge as N
from quire.operators import pages as P
from quire.operators import structure as B

TEXT = "كتاب الأربعين\nمقدمة\nنص المقدمة هنا\nالحديث الأول\n١\nعَنْ عُمَرَ قَالَ\nرواه البخاري\nكتاب الأربعين\n٧\nالحديث الثاني\n2 - نص ثان [رواه مسلم] بعده\n-----\nالفهرس\nالحديث الأول\nالحديث الثاني\n"
CONFIG = {
    "unit_headings": ["الحديث الأول", {"text": "الحديث الثاني"}],
    "back_matter": [{"type": "index", "title": "الفهرس", "role": "index", "start_at": {"text": "الفهرس"}}],
    "running_headers": ["كتاب الأربعين"],
    "sections": [{"title": "مقدمة", "level": 1}],
}


def built(text=TEXT, overrides=(), **config):
    return B.Book(text, B.settings(json.dumps({**CONFIG, **config}, ensure_ascii=False)), list(overrides)).build()


def test_segments_of_a_small_book():
    b = built()
    got = [(o, r, b.text[s:e]) for _, o, r, s, e, _, _ in b.segments()]
    assert got[:4] == [("node_001", "front_matter", "كتاب الأربعين"), ("node_s001", "heading", "مقدمة"), ("node_s001", "text", "نص المقدمة هنا"), ("unit_001", "heading", "الحديث الأول")]
    assert ("unit_001", "number", "١") in got and ("unit_002", "number", "2 -") in got
    assert ("running_header", "", "كتاب الأربعين") in got and ("page_number", "", "٧") in got and ("separator", "", "-----") in got
    assert ("unit_001", "source_attribution", "رواه البخاري") in got and ("unit_002", "source_attribution", "[رواه مسلم]") in got
    assert got[-1] == ("node_003", "index", "الفهرس\nالحديث الأول\nالحديث الثاني")


def test_every_visible_character_has_one_owner():
    for text in (TEXT, TEXT.replace("\n", "\r\n"), TEXT.replace("هنا", "😀 هنا"), "", "بلا عناوين"):
        b = built(text)
        seen = [0] * len(text)
        for _, _, _, s, e, _, _ in b.segments():
            for p in range(s, e):
                seen[p] += 1
        assert all(n <= 1 for n in seen) and all(n == 1 for n, c in zip(seen, text) if not c.isspace())


def test_units_and_issues():
    b = built()
    # the second unit's text behind its attribution costs .03
    assert [(u[0], u[2], u[3], u[6]) for u in b.unit_rows()] == [("unit_001", "١", "standalone", 0.95), ("unit_002", "2", "standalone", 0.92)]
    b = built(unit_headings=["الحديث الأول", "الحديث المفقود"])
    assert [u.ordinal for u in b.units] == [1] and [i[0] for i in b.issues] == ["heading_not_found", "ambiguous_number", "page_boundary_unknown"]


def test_the_last_fitting_heading_is_chosen():
    text = "باب\nباب\nنص\nفصل\nنص\n"
    b = built(text, unit_headings=["باب", "فصل"], back_matter=[], sections=[], running_headers=[])
    assert [u.heading for u in b.units] == [(4, 7), (11, 14)]
    b = built("نص باب نص\nفصل 12\n", unit_headings=["باب", "فصل"], back_matter=[], sections=[], running_headers=[])
    assert [u.stands for u in b.units] == ["glued", "standalone_with_page_number"]


def test_overrides():
    b = built(overrides=[{"op": "mark_noise", "at": {"text": "نص المقدمة"}, "type": "stamp", "reason": "r"}, {"op": "assign", "at": {"text": "بعده"}, "ordinal": 1, "reason": "r"}, {"op": "set_role", "at": {"text": "عمر"}, "role": "isnad"}, {"op": "mark_noise", "at": {"text": "غير موجود"}, "reason": "r"}, {"op": "what"}])
    got = {(o, r): (p, b.text[s:e]) for _, o, r, s, e, p, _ in b.segments()}
    assert got["stamp", "override"][1] == "نص المقدمة" and got["unit_001", "isnad"][1] == "عُمَر"
    assert ("unit", "unit_001", "hadith_text", TEXT.index("بعده"), TEXT.index("بعده") + 4, "displaced", 0.85) in list(b.segments())
    assert sorted(i[0] for i in b.issues) == ["ambiguous_number"] + ["manual_decision"] * 3 + ["override_failed"] * 2 + ["override_without_reason"] * 2 + ["page_boundary_unknown"]


def test_books_are_rows(spark):
    rows = [(1, TEXT, json.dumps(CONFIG), None), (2, None, None, None), (3, "x", None, json.dumps({"overrides": []}))]
    got = B.build_books(spark.createDataFrame(rows, "book_id int, text string, config string, overrides string")).collect()
    assert {r["book_id"] for r in got if r["relation"] == "segment"} == {"1", "3"}
    assert sum(r["relation"] == "unit" for r in got) == 2


def test_pages_align(spark):
    r = random.Random(1)
    words = ["".join(r.choice("ابتثجحخدذرزسشصض") for _ in range(r.randint(2, 7))) for _ in range(400)]
    text = " ".join(w + "ِ" if i % 3 == 0 else w for i, w in enumerate(words))
    pages = [(1, i + 1, " ".join(words[100 * i : 100 * i + 100])) for i in range(4)]
    pages[2] = (1, 3, "لا يوجد")
    got = P.align(spark.createDataFrame([("1", text)], "book_id string, text string"), spark.createDataFrame(pages, "book_id string, page_index int, text string")).orderBy("page_index").collect()
    assert [r["evidence"] for r in got] == ["pdf_text_alignment", "pdf_text_alignment", "interpolated", "pdf_text_alignment"]
    want = [sum(len(w) + (i % 3 == 0) + 1 for i, w in enumerate(words[: 100 * k])) for k in range(4)]
    assert [r["char_start"] for r in got][0::1][:2] == want[:2] and got[3]["char_start"] == want[3] and want[1] < got[2]["char_start"] < want[3]
    assert [r["char_end"] for r in got] == [*[r["char_start"] for r in got[1:]], len(text)]


GOOD = {"type": "belief", "statement": "الإيمان قول وعمل", "said_by": {"kind": "author"}, "basis": "explicit", "evidence": [{"piece": "p01", "quote": "الإيمان قول وعمل يزيد"}]}


def reasons(spark, **change):
    o = {**GOOD, **change}
    schema = "unit_id string, object int, type string, statement string, said_by struct<kind:string,name_in_text:string>, basis string, inference_reason string, evidence array<struct<piece:string,quote:string>>"
    row = ("u1", 0, o["type"], o["statement"], (o["said_by"].get("kind"), o["said_by"].get("name_in_text")), o["basis"], o.get("inference_reason"), [(e["piece"], e["quote"]) for e in o["evidence"]])
    pieces = spark.createDataFrame([("u1", "p01", "author", "قال سفيان: الإِيمَانُ قَوْلٌ وعملٌ، يزيد وينقص"), ("u1", "p02", "editor", "تعليق المحقق على هذا الموضع")], "unit_id string, piece_id string, by string, text string")
    return N.check_objects(spark.createDataFrame([row], schema), pieces, spark.createDataFrame([("belief",)], "type string")).first()["reasons"]


def test_planted_mistakes_are_rejected_with_their_code(spark):
    assert reasons(spark) == []
    assert reasons(spark, type="x") == ["E_TYPE"]
    assert reasons(spark, statement="only latin") == ["E_STATEMENT"] and reasons(spark, statement="ا" * 301) == ["E_STATEMENT"]
    assert reasons(spark, basis="inferred") == ["E_BASIS"] and reasons(spark, basis=None) == ["E_BASIS"]
    assert reasons(spark, basis="inferred", inference_reason="لأن") == []
    assert reasons(spark, said_by={"kind": "who"}) == ["E_SPEAKER_KIND"]
    assert reasons(spark, evidence=[]) == ["E_NO_EVIDENCE"]
    assert reasons(spark, evidence=[{"piece": "p09", "quote": "الإيمان قول وعمل"}]) == ["E_PIECE"]
    assert reasons(spark, evidence=[{"piece": "p01", "quote": "قول"}]) == ["E_QUOTE_SHORT"]
    assert reasons(spark, evidence=[{"piece": "p01", "quote": "الإيمان اعتقاد بالقلب"}]) == ["E_QUOTE_NOT_FOUND"]
    assert reasons(spark, said_by={"kind": "editor"}) == ["E_SPEAKER_ROLE"]
    assert reasons(spark, evidence=[{"piece": "p02", "quote": "تعليق المحقق على"}]) == ["E_SPEAKER_ROLE"]
    assert reasons(spark, said_by={"kind": "quoted", "name_in_text": "مالك"}) == ["E_NAME_NOT_IN_TEXT"]
    assert reasons(spark, said_by={"kind": "quoted", "name_in_text": "سُفْيان"}) == []
    assert reasons(spark, type="x", basis="?", evidence=[{"piece": "p09", "quote": ""}, {"piece": "p01", "quote": "قول"}]) == ["E_TYPE", "E_BASIS", "E_PIECE", "E_QUOTE_SHORT"]


def test_drafts_and_acceptance(spark):
    draft = {"unit_id": "u1", "model_used": "m", "prompt_version": "ke-v1", "objects": [GOOD]}
    raws = {"u1": draft, "u2": {**draft, "unit_id": "x"}, "u3": {**draft, "unit_id": "u3", "prompt_version": "0"}, "u4": {**draft, "unit_id": "u4", "model_used": " "}, "u5": {**draft, "unit_id": "u5", "objects": []}, "u6": {**draft, "unit_id": "u6", "objects": [GOOD] * 9}}
    drafts = spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in raws.items()] + [("u7", "{broken")], "unit_id string, raw string")
    units = spark.createDataFrame([(f"u{i}",) for i in range(1, 9)], "unit_id string")
    got = {r["unit_id"]: r["reasons"] for r in N.draft_reasons(drafts, units).collect()}
    assert got == {"u1": [], "u2": ["E_UNIT"], "u3": ["E_PROMPT_VERSION"], "u4": ["E_MODEL"], "u5": ["E_EMPTY"], "u6": ["E_TOO_MANY"], "u7": ["E_JSON"], "u8": ["E_MISSING_DRAFT"]}
    checked = spark.createDataFrame([("u1", i, s, b, w) for i, (s, b, w) in enumerate([("قول", "explicit", []), ("قَوْل", "inferred", []), ("خطأ", "explicit", ["E_TYPE"])])], "unit_id string, object int, statement string, basis string, reasons array<string>")
    got = [(r["id"], r["confidence"], r["repeat"]) for r in N.accept(checked, spark.createDataFrame([("u1", 0.7)], "unit_id string, confidence double")).orderBy("id").collect()]
    assert got == [("ko_u1_01", 0.7, False), ("ko_u1_02", 0.6, True)]


def test_built_books_have_no_errors(spark):
    from quire.operators import constraints as C
    from quire.operators import validate as V

    books = spark.createDataFrame([("1", TEXT, json.dumps(CONFIG), None), ("2", "بلا عناوين", None, None)], "book_id string, text string, config string, overrides string")
    built = B.build_books(books).cache()
    assert [tuple(r) for r in C.report([C.gathered(V.violations(built, books))]).where("severity = 'error'").collect()] == [("offset_range", "error", 1, ["10-10"])]  # the main part of a book without units
    row = {r["book_id"]: r for r in V.summary(built, books).collect()}
    assert row["1"]["covered"] == row["1"]["visible"] and row["1"]["units"] == 2 and row["2"]["covered"] == row["2"]["visible"]


PLANTED = [
    # (rule, severity, a row changed or added): each breaks one rule of an otherwise sound book
    ("offset_range", "error", {"relation": "noise", "id": "n1", "owner": "x", "role": "", "char_start": 90, "char_end": 120}),
    ("schema", "error", {"relation": "noise", "id": "n1", "owner": "x", "role": "", "char_start": 90}),
    ("schema", "error", {"relation": "issue", "id": "i9", "kind": "page_boundary_unknown", "role": "grave", "note": "", "confidence": 0.5}),
    ("ids", "error", {"relation": "node", "id": "node_000", "kind": "book", "owner": "node_000", "char_start": 0, "char_end": 100, "confidence": 0.9}),
    ("tree", "error", {"relation": "node", "id": "x", "kind": "section", "owner": "nobody", "char_start": 0, "char_end": 9, "confidence": 0.9}),
    ("duplicate_segment", "error", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "main", "char_start": 20, "char_end": 50, "placement": "in_span", "confidence": 0.8}),
    ("refs", "error", {"relation": "segment", "kind": "unit", "owner": "unit_009", "role": "main", "char_start": 20, "char_end": 50, "placement": "displaced", "confidence": 0.8}),
    ("refs", "error", {"relation": "unit_issue", "owner": "unit_001", "ref": "issue_077"}),
    ("overlap", "error", {"relation": "unit", "id": "unit_003", "kind": "hadith", "owner": "node_002", "ordinal": 3, "char_start": 40, "char_end": 49, "confidence": 0.8, "note": ""}),
    ("placement", "error", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "x", "char_start": 60, "char_end": 70, "placement": "in_span", "confidence": 0.7}),
    ("foreign_mirror", "error", {"relation": "foreign", "owner": "unit_002", "ref": "unit_001", "char_start": 60, "char_end": 70}),
    ("coverage_overlap", "error", {"relation": "noise", "id": "n1", "owner": "x", "role": "", "char_start": 30, "char_end": 32}),
    ("noise_too_long", "warn", {"relation": "noise", "id": "n1", "owner": "x", "role": "", "char_start": 10, "char_end": 95}),
    ("numbering", "error", {"relation": "unit", "id": "unit_005", "kind": "hadith", "owner": "node_002", "ordinal": 5, "char_start": 98, "char_end": 99, "confidence": 0.8, "note": ""}),
    ("confidence", "error", {"relation": "unit", "id": "unit_003", "kind": "hadith", "owner": "node_002", "ordinal": 3, "char_start": 98, "char_end": 99, "confidence": 1.5, "note": ""}),
    ("issue_location", "warn", {"relation": "issue", "id": "i9", "kind": "what", "role": "low", "note": "", "confidence": 0.5}),
    ("issue_location", "error", {"relation": "occurrence", "owner": "issue_001", "kind": "what", "ref": "unit_001", "char_start": 80, "char_end": 82}),
    ("offset_consistency", "error", {"relation": "occurrence", "owner": "issue_001", "kind": "what", "ref": "unit_001", "char_start": 20, "char_end": 22}),
    ("footnote_pairing", "error", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "takhrij", "char_start": 20, "char_end": 30, "placement": "in_span", "ref": "fn_001", "note": "(1)", "confidence": 0.8}),
    ("footnote_pairing", "warn", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "anchor", "char_start": 20, "char_end": 30, "placement": "in_span", "note": "(1)", "confidence": 0.8}),
    ("footnote_marker", "warn", {"relation": "segment", "kind": "unit", "owner": "unit_002", "role": "gharib", "char_start": 60, "char_end": 61, "placement": "in_span", "ref": "fn_001", "confidence": 0.8}),
    ("footnote_ids", "warn", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "gharib", "char_start": 20, "char_end": 30, "placement": "in_span", "note": "(1)", "confidence": 0.8}),
    ("page_confidence", "warn", {"relation": "page", "id": "2", "kind": "x", "page": 2, "char_start": 98, "char_end": 100, "confidence": 0.85}),
    ("pages", "error", {"relation": "page", "id": "9", "kind": "x", "page": 9, "char_start": 10, "char_end": 20, "confidence": 0.5}),
    ("roles", "warn", {"relation": "unit", "id": "unit_003", "kind": "hadith", "owner": "node_002", "ordinal": 3, "char_start": 98, "char_end": 99, "confidence": 0.8, "note": "title"}),
    ("fragmented_segments", "warn", {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "main", "char_start": 51, "char_end": 52, "placement": "in_span", "confidence": 0.8}),
]
#: A sound book of 100 characters: a front, two units with headings, and a page number right at the front's end.
SOUND = [
    {"relation": "node", "id": "node_000", "kind": "book", "char_start": 0, "char_end": 100, "confidence": 0.95},
    {"relation": "node", "id": "node_002", "kind": "main", "owner": "node_000", "char_start": 10, "char_end": 100, "confidence": 0.95},
    {"relation": "page", "id": "1", "kind": "document_start", "page": 1, "char_start": 0, "char_end": 98, "confidence": 0.9},
    {"relation": "noise", "id": "noise_0001", "owner": "page_number", "role": "", "char_start": 8, "char_end": 10},
    {"relation": "segment", "kind": "node", "owner": "node_001", "role": "front", "char_start": 0, "char_end": 8, "confidence": 0.7},
    {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "heading", "char_start": 10, "char_end": 20, "placement": "in_span", "confidence": 0.9},
    {"relation": "segment", "kind": "unit", "owner": "unit_001", "role": "main", "char_start": 20, "char_end": 50, "placement": "in_span", "confidence": 0.8},
    {"relation": "segment", "kind": "unit", "owner": "unit_002", "role": "heading", "char_start": 53, "char_end": 60, "placement": "in_span", "confidence": 0.9},
    {"relation": "segment", "kind": "unit", "owner": "unit_002", "role": "main", "char_start": 60, "char_end": 100, "placement": "in_span", "confidence": 0.8},
    {"relation": "unit", "id": "unit_001", "kind": "hadith", "owner": "node_002", "ordinal": 1, "char_start": 10, "char_end": 52, "confidence": 0.8, "note": ""},
    {"relation": "unit", "id": "unit_002", "kind": "hadith", "owner": "node_002", "ordinal": 2, "char_start": 53, "char_end": 100, "confidence": 0.75, "note": ""},
    {"relation": "unit_issue", "owner": "unit_002", "ref": "issue_001"},
    {"relation": "issue", "id": "issue_001", "kind": "what", "role": "low", "note": "", "confidence": 0.5},
    {"relation": "occurrence", "owner": "issue_001", "kind": "what", "ref": "unit_002", "char_start": 60, "char_end": 100},
]


def test_planted_violations_are_found(spark):
    from quire.operators import constraints as C
    from quire.operators import validate as V

    def rows(book, some):
        return [tuple({"book_id": book, **r}.get(name) for name in B.NAMES) for r in some]

    titles = {"unit_001": "x" * 10, "unit_002": "x" * 7}
    sound = [{**r, "note": titles[r["id"]]} if r["relation"] == "unit" else r for r in SOUND]
    data, books = rows("sound", sound), [("sound", "x" * 50 + "   " + "x" * 47)]
    for k, (_, _, row) in enumerate(PLANTED):
        data += rows(str(k), [*sound, row])
        books.append((str(k), books[0][1]))
    texts = spark.createDataFrame([*books, ("bare", "text without relations"), ("gap", "seen")], "book_id string, text string")
    built = spark.createDataFrame(data + rows("gap", sound[:2]), B.RELATIONS).cache()
    all_ = C.gathered(V.violations(built, texts))
    found = all_.collect()
    by_book = {}
    for r in found:
        by_book.setdefault(r["key"], set()).add((r["check"], r["severity"]))
    assert by_book.get("sound", set()) == set()
    missed = [(k, rule, by_book.get(str(k))) for k, (rule, severity, _) in enumerate(PLANTED) if (rule, severity) not in by_book.get(str(k), set())]
    assert missed == []
    assert ("files", "error") in by_book["bare"] and ("coverage_gap", "error") in by_book["gap"] and ("pages", "warn") in by_book["gap"]
    assert C.report([all_]).count() > 20


def test_forbidden_keys_and_profiles(spark):
    from quire.operators import validate as V
    from quire.sources import files
    from pyspark.sql import functions as F

    rows = [(1, json.dumps({"a": [{"cs": 1, "x": {"end": 2}}], "note": 'he said "start": no'})), (2, '{"char_start": 1}'), (3, None)]
    got = {r["k"]: r["f"] for r in spark.createDataFrame(rows, "k int, j string").select("k", V.forbidden_keys(F.col("j")).alias("f")).collect()}
    assert sorted(got[1]) == ["cs", "end"] and got[2] == [] and got[3] is None
    actual = files.profile(spark.createDataFrame([("1", bytearray("a\r\nب".encode())), ("2", bytearray(b"b"))], "book_id string, content binary"), "book_id", F.col("content"))
    stored = actual.where("book_id = '1'").select("book_id", F.lit("0").alias("sha256"), "n_chars", "crlf")
    assert sorted(map(tuple, V.profile_differences(stored, actual).collect())) == [("1", "sha256"), ("2", "crlf"), ("2", "n_chars"), ("2", "sha256")]


def test_sources_and_files(spark):
    from quire.operators import validate as V
    from quire.sources import files
    from pyspark.sql import functions as F

    raw = [("a", bytearray(b"ok")), ("b", bytearray(b"\xef\xbb\xbfok")), ("c", bytearray(b"\xff"))]
    profiles = files.profile(spark.createDataFrame(raw, "book_id string, content binary"), "book_id", F.col("content"))
    assert sorted((r["key"], r["severity"]) for r in V.source_violations(profiles).collect()) == [("b", "warn"), ("c", "error")]
    found = spark.createDataFrame([("1", "units.json", '{"cs": 1}', None), ("1", "issues.json", "{", "json"), ("2", "units.json", "{}", "crlf"), ("2", "issues.json", "{}", "bom")], "book_id string, name string, content string, problem string")
    required = spark.createDataFrame([("units.json",), ("issues.json",), ("structure.json",)], "name string")
    got = sorted((r["key"], r["check"], r["severity"], r["message"]) for r in V.file_violations(found, required).collect())
    assert got == [("1", "field_names", "error", "units.json cs"), ("1", "files", "error", "missing structure.json"), ("1", "json", "error", "issues.json json"), ("2", "encoding", "error", "issues.json bom"), ("2", "encoding", "warn", "units.json crlf"), ("2", "files", "error", "missing structure.json")]


NOTES = "باب أول\nقال المصنف كلاما عن الصبر (1) وعن الحلم (2)\n(1) رواه مسلم في صحيحه\nوهو في السنن أيضا 12\n(2) أخرجه أحمد، قوله الحلم: أي الأناة\nباب ثان\n(3)\nنص آخر عن الشكر\n(3) تخريج ثالث هنا\n(4) معنى الصبر: حبس النفس\n"


def noted():
    return built(NOTES, unit_headings=["باب أول", "باب ثان"], back_matter=[], sections=[], running_headers=[])


def test_footnotes_are_found_split_and_owned():
    b = noted()
    got = [(f.marker, b.text[f.start : f.end], f.owner, f.confidence) for f in b.footnotes]
    assert got == [(1, "(1) رواه مسلم في صحيحه\nوهو في السنن أيضا 12", 0, 0.8), (2, "(2) أخرجه أحمد، قوله الحلم: أي الأناة", 0, 0.9), (3, "(3) تخريج ثالث هنا", 0, 0.8), (4, "(4) معنى الصبر: حبس النفس", 1, 0.5)]
    assert [(a.marker, a.unit, a.used) for a in b.anchors] == [(1, 0, True), (2, 0, True), (3, 0, True)]
    assert sorted(i[0] for i in b.issues) == ["displaced_anchor", "displaced_footnote", "page_boundary_unknown", "unanchored_footnote"]


def test_a_note_splits_at_a_word_with_a_colon_only():
    text = "باب\nنص عن الصبر (1) (2)\n(1) رواه مسلم معنى الصبر كذا\n(2) رواه أحمد معنى: الصبر حبس\n"
    b = built(text, unit_headings=["باب"], back_matter=[], sections=[], running_headers=[])
    assert [(r, b.text[s:e]) for _, _, r, s, e, _, _ in b.segments() if r in ("takhrij", "gharib")] == [("takhrij", "(1) رواه مسلم معنى الصبر كذا"), ("takhrij", "(2) رواه أحمد"), ("gharib", "معنى: الصبر حبس")]


def test_the_earliest_free_anchor_is_used_up_first():
    text = "باب\nنص أول (1) ثم كلام (1) آخر\n(1) رواه مسلم في صحيحه\n"
    b = built(text, unit_headings=["باب"], back_matter=[], sections=[], running_headers=[])
    assert [a.used for a in b.anchors] == [True, False] and b.footnotes[0].anchor is b.anchors[0]
    assert [i[0] for i in b.issues] == ["orphan_anchor", "page_boundary_unknown"]


def test_order_in_a_block_needs_an_owner_that_is_not_later():
    text = "باب أول\nكلام عن الصبر\nباب ثان\nكلام عن الحلم (2)\n(1) رواه مسلم فقط\n(2) رواه أحمد فقط\n"
    b = built(text, unit_headings=["باب أول", "باب ثان"], back_matter=[], sections=[], running_headers=[])
    assert [(f.marker, f.owner, f.confidence) for f in b.footnotes] == [(1, 0, 0.55), (2, 1, 0.8)]


def test_numbers_attributions_sections_and_trailing_text():
    text = "مقدمة\nتمهيد\nنص\nباب 1\n1\nنص أول (رواه أحمد) ثم\nرواه مسلم\nذيل\nباب 2\n3\n"
    b = built(text, unit_headings=["باب 1", "باب 2"], back_matter=[], running_headers=[], sections=[{"text": "مقدمة", "level": 1}, {"text": "تمهيد", "level": 2}])
    assert [(s.id, s.parent, text[s.start : s.end]) for s in b.sections] == [("node_s001", "node_001", "مقدمة\nتمهيد\nنص\n"), ("node_s002", "node_s001", "تمهيد\nنص\n")]
    got = [(o, r, text[s:e]) for _, o, r, s, e, _, _ in b.segments()]
    assert ("unit_001", "number", "1") in got and ("page_number", "", "3") in got
    assert ("unit_001", "source_attribution", "(رواه أحمد) ثم\nرواه مسلم\nذيل") in got  # a round bracket has no closing that counts
    rows = list(b.rows())
    assert {r["kind"] for r in rows if r["relation"] == "issue"} == {"ambiguous_number", "page_number_noise", "page_boundary_unknown"}
    assert built("a").build().units == []


def test_pages_snap_to_marks_and_rise():
    header = "كتاب الأربعين"
    text = "باب\n" + "نص هنا\n" * 30 + header + "\n" + "نص هنا\n" * 60 + "باب أخير\n"
    at = text.index(header)
    pages = [{"page_index": 1, "char_start": 0, "confidence": 0.55}, {"page_index": 2, "char_start": at + 100}, {"page_index": 3, "char_start": at + 380}, {"page_index": 4, "char_start": at + 380}]
    b = B.Book(text, B.settings(json.dumps({"unit_headings": ["باب"], "running_headers": [header]}, ensure_ascii=False)), [], pages).build()
    assert b.starts == [(0, "document_start", 0.9), (at, "snapped_to_header", 0.85), (at + 380, "pdf_alignment_only", 0.55), (at + 381, "pdf_alignment_only", 0.55)]
    weak = next(i for i in b.issues if i.kind == "weak_page_boundary")
    assert [(p.start, p.end) for p in weak.places] == [(at + 380, at + 381), (at + 381, at + 382)]
    assert b.page_at(at - 1) == 1 and b.page_at(at) == 2 and b.page_at(at + 400) == 4


def layout_book(front=()):
    """Two pages: text, a gap, and footnotes; the second page's zone begins with what carries on the first's last footnote."""
    one = [*front, "باب أول", "كلام طويل عن الصبر والحلم (1)", "وكلام آخر طويل عن الشكر", "وكلام ثالث طويل عن الورع", "(1) رواه مسلم في صحيحه عن أبيه"]
    two = ["باب ثان", "كلام جديد عن الزهد والتقوى (1)", "وكلام بعده عن الصدق والوفاء", "وكلام أخير عن البر والصلة", "تتمة الحاشية من الصفحة الأولى", "(1) أخرجه أحمد في مسنده الكبير"]
    lines, txt, pages, at = [], [], [], 0
    for index, own in ((1, one), (2, two)):
        printed, y = [], 100.0
        for k, t in enumerate(own):
            y += 60 if t.startswith(("(1) رواه", "تتمة")) else 20
            printed.append({"bbox": [50, y, 400, y + 12], "text": t})
            txt.append({"char_start": at, "char_end": at + len(t), "page_index": index, "line": k, "score": 1.0, "cover": 1.0, "n": 20})
            lines.append(t)
            at += len(t) + 1
        pages.append({"page_index": index, "char_start": 0 if index == 1 else txt[len(one)]["char_start"] + 7, "confidence": 0.75, "height": 400.0, "lines": printed})
    return "\n".join(lines), pages, txt


def test_layout_gives_zones_pages_and_owners(spark):
    text, pages, txt = layout_book()
    config = json.dumps({"unit_headings": ["باب أول", "باب ثان"]}, ensure_ascii=False)
    b = B.Book(text, B.settings(config), [], pages, txt).build()
    assert [b.zones.zone.get(k) for k in range(11)] == ["main"] * 4 + ["footnote"] + ["main"] * 4 + ["footnote"] * 2 and b.zones.carried == {9}
    assert b.zones.info[2] == {"footnote_zone_top_y": 240.0, "continuation_lines": 1, "line_pitch": 20.0}
    assert [(f.id, f.owner, f.page, f.confidence, [text[s:e] for s, e in f.more]) for f in b.footnotes] == [("fn_001", 0, 1, 0.85, ["تتمة الحاشية من الصفحة الأولى"]), ("fn_002", 1, 2, 0.85, [])]
    assert b.starts == [(0, "document_start", 0.9), (txt[5]["char_start"], "pdf_line_layout", 0.75)]
    kinds = [i.kind for i in b.issues]
    assert "footnote_continuation_joined" in kinds and "layout_mismatch" not in kinds
    joined = [(r["owner"], r["role"], r["ref"], r["placement"]) for r in b.rows() if r["relation"] == "segment" and r["char_start"] == txt[9]["char_start"]]
    assert joined == [("unit_001", "takhrij", "fn_001", "displaced")]
    assert [(r["owner"], r["ref"]) for r in b.rows() if r["relation"] == "foreign"] == [("unit_002", "unit_001")]
    moved = B.Book(text, B.settings(config), [], pages, txt[1:]).build()
    assert "layout_mismatch" in [i.kind for i in moved.issues] and not moved.zones.zone
    model = json.dumps({"pages": pages, "txt_lines": txt}, ensure_ascii=False)
    books = spark.createDataFrame([("1", text, config, None, model), ("2", text, "{broken", "[", "]")], "book_id string, text string, config string, overrides string, pages string")
    rows = B.build_books(books).collect()
    assert sum(r["relation"] == "page" for r in rows) == 2
    assert [r["note"] for r in rows if r["kind"] == "unreadable_settings"] == ["config", "overrides", "pages"]


def test_footnote_characters_keep_one_owner():
    b = noted()
    seen = [0] * len(NOTES)
    for _, _, _, s, e, _, _ in b.segments():
        for p in range(s, e):
            seen[p] += 1
    assert all(n == 1 for n, c in zip(seen, NOTES) if not c.isspace())
    assert any(x[5] == "displaced" for x in b.segments())
