"""What a build leaves: files, reading sheets, comparisons with another build, and the command line over them."""

import json
import random

import pytest

from pyspark.sql import functions as F

from quire import __main__ as cli
from quire.operators import builds, compare, constraints, knowledge, sheets
from quire.operators import structure as B
from quire.sources import files, outputs, scratch
from tests.test_books import CONFIG, NOTES, TEXT, layout_book

BOOK_CONFIG = json.dumps(CONFIG, ensure_ascii=False)


@pytest.fixture(scope="module")
def books(spark):
    notes = json.dumps({"unit_headings": ["باب أول", "باب ثان"]}, ensure_ascii=False)
    return spark.createDataFrame([("1", TEXT, BOOK_CONFIG, None), ("2", NOTES, notes, None), ("3", None, None, None)], "book_id string, text string, config string, overrides string").cache()


@pytest.fixture(scope="module")
def built(books):
    return B.build_books(books).cache()


def test_sheets_of_units(spark, books, built):
    found = sheets.pieces(built, books, {"footnote_roles": {"takhrij": "include"}})
    got = {(r["book_id"], r["unit_id"], r["piece_id"]): r for r in found.collect()}
    assert [(k[2], r["kind"], r["by"], r["text"]) for k, r in sorted(got.items()) if k[:2] == ("1", "unit_001")] == [("p01", "heading", "editor", "الحديث الأول"), ("p02", "main", "author", "عَنْ عُمَرَ قَالَ"), ("p03", "attribution", "author", "رواه البخاري")]
    two = [(r["kind"], r["label"], r["text"]) for k, r in sorted(got.items()) if k[:2] == ("2", "unit_001")]
    assert two[1] == ("main", "main text", "قال المصنف كلاما عن الصبر وعن الحلم")
    assert two[2] == ("footnote", "footnote (1) (takhrij)", "(1) رواه مسلم في صحيحه وهو في السنن أيضا 12") and len(two) == 5  # one is read in the next unit
    for (book, _, _), r in got.items():
        source = {"1": TEXT, "2": NOTES}[book]
        for x in r["spans"]:
            assert r["text"][x["piece_start"] : x["piece_start"] + x["char_end"] - x["char_start"]] == source[x["char_start"] : x["char_end"]].replace("\n", " ")
    bare = {r["kind"] for r in sheets.pieces(built, books, {"footnote_roles": {}}).collect()}
    assert bare == {"heading", "main", "attribution"}
    files_ = {(r["book_id"], r["unit_id"]): r for r in sheets.sheets(built, found).collect()}
    assert set(files_) == {("1", "unit_001"), ("1", "unit_002"), ("2", "unit_001"), ("2", "unit_002")}
    sheet = json.loads(files_["1", "unit_001"]["json"])
    assert sheet["ordinal"] == 1 and [p["id"] for p in sheet["pieces"]] == ["p01", "p02", "p03"]
    assert files_["1", "unit_001"]["markdown"].startswith("UNIT unit_001  (hadith 1)\n\n[p01] heading — the EDITOR's words\nالحديث الأول\n\n[p02] main text — the AUTHOR's text (it may")


def test_some_units_and_unknown_ones(spark, built):
    units = built.where("relation = 'unit' and book_id = '1'")
    some, unknown = sheets.chosen(units, spark.createDataFrame([("unit_002",), ("unit_009",), (None,)], "id string"))
    assert [r["id"] for r in some.collect()] == ["unit_002"] and [r["id"] for r in unknown.collect()] == ["unit_009"]
    assert sheets.chosen(units, None)[0].count() == 2


def test_quotes_lead_to_the_source(spark, books, built):
    pieces = sheets.pieces(built.where("book_id = '2'"), books)
    quotes = [("unit_001", 0, 0, "p02", "الصَّبْر وعن الحلم"), ("unit_001", 0, 1, "p02", "ليس هنا"), ("unit_001", 1, 0, "p09", "الصبر")]
    got = knowledge.quoted_parts(spark.createDataFrame(quotes, "unit_id string, object int, k int, piece string, quote string"), pieces).orderBy("char_start").collect()
    assert [NOTES[r["char_start"] : r["char_end"]] for r in got] == ["الصبر", "وعن الحلم"] and {(r["object"], r["k"]) for r in got} == {(0, 0)}


def test_changed_spans_by_brute_force(spark):
    r = random.Random(3)

    def labelling():
        out, at = [], 0
        while at < 60:
            size = r.randint(1, 9)
            if r.random() < 0.8:
                out.append((1, r.choice("xyz"), at, at + size))
            at += size
        return out

    for _ in range(4):
        old, new = labelling(), labelling()
        say = [{p: label for _, label, s, e in side for p in range(s, e)} for side in (old, new)]
        frames = [spark.createDataFrame(side, "b int, label string, s int, e int") for side in (old, new)]
        got = compare.changed_spans(*frames, ["b"], "label", "s", "e").collect()
        seen = {p: (x["old"], x["new"]) for x in got for p in range(x["s"], x["e"])}
        assert sum(x["e"] - x["s"] for x in got) == len(seen)
        assert seen == {p: (say[0].get(p), say[1].get(p)) for p in range(80) if say[0].get(p) != say[1].get(p)}
        runs = compare.label_runs(compare.changed_spans(*frames, ["b"], "label", "s", "e"), ["b"], "s", "e", 5).orderBy("s").collect()
        want: list = []
        for p in sorted(seen):
            if want and want[-1][0] == seen[p] and p - want[-1][2] < 5:
                want[-1][2] = p
            else:
                want.append([seen[p], p, p])
        assert [((x["old"], x["new"]), x["s"], x["e"] - 1) for x in runs] == [tuple(w) for w in want]


def test_builds_are_compared(spark, books, built):
    assert compare.differences(built, built, books).count() == 0 and compare.unequal(built, built).count() == 0
    overrides = json.dumps({"overrides": [{"op": "mark_noise", "at": {"text": "بعده"}, "type": "stamp", "reason": "r"}]}, ensure_ascii=False)
    other = B.build_books(books.withColumn("overrides", F.when(F.col("book_id") == "1", overrides))).cache()
    got = {(r["book_id"], r["what"], r["key"]): (r["old"], r["new"]) for r in compare.differences(built, other, books).collect()}
    at = TEXT.index("بعده")
    assert got["1", "label", f"{at}-{at + 4}"] == ("unit 2 hadith_text", "noise stamp")
    assert got["1", "unit", "2"][0] != got["1", "unit", "2"][1] and any(k[1] == "issue" and "manual_decision" in k[2] for k in got)
    assert {k[0] for k in got} == {"1"}
    detail = built.withColumn("confidence", F.when(F.col("relation") == "noise", 0.1).otherwise(F.col("confidence")))
    assert [(r["book_id"], r["what"], r["key"]) for r in compare.differences(built, detail, books).where("book_id = '1'").collect()] == [("1", "detail", "noise")]


def test_files_of_a_build(spark, books, built, tmp_path):
    profiles = files.profile(books, "book_id", F.coalesce("text", F.lit("")).cast("binary"))
    n = outputs.write_named(builds.book_files(builds.completed(built, books), profiles), str(tmp_path))
    assert n == 12
    read = {name: json.loads((tmp_path / "1" / f"{name}.json").read_text(encoding="utf-8")) for name in ("book_profile", "structure", "units", "issues")}
    assert read["book_profile"]["source_length_chars"] == len(TEXT) and read["structure"]["root"] == "node_000"
    assert [x["id"] for x in read["structure"]["nodes"]] == ["node_000", "node_001", "node_002", "node_003", "node_s001"]
    assert [u["id"] for u in read["units"]["units"]] == ["unit_001", "unit_002"] and read["units"]["units"][0]["segments"][0]["role"] == "heading"
    assert {"ambiguous_number", "page_boundary_unknown", "trailing_fragment"} <= {i["type"] for i in read["issues"]["issues"]}
    assert json.loads((tmp_path / "3" / "units.json").read_text())["units"] == []
    raw = (tmp_path / "1" / "units.json").read_bytes()
    assert not raw.startswith(b"\xef\xbb\xbf") and "باب".encode() not in raw and "الحديث".encode() in raw


@pytest.fixture(scope="module")
def stored(spark, books, tmp_path_factory):
    """The files of three books, their relation and its source."""
    folder = tmp_path_factory.mktemp("stored")
    profiles = files.profile(books, "book_id", F.coalesce("text", F.lit("")).cast("binary")).cache()
    pages = json.dumps([{"page_index": k + 1, "printed_page_number": None, "char_start": at, "char_end": at + 40, "evidence": "x", "confidence": 0.5} for k, at in enumerate((0, 40))])
    with_pages = books.withColumn("pages", F.when(F.col("book_id") == "1", pages))
    whole = builds.completed(scratch.written(B.build_books(with_pages), "built"), books).cache()
    outputs.write_named(builds.book_files(whole, profiles), str(folder))
    return folder, whole, profiles


def table_of(rows):
    return sorted(tuple((v is None, v) for v in r) for r in rows.select(*B.NAMES).collect())


def test_stored_builds_are_read_as_they_were(spark, stored, tmp_path):
    folder, whole, profiles = stored
    found = builds.read_files(spark, str(folder)).cache()
    assert found.count() == 12 and found.where("problem is not null").count() == 0
    again = builds.relation_of(found).cache()
    kinds = {r["relation"] for r in again.select("relation").distinct().collect()}
    assert {"root", "child", "raw_text", "node", "unit", "segment", "issue", "occurrence", "page", "noise"} <= kinds
    assert table_of(again) == table_of(whole)
    assert sorted(map(tuple, builds.stored_profiles(found).collect())) == sorted((r["book_id"], r["sha256"], r["n_chars"], r["crlf"]) for r in profiles.collect())
    units = json.loads((folder / "1" / "units.json").read_text(encoding="utf-8"))["units"]
    nodes = json.loads((folder / "1" / "structure.json").read_text(encoding="utf-8"))["nodes"]
    assert all({*builds.FIELDS["units.json", "units"]} <= set(u) for u in units) and units[0]["raw_text"] == TEXT[units[0]["span"]["char_start"] : units[0]["span"]["char_end"]]
    assert nodes[0]["children"] == ["node_001", "node_002", "node_003"] and nodes[0]["parent_id"] is None and "parent_id" in nodes[0]
    assert nodes[2]["children"] == [u["id"] for u in units] and nodes[1]["segments"] and {"page_start", "page_end"} <= set(units[0]["span"])


def test_stored_builds_are_checked(spark, books, stored, tmp_path):
    """Copies of one sound build, each broken in its own way."""
    import shutil

    folder, _, profiles = stored
    for name in ("sound", "edited", "missing", "renamed"):
        shutil.copytree(folder / "1", tmp_path / name)

    def edit(path, f):
        value = json.loads(path.read_text(encoding="utf-8"))
        f(value)
        path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")

    def units(v):
        v["units"][0]["raw_text"] += "?"
        del v["units"][1]["issue_ids"]
        v["units"][0]["segments"].append({"role": "noise_ref", "noise_id": "noise_9999"})

    def structure(v):
        v["nodes"][0]["children"].append("node_999")
        v["nodes"][1]["children"].append("node_002")
        v["nodes"][3]["parent_id"], v["nodes"][4]["parent_id"] = v["nodes"][4]["id"], v["nodes"][3]["id"]

    edit(tmp_path / "edited" / "book_profile.json", lambda v: v.update(source_sha256="x"))
    edit(tmp_path / "edited" / "units.json", units)
    edit(tmp_path / "edited" / "structure.json", structure)
    (tmp_path / "missing" / "issues.json").unlink()
    (tmp_path / "missing" / "units.json").write_bytes(b"{")
    edit(tmp_path / "renamed" / "structure.json", lambda v: v["pages"][0].update(x={"cs": 1}))
    found = builds.read_files(spark, str(tmp_path)).cache()
    ids = F.explode(F.array(*map(F.lit, ("sound", "edited", "missing", "renamed"))))
    own, sources = (x.where("book_id = '1'").withColumn("book_id", ids) for x in (books, profiles))
    got = {x: set() for x in ("sound", "edited", "missing", "renamed")}
    for r in constraints.gathered(builds.stored_violations(found, builds.relation_of(found).cache(), own, sources)).where("severity = 'error'").collect():
        got[r["key"]].add((r["check"], r["message"]))
    assert not got["sound"] and got["renamed"] == {("field_names", "structure.json cs")}
    assert {("profile", "sha256"), ("offset_text", "unit_001"), ("schema", "unit_002 issue_ids"), ("refs", "unit_001 noise_9999"), ("tree", "node_000 node_999"), ("tree", "node_001 node_002")} <= got["edited"]
    assert {("tree", f"not below the root: {x}") for x in ("node_003", "node_s001")} <= got["edited"]
    assert {("files", "missing issues.json"), ("json", "units.json json")} <= got["missing"]


def test_pages_are_upserted(spark, tmp_path):
    name = "quire_pages"
    page = lambda b, n, t: (b, n, t)
    frame = lambda rows: spark.createDataFrame(rows, "book_id string, page_number int, raw_text string")
    read = lambda: sorted(map(tuple, spark.table(name).select("book_id", "page_number", "raw_text").collect()))
    try:
        outputs.upsert_table(frame([page("a", 1, "x"), page("a", 2, "y"), page("b", 1, "z")]), name, ["book_id", "page_number"], ["raw_text"], "book_id")
        files_of_b = {r[0] for r in spark.table(name).where("book_id = 'b'").select(F.input_file_name()).collect()}
        assert outputs.save_pages(frame([page("a", 2, "later"), page("c", 1, "new"), page("a", 2, "early")]), str(tmp_path), name)
        assert outputs.save_pages(frame([page("a", 2, "later")]), str(tmp_path), name)
        assert read() == [("a", 1, "x"), ("a", 2, "later"), ("b", 1, "z"), ("c", 1, "new")]
        assert {r[0] for r in spark.table(name).where("book_id = 'b'").select(F.input_file_name()).collect()} == files_of_b
        broken = frame([page("a", 1, "never")]).withColumn("raw_text", F.when(F.lit(True), F.raise_error("lost")).cast("string"))
        with pytest.raises(Exception, match="lost"):
            outputs.upsert_table(broken, name, ["book_id", "page_number"], ["page_number"], "book_id")
        outputs.upsert_table(frame([]), name, ["book_id", "page_number"], ["raw_text"], "book_id")
        assert len(read()) == 4
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables_of_the_archive(spark, tmp_path):
    names = outputs.create_tables(spark)
    try:
        assert names == ["books", "raw_pages", "knowledge_objects", "relationships"] and outputs.create_tables(spark) == names
        tables = {n: spark.table(n) for n in names}
        assert outputs.table_violations(tables).count() == 0
        tables["books"] = spark.createDataFrame([(1, "a", "t", 1, None), (2, "a", "t", 1, None)], spark.table("books").schema)
        tables["raw_pages"] = spark.createDataFrame([(1, 1, None, "x", None, None, None, 9)], spark.table("raw_pages").schema)
        assert sorted((r["check"], r["key"]) for r in outputs.table_violations(tables).collect()) == [("refs", "raw_pages"), ("unique", "books")]
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    pages = spark.createDataFrame([("b", 7, "نص")], "book_id string, page_number int, raw_text string")
    assert outputs.save_pages(pages, str(tmp_path), "no_such_table") is False
    assert json.loads((tmp_path / "b" / "page-007.json").read_text(encoding="utf-8"))["raw_text"] == "نص"


def test_files_of_a_folder(spark, tmp_path):
    for name in ("p10.png", "p2.png", "x.txt", "none.png"):
        (tmp_path / name).write_bytes(b"x")
    got = files.listed(spark, str(tmp_path), ".png").orderBy("place").collect()
    assert [(r["name"], r["number"], r["place"]) for r in got] == [("none.png", None, 1), ("p10.png", 10, 2), ("p2.png", 2, 3)]


def test_command_line(spark, tmp_path, capsys):
    text, pages, txt = layout_book(["مقدمة الكتاب كله"])
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "book.txt").write_text(text, encoding="utf-8")
    config = {"unit_headings": ["باب أول", "باب ثان"], "body_role": "text"}
    (tmp_path / "config.json").write_text(json.dumps(config, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "printed.json").write_text(json.dumps([{"text": "", "height": p["height"], "lines": p["lines"]} for p in pages], ensure_ascii=False), encoding="utf-8")
    texts, out = str(tmp_path / "texts"), str(tmp_path / "out")
    assert cli.main(["pages", texts, str(tmp_path / "printed.json"), "--out", out]) == 0
    model = json.loads((tmp_path / "out" / "book" / "pages.json").read_text(encoding="utf-8"))
    assert [p["page_index"] for p in model["pages"]] == [1, 2] and len(model["txt_lines"]) == 12 and len(model["pages"][1]["lines"]) == 6
    common = ["--config", str(tmp_path / "config.json"), "--pages", str(tmp_path / "out" / "book" / "pages.json")]
    assert cli.main(["build", texts, *common, "--out", out]) == 0
    units = json.loads((tmp_path / "out" / "book" / "units.json").read_text(encoding="utf-8"))["units"]
    assert [u["id"] for u in units] == ["unit_001", "unit_002"] and units[0]["segments"][-1]["placement"] == "displaced"
    assert cli.main(["validate", texts, *common, "--out", out]) == 0
    report = json.loads((tmp_path / "out" / "validation_report.json").read_text())
    assert report["status"] == "pass" and report["stats"]["book"]["units"] == 2 and report["stats"]["book"]["source_length_chars"] == len(text)
    assert cli.main(["prepare", texts, *common, "--units", "unit_001", "--out", out]) == 0
    assert (tmp_path / "out" / "book" / "unit_001.md").exists() and not (tmp_path / "out" / "book" / "unit_002.md").exists()
    assert cli.main(["prepare", texts, *common, "--units", "unit_077", "--out", out]) == 2
    (tmp_path / "drafts").mkdir()
    good = {"type": "belief", "statement": "الصبر والحلم", "said_by": {"kind": "author"}, "basis": "explicit", "evidence": [{"piece": "p02", "quote": "كلام طويل عن الصبر"}]}
    for unit, objects in (("unit_001", [good]), ("unit_002", [good, {**good, "basis": "?"}])):
        (tmp_path / "drafts" / f"{unit}.json").write_text(json.dumps({"unit_id": unit, "model_used": "m", "prompt_version": "ke-v1", "objects": objects}, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "sheet.json").write_text(json.dumps({"types": [{"id": "belief"}]}), encoding="utf-8")
    assert cli.main(["check", str(tmp_path / "drafts"), "--texts", texts, *common, "--sheet-config", str(tmp_path / "sheet.json"), "--out", out]) == 1
    result = json.loads((tmp_path / "out" / "knowledge_objects.json").read_text(encoding="utf-8"))
    assert [o["id"] for o in result["objects"]] == ["ko_unit_001_01"] and text[result["objects"][0]["evidence"][0]["char_start"] :].startswith("كلام طويل عن الصبر")
    assert [(r["unit_id"], r["object"], r["reasons"]) for r in result["rejected"]] == [("unit_002", 0, ["E_QUOTE_NOT_FOUND"]), ("unit_002", 1, ["E_BASIS", "E_QUOTE_NOT_FOUND"])]
    one = result["objects"][0]
    assert (one["type"], one["said_by"], one["model_used"], one["prompt_version"], one["status"], one["warnings"]) == ("belief", {"kind": "author"}, "m", "ke-v1", "experimental", [])
    assert set(one["evidence"][0]) == {"piece", "quote", "char_start", "char_end", "role", "page", "page_end", "parts"} and one["evidence"][0]["parts"][0]["char_start"] == one["evidence"][0]["char_start"]
    assert result["units_checked"] == ["unit_001", "unit_002"] and {k: (v["accepted"], v["rejected"]) for k, v in result["per_unit"].items()} == {"unit_001": (1, 0), "unit_002": (0, 2)}
    assert cli.main(["prepare", texts, "--build", out, "--units", "unit_002", "--out", str(tmp_path / "again")]) == 0
    assert (tmp_path / "again" / "book" / "unit_002.md").exists()
    stored = str(tmp_path / "stored")
    assert cli.main(["diff", texts, *common, "--against", stored, "--approve"]) == 0
    assert cli.main(["diff", texts, *common, "--against", stored]) == 0
    assert cli.main(["diff", texts, *common[:2], "--against", stored]) == 1
    assert cli.main(["discover", texts]) == 0


def test_databases(spark):
    try:
        assert files.create_database(spark, "quire_test") and not files.create_database(spark, "quire_test")
    finally:
        spark.sql("DROP DATABASE IF EXISTS quire_test CASCADE")
