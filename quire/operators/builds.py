"""Builds as files and back: what build_books yields, completed and written as the four JSON files of a book, and such files shredded into the same relation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import constraints as C
from quire.operators import spans as S
from quire.operators import validate as V
from quire.operators.structure import NAMES, RELATIONS
from quire.sources import files

#: The files of a build and their shapes: fixed values.
FILES = ("book_profile.json", "structure.json", "units.json", "issues.json")
PLACE = "char_start: INT, char_end: INT"
ZONE = "footnote_zone_top_y DOUBLE, continuation_lines INT, line_pitch DOUBLE"
STRUCTURE = f"""root STRING,
pages ARRAY<STRUCT<page_index: INT, printed_page_number: INT, {PLACE}, evidence: STRING, confidence: DOUBLE, footnote_zone: STRUCT<{ZONE}>>>,
noise_spans ARRAY<STRUCT<id: STRING, type: STRING, {PLACE}, source: STRING>>,
nodes ARRAY<STRUCT<id: STRING, type: STRING, title: STRING, level: INT, parent_id: STRING, children: ARRAY<STRING>, source: STRUCT<{PLACE}, page_start: INT, page_end: INT>, evidence: STRING, confidence: DOUBLE,
  segments: ARRAY<STRUCT<role: STRING, {PLACE}, confidence: DOUBLE>>>>"""
SEGMENT = f"role: STRING, {PLACE}, marker: STRING, footnote_id: STRING, footnote_marker: STRING, placement: STRING, page_index: INT, confidence: DOUBLE, noise_id: STRING"
UNITS = f"""units ARRAY<STRUCT<id: STRING, type: STRING, ordinal: INT, number_raw: STRING, title: STRING, title_variants: ARRAY<STRING>, parent_id: STRING, heading: STRING,
  span: STRUCT<{PLACE}, page_start: INT, page_end: INT>, raw_text: STRING, segments: ARRAY<STRUCT<{SEGMENT}>>,
  foreign_spans: ARRAY<STRUCT<{PLACE}, belongs_to: STRING>>, issue_ids: ARRAY<STRING>, confidence: DOUBLE>>"""
ISSUES = f"""issues ARRAY<STRUCT<id: STRING, type: STRING, severity: STRING, description: STRING, occurrences: ARRAY<STRUCT<unit_id: STRING, {PLACE}, note: STRING>>, confidence: DOUBLE, needs_visual_check: BOOLEAN, candidates: ARRAY<STRING>>>"""
PROFILE = "source_sha256 STRING, source_length_chars INT, line_endings STRING"
#: Fields that each entry of a file's list must have, null or not: fixed values.
FIELDS = {
    ("units.json", "units"): ("id", "type", "ordinal", "title", "parent_id", "span", "raw_text", "segments", "foreign_spans", "issue_ids", "confidence"),
    ("structure.json", "nodes"): ("id", "source"),
    ("structure.json", "noise_spans"): ("id", "char_start", "char_end"),
    ("issues.json", "issues"): ("id", "type", "severity", "description", "confidence"),
}
ROOT = "node_000"
KEEP_NULLS = {"ignoreNullFields": "false"}
_TYPES = dict(c.split() for c in RELATIONS.split(", "))


def _rows(frame: DataFrame, relation: str, **columns: Column | str) -> DataFrame:
    """Rows of the long relation, other columns null."""
    given = {k: F.col(c) if isinstance(c, str) else c for k, c in columns.items()} | {"relation": F.lit(relation)}
    return frame.select("book_id", *[given.get(n, F.lit(None)).cast(_TYPES[n]).alias(n) for n in NAMES if n != "book_id"])


def completed(built: DataFrame, books: DataFrame) -> DataFrame:
    """built with what follows from it: root, children of nodes, texts of units, and the noise within them.

    rows 'root' (ref), 'child' (owner, ref, ordinal), 'raw_text' (owner, note), 'noise_ref' (owner, ref); zones of pages are
    written in one form. Books without rows have none. An empty table gives an empty one.
    """
    zone = F.to_json(F.from_json("note", ZONE), KEEP_NULLS)
    own = built.withColumn("note", F.when((F.col("relation") == "page") & F.col("note").isNotNull(), zone).otherwise(F.col("note")))
    by = Window.partitionBy("book_id", "owner").orderBy("relation", "char_start", "id")
    children = built.where("relation in ('node', 'unit') and owner is not null").withColumn("nth", F.row_number().over(by))
    units = V.relation(built, "unit")
    texts = V.with_text(units.select("book_id", "id", "char_start", "char_end"), books)
    held = S.containing(V.relation(built, "noise").select("book_id", F.col("id").alias("noise"), F.col("char_start").alias("at")), units.select("book_id", "id", F.col("char_start").alias("us"), F.col("char_end").alias("ue")), ["book_id"], "at", "us", "ue", 4096)
    more = [
        _rows(built.where((F.col("relation") == "node") & (F.col("id") == ROOT)), "root", ref="id"),
        _rows(children, "child", owner="owner", ref="id", ordinal="nth"),
        _rows(texts, "raw_text", owner="id", note="span_text"),
        _rows(held, "noise_ref", owner="id", ref="noise"),
    ]
    return reduce(DataFrame.unionByName, more, own)


def _listed(rows: DataFrame, keys: list[str], fields: list[Column], order: list[str], alias: str) -> DataFrame:
    """(keys, alias): rows of a key as an ordered array of structs."""
    each = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("_at"), F.struct(*fields).alias("x"))))
    return rows.groupBy(*keys).agg(F.transform(each, lambda r: r["x"]).alias(alias))


def _values(rows: DataFrame, value: str, order: str, alias: str) -> DataFrame:
    """(book_id, id, alias): the values of an owner as an ordered array."""
    each = F.array_sort(F.collect_list(F.struct(order, F.col(value).alias("x"))))
    return rows.groupBy("book_id", F.col("owner").alias("id")).agg(F.transform(each, lambda r: r["x"]).alias(alias))


def _with(rows: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """rows with the last column of each part, an empty list where a part has none."""
    for part in parts:
        name = part.columns[-1]
        rows = rows.join(part, keys, "left").withColumn(name, F.coalesce(name, F.array().cast(part.schema[name].dataType)))
    return rows


def book_files(whole: DataFrame, profiles: DataFrame) -> DataFrame:
    """(book_id, name, content): the profile, structure, units and issues of every book, from a completed relation.

    profiles is what files.profile tells of the sources. Every field is there, as null where it has no value, and books without
    rows of a kind have an empty list of it.
    """
    rel = lambda name: V.relation(whole, name)
    place, book, own = [F.col("char_start"), F.col("char_end")], ["book_id"], ["book_id", "id"]
    roots = whole.select("book_id").distinct()
    pages = _listed(rel("page"), book, [F.col("page").alias("page_index"), F.col("ordinal").alias("printed_page_number"), *place, F.col("kind").alias("evidence"), "confidence", F.from_json("note", ZONE).alias("footnote_zone")], ["char_start", "page"], "pages")
    noise = _listed(rel("noise"), book, [F.col("id"), F.col("owner").alias("type"), *place, F.nullif("role", F.lit("")).alias("source")], ["char_start", "id"], "noise_spans")
    children = _values(rel("child"), "ref", "ordinal", "children")
    laid = rel("segment").where("kind = 'node'").withColumn("id", F.col("owner"))
    laid = _listed(laid, own, [F.col("role"), *place, F.col("confidence")], ["char_start"], "segments")
    each = _with(rel("node"), [children, laid], own)
    span = F.struct(*place, F.col("page").alias("page_start"), "page_end")
    nodes = _listed(each, book, [F.col("id"), F.col("kind").alias("type"), F.col("note").alias("title"), F.col("role").try_cast("int").alias("level"), F.col("owner").alias("parent_id"), F.col("children"), span.alias("source"), F.col("evidence"), F.col("confidence"), F.col("segments")], ["id"], "nodes")
    top = rel("root").select("book_id", F.col("ref").alias("root"))
    structure = _with(roots.join(top, "book_id", "left"), [pages, noise, nodes], book)

    note, is_note = F.col("note"), F.col("role").isin(*V.NOTE_ROLES)
    of_unit = rel("segment").where("kind = 'unit'").select("*", F.lit(None).cast("string").alias("noise")).unionByName(rel("noise_ref").select("*", F.col("ref").alias("noise")).withColumn("ref", F.lit(None).cast("string")).withColumn("role", F.lit("noise_ref")))
    fields = [F.col("role"), *place, F.when(~is_note, note).alias("marker"), F.col("ref").alias("footnote_id"), F.when(is_note, note).alias("footnote_marker"), F.col("placement"), F.col("page").alias("page_index"), F.col("confidence"), F.col("noise").alias("noise_id")]
    segments = _listed(of_unit.withColumn("id", F.col("owner")).withColumn("last", F.col("noise").isNotNull()), own, fields, ["last", "char_start", "noise"], "segments")
    foreign = _listed(rel("foreign").withColumn("id", F.col("owner")), own, [*place, F.col("ref").alias("belongs_to")], ["char_start", "ref"], "foreign_spans")
    links, variants = _values(rel("unit_issue"), "ref", "ref", "issue_ids"), _values(rel("variant"), "note", "ordinal", "title_variants")
    raw = rel("raw_text").select("book_id", F.col("owner").alias("id"), F.col("note").alias("raw_text"))
    unit = _with(rel("unit").join(raw, own, "left"), [segments, foreign, links, variants], own)
    units = _listed(unit, book, [F.col("id"), F.col("kind").alias("type"), F.col("ordinal"), F.col("ref").alias("number_raw"), F.col("note").alias("title"), F.col("title_variants"), F.col("owner").alias("parent_id"), F.col("role").alias("heading"), span.alias("span"), F.col("raw_text"), F.col("segments"), F.col("foreign_spans"), F.col("issue_ids"), F.col("confidence")], ["ordinal", "id"], "units")

    places = _listed(rel("occurrence").withColumn("id", F.col("owner")), own, [F.col("ref").alias("unit_id"), *place, F.col("note")], ["char_start", "char_end", "ref"], "occurrences")
    candidates = _values(rel("candidate"), "note", "ordinal", "candidates")
    issue = _with(rel("issue"), [places, candidates], own)
    issues = _listed(issue, book, [F.col("id"), F.col("kind").alias("type"), F.col("role").alias("severity"), F.col("note").alias("description"), F.col("occurrences"), F.col("confidence"), F.coalesce(F.col("placement") == "look", F.lit(False)).alias("needs_visual_check"), F.col("candidates")], ["id"], "issues")

    def file(rows: DataFrame, name: str, *columns: str | Column) -> DataFrame:
        return rows.select(F.col("book_id").cast("string").alias("book_id"), F.lit(name).alias("name"), F.to_json(F.struct(*columns), KEEP_NULLS).alias("content"))

    profile = file(profiles, FILES[0], F.col("sha256").alias("source_sha256"), F.col("n_chars").alias("source_length_chars"), F.when(F.col("crlf"), "CRLF").otherwise("LF").alias("line_endings"))
    return profile.unionByName(file(structure, FILES[1], "root", "pages", "noise_spans", "nodes")).unionByName(file(_with(roots, [units], book), FILES[2], "units")).unionByName(file(_with(roots, [issues], book), FILES[3], "issues"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(book_id, name, content, problem): the files of stored builds, folder/BOOK/NAME; what is no UTF-8 has a null content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{" + ",".join(FILES) + "}").load(folder)
    text = F.col("content").cast("string")
    part = lambda i: F.element_at(F.split("path", "/"), i)
    return found.select(part(-2).alias("book_id"), part(-1).alias("name"), F.when(F.is_valid_utf8(text), F.regexp_replace(text, "^﻿", "")).alias("content"), files.json_problem(F.col("content")).alias("problem"))


def _parsed(found: DataFrame, name: str, shape: str) -> DataFrame:
    return found.where(F.col("name") == name).select("book_id", F.from_json("content", shape).alias("j")).where("j is not null").select("book_id", "j.*")


def relation_of(found: DataFrame) -> DataFrame:
    """The long relation of stored builds, completed, from read_files. Files that cannot be parsed, and keys of other shapes, have no rows."""
    structure, units, issues = _parsed(found, FILES[1], STRUCTURE), _parsed(found, FILES[2], UNITS), _parsed(found, FILES[3], ISSUES)
    place = lambda c: {"char_start": f"{c}.char_start", "char_end": f"{c}.char_end"}
    each = lambda frame, c, *keep: frame.select("book_id", *keep, F.explode(c).alias("x"))
    nodes, unit, issue = each(structure, "nodes"), each(units, "units"), each(issues, "issues")
    listed = lambda frame, c: frame.select("book_id", F.col("x.id").alias("owner"), F.posexplode(f"x.{c}").alias("at", "y"))
    segments = listed(unit, "segments")
    is_ref = F.coalesce(F.col("y.role") == "noise_ref", F.lit(False))
    occurrence = issue.select("book_id", F.col("x.id").alias("owner"), F.col("x.type").alias("kind"), F.explode("x.occurrences").alias("y"))
    parts = [
        _rows(structure.where("root is not null"), "root", ref="root"),
        _rows(each(structure, "pages"), "page", id=F.col("x.page_index"), kind="x.evidence", page="x.page_index", ordinal="x.printed_page_number", confidence="x.confidence", note=F.to_json("x.footnote_zone", KEEP_NULLS), **place("x")),
        _rows(each(structure, "noise_spans"), "noise", id="x.id", kind=F.lit("noise"), owner="x.type", role=F.coalesce("x.source", F.lit("")), **place("x")),
        _rows(nodes, "node", id="x.id", kind="x.type", owner="x.parent_id", role=F.coalesce(F.col("x.level").cast("string"), F.lit("")), page="x.source.page_start", page_end="x.source.page_end", confidence="x.confidence", note="x.title", evidence="x.evidence", **place("x.source")),
        _rows(listed(nodes, "children"), "child", owner="owner", ref="y", ordinal=F.col("at") + 1),
        _rows(listed(nodes, "segments"), "segment", kind=F.lit("node"), owner="owner", role="y.role", confidence="y.confidence", **place("y")),
        _rows(unit, "unit", id="x.id", kind="x.type", owner="x.parent_id", role="x.heading", ordinal="x.ordinal", page="x.span.page_start", page_end="x.span.page_end", ref="x.number_raw", note="x.title", confidence="x.confidence", **place("x.span")),
        _rows(unit.where("x.raw_text is not null"), "raw_text", owner="x.id", note="x.raw_text"),
        _rows(listed(unit, "title_variants"), "variant", owner="owner", ordinal="at", note="y"),
        _rows(segments.where(~is_ref), "segment", kind=F.lit("unit"), owner="owner", role="y.role", placement="y.placement", page="y.page_index", confidence="y.confidence", ref="y.footnote_id", note=F.coalesce("y.footnote_marker", "y.marker"), **place("y")),
        _rows(segments.where(is_ref), "noise_ref", owner="owner", ref="y.noise_id"),
        _rows(listed(unit, "foreign_spans"), "foreign", owner="owner", ref="y.belongs_to", **place("y")),
        _rows(listed(unit, "issue_ids"), "unit_issue", owner="owner", ref="y"),
        _rows(issue, "issue", id="x.id", kind="x.type", role="x.severity", note="x.description", confidence="x.confidence", placement=F.when(F.col("x.needs_visual_check"), "look")),
        _rows(occurrence, "occurrence", owner="owner", kind="kind", ref="y.unit_id", note="y.note", **place("y")),
        _rows(listed(issue, "candidates"), "candidate", owner="owner", ordinal="at", note="y"),
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_profiles(found: DataFrame) -> DataFrame:
    """(book_id, sha256, n_chars, crlf) as the stored profiles have it."""
    return _parsed(found, FILES[0], PROFILE).select("book_id", F.col("source_sha256").alias("sha256"), F.col("source_length_chars").cast("long").alias("n_chars"), (F.col("line_endings") == "CRLF").alias("crlf"))


def tree_violations(whole: DataFrame) -> list[DataFrame]:
    """Violations of trees: a root, a parent or a child that is not there, a child that names another parent, a unit's unknown noise, and nodes that do not hang on the root."""
    known = whole.where("relation in ('node', 'unit')").select("book_id", F.col("id").alias("ref"), F.col("relation").alias("what"), F.col("owner").alias("parent"))
    child = V.relation(whole, "child").select("book_id", "owner", "ref")
    met = child.join(known, ["book_id", "ref"], "left")
    roots, nodes = V.relation(whole, "root"), known.where("what = 'node'")
    noise = V.relation(whole, "noise").select("book_id", F.col("id").alias("ref"))
    book, link = F.col("book_id"), F.concat_ws(" ", "owner", "ref")
    lost = C.unreachable(nodes.select("book_id", F.col("ref").alias("id"), "parent"), roots.select("book_id", F.col("ref").alias("id")), ["book_id"], "id", "parent")
    return [
        C.violations(roots.join(nodes, ["book_id", "ref"], "left_anti"), "tree", "error", book, F.concat(F.lit("root "), "ref")),
        C.violations(met.where("what is null"), "tree", "error", book, link),
        C.violations(met.where("what = 'node' and not (parent <=> owner)"), "tree", "error", book, link),
        C.violations(lost, "tree", "error", book, F.concat(F.lit("not below the root: "), "id")),
        C.violations(V.relation(whole, "noise_ref").join(noise, ["book_id", "ref"], "left_anti"), "refs", "error", book, link),
    ]


def stored_violations(found: DataFrame, whole: DataFrame, books: DataFrame, profiles: DataFrame) -> list[DataFrame]:
    """Violations of stored builds: files, profiles, fields, trees and stored texts, and all of validate.violations.

    found and whole are read_files and relation_of, which should be a table; books(book_id, text) and profiles (files.profile) are the sources.
    Builds of unknown sources have no text, so that their places are out of range.
    """
    required = found.sparkSession.createDataFrame([(name,) for name in FILES], "name string")
    differ = V.profile_differences(stored_profiles(found), profiles)
    lacks = []
    for (name, field), keys in FIELDS.items():
        entries = found.where(F.col("name") == name).select("book_id", F.explode(F.from_json("content", f"{field} ARRAY<MAP<STRING, STRING>>")[field]).alias("x"))
        missing = F.array_except(F.array(*map(F.lit, keys)), F.map_keys("x"))
        lacks.append(C.violations(entries.where(F.size(missing) > 0), "schema", "error", F.col("book_id"), F.concat_ws(" ", F.col("x")["id"], F.array_join(missing, ","))))
    spans = V.relation(whole, "unit").select("book_id", F.col("id").alias("owner"), "char_start", "char_end").join(V.relation(whole, "raw_text").select("book_id", "owner", F.col("note").alias("raw_text")), ["book_id", "owner"])
    wrong = V.with_text(spans, books).where("raw_text <> span_text")
    return [
        V.file_violations(found, required),
        C.violations(differ, "profile", "error", F.col("book_id"), F.col("field")),
        *lacks,
        C.violations(wrong, "offset_text", "error", F.col("book_id"), F.col("owner")),
        *tree_violations(whole),
        *V.violations(whole, books),
    ]
