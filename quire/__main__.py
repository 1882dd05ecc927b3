"""Command line: python -m quire COMMAND ... on files of this machine.

discover TEXTS [--config F]                     common lines, heading candidates, markers, configured headings not found
pages TEXTS PAGES --out FOLDER                  align page texts (JSON lists of {text, height, lines} by book) and write pages.json
build TEXTS [--config F] [--overrides F] [--pages F] --out FOLDER   write each book's profile, structure, units and issues
validate (as build)                             build, print and write the report of the constraints
prepare (as build) [--units a,b]                write the reading sheets of all or some units
check DRAFTS (as prepare, TEXTS by --texts)     check drafted statements and write knowledge_objects.json
diff (as build) --against FOLDER [--approve]    compare a build with a stored one; --approve stores it if it has no errors

validate, prepare, check and diff take --build FOLDER: the stored files of builds, FOLDER/BOOK/*.json, in place of a new one.

Ends with 0, with 1 if there are errors, rejections or differences, with 2 if a source or an input cannot be read.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import builds, compare, constraints, discover, knowledge, layout, pages, sheets, spans, structure, validate
from quire.sources import files, outputs, scratch


def _text(path: str | None) -> str | None:
    return Path(path).read_text(encoding="utf-8") if path else None


def _discover(books: DataFrame) -> int:
    """Print what settings could be made of the texts."""
    lines = scratch.written(spans.line_table(books, "book_id", "text"), "lines")
    discover.figures(lines).show(100, truncate=False)
    discover.common_lines(lines).orderBy("book_id", F.desc("n"), "first_at").show(1000, truncate=False)
    discover.heading_candidates(lines).orderBy("book_id", F.desc("strong"), "line_no").show(1000, truncate=False)
    heads = F.from_json("config", "unit_headings ARRAY<STRING>")["unit_headings"]
    named = F.transform(heads, lambda h: F.coalesce(F.get_json_object(h, "$.text"), h))
    discover.missing_headings(books.withColumn("headings", named)).show(1000, truncate=False)
    return 0


def _pages(spark: SparkSession, texts: DataFrame, path: str, out: str) -> int:
    """Align printed lines, a file BOOK.json for each book or one file for the only book, and place the books' lines on them."""
    named = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    only = [r[0] for r in texts.select("book_id").limit(2).collect()]
    book = F.lit(only[0]) if len(only) == 1 and not Path(path).is_dir() else named
    printed = files.read_pdf_lines(spark, path).select(book.alias("book_id"), (F.col("page") + 1).alias("page_index"), "height", "line", "bbox", "text")
    whole = printed.groupBy("book_id", "page_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("text"))
    model = scratch.written(pages.align(texts, whole), "page-model")
    lines = scratch.written(spans.line_table(texts, "book_id", "text"), "lines")
    held = spans.containing(lines, model.select("book_id", "page_index", F.col("char_start").alias("ps"), F.col("char_end").alias("pe")), ["book_id"], "char_start", "ps", "pe", 4096)
    placed = layout.match_lines(held.select("book_id", "line_no", "page_index", F.col("line").alias("text")), printed.select("book_id", "page_index", "line", F.col("bbox")[1].alias("y0"), "text"))
    every = lines.drop("line").join(placed, ["book_id", "line_no"], "left")
    outputs.write_named(outputs.pages_file(model, every, printed), out)
    return 0


def _check(spark: SparkSession, built: DataFrame, pieces: DataFrame, folder: str, config: dict, wanted: DataFrame | None, out: str) -> int:
    """Gate the drafts of a folder (UNIT.json each), check their objects and write what is accepted and rejected."""
    drafts = spark.read.text(f"{folder}/*.json", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("unit_id"), F.col("value").alias("raw"))
    units = validate.relation(built, "unit").select(F.col("id").alias("unit_id"), "confidence")
    asked = units.select("unit_id") if wanted is None else wanted.toDF("unit_id")
    gated = scratch.written(knowledge.draft_reasons(drafts, asked, units), "drafts")
    sound = gated.where(F.size("reasons") == 0)
    objects = sound.select("unit_id", F.posexplode("draft.objects").alias("object", "o")).select("unit_id", "object", "o.*")
    types = spark.createDataFrame([(t["id"],) for t in config.get("types", []) if "id" in t] or [("",)], "type string")
    checked = scratch.written(knowledge.check_objects(objects, pieces, types), "checked")
    accepted = scratch.written(knowledge.accept(checked, units), "accepted")
    found = scratch.written(knowledge.outcome(gated, checked, accepted, pieces), "outcome")
    outputs.write_named(knowledge.outcome_file(found), out, ())
    return int(not found.where(F.size("rejected") > 0).isEmpty())


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="quire", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["discover", "pages", "build", "validate", "prepare", "check", "diff"])
    parser.add_argument("inputs", nargs="+")
    for name in ("--config", "--overrides", "--pages", "--units", "--against", "--texts", "--sheet-config", "--build"):
        parser.add_argument(name)
    parser.add_argument("--out", default="out")
    parser.add_argument("--approve", action="store_true")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    found = files.profile(files.spread(files.read_texts(spark, a.texts or a.inputs[0])), "book_id", F.col("content"))
    texts = found.select("book_id", "text")
    if texts.where("text is null").count():
        return 2
    if a.command == "pages":
        return _pages(spark, texts, a.inputs[1], a.out)
    given = [F.lit(_text(path)).cast("string").alias(name) for name, path in (("config", a.config), ("overrides", a.overrides), ("pages", a.pages))]
    books = texts.select("book_id", "text", *given)
    if a.command == "discover":
        return _discover(books)
    if a.build:
        stored = scratch.written(builds.read_files(spark, a.build), "stored-files")
        built = scratch.written(builds.relation_of(stored), "stored-builds")
        broken = builds.stored_violations(stored, built, books, found)
    else:
        built = scratch.written(builds.completed(scratch.written(structure.build_books(books), "built-books"), books), "complete-builds")
        broken = [*validate.violations(built, books), *builds.tree_violations(built)]
    if a.command == "build":
        outputs.write_named(builds.book_files(built, found), a.out)
        return 0
    if a.command in ("prepare", "check"):
        import json

        config = json.loads(_text(a.sheet_config) or "{}")
        wanted = spark.createDataFrame([(u,) for u in a.units.split(",")], "id string") if a.units else None
        units = validate.relation(built, "unit")
        some, unknown = sheets.chosen(units, wanted)
        if unknown is not None and not unknown.isEmpty():
            print("unknown unit ids:", ", ".join(sorted(r[0] for r in unknown.collect())), file=sys.stderr)
            return 2
        own = scratch.written(sheets.pieces(built, books, config).join(some.select("book_id", F.col("id").alias("unit_id")), ["book_id", "unit_id"], "left_semi"), "pieces")
        if a.command == "check":
            return _check(spark, built, own, a.inputs[0], config, wanted, a.out)
        each = sheets.sheets(built, own).join(some.select("book_id", F.col("id").alias("unit_id")), ["book_id", "unit_id"], "left_semi")
        for column, ending in (("json", ".json"), ("markdown", ".md")):
            outputs.write_named(each.select("book_id", F.concat("unit_id", F.lit(ending)).alias("name"), F.col(column).alias("content")), a.out)
        return 0
    report = scratch.written(constraints.report([constraints.gathered([*broken, validate.source_violations(found)])]), "report")
    errors = report.where("severity = 'error'")
    if a.command == "validate":
        report.show(100, truncate=False)
        outputs.write_named(outputs.report_file(report, validate.summary(built, books)), a.out, ())
        return int(not errors.isEmpty())
    changed = compare.differences(spark.read.schema(built.schema).parquet(a.against), built, books) if Path(a.against).exists() else None
    if changed is not None:
        changed.orderBy("book_id", "what", "key").show(100, truncate=False)
    if a.approve:
        files.approve(built, errors, a.against)
        return 0
    return int(changed is None or not changed.isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
