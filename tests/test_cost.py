"""What work costs: calls by the characters of a text, sizes of batches, scans of a table."""

import cProfile
import json
import pstats
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import canvas
from quire.operators import constraints as C
from quire.operators import spans as S
from quire.operators import structure as B
from quire.operators import validate as V
from quire.plans import catalog
from quire.sources import scratch


def test_fold_makes_fewer_calls_than_its_text_has_words():
    text = "Head\n" + "\n".join("some words of a rather long line without any mark" for _ in range(2_000))
    with cProfile.Profile() as profile:
        rows = B.fold("b", text, json.dumps({"unit_headings": ["Head"], "garbled": {"latin_max_run_in_arabic": 0}}), None, None)
    assert any(r["relation"] == "unit" for r in rows)
    # Per line a few calls are made (60,000 here); one for each character would make 200,000 and more.
    assert pstats.Stats(profile).total_calls < len(text)


@pytest.mark.parametrize("text", ["", "plain words", "  a\t\tb\n c ", "café naïve", "أَحْمَد ١۲ ﻿ـ ى", "a‌b  c", "\U0001f600 ٱکx", "َ", " َ ", "\x85\x1c"])
def test_view_by_tables_is_the_view_by_characters(text):
    kept = "".join(c for c in text.translate(canvas.FOLD) if not re.match(f"[{T.ENGINE.drop}]", c))
    assert canvas.normal(text) == " ".join(kept.split())
    assert canvas.Reading(text).flat == re.sub(r"\s+", " ", kept)


@pytest.mark.parametrize("longest", [0, 1, 2, 3])
def test_garbled_latin_runs_are_whole_runs(longest):
    text = "xب ab abcبd abcd a1béc ab"
    rows = B.fold("b", text, json.dumps({"garbled": {"latin_max_run_in_arabic": longest, "skip_regions": []}, "front_matter": {"role": "front_matter"}}), None, None)
    found = [(r["char_start"], r["char_end"]) for r in rows if r["relation"] == "noise" and r["owner"] == "garbled_glyph"]
    covered = {p for s, e in found for p in range(s, e) if not text[p].isspace()}
    assert covered == {p for m in re.finditer("[A-Za-z]+", text) if len(m[0]) <= longest for p in range(*m.span())}


def test_white_space_and_marks_are_told_by_one_range_first(spark):
    """Patterns meet every character of every text: each looks at one far range before its members, and stays the same set."""
    assert T.ANY_SPACE.count("&&") == 1
    plan = spark.createDataFrame([("a",)], "text string").select(T.ENGINE.apply(F.col("text")), T.QUOTE.apply(F.col("text")), T.PAGES.apply(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert f"[{T.ENGINE.drop}], ," not in plan and plan.count(f"[{T.FAR}&&[") >= 3
    spaces = [chr(c) for c in range(1 << 16) if chr(c).isspace()]
    dropped = [c for c in map(chr, range(1 << 16)) if re.match(f"[{T.ENGINE.drop}]", c)]
    rows = [(c,) for c in map(chr, range(1, 1 << 16)) if not "\ud800" <= c <= "\udfff"]
    found = spark.createDataFrame(rows, "c string")
    assert sorted(r.c for r in found.where(F.col("c").rlike(T.ANY_SPACE)).collect()) == sorted(spaces)
    vanished = found.select("c", T.ENGINE.apply(F.concat(F.lit("x"), F.col("c"), F.lit("y"))).alias("n"))
    assert sorted(r.c for r in vanished.where("n = 'xy'").collect()) == sorted(dropped)
    seen = {r.c: r.n for r in vanished.collect()}
    assert all(seen[c] == f"x{canvas.normal('a' + c + 'b')[1:-1] if c not in spaces else ' '}y" for c in seen)
    near = spark.createDataFrame([("bana na",)], "text string").select(T.Normalizer("a-b", False, "none").apply(F.col("text")).alias("t"))
    assert near.first().t == "nn"


def documents(spark, folder):
    """A folder with a table documents of some odd texts."""
    texts = ["Head line\n" + "à" * 120, "", None, "\n\n", "a\r\nb\n", "One\nTwo\nThree\n", "é\x85b c"]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(3, "again\n")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["heading_candidates", "most_common_lines", "duplicate_statements", "discover_headings", "discover_figures"])
def test_lines_without_offsets_never_go_to_python(spark, tmp_path, name):
    assert "MapInArrow" not in plan(catalog.QUERIES[name](spark, documents(spark, tmp_path)))


def test_numbered_lines_are_those_of_the_line_table(spark, tmp_path):
    docs = spark.read.parquet(f"{documents(spark, tmp_path)}/documents.parquet")
    whole = S.line_table(docs, "doc_id", "text").select("doc_id", "line_no", "line")
    cut = S.numbered_lines(docs, "doc_id", "text")
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert [f.dataType for f in cut.schema] == [f.dataType for f in whole.schema]


def test_portions_hold_a_bounded_part_of_a_batch():
    texts = ["x" * 10] * 1000 + ["y" * 5000, None, "", "z"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["k", "t"])
    parts = list(S.portions(batch, 1, 500))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert max(sum(len(t or "") for t in p.column(1).to_pylist()) for p in parts if "y" * 5000 not in p.column(1).to_pylist()) <= 510
    assert list(S.portions(batch.slice(0, 0), 1)) == [] and len(list(S.portions(batch, 1))) == 1


def test_checks_share_one_reading_of_the_texts(spark, tmp_path):
    folder = documents(spark, tmp_path)
    config = F.lit(json.dumps({"unit_headings": ["Head", "Two"], "garbled": {"latin_max_run_in_arabic": 0}}))
    books = spark.read.parquet(f"{folder}/documents.parquet").where("text <> 'again\n'").select(F.col("doc_id").alias("book_id"), "text", config.alias("config"), F.lit(None).cast("string").alias("overrides"))
    built = scratch.written(B.build_books(books), "built")
    found = V.violations(built, books)
    reading = [f for f in found if any(p.startswith(f"file://{folder}") for p in f.inputFiles())]
    assert reading == []  # lengths and texts of spans come from tables that were written once
    assert {r.check for r in C.gathered(found).collect()} >= {"pages"}


def test_texts_of_all_checks_by_one_join(spark):
    """Gaps show, noise and headings are what they are, and only blank text between segments is told."""
    books = spark.createDataFrame([("a", "ab  cd\n \nef"), ("b", None)], "book_id string, text string")
    spans = lambda rows: spark.createDataFrame([("a", "u", s, e) for s, e in rows], "book_id string, owner string, char_start int, char_end int")
    got = V._texts({"gap": spans([(0, 2), (2, 4), (4, 99)]).drop("owner"), "noise": spans([(2, 4)]), "heading": spans([(4, 6)]), "between": spans([(6, 9), (6, 10)])}, books)
    assert {k: sorted((r.owner, r.char_start, r.span_text) for r in rows.collect()) for k, rows in got.items()} == {
        "gap": [(None, 0, "ab")],
        "noise": [("u", 2, "  ")],
        "heading": [("u", 4, "cd")],
        "between": [("u", 6, "\n \n")],
    }
