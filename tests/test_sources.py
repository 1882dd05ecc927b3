"""Sources with byte order marks, broken text and JSON, both forms of page lists."""

import json

import pytest

from pyspark.sql import functions as F

from quire.sources import files


def test_texts_keep_their_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿ab\r\nc😀".encode())
    (tmp_path / "b.txt").write_bytes(b"\xff")
    got = {r["book_id"]: r for r in files.profile(files.read_texts(spark, str(tmp_path)), "book_id", F.col("content")).collect()}
    assert got["a"]["n_chars"] == 7 and got["a"]["crlf"] and got["a"]["bom"] and got["b"]["text"] is None


def test_json_problems(spark, tmp_path):
    for name, raw in {"ok": b'{"a": 1}', "bom": b'\xef\xbb\xbf{"a": 2}', "bad": b"{", "enc": b'{"a": "\xff"}'}.items():
        (tmp_path / f"{name}.json").write_bytes(raw)
    got = {r["path"].split("/")[-1]: (r["value"]["a"] if r["value"] else None, r["problem"]) for r in files.read_json(spark, str(tmp_path), "a INT").collect()}
    assert got == {"ok.json": (1, None), "bom.json": (2, "bom"), "bad.json": (None, "json"), "enc.json": (None, "encoding")}


def test_page_lists(spark, tmp_path):
    page = {"page_index": 1, "printed_page_number": None, "char_start": 0, "char_end": 5, "evidence": "e", "confidence": 0.5}
    (tmp_path / "list.json").write_text(json.dumps([page]))
    (tmp_path / "dict.json").write_text(json.dumps({"pages": [page, page], "txt_lines": [{"char_start": 0, "n": 3}]}))
    got = {r["path"].split("/")[-1]: (len(r["pages"]), r["txt_lines"] and len(r["txt_lines"])) for r in files.read_pages(spark, str(tmp_path)).collect()}
    assert got == {"list.json": (1, None), "dict.json": (2, 1)}


def test_pdf_lines_are_ordered(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"text": "x", "height": 100.0, "lines": [{"bbox": [0.0, 20.0, 50.0, 30.0], "text": "c"}, {"bbox": [0.0, 10.0, 50.0, 20.0], "text": "b"}, {"bbox": [60.0, 10.0, 90.0, 20.0], "text": "a"}]}]))
    assert [r["text"] for r in files.read_pdf_lines(spark, str(tmp_path / "p.json")).orderBy("line").collect()] == ["a", "b", "c"]


def test_guarded_snapshot(spark, tmp_path):
    rows = spark.range(3)
    files.approve(rows, rows.limit(0), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    with pytest.raises(ValueError):
        files.approve(rows, rows, str(tmp_path / "s"))
