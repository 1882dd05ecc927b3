"""Normalizers and offsets, with marks, joiners, astral characters and odd white space."""

import re

from pyspark.sql import functions as F

from quire.functions import text as T

SAMPLES = ["قَالَ رَسُولُ اللَّهِ", " الإيمان  بالله\t‏و ١٢٣ ", "😀 a b\x1c c", "", "a\r\nb", "كتــاب", "ة ى ک", "مُّ"]
DROP = re.compile("[ً-ْٰۖ-ۭـ‌-‏﻿]")


def fold(c):
    return c.translate(str.maketrans(T.LETTERS_FROM + T.DIGITS_FROM, T.LETTERS_TO + T.DIGITS_TO))


def view(s):
    out = []
    for i, c in enumerate(s):
        if DROP.match(c):
            continue
        c = " " if c.isspace() else fold(c)
        if c == " " and out and out[-1][1] == " ":
            continue
        out.append((i, c))
    return out


def frame(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "k int, t string")


def test_views_and_norms(spark):
    for r in frame(spark).select("k", T.with_offsets(F.col("t")).alias("v"), T.ENGINE.apply(F.col("t")).alias("n"), T.QUOTE.apply(F.col("t")).alias("q"), T.PAGES.apply(F.col("t")).alias("p")).collect():
        s = SAMPLES[r["k"]]
        assert [(x["p"], x["ch"]) for x in r["v"]] == view(s)
        assert r["n"] == "".join(c for _, c in view(s)).strip()
        kept = "".join(fold(c) if c.isalnum() else " " for c in s if not DROP.match(c))
        assert r["q"] == " ".join(kept.split())
        assert r["p"] == "".join(c for c in s if not c.isspace() and not (DROP.match(c) and c != "﻿"))


def test_find_all_is_overlapping_and_ends_at_letters(spark):
    rows = spark.createDataFrame([("اااا", "اا"), ("قَالَ قَالَ", "قال"), ("xx", ""), ("😀ab ab", "ab")], "t string, n string")
    got = [[(x["char_start"], x["char_end"]) for x in r["o"]] for r in rows.select(T.find_all(F.col("t"), F.col("n")).alias("o")).collect()]
    assert got == [[(0, 2), (1, 3), (2, 4)], [(0, 4), (6, 10)], [], [(1, 3), (4, 6)]]


def test_matches_with_offsets(spark):
    rows = spark.createDataFrame([("😀12 a 345",), ("none",), ("7",)], "t string")
    got = [[(x["char_start"], x["char_end"], x["value"]) for x in r["m"]] for r in rows.select(T.matches_with_offsets(F.col("t"), "[0-9]+").alias("m")).collect()]
    assert got == [[(1, 3, "12"), (6, 9, "345")], [], [(0, 1, "7")]]


def test_small_measures(spark):
    row = spark.createDataFrame([("قَا ل",)], "t string").select(
        T.mark_ratio(F.col("t")).alias("r"), T.mark_ratio(F.lit("123")).alias("none"), T.letter_pairs(F.lit("abc d"), "a-z").alias("p"), T.to_int(F.lit("١٢")).alias("i"), T.to_int(F.lit("x")).alias("x"),
        T.snippet(F.lit("a\nb" + "x" * 60)).alias("s"), T.trimmed_span(F.lit("  ab \n"), F.lit(0), F.lit(6)).alias("span"), T.standalone(F.lit(" - "), F.lit(" 12.")).alias("no"), T.standalone(F.lit(" - "), F.lit(" 12."), digits=True).alias("yes"), T.at_line_edge(F.lit("ab "), F.lit(" .")).alias("edge"),
    ).first()
    assert abs(row["r"] - 1 / 3) < 1e-9 and row["none"] == 0.0 and row["p"] == ["ab", "bc", "1d"] and (row["i"], row["x"]) == (12, None)
    assert row["s"] == "a⏎b" + "x" * 47 + "…" and tuple(row["span"]) == (2, 4) and (row["no"], row["yes"], row["edge"]) == (False, True, True)
