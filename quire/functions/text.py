"""Text as the structure operators see it: four normalizers, offsets into the source, and small measures.

Offsets are code points, ends exclusive. Spark's length, substring, instr and split count code points;
regexp_instr counts UTF-16 units and is never used here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks that normalizing drops, and letters and digits that it folds: fixed values.
MARKS = "\u064b-\u0652\u0670\u06d6-\u06ed"
TATWEEL = "\u0640"
JOINERS = "\u200c\u200d\u200e\u200f"
BYTE_ORDER = "\ufeff"
LETTERS_FROM, LETTERS_TO = "أإآٱىیةک", "ااااييهك"
DIGITS_FROM, DIGITS_TO = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789"
#: A range with all characters that normalizing drops or folds; others fail it at once.
FAR = "\u0622-\ufeff"
ARABIC = "\u0621-\u064a\u0671-\u06d3"
PUNCTUATION = r"\-–—•·*_|.:،؛,;!?؟«»()\[\]{}\"'/\\"
#: What Python calls white space, for Java's regular expressions: single characters first, the far ones behind one range that most characters fail.
ANY_SPACE = "[\\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f \u0085\u00a0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"


@dataclass(frozen=True)
class Normalizer:
    """drop: characters that vanish; fold: letters and digits to unify; space: 'one' keeps a single space per run, 'none' removes all; words: whether every run of other than letters and digits counts as space."""

    drop: str
    fold: bool
    space: str
    words: bool = False

    def apply(self, text: Column) -> Column:
        ahead = f"{FAR}&&" if re.fullmatch(f"[-{FAR}]*", self.drop) else ""
        changed = f"[{ahead}[{self.drop}{LETTERS_FROM + DIGITS_FROM if self.fold else ''}]]"
        out = F.regexp_replace(text, f"[{ahead}[{self.drop}]]", "")
        if self.fold:
            out = F.translate(out, LETTERS_FROM + DIGITS_FROM, LETTERS_TO + DIGITS_TO)
        out = F.when(text.rlike(changed), out).otherwise(text)
        if self.words:
            out = F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")
        else:
            out = F.regexp_replace(out, f"{ANY_SPACE}+", " " if self.space == "one" else "")
        return F.trim(out) if self.space == "one" else out


ENGINE = Normalizer(MARKS + TATWEEL + JOINERS + BYTE_ORDER, True, "one")
PAGES = Normalizer(MARKS + TATWEEL + JOINERS, False, "none")
QUOTE = Normalizer(MARKS + TATWEEL + JOINERS + BYTE_ORDER, True, "one", words=True)
LEGACY = Normalizer(MARKS + TATWEEL + "\u200c\u200e\u200f", False, "none")


def let(value: Column, body) -> Column:
    """body of a value that is computed once per row, however often lambdas in body refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _is_space(c: Column) -> Column:
    return c.rlike(f"^{ANY_SPACE}$")


def with_offsets(text: Column, normalizer: Normalizer = ENGINE) -> Column:
    """The normalized text as array<struct<p, ch>>: each character with the source place it comes from, not trimmed."""
    chars = F.transform(F.split(text, ""), lambda c, i: F.struct(i.alias("p"), c.alias("ch")))
    kept = F.filter(chars, lambda x: (x["ch"] != "") & ~x["ch"].rlike(f"[{normalizer.drop}]"))
    if normalizer.fold:
        kept = F.transform(kept, lambda x: F.struct(x["p"].alias("p"), F.translate(x["ch"], LETTERS_FROM + DIGITS_FROM, LETTERS_TO + DIGITS_TO).alias("ch")))
    blank = (lambda c: ~c.rlike(r"[\p{L}\p{N}]")) if normalizer.words else _is_space
    if normalizer.space == "none":
        return F.filter(kept, lambda x: ~blank(x["ch"]))
    spaced = F.transform(kept, lambda x: F.struct(x["p"].alias("p"), F.when(blank(x["ch"]), " ").otherwise(x["ch"]).alias("ch")))
    return let(spaced, lambda all_: F.filter(all_, lambda x, i: ~((x["ch"] == " ") & (i > 0) & (F.get(all_, i - 1)["ch"] == " "))))


def find_all(text: Column, needle: Column, normalizer: Normalizer = ENGINE) -> Column:
    """Every occurrence of a needle, overlapping ones too, as array<struct<char_start, char_end>> in the source.

    Both sides are normalized; an occurrence ends right after its last base letter, so marks behind it stay outside.
    """
    flat = lambda view: F.array_join(F.transform(view, lambda x: x["ch"]), "")

    def places(view: Column, line: Column, pattern: Column) -> Column:
        n = F.length(pattern)
        at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(line), F.lit(1))), lambda i: (n > 0) & (F.substr(line, i, n) == pattern))
        return F.transform(at, lambda i: F.struct(F.get(view, i - 1)["p"].alias("char_start"), (F.get(view, i + n - 2)["p"] + 1).alias("char_end")))

    return let(with_offsets(text, normalizer), lambda view: let(F.struct(flat(view).alias("line"), normalizer.apply(needle).alias("pattern")), lambda x: places(view, x["line"], x["pattern"])))


def matches_with_offsets(text: Column, pattern: str) -> Column:
    """Non-empty matches of a pattern as array<struct<char_start, char_end, value>>, by the lengths of what lies between."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.transform(F.split(text, pattern), lambda b: F.length(b))
    each = let(gaps, lambda gap: F.transform(found, lambda m, i: F.struct(F.get(gap, i).alias("gap"), m.alias("m"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<char_start:int,char_end:int,value:string>>").alias("out"))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("char_start"), end.alias("char_end"), x["m"].alias("value")))).alias("out"))

    return F.aggregate(each, zero, add)["out"]


def digits_beside(line: Column, start: Column, end: Column) -> Column:
    """The digit runs of a line outside a span of it, as matches_with_offsets has them."""
    return F.filter(matches_with_offsets(line, "[0-9٠-٩۰-۹]+"), lambda m: (m["char_end"] <= start) | (m["char_start"] >= end))


def count_of(text: Column, chars: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]", ""))


def mark_ratio(text: Column, marks: str = MARKS, letters: str = ARABIC) -> Column:
    """Marks per letter, 0 without letters."""
    return F.coalesce(F.try_divide(count_of(text, marks), count_of(text, letters)), F.lit(0.0))


def words_with(text: Column, letters: str = ARABIC) -> Column:
    """White-space separated words that have a letter of a class."""
    return F.filter(F.split(text, f"{ANY_SPACE}+"), lambda w: w.rlike(f"[{letters}]"))


def letter_pairs(text: Column, letters: str) -> Column:
    """Pairs of adjacent letters within words, repeats kept; a single letter is a pair with 1 in front."""
    runs = F.regexp_extract_all(text, F.lit(f"([{letters}]+)"), F.lit(1))
    return F.flatten(F.transform(runs, lambda r: F.when(F.length(r) == 1, F.array(F.concat(F.lit("1"), r))).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substr(r, i, F.lit(2))))))


def to_int(text: Column) -> Column:
    """Digits of any of the three scripts as an integer, null if it is none."""
    return F.translate(text, DIGITS_FROM, DIGITS_TO).try_cast("int")


def snippet(text: Column, most: int = 50) -> Column:
    """A text for reports: line ends shown, cut with an ellipsis."""
    shown = F.replace(text, F.lit("\n"), F.lit("⏎"))
    return F.when(F.length(shown) > most, F.concat(F.substring(shown, 1, most), F.lit("…"))).otherwise(shown)


def trimmed_span(text: Column, start: Column, end: Column) -> Column:
    """A span without white space at its ends, as struct<char_start, char_end>."""
    part = F.substr(text, start + 1, end - start)
    left = F.length(part) - F.length(F.regexp_replace(part, f"^{ANY_SPACE}+", ""))
    right = F.length(part) - F.length(F.regexp_replace(part, f"{ANY_SPACE}+$", ""))
    return F.struct((start + left).alias("char_start"), F.greatest(start + left, end - right).alias("char_end"))


def standalone(before: Column, after: Column, digits: bool = False, punctuation: str = PUNCTUATION) -> Column:
    """Whether the rest of the line around a span is white space and punctuation only (and digits, if allowed)."""
    return ~F.concat(before, after).rlike(rf"[^\s{punctuation}{r'\p{N}' if digits else ''}]")


def at_line_edge(before: Column, after: Column, punctuation: str = PUNCTUATION) -> Column:
    return ~before.rlike(rf"[^\s{punctuation}]") | ~after.rlike(rf"[^\s{punctuation}]")
