"""A text as the book operators read it (lines, a normalized view with the way back), and labels painted on it by break points.

Nothing here keeps a value per character but two arrays of the view; a painted book has as many pieces as it has
changes of label, and lookups are bisections.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np

from quire.functions import text as T

FOLD = str.maketrans(T.LETTERS_FROM + T.DIGITS_FROM, T.LETTERS_TO + T.DIGITS_TO)
Span = tuple[int, int]


def _ranges(chars: str) -> Iterator[int]:
    """Code points of a character class without escapes."""
    at = 0
    while at < len(chars):
        last = at + 2 if chars[at + 1 : at + 2] == "-" else at
        yield from range(ord(chars[at]), ord(chars[last]) + 1)
        at = last + 1


#: By code point, as far as normalizing looks: what vanishes, and what is white space.
DROPPED, SPACE = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
DROPPED[list(_ranges(T.ENGINE.drop))] = True
SPACE[[c for c in range(1 << 16) if chr(c).isspace()]] = True
#: The view's character by code point: white space as a space, letters and digits folded.
VIEW = np.arange(1 << 16, dtype="<u4")
VIEW[list(FOLD)] = list(FOLD.values())
VIEW[SPACE] = 32
_DROP, _CHANGED = re.compile(f"[{T.ENGINE.drop}]"), re.compile(f"[{T.ENGINE.drop}{T.LETTERS_FROM}{T.DIGITS_FROM}]")


def normal(text: str) -> str:
    """A needle in the form of the view: marks dropped, letters and digits folded, one space between words."""
    if not text.isascii() and _CHANGED.search(text):
        text = _DROP.sub("", text.translate(FOLD))
    return " ".join(text.split())


class Reading:
    """A text with its lines and its normalized view."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.minimum(codes, (1 << 16) - 1)
        kept = np.flatnonzero(~DROPPED[low])
        blank = SPACE[low[kept]]
        again = np.zeros(len(blank), bool)
        again[1:] = blank[1:] & blank[:-1]
        self.places = kept[~again]
        codes_kept, low = codes[self.places], low[self.places]
        self.flat = np.where(codes_kept == low, VIEW[low], codes_kept).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        self.starts = [0, *(np.flatnonzero(codes == 10) + 1).tolist()]

    # --- lines

    def line_at(self, p: int) -> int:
        return bisect_right(self.starts, p) - 1

    def line(self, i: int) -> Span:
        """A line's start and end, its line end left out."""
        return self.starts[i], self.starts[i + 1] - 1 if i + 1 < len(self.starts) else self.n

    def line_start(self, p: int) -> int:
        return self.starts[self.line_at(p)]

    def beside(self, span: Span) -> tuple[Span, Span]:
        """What stands before and after a span on the lines that it touches."""
        s, e = span
        return (self.line_start(s), s), (e, self.line(self.line_at(max(s, e - 1)))[1])

    def lines(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(number, start, end) of the lines that begin in a span."""
        for i in range(bisect_left(self.starts, start), bisect_left(self.starts, end)):
            yield i, *self.line(i)

    # --- the view

    def to_view(self, p: int) -> int:
        """The first place of the view that does not come before p."""
        return int(np.searchsorted(self.places, p))

    def find(self, text: str, start: int = 0, end: int | None = None) -> list[Span]:
        """Every normalized occurrence within a span, overlapping ones too, as source spans that end after their last letter."""
        needle, end, out = normal(text), self.n if end is None else end, []
        at = self.flat.find(needle, self.to_view(start)) if needle else -1
        while at >= 0:
            span = int(self.places[at]), int(self.places[at + len(needle) - 1]) + 1
            if span[0] >= end:
                break
            if span[1] <= end:
                out.append(span)
            at = self.flat.find(needle, at + 1)
        return out

    def pick(self, spec: dict | None, start: int = 0, end: int | None = None) -> Span | None:
        """The occurrence that a spec of text and number (from 1, or last) names."""
        found = self.find(str(spec["text"]), start, end) if spec and spec.get("text") else []
        which = (spec or {}).get("occurrence", 1)
        if which == "last":
            return found[-1] if found else None
        return found[which - 1] if isinstance(which, int) and 0 < which <= len(found) else None

    def trimmed(self, span: Span) -> Span:
        """A span without white space at its ends; empty if there is nothing else."""
        part = self.text[span[0] : span[1]]
        start = span[1] - len(part.lstrip())
        return start, max(start, span[0] + len(part.rstrip()))


class Label(NamedTuple):
    """What a piece of text belongs to: a unit (by its place among the units) or node in a role, or noise of a kind; tag names a footnote or anchor, or an override."""

    kind: str
    owner: int | str
    role: str = ""
    tag: str = ""


class Canvas:
    """Labels over [0, n), as places where the label changes."""

    def __init__(self, n: int):
        self.n, self.at, self.labels = n, [0], [None]

    def _cut(self, p: int) -> int:
        """The piece that begins at p, which begins there now."""
        if p >= self.n:
            return len(self.at)
        i = bisect_left(self.at, p)
        if i == len(self.at) or self.at[i] != p:
            self.at.insert(i, p)
            self.labels.insert(i, self.labels[i - 1])
        return i

    def paint(self, span: Span, label: Label, over: Callable[[Label | None], bool] | None = None) -> None:
        """Label a span, or what of it has a label that satisfies over."""
        s, e = max(0, span[0]), min(self.n, span[1])
        if s >= e:
            return
        a = self._cut(s)
        b = self._cut(e)
        if over is None:
            self.at[a:b], self.labels[a:b] = [s], [label]
        else:
            self.labels[a:b] = [label if over(x) else x for x in self.labels[a:b]]

    def __getitem__(self, p: int) -> Label | None:
        return self.labels[bisect_right(self.at, p) - 1]

    def pieces(self, start: int, end: int) -> Iterator[tuple[int, int, Label | None]]:
        """What a span consists of, in order."""
        i = bisect_right(self.at, start) - 1
        while i < len(self.at) and self.at[i] < end:
            stop = self.at[i + 1] if i + 1 < len(self.at) else self.n
            if max(start, self.at[i]) < min(end, stop):
                yield max(start, self.at[i]), min(end, stop), self.labels[i]
            i += 1

    def visible(self, read: Reading, start: int, end: int) -> Iterator[tuple[int, int, Label | None]]:
        """The pieces of a span that have other than white space, without it at their ends."""
        for s, e, label in self.pieces(start, end):
            s, e = read.trimmed((s, e))
            if s < e:
                yield s, e, label

    def runs(self, read: Reading) -> Iterator[tuple[int, int, Label | None]]:
        """Longest runs of one label, white space between and around them not counting."""
        last = None
        for s, e, label in self.visible(read, 0, self.n):
            if last and last[2] == label:
                last = (last[0], e, label)
                continue
            if last:
                yield last
            last = (s, e, label)
        if last:
            yield last
