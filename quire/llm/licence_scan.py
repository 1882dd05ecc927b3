"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds every template once and gives, for each token streamed, the longest match that ends
there (the matching statistics); the states that its suffix links lead to give the shorter matches that end
there in other places. A match that neither side can extend counts, if it has MIN_MATCH tokens or more, for
each of its places, so what is found of a template does not depend on the other templates. Matches are chained
per template, in order in both text and template; the share of a template's tokens that the best chain covers
is its score, and COVER or more earns its label. Base phrases are templates too: a place of a phrase is a
token at which the phrase ends inside the current match.

The automaton is built from fixed texts on the driver and is broadcast (some thousand states). A file is
scanned in one pass whose memory is its tokens; files are rows, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left as bisect
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._shared import small_batches, table

#: Base phrases of the contract: fixed values.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Licence texts and notices as their publishers word them: fixed values.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License."),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Fewest tokens of a match that counts, share of a template that its chain must cover, and most words between two matches of a chain.
MIN_MATCH, COVER, MAX_GAP = 3, 0.8, 40

#: Letters A-Z become small; what is no word byte becomes a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z lower-cased first."""
    return (text or "").encode().translate(_BYTES).split()


@dataclass
class Automaton:
    """Generalised suffix automaton of token sequences; state 0 is the empty match."""

    vocabulary: dict = field(default_factory=dict)
    step: list = field(default_factory=lambda: [{}])
    link: list = field(default_factory=lambda: [-1])
    longest: list = field(default_factory=lambda: [0])
    places: list = field(default_factory=lambda: [set()])
    labels: list = field(default_factory=list)
    sizes: list = field(default_factory=list)
    ends: list = field(default_factory=list)
    n_phrases: int = 0
    endings: list = field(default_factory=list)
    words: list = field(default_factory=list)
    shorter: list = field(default_factory=list)

    def _state(self, longest: int, step: dict) -> int:
        self.step.append(step)
        self.link.append(0)
        self.longest.append(longest)
        self.places.append(set())
        return len(self.step) - 1

    def _extend(self, last: int, token: int) -> int:
        """The state of the sequence so far followed by token."""
        known = self.step[last].get(token)
        if known is not None and self.longest[known] == self.longest[last] + 1:
            return known
        if known is not None:
            return self._split(last, token, known)
        new = self._state(self.longest[last] + 1, {})
        at = last
        while at >= 0 and token not in self.step[at]:
            self.step[at][token] = new
            at = self.link[at]
        if at >= 0:
            target = self.step[at][token]
            self.link[new] = target if self.longest[target] == self.longest[at] + 1 else self._split(at, token, target)
        return new

    def _split(self, at: int, token: int, target: int) -> int:
        """Give the shorter matches of target a state of their own and lead there what meant them."""
        part = self._state(self.longest[at] + 1, dict(self.step[target]))
        self.link[part], self.link[target] = self.link[target], part
        while at >= 0 and self.step[at].get(token) == target:
            self.step[at][token] = part
            at = self.link[at]
        return part

    def add(self, label: str, words: list[bytes]) -> None:
        which, state = len(self.sizes), 0
        self.labels.append(label)
        self.sizes.append(len(words))
        self.words.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
        for i, token in enumerate(self.words[-1], 1):
            state = self._extend(state, token)
            self.places[state].add((which, i))
        self.ends.append(state)

    def finish(self) -> Automaton:
        """Hand every state's places on to its shorter matches, and list by state the phrases that end in its match and the places of its shorter matches alone."""
        by_length = sorted(range(1, len(self.step)), key=self.longest.__getitem__)
        for s in reversed(by_length):
            if self.link[s] > 0:
                self.places[self.link[s]] |= self.places[s]
        self.endings, self.shorter = ([[] for _ in self.step] for _ in range(2))
        for s in by_length:
            link = self.link[s]
            self.endings[s] = [k for k in range(self.n_phrases) if self.ends[k] == s] + self.endings[link]
            self.shorter[s] = [(k, p, self.longest[link]) for k, p in sorted(self.places[link] - self.places[s])] + self.shorter[link] if link > 0 else []
        self.places = [sorted(p) for p in self.places]
        return self

    def matches(self, state: int, length: int, following: int | None) -> Iterator[tuple[int, int, int]]:
        """(template, its end there, length) of every match that ends at the current token and that the following token does not extend."""
        for k, p in self.places[state]:
            if p == self.sizes[k] or self.words[k][p] != following:
                yield k, p, length
        for k, p, n in self.shorter[state]:
            if p == self.sizes[k] or self.words[k][p] != following:
                yield k, p, n


def build(phrases=PHRASES, templates=TEMPLATES) -> Automaton:
    a = Automaton()
    for label, text in phrases:
        a.add(label, words_of(text))
    a.n_phrases = len(phrases)
    for label, text in templates:
        a.add(label, words_of(text))
    return a.finish()


def statistics(a: Automaton, ids: list[int]):
    """Stream tokens: for each, the state and length of the longest match that ends there."""
    state = length = 0
    for t in ids:
        while state and t not in a.step[state]:
            state = a.link[state]
            length = a.longest[state]
        state = a.step[state].get(t, 0)
        length = length + 1 if state else 0
        yield state, length


def chains(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """For each match (text end, template end, length) the best chain that ends with it: (template tokens covered, text begin, text end).

    A chain's matches are in order in both, at most MAX_GAP words apart. A match may overlap its predecessor; it
    then counts with what lies past it in both. Of chains that cover as much the shortest is taken. Only matches
    within reach are compared, so the time grows with the text and not with its square.
    """
    reach = MAX_GAP + max((n for _, _, n in matches), default=0)
    near: deque = deque()
    out = []
    for e, p, n in sorted(set(matches)):
        while near and near[0][0] < e - reach:
            near.popleft()
        top = (n, e - n)
        for e0, p0, (have, begin) in near:
            if e0 < e and p0 < p and e - n - e0 <= MAX_GAP:
                top = max(top, (have + min(n, e - e0, p - p0), begin))
        near.append((e, p, top))
        out.append((*top, e))
    return out


def covered_spans(matches: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Chains that cover least template tokens or more, the best first and none overlapping another, in text order.

    What lies between accepted chains is chained again without them, until nothing more is accepted.
    """
    accepted, open_parts = [], [matches]
    while open_parts:
        part = open_parts.pop()
        taken: list[tuple[int, int, int]] = []  # in text order
        for have, begin, end in sorted((c for c in chains(part) if c[0] >= least), key=lambda c: (-c[0], c[2] - c[1], c[1])):
            at = bisect(taken, begin, key=lambda c: c[1])
            if (not at or taken[at - 1][2] <= begin) and (at == len(taken) or taken[at][1] >= end):
                taken.insert(at, (have, begin, end))
        if taken:
            accepted += taken
            rest: dict[int, list] = {}
            for e, p, n in part:
                at = bisect(taken, e - n, key=lambda c: c[1])
                if (not at or taken[at - 1][2] <= e - n) and (at == len(taken) or taken[at][1] >= e):
                    rest.setdefault(at, []).append((e, p, n))
            open_parts += rest.values()
    return sorted(accepted, key=lambda c: c[1])


def scan(a: Automaton, text: str | None, min_match: int = MIN_MATCH, cover: float = COVER) -> dict:
    """One file: number of words, places of base phrases, labels, the best cover of a template, and spans.

    spans has every place of a base phrase and every chain that earns its template's label, as (template,
    label, first_word, last_word, cover); templates count on from the phrases, and last_word is inclusive.
    """
    words = words_of(text)
    n = len(words)
    ids = np.fromiter((a.vocabulary.get(w, -1) for w in words), np.int64, n)
    known = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
    begins, ends = known[::2], known[1::2]
    # a match lies within a run of known tokens, so shorter runs hold neither matches that count nor phrases
    fewest = min([min_match, *a.sizes[: a.n_phrases]])
    long_enough = ends - begins >= fewest
    base, found = [], {}
    for b, e in zip(begins[long_enough].tolist(), ends[long_enough].tolist()):
        run = ids[b:e].tolist()
        for i, (state, length) in enumerate(statistics(a, run), 1):
            for k in a.endings[state]:
                if a.sizes[k] <= length:
                    base.append((k, b + i - a.sizes[k], b + i))
            if length >= min_match:
                for k, p, size in a.matches(state, length, run[i] if i < len(run) else None):
                    if size >= min_match:
                        found.setdefault(k, []).append((b + i, p, size))
    best = {k: max(have for have, _, _ in chains(m)) / a.sizes[k] for k, m in found.items()}
    spans = {place: 1.0 for place in base}
    for k in (k for k, x in best.items() if x >= cover):
        spans |= {(k, begin, end): have / a.sizes[k] for have, begin, end in covered_spans(found[k], cover * a.sizes[k]) if (k, begin, end) not in spans}
    starts = [begin for _, begin, _ in base]
    return {
        "n_words": n, "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({a.labels[k] for k, _, _ in base})), "labels": ",".join(sorted({a.labels[k] for k, _, _ in spans})), "score": min(1.0, max(best.values(), default=0.0)),
        "spans": [dict(zip(SPAN, (k, a.labels[k], begin, end - 1, x))) for (k, begin, end), x in sorted(spans.items(), key=lambda y: (y[0][1], y[0]))],
    }


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<template:int,label:string,first_word:long,last_word:long,cover:double>>"
SPAN = {"template": pa.int32(), "label": pa.string(), "first_word": pa.int64(), "last_word": pa.int64(), "cover": pa.float64()}


def scan_files(docs: DataFrame, automaton: Automaton | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Scan every whole text. Returns (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    spans are the accepted templates with their places, see scan(); labels are theirs. One row per row of docs,
    repeated rows and null ids included. Null and empty texts have no words, no places, empty labels and score 0.
    Places of one phrase may overlap and are all counted. A task holds one file's words at a time. Other columns
    are left out, so their names cannot clash. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(automaton or build())

    @F.arrow_udf(COLUMNS)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [scan(shared.value, t.as_py()) for t in texts]
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "score": pa.float64(), "spans": pa.list_(pa.struct(list(SPAN.items())))}
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kinds.get(k, pa.string())) for k in names], names)

    out = docs.select(F.col(id_column).alias("doc_id"), scanned(F.col(text_column)).alias("found"))
    return out.select("doc_id", "found.*")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, which need no spans."""
    return scan_files(table(spark, sf_dir, "documents")).drop("spans")
