"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read from both ends by gated recurrent units; the two states label every position
with a probability per language and one for none of them, and a document's probabilities are the mean over all
of its positions. Long texts are read in stretches of WINDOW bytes; a unit begins CONTEXT bytes ahead of its
stretch, so that every position is labelled by a state that has seen what is around it, and long texts are as fast
as short ones. The network is trained here, in numpy, by backpropagation through time, on a bounded sample of
labelled rows and, for the class of none, on letters in random order; texts are scored whole.

Gates and candidate are squashed by x / (1 + |x|), which is cheaper than tanh and has a simple slope.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._shared import free_name, labelled_sample, remainder, small_batches, table

WINDOW, CONTEXT, HIDDEN = 256, 16, 8
#: Bytes of a stretch that is trained on; most labelled rows per language that are fitted; stretches of a training step, and steps.
TRAINED, SAMPLE_PER_LANGUAGE, BATCH, STEPS, RATE = 64, 400, 96, 240, 0.03
#: Stretches that are scored at a time: the memory of a task does not depend on its texts.
LANES = 1024
#: First and last letters of scripts that random letters are drawn from, beside those of the sample.
SCRIPTS = ((0x0100, 0x017F), (0x0370, 0x03FF), (0x0400, 0x04FF), (0x05D0, 0x05EA), (0x0620, 0x064A), (0x0904, 0x0939), (0x0E01, 0x0E30), (0x3041, 0x3096), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
GATES = ("z", "r", "n")


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    x /= 1 + np.abs(x)
    return x


@dataclass
class Network:
    """Weights by name: for each direction d and gate g, T_dg (256, hidden) per byte and U_dg (hidden, hidden); O and b for labels, the languages and none of them."""

    languages: tuple[str, ...]
    w: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages, hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng, w = np.random.default_rng(seed), {}
        for d in "fb":
            for g in GATES:
                w[f"T_{d}{g}"] = (rng.standard_normal((256, hidden)) * 0.5).astype(np.float32)
                w[f"U_{d}{g}"] = (rng.standard_normal((hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        w["O"] = (rng.standard_normal((2 * hidden, len(languages) + 1)) * 0.3).astype(np.float32)
        w["b"] = np.zeros(len(languages) + 1, np.float32)
        return cls(tuple(languages), w)

    def run(self, d: str, codes: np.ndarray, mask: np.ndarray | None = None, keep: list | None = None) -> np.ndarray:
        """States (window, lanes, hidden) of one direction over codes (window, lanes); mask is 0 past a text's end.

        keep collects what backpropagation needs.
        """
        w, (n_steps, lanes) = self.w, codes.shape
        hidden = w["O"].shape[0] // 2
        out = np.empty((n_steps, lanes, hidden), np.float32)
        h = np.zeros((lanes, hidden), np.float32)
        for t in range(n_steps) if d == "f" else range(n_steps - 1, -1, -1):
            z, r = h @ w[f"U_{d}z"], h @ w[f"U_{d}r"]
            z += w[f"T_{d}z"].take(codes[t], axis=0)
            r += w[f"T_{d}r"].take(codes[t], axis=0)
            for gate in (squash(z), squash(r)):
                gate += 1
                gate *= 0.5
            n = (r * h) @ w[f"U_{d}n"]
            n += w[f"T_{d}n"].take(codes[t], axis=0)
            squash(n)
            new = h - n
            new *= z
            new += n
            if mask is not None:
                new *= mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, n))
            out[t] = h = new
        return out

    def label(self, codes: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (window, lanes, languages + 1) of every position."""
        hidden = self.w["O"].shape[0] // 2
        logits = self.run("f", codes, mask) @ self.w["O"][:hidden]
        logits += self.run("b", codes, mask) @ self.w["O"][hidden:]
        logits += self.w["b"]
        if float((np.abs(self.w["O"]).sum(axis=0) + np.abs(self.w["b"])).max()) > 60:
            return softmax(logits)
        p = np.exp(logits, out=logits)  # states are within 1, so no logit is large
        p /= (p.reshape(-1, p.shape[2]) @ np.ones((p.shape[2], 1), p.dtype)).reshape(*p.shape[:2], 1)
        return p

    def gradients(self, codes: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over positions and its gradients, by backpropagation through time."""
        hidden = self.w["O"].shape[0] // 2
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(d, codes, mask, kept[d]) for d in "fb"], axis=2)
        p = softmax(states @ self.w["O"] + self.w["b"])
        lanes, n = np.arange(codes.shape[1]), mask.sum()
        loss = float(-(np.log(p[:, lanes, target] + 1e-9) * mask).sum() / n)
        error = p
        error[:, lanes, target] -= 1
        error *= (mask / n)[:, :, None]
        flat = error.reshape(-1, error.shape[2])
        grads = {"O": states.reshape(-1, 2 * hidden).T @ flat, "b": flat.sum(axis=0)}
        into = error @ self.w["O"].T
        for d, part in (("f", into[:, :, :hidden]), ("b", into[:, :, hidden:])):
            U = {g: self.w[f"U_{d}{g}"] for g in GATES}
            dU, dT = {g: np.zeros_like(U[g]) for g in GATES}, {g: np.zeros((256, hidden), np.float32) for g in GATES}
            dh = np.zeros_like(part[0])
            for t, h, z, r, n_ in reversed(kept[d]):
                dh = (dh + part[t]) * mask[t][:, None]
                a = {"n": dh * (1 - z) * (1 - np.abs(n_)) ** 2}
                back = a["n"] @ U["n"].T
                a["z"] = dh * (h - n_) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                a["r"] = back * h * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                dU["n"] += (r * h).T @ a["n"]
                dU["z"] += h.T @ a["z"]
                dU["r"] += h.T @ a["r"]
                for g in GATES:
                    np.add.at(dT[g], codes[t], a[g])
                dh = dh * z + back * r + a["z"] @ U["z"].T + a["r"] @ U["r"].T
            grads |= {f"U_{d}{g}": dU[g] for g in GATES} | {f"T_{d}{g}": dT[g] for g in GATES}
        return loss, grads


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def windows(data: bytes, width: int = TRAINED) -> tuple[np.ndarray, np.ndarray]:
    """A text's bytes as rows of width, the last filled up with zeros, and the number of bytes in each."""
    n = -(-len(data) // width)
    rows = np.zeros(n * width, np.uint8)
    rows[: len(data)] = np.frombuffer(data, np.uint8)
    sizes = np.full(n, width)
    if n:
        sizes[-1] = len(data) - width * (n - 1)
    return rows.reshape(n, width), sizes


def stretches(sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """For texts of these sizes, one after the other: owner of each stretch, and where its reading begins, its own bytes begin and end, and its reading ends."""
    many = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), many)
    begin = (np.cumsum(sizes) - sizes)[owner]
    end = begin + sizes[owner]
    own = begin + WINDOW * (np.arange(len(owner)) - (np.cumsum(many) - many)[owner])
    return owner, np.maximum(own - CONTEXT, begin), own, np.minimum(own + WINDOW, end), np.minimum(own + WINDOW + CONTEXT, end)


def _mask(sizes: np.ndarray, width: int) -> np.ndarray:
    return (np.arange(width)[:, None] < sizes).astype(np.float32)


def nonsense(texts: list[str], rng: np.random.Generator, n: int) -> list[str]:
    """Texts in no language: letters of the given texts or of another script in random order, with the spaces of a text."""
    alphabet = sorted({c for t in texts for c in t[:2000] if LETTER.match(c)} | {"x"})
    out = []
    for i in range(n):
        like = np.array(list(texts[rng.integers(len(texts))][: 2 * TRAINED]))
        if i % 3 == 0:
            a, b = SCRIPTS[rng.integers(len(SCRIPTS))]
            letters = np.array([chr(c) for c in rng.integers(a, b + 1, len(like))])
        elif i % 3 == 1:
            letters = rng.permutation(like)
        else:
            letters = rng.choice(alphabet, len(like))
        out.append("".join(np.where(np.char.isspace(like), like, letters)))
    return out


def fit(texts: list[str], languages: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 7) -> Network:
    """Train by Adam on stretches drawn at random, every language and none of them as often as any other. Reruns agree."""
    names = sorted(set(languages))
    net = Network.fresh(names, hidden, seed)
    rng = np.random.default_rng(seed)
    some = [t for t in texts if t]
    by_class = [[t for t, x in zip(texts, languages) if x == name and t] for name in names]
    by_class.append(nonsense(some, rng, 600) if some else [])
    cuts = []
    for own in by_class:
        cut = [windows(t.encode()) for t in own]
        cuts.append((np.concatenate([c[0] for c in cut] or [np.zeros((0, TRAINED), np.uint8)]), np.concatenate([c[1] for c in cut] or [np.zeros(0, int)])))
    have = [k for k, (rows, _) in enumerate(cuts) if len(rows)]
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    for step in range(1, steps + 1 if have else 1):
        target = np.array([have[i % len(have)] for i in range(BATCH)])
        picks = [rng.integers(len(cuts[k][0])) for k in target]
        rows = np.stack([cuts[k][0][i] for k, i in zip(target, picks)])
        sizes = np.array([cuts[k][1][i] for k, i in zip(target, picks)])
        _, grads = net.gradients(np.ascontiguousarray(rows.T), _mask(sizes, TRAINED), target)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, texts: list[str | None]) -> np.ndarray:
    """Mean probabilities (texts, languages + 1) over all positions; zeros for texts without bytes."""
    data = [(t or "").encode() for t in texts]
    sizes = np.array([len(x) for x in data], np.int64)
    total = np.zeros((len(texts), len(net.languages) + 1))
    codes = np.frombuffer(b"".join(data), np.uint8)
    owner, begin, own, stop, end = stretches(sizes)
    order = np.argsort(begin - end, kind="stable")  # the longest first, so that a batch reads no more than its longest
    for i in range(0, len(order), LANES):
        at = order[i : i + LANES]
        steps = np.arange(int((end - begin)[at[0]]))[:, None]
        read = steps < (end - begin)[at]
        rows = codes[np.minimum(begin[at] + steps, len(codes) - 1)] * read
        p = net.label(rows.astype(np.uint8), None if read.all() else read.astype(np.float32))
        p *= ((steps >= (own - begin)[at]) & (steps < (stop - begin)[at]))[:, :, None]
        np.add.at(total, owner[at], p.sum(axis=0, dtype=np.float64))
    return total / np.maximum(sizes, 1)[:, None]


def judge(net: Network, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """The best language, its pooled probability and that of none; UNKNOWN, 0 and 1 for texts that are null or have no letters. Ties go to the first language."""
    known = [bool(t and LETTER.search(t)) and bool(net.languages) for t in texts]
    p = pooled(net, [t if k else None for t, k in zip(texts, known)])
    best = p[:, :-1].argmax(axis=1) if len(net.languages) else np.zeros(len(texts), int)
    names = [net.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, [min(1.0, float(row[b])) if k else 0.0 for row, b, k in zip(p, best, known)], [float(row[-1]) if k else 1.0 for row, k in zip(p, known)]


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, fold: int = 2) -> Network:
    """Fit on docs(doc_id, text, lang): rows with a language whose crc32(doc_id as text) mod 4 is not fold.

    Rows with a null id or language and texts without letters take no part; without any others no language is known.
    Of rows that repeat an id, the smallest language and text count.
    """
    known = docs.where(remainder(F.col("doc_id"), 4) != fold).select("doc_id", F.col("lang").alias("label"))
    rows = labelled_sample(docs.where("lang is not null"), known, per_language)
    rows = [r for r in rows if r["text"] and LETTER.search(r["text"])]
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def identify(docs: DataFrame, net: Network, into: str = "language", text_column: str = "text") -> DataFrame:
    """docs with the column into, a struct of lang_pred, score (the pooled probability, 0 to 1) and none (that of no known language) per row.

    Texts that are null, empty or without letters get UNKNOWN, 0 and 1. All columns and rows of docs are
    kept, repeated ones included; a column of the name into is an error. Only the text goes to Python. An empty
    table gives an empty one.
    """
    if free_name(docs, into) != into:
        raise ValueError(f"the table has a column {into}")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("lang_pred string, score double, none double")
    def judged(texts: pa.Array) -> pa.Array:
        names, *numbers = judge(shared.value, texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), *(pa.array(x, pa.float64()) for x in numbers)], ["lang_pred", "score", "none"])

    return docs.withColumn(into, judged(F.col(text_column)))


def keep_known(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of docs that have letters and are not likelier in none of the languages than in all together, with their columns; repeated rows stay."""
    name = free_name(docs, "language")
    found = identify(docs, net, name)
    return found.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.none") <= 0.5)).drop(name)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language per document; a null doc_id has a null held_out, a null or letterless text und and 0.

    Texts of any length are read whole, in stretches; equal probabilities go to the first language by name.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "language.lang_pred", "language.score")
