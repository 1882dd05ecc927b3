"""SentencePiece encoding and decoding: sampled segmentations without replacement.

A text's segmentations are the paths of a lattice whose edges are vocabulary pieces. A piece has the
probability that Zipf's law gives its rank in the vocabulary (the model file holds merge ranks, not
probabilities); a path has the product of its pieces' over the lattice's total. Gumbel top-k draws k
distinct paths as the k largest of all log-probabilities perturbed by Gumbel noise, found from the top:

* backward sums give every node's log mass, so a set of paths that share a prefix has a known mass;
* the best path of a set is an ancestral sample and inherits the set's perturbed maximum; what remains of
  the set splits, step by step along that path, into sets of known mass, whose maxima are Gumbel noise
  truncated at the set's. Since these bounds are exact, always opening the best set is an A-star search
  that never opens a set without emitting its best path.

The (k+1)-th maximum is the threshold of the inclusion scores. Random numbers are hashes of the row's key
and a counter, so a row's samples depend on nothing else. Words (as in token_counts) share no piece, so
lattices are built per distinct word of a block of texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm._shared import small_batches, table
from quire.llm.token_counts import SPACE_MARK, model_path

K, SEED = 2, 42
#: Characters of text whose words share one set of lattices, and of texts that are sampled together.
BLOCK, LOT = 4_000_000, 400_000
#: Nodes of the lattices that are built together.
PART = 200_000
#: Rank is shifted by this in Zipf's law.
SHIFT = 50.0
#: Uniform numbers have 53 bits, so a set this far below another cannot have the larger maximum.
FAR = 40.0
#: A set of paths is looked at at once if its prefix has at least this log-probability; others when a maximum comes near theirs.
NEAR = -100.0
WORD = re.compile(r" *[^ \n]+| +|\n")
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs, equal outputs; others look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from 64-bit keys."""
    return unit(mix(x))


class Vocabulary:
    """Pieces of a model with their log-probabilities, and bytes for decoding."""

    _open: dict = {}

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        special = {*self.byte_ids.tolist(), *(i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.ids = np.array([i for i in range(n) if i not in special])
        pieces = [model.id_to_piece(int(i)).replace(SPACE_MARK, " ") for i in self.ids]
        weight = 1.0 / (SHIFT - np.array([model.get_score(int(i)) for i in self.ids]))
        tail = 1.0 / (SHIFT + len(self.ids))
        total = weight.sum() + 256 * tail
        self.log_byte = float(np.log(tail / total))
        self.longest = max(map(len, pieces))
        #: Whether a string may begin a longer piece, by the top bits of its key.
        self.begins = np.zeros(1 << 20, bool)
        for p in pieces:
            x = 0
            for c in p[:-1]:
                x = self.grow_one(x, ord(c))
                self.begins[x >> 44] = True
        keys = np.array([self.key(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.piece, self.log_p = keys[order], self.ids[order], np.log(weight[order] / total)
        self.hint = np.zeros(1 << 20, bool)
        self.hint[self.keys >> np.uint64(44)] = True
        raw = [b""] * n
        for i, p in zip(self.ids, pieces):
            raw[i] = p.encode()
        for b, i in enumerate(self.byte_ids):
            raw[i] = bytes([b])
        self.lengths = np.array([len(r) for r in raw])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    @classmethod
    def open(cls, path: str) -> Vocabulary:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    @staticmethod
    def grow(key: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The key of a string followed by one more character."""
        x = (key ^ code) * np.uint64(0x100000001B3D)
        return x ^ (x >> np.uint64(29))

    @staticmethod
    def grow_one(x: int, code: int) -> int:
        x = (x ^ code) * 0x100000001B3D % 2**64
        return x ^ (x >> 29)

    @classmethod
    def key(cls, text: str) -> int:
        return reduce(cls.grow_one, map(ord, text), 0)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in keys, -1 for strings that are no piece."""
        out = np.full(len(keys), -1)
        maybe = np.flatnonzero(self.hint[keys >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        out[maybe[hit]] = at[hit]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding adds; broken UTF-8 is replaced as the library does."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        body = self.raw[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        return (body[1:] if body[:1] == b" " else body).decode(errors="replace")


def _part(words: list[str], sizes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """Edges of the lattices of some words: first and last node, piece, log-probability given the first node, its running sum over the node's edges; and by node where its edges end."""
    first, n_nodes = np.cumsum(sizes + 1) - (sizes + 1), int((sizes + 1).sum())
    codes = np.zeros(n_nodes, np.uint64)
    text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    left = np.ones(n_nodes, bool)
    left[first + sizes] = False
    codes[left] = text
    ahead = np.zeros(n_nodes, np.int64)  # characters from a node to its word's end
    ahead[left] = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text))
    at, keys, found = np.flatnonzero(left), np.zeros(len(text), np.uint64), []
    degree = np.zeros(n_nodes, np.int64)
    for length in range(1, v.longest + 1):
        keep = ahead[at] >= length
        at, keys = at[keep], keys[keep]
        if not len(at):
            break
        keys = v.grow(keys, codes[at + length - 1])
        place = v.find(keys)
        hit = np.flatnonzero(place >= 0)
        here = at[hit]
        found.append((here, np.full(len(hit), length), v.piece[place[hit]], v.log_p[place[hit]], degree[here]))
        degree[here] += 1
        on = v.begins[keys >> np.uint64(44)]
        at, keys = at[on], keys[on]
        if length == 1:  # a character that is no piece is its bytes
            bare = np.flatnonzero(left & (degree == 0))
            width = 1 + (codes[bare] > 0x7F) + (codes[bare] > 0x7FF) + (codes[bare] > 0xFFFF).astype(np.int64)
            found.append((bare, np.ones(len(bare), np.int64), -codes[bare].astype(np.int64) - 1, width * v.log_byte, degree[bare]))
            degree[bare] = 1
    end = np.cumsum(degree)
    node, size, one, weight, nth = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
    slot = end[node] - 1 - nth  # edges of a node from the longest, which is the likeliest, to the shortest
    src, length, piece, score = np.empty_like(node), np.empty_like(size), np.empty_like(one), np.empty(len(node))
    src[slot], length[slot], piece[slot], score[slot] = node, size, one, weight
    begin, dst = end - degree, src + length
    # backward sums: the log mass of what leads from a node to its word's end, for all words at once by distance from it
    mass, far = np.zeros(n_nodes), int(ahead.max(initial=0))
    nodes = np.argsort(ahead.astype(np.int16) if far < 1 << 15 else ahead, kind="stable")
    steps = np.searchsorted(ahead[nodes], np.arange(1, far + 2))
    for a, b in zip(steps, steps[1:]):
        own = nodes[a:b]
        many = degree[own]
        cut = np.cumsum(many) - many
        edges = np.repeat(begin[own] - cut, many) + np.arange(int(many.sum()))
        x = score[edges] + mass[dst[edges]]
        top = np.maximum.reduceat(x, cut)
        mass[own] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, many)), cut))
    log_q = np.minimum(score + mass[dst] - mass[src], 0.0)
    q = np.exp(log_q)
    upto, some = np.cumsum(q), degree > 0
    upto -= np.repeat((upto - q)[begin[some]], degree[some])
    upto[end[some] - 1] = 2.0  # whatever rounding left, the last edge takes it
    return src.astype(np.int32), dst.astype(np.int32), piece.astype(np.int32), log_q, upto, end.astype(np.int32)


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    """One array of all parts, which are let go."""
    return np.concatenate(parts) if parts else np.zeros(0, kind)


class Lattices:
    """The lattices of distinct words: a word of m characters has m + 1 nodes; edges are sorted by their first node.

    They are built a PART of the words at a time, whose sorts and sums stay in the processor's cache and
    whose intermediate arrays are small beside the result.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1)
        self.first = ends - (sizes + 1)
        self.n_nodes = int(ends[-1]) if len(words) else 0
        columns: list[list] = [[] for _ in range(6)]
        at = nodes = edges = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(ends, nodes + PART)))
            src, dst, piece, log_q, upto, end = _part(words[at:to], sizes[at:to], vocabulary)
            for column, values in zip(columns, (src + np.int32(nodes), dst + np.int32(nodes), piece, log_q, upto, end + np.int32(edges))):
                column.append(values)
            at, nodes, edges = to, int(ends[to - 1]), edges + len(src)
        self.end, self.upto, self.log_q, self.piece, self.dst, self.src = (_joined(columns.pop(), k) for k in (np.int32, np.float64, np.float64, np.int32, np.int32, np.int32))
        self.begin = np.concatenate([np.zeros(1, np.int32), self.end[:-1]])

    def choose(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each node, by its probability; nodes have few edges, so these are tried in turn."""
        e = self.begin[nodes]
        on = np.flatnonzero(u >= self.upto[e])
        while len(on):
            e[on] += 1
            on = on[u[on] >= self.upto[e[on]]]
        return e

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ancestral samples from each node to its word's end: edges of all in order, and how many each took. Keys are random bits."""
        taken = np.zeros(len(nodes), np.int64)
        active, rounds = np.flatnonzero(self.begin[nodes] < self.end[nodes]), []
        nodes = nodes[active]
        while len(active):
            e = self.choose(nodes, uniform(keys[active] + np.array([len(rounds)], np.uint64) * _GOLD) if rounds else unit(keys[active]))
            rounds.append((active, e))
            taken[active] += 1
            nodes = self.dst[e]
            on = self.begin[nodes] < self.end[nodes]
            active, nodes = active[on], nodes[on]
        at = np.cumsum(taken) - taken
        out = np.empty(int(taken.sum()), np.int64)
        for t, (who, e) in enumerate(rounds):
            out[at[who] + t] = e
        return out, taken


@dataclass
class Opened:
    """The sets that leave a path at some of its steps: prefix log-probabilities there, perturbed maxima, and edges taken out at a step beyond the path's own."""

    steps: np.ndarray
    prefix: np.ndarray
    maxima: np.ndarray
    shut: dict[int, list[int]]
    #: First step that belongs to this path alone, and whether all of its steps have been looked at.
    first: int
    whole: bool


class Search:
    """The samples of one text so far, and the sets of paths that are left."""

    def __init__(self, key: int, words: np.ndarray, lattices: Lattices):
        self.key, self.lattices, self.starts = np.uint64(key), lattices, lattices.first[words]
        self.paths: list[np.ndarray] = []
        self.sums: list[float] = []  # log-probability of each path
        self.best: list[float] = []  # perturbed log-probability of each path
        self.open: list[Opened] = []

    def _noise(self, *counters: int) -> float:
        x = xxhash.xxh64_intdigest(repr(counters).encode(), int(self.key))
        return ((x >> 11) + 0.5) * 2.0**-53

    def start(self) -> tuple[np.ndarray, np.ndarray, tuple] | None:
        """Nodes and keys to walk from for the next path; its prefix, the prefix's log-probability and its bound. None if there is no path."""
        rank, lat = len(self.paths), self.lattices
        if not rank:
            return self.starts, self._keys(rank, 0), (np.zeros(0, np.int64), 0.0, -math.log(-math.log(self._noise(0))))
        found = self.next_best()
        if found is None:
            return None
        j, i = found
        opened, path = self.open[j], self.paths[j]
        step, bound, prefix = int(opened.steps[i]), float(opened.maxima[i]), float(opened.prefix[i])
        out = opened.shut.setdefault(step, [])
        taken = [int(path[step]), *out]
        edge = self._other(taken, self._noise(rank, 1))
        out.append(edge)
        opened.maxima[i] = self._rest(prefix, [*taken, edge], bound, self._noise(rank, 2))
        last = lat.dst[path[:step]]
        word = int(np.count_nonzero(lat.begin[last] == lat.end[last]))
        nodes = np.concatenate([[lat.dst[edge]], self.starts[word + 1 :]])
        return nodes, self._keys(rank, word), (np.append(path[:step], edge), prefix + float(lat.log_q[edge]), bound)

    def _keys(self, rank: int, word: int) -> np.ndarray:
        places = np.arange(word, len(self.starts), dtype=np.uint64)
        with np.errstate(over="ignore"):
            return mix(self.key + (np.uint64(rank + 7) << np.uint64(40)) + places * _GOLD)

    def _left(self, taken: list[int]) -> tuple[int, list[float]]:
        """First edge of the node that the taken edges leave, and the probabilities of its edges, 0 for those taken."""
        lat = self.lattices
        node = int(lat.src[taken[0]])
        a = int(lat.begin[node])
        return a, [0.0 if e in taken else math.exp(x) for e, x in enumerate(lat.log_q[a : int(lat.end[node])].tolist(), a)]

    def _other(self, taken: list[int], u: float) -> int:
        """An edge of the same node that is not taken, by probability."""
        a, q = self._left(taken)
        u *= sum(q)
        for e, x in enumerate(q, a):
            if x > 0:
                chosen = e
                u -= x
                if u < 0:
                    break
        return chosen

    def _rest(self, prefix: float, taken: list[int], bound: float, u: float) -> float:
        """Perturbed maximum of the paths that share a prefix and go on by none of the edges taken."""
        left = sum(self._left(taken)[1])
        if not left:
            return -math.inf
        mass = prefix + math.log(left)
        return min(bound, mass - math.log(math.exp(mass - bound) - math.log(u)))

    def _widen(self) -> None:
        """Look at the sets of all steps of all paths."""
        for j, o in enumerate(self.open):
            if not o.whole:
                path, n = self.paths[j], o.first + len(o.steps)
                log_q = self.lattices.log_q[path[n:]]
                prefix = self.sums[j] - log_q.sum() + np.cumsum(log_q) - log_q
                steps = np.arange(n, len(path))
                salt = np.full(len(steps), set_salt(self.key, j), np.uint64)
                far = maxima(self.lattices, path[n:], steps, prefix, salt, np.full(len(steps), self.best[j]))
                o.steps, o.prefix, o.maxima, o.whole = np.append(o.steps, steps), np.append(o.prefix, prefix), np.append(o.maxima, far), True

    def next_best(self) -> tuple[int, int] | None:
        """The path and place in its open sets with the largest maximum."""
        value, j = max(((float(o.maxima.max(initial=-np.inf)), -j) for j, o in enumerate(self.open)), default=(-np.inf, 0))
        if value < NEAR + FAR and not all(o.whole for o in self.open):
            self._widen()
            return self.next_best()
        return None if value == -np.inf else (-j, int(self.open[-j].maxima.argmax()))

    def threshold(self) -> float:
        found = self.next_best()
        return -np.inf if found is None else float(self.open[found[0]].maxima[found[1]])


def set_salt(key: np.uint64, path: int) -> np.uint64:
    """What the noise of the sets of a text's path starts from."""
    return mix(np.array([key ^ (np.uint64(path + 3) << np.uint64(48))], np.uint64))[0]


def maxima(lattices: Lattices, edges: np.ndarray, steps: np.ndarray, prefix: np.ndarray, salt: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Perturbed maxima of the sets that leave a path at each of its edges, given what bounds the path's own set."""
    rest = 1.0 - np.exp(lattices.log_q[edges])
    node = lattices.src[edges]
    rest[lattices.end[node] - lattices.begin[node] == 1] = 0.0
    with np.errstate(divide="ignore", over="ignore"):
        return truncated(prefix + np.log(rest), bound, uniform(salt + steps.astype(np.uint64) * _GOLD))


def emit(plans: list[tuple[Search, tuple]], lattices: Lattices, edges: np.ndarray, sizes: np.ndarray) -> None:
    """Add a path to every search: its prefix followed by its part of the edges walked (sizes of them); and open the near sets along what is new."""
    log_q = lattices.log_q[edges]
    ends = np.cumsum(sizes)
    upto = np.empty_like(log_q)
    for (_, p), a, b in zip(plans, (ends - sizes).tolist(), ends.tolist()):  # a text's sums do not depend on its neighbours
        np.cumsum(log_q[a:b], out=upto[a:b])
        upto[a:b] += p[1]
    prefix = upto - log_q
    near = np.flatnonzero(prefix >= NEAR)
    owner = np.searchsorted(ends, near, side="right")
    first = np.array([len(p[0]) for _, p in plans])
    steps = near - (ends - sizes)[owner] + first[owner]
    salt = np.array([set_salt(s.key, len(s.paths)) for s, _ in plans], np.uint64)
    tops = maxima(lattices, edges[near], steps, prefix[near], salt[owner], np.array([p[2] for _, p in plans])[owner])
    many = np.bincount(owner, minlength=len(plans))
    cut = np.cumsum(many)
    for k, (s, (head, log_head, bound)) in enumerate(plans):
        a, b = int(ends[k] - sizes[k]), int(ends[k])
        i, j = int(cut[k] - many[k]), int(cut[k])
        s.paths.append(np.concatenate([head, edges[a:b]]) if len(head) else edges[a:b])
        s.sums.append(float(upto[b - 1]) if b > a else log_head)
        s.best.append(bound)
        s.open.append(Opened(steps[i:j], prefix[near[i:j]], tops[i:j], {}, int(first[k]), j - i == b - a))


def truncated(mass: np.ndarray, bound: float, u: np.ndarray) -> np.ndarray:
    """Gumbel noise about mass, given that it does not exceed bound."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        g = mass - np.log(np.exp(mass - bound) - np.log(u))
    return np.where(mass == -np.inf, -np.inf, np.minimum(g, bound))


def inclusion(log_p: float, threshold: float) -> float:
    """Log of the probability that a path's perturbed log-probability exceeds the threshold."""
    if threshold == -np.inf:
        return 0.0
    x = log_p - threshold
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


def expand(lattices: Lattices, path: np.ndarray, byte_ids: np.ndarray) -> np.ndarray:
    """Piece ids of a path; characters that are no piece become the ids of their bytes."""
    pieces = lattices.piece[path]
    odd = np.flatnonzero(pieces < 0)
    if not len(odd):
        return pieces
    codes = -pieces[odd] - 1
    if (codes < 128).all():
        pieces[odd] = byte_ids[codes]
        return pieces
    parts, at = [], 0
    for i, c in zip(odd.tolist(), codes.tolist()):
        parts += [pieces[at:i], byte_ids[list(chr(c).encode())]]
        at = i + 1
    return np.concatenate([*parts, pieces[at:]])


def samples(texts: list[str | None], keys: list[int], vocabulary: Vocabulary, k: int = K) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """For each text up to k distinct segmentations: its place, rank, ids, log-probability, perturbed log-probability and log inclusion score."""
    found, many = [], []
    for t in texts:
        own = WORD.findall(f" {t.replace(SPACE_MARK, ' ')}") if t else []
        found += own
        many.append(len(own))
    coded = pa.array(found, pa.large_string()).dictionary_encode()
    del found
    words = np.split(coded.indices.to_numpy().astype(np.int64), np.cumsum(many)[:-1])
    distinct = coded.dictionary.to_pylist()
    del coded
    lattices = Lattices(distinct, vocabulary)
    del distinct
    lot: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        lot.append(i)
        size += len(t or "")
        if size >= LOT or i == len(texts) - 1:
            yield from _sample_lot(lot, words, keys, lattices, vocabulary, k)
            lot, size = [], 0


def _sample_lot(lot, words, keys, lattices, vocabulary, k) -> Iterator[tuple]:
    searches = {i: Search(keys[i], words[i], lattices) for i in lot}
    for _ in range(k):
        plans = [(s, p) for s in searches.values() if (p := s.start())]
        if not plans:
            break
        edges, taken = lattices.walk(np.concatenate([p[0] for _, p in plans]), np.concatenate([p[1] for _, p in plans]))
        of_plan = np.cumsum([len(p[0]) for _, p in plans])
        upto = np.concatenate([[0], np.cumsum(taken)])[of_plan]
        emit([(s, p[2]) for s, p in plans], lattices, edges, np.diff(upto, prepend=0))
    for i, s in searches.items():
        limit = s.threshold()
        for rank, (path, log_p, best) in enumerate(zip(s.paths, s.sums, s.best), 1):
            yield i, rank, expand(lattices, path, vocabulary.byte_ids), log_p, best, inclusion(log_p, limit)


COLUMNS = "rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def sample_pieces(docs: DataFrame, k: int = K, seed: int = SEED, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """Up to k distinct segmentations of every whole text, sampled without replacement.

    Returns (doc_id, rank, ids, log_prob, perturbed, log_inclusion, round_trip, n_pieces, ids_hash), a row per
    row of docs and sample, rank 1 having the largest perturbed log-probability; round_trip tells that
    decoding the ids gives the text. Without with_ids, ids is left out. The seed of a row is its id as text, of a
    null id its text; so repeated rows give the same samples again. Null and empty texts have one
    segmentation, the empty one. Texts are cut at spaces and line ends only; a word of n characters takes n
    short rounds (400,000 of them some seconds) and memory for its lattice, about 100 bytes a character and
    piece. Other columns are left out. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    path = path or model_path()
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = docs.schema["doc_id"].dataType
    id_kind = to_arrow_type(id_type)

    def blocks(batches):
        ids, texts, size = [], [], 0
        for b in batches:
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_py()
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
                if size >= BLOCK:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def sampled(batches):
        vocabulary = Vocabulary.open(path)
        for ids, texts in blocks(batches):
            keys = [xxhash.xxh64_intdigest((t or "") if i is None else str(i), seed) for i, t in zip(ids, texts)]
            rows, size = [], 0
            for row in samples(texts, keys, vocabulary, k):
                found, text = row[2].astype(np.int32), texts[row[0]] or ""
                same = vocabulary.decode(found) == text.replace(SPACE_MARK, " ")
                rows.append((ids[row[0]], row[1], found if with_ids else None, *row[3:], same, len(found), xxhash.xxh64_intdigest(found.tobytes(), seed) - (1 << 63)))
                size += len(found)
                if size > 500_000:
                    yield batch(rows)
                    rows, size = [], 0
            yield batch(rows)

    names = ("doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip", "n_pieces", "ids_hash")
    kinds = (id_kind, pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())

    def batch(rows):
        columns = [None if c == 2 else pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
        ends = np.cumsum([0, *(r[7] for r in rows)], dtype=np.int32)
        columns[2] = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *(r[2] for r in rows)])) if with_ids else pa.nulls(len(rows), kinds[2])
        return pa.record_batch(columns, list(names))

    out = docs.mapInArrow(sampled, f"doc_id {id_type.simpleString()}, {COLUMNS}, n_pieces long, ids_hash long")
    return out if with_ids else out.drop("ids")


def decode_pieces(encoded: DataFrame, path: str | None = None, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """encoded with the text of its piece ids in the column into; null ids stay null, no ids give an empty text."""
    path = path or model_path()

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        v = Vocabulary.open(path)
        return pa.array([None if i.as_py() is None else v.decode(np.array(i.as_py(), np.int64)) for i in ids], pa.string())

    return encoded.withColumn(into, decoded(F.col(ids_column)))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations per document, with their ids."""
    return sample_pieces(table(spark, sf_dir, "documents"))
