"""SentencePiece lattices: distinct sampled segmentations of whole texts, and decoding.

A text is a dummy space and its characters, spaces written U+2581 (a U+2581 of the text itself becomes byte
pieces). The lattice has an edge for each vocabulary piece that matches, and byte pieces where a character has
none. The vocabulary file ranks its pieces; a piece of rank r has the score -log(r + OFFSET), and a segmentation the
probability of the sum of its scores, normalised over all segmentations of the text. No piece has a
space after another character, so the lattice falls into chunks (spaces and what follows up to the next space) that are independent.

``k`` segmentations are drawn without replacement by a perturbed A-star search (Gumbel top-k): the root has
a Gumbel value for the whole probability; a subtree of segmentations has one for its own, truncated at that of the tree
it was split from. The subtrees are "as path j before chunk t, other than j's choices at t, free after". Popping the greatest
value yields the next segmentation: an unused choice at t and fresh choices after it, which is split again. Values come out in
falling order, so the first k are the sample, and the next value kappa gives each its inclusion score
1 - exp(-exp(log_prob - kappa)), the probability to be among those above kappa.

All random numbers are hashes of the row's key, the draw and the place in the text, so a row has the same sample wherever it runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.bytes_text import mix, prefix_sums, span_hashes

SAMPLES = 2
SEED = 29
OFFSET = 2.7
PIECE_CHARS = 400_000  # some 60 MB in a task
_SPACE = 0x2581
_LITERAL = 0x110000  # stands for a U+2581 of the text
_GROUP = np.uint64(0x9E3779B97F4A7C15)


def default_model() -> str:
    """The place of the public 32k vocabulary, if that package is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces of a SentencePiece model; its size bounds what is sent to the tasks."""

    pieces: list[str]  # by id; byte pieces and controls are empty
    scores: np.ndarray  # by id
    byte_ids: np.ndarray  # id of each byte
    output: list[bytes]  # by id, what the piece decodes to

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.vocab_size()
        pieces, output, byte_ids, ranks = [], [], np.zeros(256, np.int32), np.full(n, float(n))
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                pieces.append("")
                output.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                pieces.append("")
                output.append(b"")
            else:
                pieces.append(piece)
                output.append(piece.replace("▁", " ").encode())
                ranks[i] = min(float(n), max(0.0, -sp.get_score(i)))
        return cls(pieces, -np.log(ranks + OFFSET), byte_ids, output)


class _Matcher:
    """Hash tables of the vocabulary's prefixes: one probe tells a piece, a mere prefix or neither."""

    BITS = 20

    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.scores
        self.byte_ids = vocabulary.byte_ids
        self.longest = max(map(len, vocabulary.pieces))
        found: dict[int, int] = {}
        for i, piece in enumerate(vocabulary.pieces):
            h = 0
            for n, ch in enumerate(piece):
                h = self.step(h, ord(ch))
                if n + 1 == len(piece):
                    found[h] = i
                else:
                    found.setdefault(h, -1)
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.ids = np.full(1 << self.BITS, -2, np.int32)
        self.probes = 0
        for h, i in found.items():
            at, probes = self._slot(h), 1
            while self.ids[at] != -2:
                at, probes = (at + 1) % (1 << self.BITS), probes + 1
            self.keys[at], self.ids[at] = h, i
            self.probes = max(self.probes, probes)
        self.output = np.frombuffer(b"".join(vocabulary.output), np.uint8)
        self.output_at = np.concatenate([[0], np.cumsum([len(o) for o in vocabulary.output])])

    @staticmethod
    def step(h: int, ch: int) -> int:
        return (h * 0x9E3779B97F4A7C15 + ch + 1) % (1 << 64)

    def _slot(self, h: int) -> int:
        return ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93 % (1 << 64)) >> (64 - self.BITS)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """The id, -1 for a mere prefix, -2 for neither."""
        at = (((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.where(self.keys[at] == h, self.ids[at], np.int32(-2))
        open_ = np.flatnonzero((out == -2) & (self.ids[at] != -2))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % (1 << self.BITS)
            hit = self.keys[at[open_]] == h[open_]
            out[open_[hit]] = self.ids[at[open_[hit]]]
            open_ = open_[~hit & (self.ids[at[open_]] != -2)]
        return out


@lru_cache(maxsize=2)
def _matcher(model_file: str) -> _Matcher:
    return _Matcher(Vocabulary.load(model_file))


@dataclass
class Lattice:
    """The lattice of distinct chunks, laid end to end; node i is before character i."""

    chars: np.ndarray
    starts: np.ndarray  # of each chunk
    ends: np.ndarray
    first: np.ndarray  # first edge of each node
    degree: np.ndarray
    length: np.ndarray  # of each edge, in characters
    piece: np.ndarray  # id of each edge, -1 for the bytes of a character
    upto: np.ndarray  # probability of this and earlier edges of the node
    log_p: np.ndarray  # of each edge, given its node
    others: np.ndarray  # probability of the node's other edges, a sum of theirs and so exact where it is tiny


def _lattice(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, m: _Matcher) -> Lattice:
    n = len(chars)
    left = np.repeat(ends, ends - starts) - np.arange(n)
    matches = []
    alive, h = np.arange(n), np.zeros(n, np.uint64)
    for size in range(1, m.longest + 1):
        ok = left[alive] >= size
        alive, h = alive[ok], h[ok]
        if not len(alive):
            break
        h = h * _GROUP + chars[alive + size - 1].astype(np.uint64) + np.uint64(1)
        ids = m.look_up(h)
        hit = ids >= 0
        matches.append((alive[hit], ids[hit]))
        some = ids >= -1
        alive, h = alive[some], h[some]
    single = np.zeros(n, bool)
    if matches:
        single[matches[0][0]] = True
    lone = np.flatnonzero(~single)
    degree = np.zeros(n, np.int32)
    for at, _ in matches:
        degree[at] += 1
    degree[lone] += 1
    first = np.zeros(n + 1, np.int64)
    np.cumsum(degree, out=first[1:])
    fill = first[:-1].copy()
    length, piece = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
    for size in range(len(matches), 0, -1):  # long pieces first: mostly the likelier ones
        at, ids = matches[size - 1]
        length[fill[at]], piece[fill[at]] = size, ids
        fill[at] += 1
    length[fill[lone]], piece[fill[lone]] = 1, -1
    cps = chars[lone]
    n_bytes = 1 + (cps >= 0x80) + (cps >= 0x800) + ((cps >= 0x10000) & (cps != _LITERAL))
    score = np.where(piece >= 0, m.scores[piece], 0.0)
    score[fill[lone]] = n_bytes * m.scores[m.byte_ids[0]]

    # from the ends of the chunks backwards: total of all continuations of each node
    total = np.zeros(n + 1)
    order = np.argsort(left.astype(np.uint16) if n and left.max() < 65536 else left, kind="stable")
    sizes = np.bincount(left, minlength=1) if n else np.zeros(1, int)
    value = np.empty(len(score))
    done = 0
    # a node at the end of a chunk is the start of the next: its own total must not count
    for d in range(1, len(sizes)):
        nodes = order[done : done + sizes[d]]
        done += sizes[d]
        if not len(nodes):
            continue
        best = np.full(len(nodes), -np.inf)
        deg = degree[nodes]
        for r in range(int(deg.max())):
            has = np.flatnonzero(deg > r)
            e = first[nodes[has]] + r
            to = nodes[has] + length[e]
            inner = length[e] < d
            v = score[e] + np.where(inner, total[to], 0.0)
            value[e] = v
            best[has] = np.logaddexp(best[has], v)
        total[nodes] = best
    log_p = value - np.repeat(total[:-1], degree)
    p = np.exp(log_p)
    upto, after = p.copy(), p.copy()
    most = int(degree.max()) if n else 0
    for r in range(1, most):
        e = first[:-1][degree > r] + r
        upto[e] += upto[e - 1]
    for r in range(most - 2, -1, -1):
        e = first[:-1][degree > r + 1] + r
        after[e] += after[e + 1]
    inside = np.ones(len(p), bool)
    inside[first[:-1]] = False
    others = np.zeros(len(p))
    others[1:] = np.where(inside[1:], upto[:-1], 0.0)
    others[:-1] += np.where(inside[1:], after[1:], 0.0)
    upto[first[1:] - 1] = np.inf  # the last edge takes the rest, also of rounding
    return Lattice(chars, starts, ends, first[:-1], degree, length, piece, upto, log_p, others)


def _uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1) from hashes of the parts, arrays of one length."""
    h = np.full(1, SEED, np.uint64)
    for part in parts:
        h = mix(part.astype(np.uint64) ^ (h * _GROUP))
    return ((h >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _draw(lat: Lattice, chunk: np.ndarray, key: np.ndarray, place: np.ndarray, draw: np.ndarray):
    """A segmentation of each chunk: (edges and owners by round, log_p, rest); rest is the probability of the chunk's other segmentations."""
    at, end = lat.starts[chunk].copy(), lat.ends[chunk]
    log_p, rest = np.zeros(len(chunk)), np.zeros(len(chunk))
    owners = np.arange(len(chunk))
    base = mix(np.asarray(key, np.uint64) ^ mix(np.asarray(place, np.uint64) * np.uint64(2) + np.uint64(1)) ^ mix(np.asarray(draw, np.uint64) ^ _GROUP))
    rounds, step = [], 0
    while len(owners):
        nodes = at[owners]
        u = (mix(base[owners] + np.full(1, step, np.uint64) * _GROUP) >> np.uint64(11)).astype(float) / float(1 << 53)
        e = lat.first[nodes]
        open_ = np.flatnonzero(lat.upto[e] <= u)
        while len(open_):
            e[open_] += 1
            open_ = open_[lat.upto[e[open_]] <= u[open_]]
        rounds.append((e, owners))
        rest[owners] += np.exp(log_p[owners]) * lat.others[e]
        log_p[owners] += lat.log_p[e]
        at[owners] = nodes + lat.length[e]
        owners = owners[at[owners] < end[owners]]
        step += 1
    return rounds, log_p, rest


def _flat(rounds: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(borders, edges): the edges of each owner one after the other."""
    counts = np.zeros(n, np.int64)
    for _, owners in rounds:
        counts[owners] += 1
    borders = np.concatenate([[0], np.cumsum(counts)])
    edges = np.empty(borders[-1], np.int64)
    for step, (e, owners) in enumerate(rounds):
        edges[borders[owners] + step] = e
    return borders, edges


def _segments_max(values: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest value of each segment and where it is; -inf and -1 for an empty one."""
    n = len(borders) - 1
    best, at = np.full(n, -np.inf), np.full(n, -1)
    full = np.flatnonzero(np.diff(borders) > 0)
    if len(full):
        top = np.maximum.reduceat(values, borders[full])
        best[full] = top
        where = np.flatnonzero(values == np.repeat(top, np.diff(borders)[full]))
        owner = np.searchsorted(borders, where, "right") - 1
        keep = np.append(True, owner[1:] != owner[:-1])
        at[owner[keep]] = where[keep]
    return best, at


def _gumbel(location: np.ndarray, u: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Gumbel values of these locations, truncated at ``below``."""
    with np.errstate(over="ignore", divide="ignore"):
        rest = np.exp(location - below) - np.log(u)
        return np.where(np.isneginf(location), -np.inf, location - np.log(rest))


class _Used:
    """The prefix tree of some segmentations of a chunk, with what probability they leave at each of its nodes.

    What is left of a node is the sum of its unused edges and of what is left below its used ones: nothing is
    subtracted, so it is exact where the used ones have nearly all, and zero where they are all there is.
    The work is linear in the characters of the chunk.
    """

    def __init__(self, lat: Lattice, chunk: int, used: list[list[int]]):
        self.lat = lat
        self.start, self.end = int(lat.starts[chunk]), int(lat.ends[chunk])
        self.first = lat.first[self.start : self.end].tolist()
        low, high = self.first[0], self.first[-1] + int(lat.degree[self.end - 1])
        self.low = low
        self.length, self.log_p = lat.length[low:high].tolist(), lat.log_p[low:high].tolist()
        self.p = np.exp(lat.log_p[low:high]).tolist()
        self.children: list[dict[int, int]] = [{}]
        self.at = [self.start]
        for path in used:
            node = 0
            for e in path:
                if e not in self.children[node]:
                    self.children[node][e] = len(self.children)
                    self.children.append({})
                    self.at.append(self.at[node] + self.length[e - low])
                node = self.children[node][e]
        self.left = [0.0] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            if self.at[node] < self.end:
                self.left[node] = sum(self._weights(node))

    def _edges(self, at: int) -> range:
        i = at - self.start
        return range(self.first[i], self.first[i + 1] if i + 1 < len(self.first) else self.low + len(self.length))

    def _weights(self, node: int) -> list[float]:
        used = self.children[node]
        return [self.p[e - self.low] * (self.left[used[e]] if e in used else 1.0) for e in self._edges(self.at[node])]

    def draw(self, u: list[float]) -> tuple[list[int], float]:
        """A segmentation that is not used, with the odds of what is left, and its log-probability; u has a number for each character."""
        path: list[int] = []
        at, node = self.start, 0
        while at < self.end:
            edges = self._edges(at)
            weights = self._weights(node) if node >= 0 else [self.p[e - self.low] for e in edges]
            x, chosen = u[len(path)] * sum(weights), -1
            for e, w in zip(edges, weights):
                if w > 0:
                    chosen = e
                    if x < w:
                        break
                    x -= w
            path.append(chosen)
            at += self.length[chosen - self.low]
            node = self.children[node].get(chosen, -1) if node >= 0 else -1
        return path, sum(self.log_p[e - self.low] for e in path)


@dataclass
class _Path:
    """One segmentation of every text: per chunk its log-probability and edges."""

    log_p: np.ndarray
    borders: np.ndarray
    edges: np.ndarray
    value: np.ndarray  # per chunk, of the subtree that leaves this path there
    before: np.ndarray  # per chunk, log-probability of what precedes it in its text
    rest: np.ndarray  # per chunk, probability of the choices that subtree still has


@dataclass
class Samples:
    """Sampled segmentations, ordered by text and then by falling value."""

    text: np.ndarray
    rank: np.ndarray
    log_prob: np.ndarray
    perturbed: np.ndarray
    inclusion: np.ndarray
    borders: np.ndarray  # of each segmentation's ids
    ids: np.ndarray


class _Search:
    """The search over the texts of one piece, all texts a step at a time."""

    def __init__(self, texts: list[str], keys: np.ndarray, m: _Matcher):
        self.m, self.n = m, len(texts)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        chars = np.frombuffer("".join("▁" + t for t in texts if t).encode("utf-32-le"), np.uint32)
        borders = np.concatenate([[0], np.cumsum(sizes)])
        dummy = np.zeros(len(chars), bool)
        dummy[borders[:-1][sizes > 0]] = True
        chars = np.where((chars == _SPACE) & ~dummy, np.uint32(_LITERAL), chars)
        chars = np.where(chars == 0x20, np.uint32(_SPACE), chars)
        space = chars == _SPACE
        starts = np.flatnonzero(space & (dummy | ~np.append(False, space[:-1])))
        ends = np.append(starts[1:], len(chars)) if len(starts) else starts
        hashes = span_hashes(prefix_sums(chars + np.uint32(1)), starts, ends)
        _, one, self.chunk = np.unique(hashes, return_index=True, return_inverse=True)
        length = (ends - starts)[one]
        to = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        at = np.arange(to[-1]) + np.repeat(starts[one] - to[:-1], length)
        self.lat = _lattice(chars[at], to[:-1], to[1:], m)
        self.borders = np.searchsorted(starts, borders)
        self.text = np.repeat(np.arange(self.n), np.diff(self.borders))
        self.place = np.arange(len(starts)) - self.borders[:-1][self.text]
        self.key = keys[self.text]
        self.keys = keys

    def _before(self, log_p: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(log_p)])
        return sums[:-1] - sums[self.borders[:-1]][self.text]

    def _subtrees(self, path: _Path, which: np.ndarray, draw: int, below: np.ndarray) -> None:
        """Draws the values of the subtrees that leave the path at these chunks."""
        with np.errstate(divide="ignore"):
            location = path.before[which] + np.log(path.rest[which])
        u = _uniform(self.key[which], self.place[which], np.full(len(which), draw))
        path.value[which] = _gumbel(location, u, below)

    def _path(self, rounds, log_p, rest) -> _Path:
        borders, edges = _flat(rounds, len(self.chunk))
        return _Path(log_p, borders, edges, np.full(len(self.chunk), -np.inf), self._before(log_p), rest)

    def _other_choice(self, at: np.ndarray, paths: list[_Path], j: np.ndarray, lost: dict, turn: int):
        """Choices at these chunks that their subtrees still have, and what these have left then: (edges, log_p, rest)."""
        size = self.lat.ends[self.chunk[at]] - self.lat.starts[self.chunk[at]]
        ends = np.cumsum(size)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        u = _uniform(np.repeat(self.key[at], size), np.repeat(self.place[at], size), np.full(len(step), turn << 20), step)
        chosen, log_p, rest = [], np.zeros(len(at)), np.zeros(len(at))
        for i, (a, t) in enumerate(zip(j.tolist(), at.tolist())):
            own = paths[a].edges[paths[a].borders[t] : paths[a].borders[t + 1]].tolist()
            gone = [own, *lost.get((a, t), ())]
            path, log_p[i] = _Used(self.lat, self.chunk[t], gone).draw(u[ends[i] - size[i] : ends[i]].tolist())
            rest[i] = _Used(self.lat, self.chunk[t], [*gone, path]).left[0]
            chosen.append(path)
        return chosen, log_p, rest

    def run(self, k: int) -> Samples:
        everything = np.arange(len(self.chunk))
        first = self._path(*_draw(self.lat, self.chunk, self.key, self.place, np.zeros(len(self.chunk))))
        top = -np.log(-np.log(_uniform(self.keys, np.full(self.n, 7))))
        self._subtrees(first, everything, 1, top[self.text])
        paths, values, lost = [first], [top], {}
        totals = [np.bincount(self.text, first.log_p, self.n)]
        for turn in range(1, k + 1):
            found = [_segments_max(p.value, self.borders) for p in paths]
            best = np.stack([f[0] for f in found])
            j = best.argmax(0)
            value = best[j, np.arange(self.n)]
            at = np.stack([f[1] for f in found])[j, np.arange(self.n)]
            values.append(value)
            if turn == k:
                break
            live = np.flatnonzero(value > -np.inf)
            j, at = j[live], at[live]
            chosen, log_p, rest = self._other_choice(at, paths, j, lost, turn)
            split = np.full(self.n, np.iinfo(np.int64).max)
            split[live] = at
            source = np.zeros(self.n, np.int64)
            source[live] = j
            after = np.flatnonzero(everything > split[self.text])
            rounds, fresh_p, fresh_rest = _draw(self.lat, self.chunk[after], self.key[after], self.place[after], np.full(len(after), turn << 20))
            fresh_borders, fresh_edges = _flat(rounds, len(after))
            # each chunk comes from the path that was left, from the other choice, or is fresh
            new_p = np.choose(source[self.text], [p.log_p for p in paths])
            count = np.choose(source[self.text], [np.diff(p.borders) for p in paths])
            new_p[at], count[at] = log_p, [len(c) for c in chosen]
            new_p[after], count[after] = fresh_p, np.diff(fresh_borders)
            new_rest = np.zeros(len(everything))
            new_rest[after] = fresh_rest
            borders = np.concatenate([[0], np.cumsum(count)])
            edges = np.empty(borders[-1], np.int64)
            kind = np.where(everything > split[self.text], -1, source[self.text])
            kind[at] = -2
            for a, old in enumerate([*paths]):
                _copy(edges, borders, old.edges, old.borders, np.flatnonzero(kind == a))
            _copy(edges, borders, fresh_edges, fresh_borders, after, np.arange(len(after)))
            for t, c in zip(at, chosen):
                edges[borders[t] : borders[t + 1]] = c
            path = _Path(new_p, borders, edges, np.full(len(everything), -np.inf), self._before(new_p), new_rest)
            for a in range(len(paths)):
                mine = j == a
                t = at[mine]
                paths[a].rest[t] = rest[mine]
                for x in np.flatnonzero(mine):
                    lost.setdefault((a, int(at[x])), []).append(chosen[x])
                self._subtrees(paths[a], t, (turn << 20) + 2 + a, value[live][mine])
            self._subtrees(path, after, turn << 21, value[self.text[after]])
            paths.append(path)
            totals.append(np.bincount(self.text, new_p, self.n))
        return self._samples(paths, totals, values)

    def _ids(self, path: _Path) -> tuple[np.ndarray, np.ndarray]:
        """(borders by text, ids)."""
        ids = self.lat.piece[path.edges]
        counts = np.ones(len(ids), np.int64)
        lone = np.flatnonzero(ids < 0)
        if len(lone):
            node = np.searchsorted(self.lat.first, path.edges[lone], "right") - 1
            kinds, code = np.unique(self.lat.chars[node], return_inverse=True)
            spelled = [self.m.byte_ids[list(("▁" if c == _LITERAL else chr(c)).encode())] for c in kinds.tolist()]
            counts[lone] = np.array([len(s) for s in spelled])[code]
        ends = np.cumsum(counts)
        out = np.repeat(ids, counts)
        for x, i in enumerate(lone):
            out[ends[i] - counts[i] : ends[i]] = spelled[code[x]]
        at = np.concatenate([[0], ends])[path.borders[self.borders]]
        return at, out

    def _samples(self, paths, totals, values) -> Samples:
        k = len(paths)
        kappa = values[k]
        rows = [(t, r) for t in range(self.n) for r in range(k) if values[r][t] > -np.inf]
        text, rank = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 2
        parts = [self._ids(p) for p in paths]
        pieces = [parts[r][1][parts[r][0][t] : parts[r][0][t + 1]] for t, r in rows]
        log_prob = np.array([totals[r][t] for t, r in rows])
        perturbed = np.array([values[r][t] for t, r in rows])
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(log_prob - kappa[text])) if rows else np.zeros(0)
        borders = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
        return Samples(text, rank + 1, log_prob, perturbed, inclusion, borders, np.concatenate(pieces) if pieces else np.zeros(0, np.int32))


def _copy(to, to_borders, source, source_borders, chunks, rows=None) -> None:
    """Copies the edges of some chunks."""
    rows = chunks if rows is None else rows
    n = source_borders[rows + 1] - source_borders[rows]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    to[np.repeat(to_borders[chunks], n) + inner] = source[np.repeat(source_borders[rows], n) + inner]


def sample_texts(texts: list[str], keys: np.ndarray, k: int, model_file: str) -> Samples:
    """Up to ``k`` distinct segmentations of each text; an empty text has one, of no pieces."""
    return _Search(texts, keys.astype(np.uint64), _matcher(model_file)).run(k)


def decode_ids(ids: np.ndarray, borders: np.ndarray, model_file: str) -> list[bytes]:
    """The UTF-8 text of each run of ids, without the dummy space."""
    m = _matcher(model_file)
    n = m.output_at[ids + 1] - m.output_at[ids]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(m.output_at[ids] - (ends - n), n)
    data = m.output[at].tobytes()
    ends = np.concatenate([[0], ends])[borders]
    return [data[a:b][1:] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


_FIELDS = [
    T.StructField("sample", T.IntegerType()),
    T.StructField("n_pieces", T.LongType()),
    T.StructField("log_prob", T.DoubleType()),
    T.StructField("perturbed", T.DoubleType()),
    T.StructField("inclusion", T.DoubleType()),
]


def _pieces(texts: list[str]) -> Iterator[slice]:
    """Runs of whole texts of about PIECE_CHARS characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE_CHARS:
            yield slice(first, i)
            first, size = i, 0
        size += len(t) + 1
    if size:
        yield slice(first, len(texts))


def _sampled(docs: DataFrame, k: int, model_file: str, last: list[T.StructField], finish) -> DataFrame:
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *_FIELDS, *last]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for part in _pieces(texts):
                s = sample_texts(texts[part], keys[part], k, model_file)
                ids = batch.column(0).slice(part.start, part.stop - part.start).take(pa.array(s.text))
                columns = [ids, pa.array(s.rank.astype(np.int32)), pa.array(np.diff(s.borders)), pa.array(s.log_prob), pa.array(s.perturbed), pa.array(s.inclusion)]
                yield pa.RecordBatch.from_arrays([*columns, *finish(s)], names=[f.name for f in fields])

    # the row's key is its doc_id alone: a text keeps its samples' randomness when it is edited
    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key")).mapInArrow(run, T.StructType(fields))


def encode_samples(docs: DataFrame, k: int = SAMPLES, model_file: str | None = None) -> DataFrame:
    """(doc_id, sample, n_pieces, log_prob, perturbed, inclusion, ids): up to k segmentations of each text.

    Null and empty texts have one segmentation, of no pieces, as a text of fewer than k segmentations has fewer; inclusion is 1
    where all are drawn. Rows with equal doc_id and text, nulls included, draw alike. Other columns are ignored; an empty
    table gives no rows. ``model_file`` must be readable under the same path on every executor.
    """
    path = model_file or default_model()

    def finish(s: Samples) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(s.borders.astype(np.int32)), pa.array(s.ids.astype(np.int32)))]

    return _sampled(docs, k, path, [T.StructField("ids", T.ArrayType(T.IntegerType()))], finish)


def sample_digests(docs: DataFrame, k: int = SAMPLES, model_file: str | None = None) -> DataFrame:
    """As ``encode_samples``, with digests for the ids and for the text that they decode to: ids_sha256, decoded_sha256."""
    path = model_file or default_model()

    def finish(s: Samples) -> list[pa.Array]:
        ids = s.ids.astype(np.int32)
        one = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(s.borders[:-1], s.borders[1:])]
        two = [hashlib.sha256(t).hexdigest() for t in decode_ids(s.ids, s.borders, path)]
        return [pa.array(one, pa.string()), pa.array(two, pa.string())]

    return _sampled(docs, k, path, [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")], finish)


def decode(encoded: DataFrame, model_file: str | None = None) -> DataFrame:
    """The rows of a frame with ``ids`` (array of int) with the decoded text as the column ``decoded``; null ids give null."""
    path = model_file or default_model()
    at = encoded.columns.index("ids")
    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != "decoded"], T.StructField("decoded", T.StringType())])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at).to_pylist()
            borders = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists])]).astype(np.int64)
            flat = np.array([i for x in lists for i in x or ()], np.int64)
            texts = [None if x is None else t.decode("utf-8", "replace") for x, t in zip(lists, decode_ids(flat, borders, path))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, schema)
