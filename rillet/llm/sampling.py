"""SentencePiece encoding, decoding and sampling of segmentations (operator 9).

``encode_texts`` gives each row the model's own segmentation, ``decode_ids`` turns ids into text again, and
``sample_segmentations`` draws further segmentations:

A text's lattice has every vocabulary piece that matches at a position (a character outside the
vocabulary becomes its byte pieces).  A segmentation's weight is the product of its pieces' weights,
``(rank + 2) ** -alpha`` for the piece of that merge rank; backward sums over the lattice give each
position's exact distribution of the next piece.

``k`` distinct segmentations are drawn without replacement by Gumbel top-k, as a best-first (A*)
search over the tree of prefixes.  A prefix's value is the largest perturbed log-probability below
it, so the bound is exact: the first child drawn inherits its parent's value, and the best of its
other children follows from one truncated Gumbel draw.  The search therefore completes a path at
once, keeps one open value per tree node, and branches next where that value is largest.  The value
left when ``k`` are drawn is the threshold kappa; a sample's inclusion score is
``1 - exp(-exp(log_prob - kappa))``, 1 if the lattice is exhausted.

A unit is a word with the space before it; no piece crosses its ends.  A Python worker keeps the lattices and
own ids of the units it met in flat arrays, and the paths of a batch of rows grow side by side, a piece a step.

``segmentations`` does the whole for every row: the model's own segmentation and the drawn ones, each
with the text that its ids decode to.

Draws are seeded by the row's key, so a row gets the same samples in any run and partitioning.

Defined cases: a null or empty text has one segmentation, the empty one; texts with fewer than ``k``
segmentations give all of them; rows with equal keys draw alike; a null key counts as its own value.
Null and empty texts encode to no ids; null ids and no ids decode to the empty text.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rillet.llm.common import map_texts

SPACE = "▁"
NEAR = 8                     # edges of a node that are compared at once
STRIDE = 16                  # pieces that rows walked side by side take at a time
WIDTH = 512                  # rows walked side by side; the next row takes the place of one that is done
FEW = 48                     # so many rows are walked one by one
LEARNT = 40_000              # units whose lattices are made at once
LONG_UNIT = 64               # characters; the lattices of longer units are made one by one
BATCH_CHARS = 5_000_000      # of texts that are sampled side by side


@dataclass(frozen=True)
class SamplingOptions:
    model: str                       # path of a SentencePiece model file, readable on every executor
    k: int = 3
    alpha: float = 1.0
    seed: int = 17
    cached_edges: int = 2_000_000    # of lattices, per Python worker (with all that belongs to them some 130 bytes each)


class Lattice:
    """Next-piece distributions of one unit: per position the edges' ends, ids and running probabilities."""

    __slots__ = ("ends", "ids", "sums", "logs", "rest")

    def __init__(self, unit: str, pieces: dict, longest: int, byte_edges):
        n = len(unit)
        beta = [-math.inf] * n + [0.0]
        self.ends, self.ids, self.sums, self.logs, self.rest = ([None] * n for _ in range(5))
        for i in range(n - 1, -1, -1):
            ends, ids, score = [], [], []
            for j in range(i + 1, min(n, i + longest) + 1):
                hit = pieces.get(unit[i:j])
                if hit is not None:
                    ends.append(j)
                    ids.append(hit[0])
                    score.append(hit[1] + beta[j])
            if not ends or ends[0] != i + 1:               # the character itself is no piece
                codes, weight = byte_edges(unit[i])
                ends.append(i + 1)
                ids.append(codes)
                score.append(weight + beta[i + 1])
            top = max(score)
            beta[i] = top + math.log(sum(math.exp(s - top) for s in score))
            logs = [s - beta[i] for s in score]
            sums, total = [], 0.0
            for x in logs:
                total += math.exp(x)
                sums.append(total)
            sums[-1] = 1.0
            self.ends[i], self.ids[i], self.sums[i], self.logs[i] = ends, ids, sums, logs
            self.rest[i] = [math.log1p(-math.exp(x)) if x < -1e-12 and len(logs) > 1 else -math.inf for x in logs]


class _Column:
    """A numpy array that grows at its end."""

    def __init__(self, kind):
        self._held, self._n = np.empty(1024, kind), 0

    def extend(self, values) -> None:
        n = self._n + len(values)
        if n > len(self._held):
            self._held = np.concatenate((self._held[:self._n], np.empty((n, *self._held.shape[1:]), self._held.dtype)))
        self._held[self._n:n] = values
        self._n = n

    @property
    def all(self) -> np.ndarray:
        return self._held[:self._n]


class _Numbers(dict):
    """Numbers names as they are first asked for."""

    def __missing__(self, name: str) -> int:
        self[name] = number = len(self)
        return number


class _Units:
    """The units met so far, as flat columns.

    What may follow at a character depends on the rest of its unit alone, so a node stands for a rest,
    whatever units end with it.  Per unit its node of every character (``place_at``, ``chars`` in
    ``place``) and its own ids (``own_at``, ``own_n`` in ``own``); per node its log-weight ``beta``,
    its first edge, their number, and the running probabilities of its first ``NEAR`` edges; per edge its
    length ``step``, ``id`` (below zero: the byte pieces of a character), running probability ``sum``, ``log``,
    and log of what is left ``rest``.  A rest is found by its first character and the node behind it:
    ``keys`` are these, sorted, and ``rests`` their nodes.
    """

    def __init__(self):
        self.index = _Numbers()
        self.keys, self.rests = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.odd: set[int] = set()           # units whose own ids depend on the text around them
        self.place, self.place_at, self.chars = _Column(np.int32), _Column(np.int64), _Column(np.int32)
        self.own, self.own_at, self.own_n = _Column(np.int32), _Column(np.int64), _Column(np.int32)
        self.beta, self.near = _Column(np.float64), _Column((np.float64, NEAR))
        self.edge, self.edges = _Column(np.int32), _Column(np.uint8)
        self.step, self.id = _Column(np.int32), _Column(np.int32)
        self.sum, self.log, self.rest = (_Column(np.float64) for _ in range(3))

    def add_own(self, own: list[list[int]]) -> None:
        size = np.array([len(x) for x in own], np.int64)
        self.own_at.extend(len(self.own.all) + np.cumsum(size) - size)
        self.own_n.extend(size)
        self.own.extend(np.fromiter(chain.from_iterable(own), np.int32, int(size.sum())))

    def add_nodes(self, beta, counts, step, ids, sums, logs, rest) -> None:
        """Nodes with their numbers of edges, and the edges."""
        sums, last = np.asarray(sums), np.cumsum(counts) - 1
        self.near.extend(sums[np.minimum((last + 1 - counts)[:, None] + np.arange(NEAR), last[:, None])])
        self.beta.extend(beta)
        self.edge.extend(len(self.step.all) + last + 1 - counts)
        self.edges.extend(counts)
        for column, values in zip((self.step, self.id, self.sum, self.log, self.rest), (step, ids, sums, logs, rest)):
            column.extend(values)


@dataclass
class _Layout:
    """A batch of texts as units: the node of every character, and each row's and unit's place among them."""
    unit_at: np.ndarray          # first character of every unit's occurrence, and the number of characters
    row_units: np.ndarray        # row r has the occurrences row_units[r] up to row_units[r + 1]
    nodes: np.ndarray
    units: np.ndarray            # unit of every occurrence


class Sampler:
    def __init__(self, options: SamplingOptions):
        import sentencepiece
        self._sp = sentencepiece.SentencePieceProcessor(model_file=options.model)
        self._options = options
        self._pieces, self._bytes = {}, {}
        worst = 0.0
        size = self._sp.get_piece_size()
        self._weights = np.zeros(size)
        shown = [""] * size                        # what a piece decodes to; None: depends on its neighbours
        for i in range(size):
            piece = self._sp.id_to_piece(i)
            shown[i] = piece.replace(SPACE, " ")
            if self._sp.is_byte(i):
                self._bytes[int(piece[3:5], 16)] = i
                shown[i] = chr(int(piece[3:5], 16)) if int(piece[3:5], 16) < 128 else None
            elif self._sp.is_control(i) or self._sp.is_unknown(i) or self._sp.is_unused(i):
                shown[i] = None
            else:
                weight = -options.alpha * math.log(2.0 - self._sp.get_score(i))
                worst = min(worst, weight)
                self._pieces[piece] = ((i,), weight)
                self._weights[i] = weight
        assert all(SPACE not in p.lstrip(SPACE) for p in self._pieces), "pieces must not cross a word's start"
        self._byte_weight = worst
        self._longest = max(map(len, self._pieces))
        self._plain = np.array([x is not None for x in shown])
        self._leads = np.array([bool(x) and x[0] == " " for x in shown]) & self._dummy_prefix()
        shown = [x or "" for x in shown]
        self._shown = pa.array(shown + [x[1:] for x in shown], pa.large_string())   # then: as a text's first piece
        self._char_codes: list[tuple] = []
        self._char_ids: dict[tuple, int] = {}
        self._trie()
        self._units = _Units()

    def _dummy_prefix(self) -> bool:
        """Whether decoding drops one leading space mark and keeps all others."""
        mark = self._sp.piece_to_id(SPACE)
        return not self._sp.is_unknown(mark) and [self._sp.decode([mark] * n) for n in (1, 2, 3)] == ["", " ", "  "]

    def _trie(self) -> None:
        """The pieces' prefixes as states: ``child`` of (state, character), found in the sorted ``keys``; ``piece`` of a state."""
        state, edges, piece = {"": 0}, {}, [-1]
        for text, ((i,), _) in self._pieces.items():
            at = 0
            for j, char in enumerate(text, 1):
                to = state.setdefault(text[:j], len(piece))
                if to == len(piece):
                    piece.append(-1)
                    edges[at << 21 | ord(char)] = to
                at = to
            piece[at] = i
        self._keys = np.array(sorted(edges), np.int64)
        self._child = np.array([edges[k] for k in self._keys.tolist()], np.int64)
        self._piece = np.array(piece, np.int32)

    def _byte_edges(self, char: str):
        codes = tuple(self._bytes.get(b, self._sp.unk_id()) for b in char.encode())
        return codes, self._byte_weight * len(codes)

    def _char_id(self, codes: tuple) -> int:
        """The id itself of a character that is one byte piece; else a number below zero for its ids."""
        if len(codes) == 1:
            return codes[0]
        if codes not in self._char_ids:
            self._char_codes.append(codes)
            self._char_ids[codes] = -len(self._char_codes)
        return self._char_ids[codes]

    def units(self, text: str) -> list[str]:
        """The normalised text cut before every first space mark: pieces never cross these cuts."""
        return self._cut(self._sp.normalize(text) if text else "")

    @staticmethod
    def _cut(norm: str) -> list[str]:
        out, start = [], 0
        at = norm.find(SPACE, 1)
        while at >= 0:
            if norm[at - 1] != SPACE:
                out.append(norm[start:at])
                start = at
            at = norm.find(SPACE, at + 1)
        if start < len(norm):
            out.append(norm[start:])
        return out

    def lattice(self, unit: str) -> Lattice:
        return Lattice(unit, self._pieces, self._longest, self._byte_edges)

    def encode(self, text: str | None) -> list[int]:
        """The model's own segmentation."""
        return self._sp.encode(text or "")

    def decode(self, ids) -> str:
        return self._sp.decode(list(map(int, ids if ids is not None else ())))

    def sample(self, text: str | None, seed: int) -> list[tuple[list[int], float, float, float]]:
        """Up to ``k`` distinct segmentations: ids, log-probability, perturbed value, inclusion score."""
        _, drawn = self.segment([text], [seed], own=False)
        return [(ids.tolist(), *scores) for ids, *scores in drawn[0]]

    def segment(self, texts: list, seeds: list[int], own: bool = True) -> tuple[list[np.ndarray], list[list[tuple]]]:
        """Of each text the model's own ids (if ``own``) and the drawn segmentations, as ``sample`` gives them."""
        if len(self._units.step.all) > self._options.cached_edges:
            self._units = _Units()
        layout = self._lay_out(texts)
        return self._own(texts, layout) if own else [], _Draw(self._units, self._codes, layout, self._longest, seeds, self._options.k).run()

    def texts(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """What the segmentations ``ids[at[r]:at[r + 1]]`` decode to."""
        full = np.flatnonzero(np.diff(at))
        first = at[full]
        place = ids.astype(np.int64)
        place[first] += len(self._plain)
        pieces = self._shown.take(pa.array(place))
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        odd = set(full[~self._leads[ids[first]]].tolist())
        odd.update((np.searchsorted(at, np.flatnonzero(~self._plain[ids]), "right") - 1).tolist())
        if odd or ends[-1] >= 1 << 31:
            data = pieces.buffers()[2]
            raw = memoryview(data) if data is not None else b""
            cut = ends[at].tolist()
            return pa.array([self.decode(ids[at[r]:at[r + 1]]) if r in odd else str(raw[a:b], "utf-8")
                             for r, (a, b) in enumerate(zip(cut, cut[1:]))], pa.string())
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(ends[at].astype(np.int32)), pieces.buffers()[2])

    def _names(self, text: str | None) -> list[str]:
        """The text's units without the space mark that leads them; others are marked by one of their own."""
        norm = self._sp.normalize(text) if text else ""
        if norm.startswith(SPACE) and SPACE + SPACE not in norm:
            return norm[1:].split(SPACE)
        return [u[1:] if u[0] == SPACE and SPACE not in u[1:] else SPACE + u for u in self._cut(norm)]

    def _lay_out(self, texts: list) -> _Layout:
        rows = [self._names(t) for t in texts]
        index, known = self._units.index, len(self._units.index)
        units = np.fromiter(map(index.__getitem__, chain.from_iterable(rows)), np.int64, sum(map(len, rows)))
        new = list(islice(index, known, None))
        for at in range(0, len(new), LEARNT):
            self._learn(new[at:at + LEARNT])
        chars = self._units.chars.all[units]
        unit_at = np.concatenate(([0], np.cumsum(chars, dtype=np.int64)))
        nodes = self._units.place.all[np.repeat(self._units.place_at.all[units] - unit_at[:-1], chars) + np.arange(unit_at[-1])]
        return _Layout(unit_at, np.cumsum([0, *map(len, rows)]), nodes, units)

    def _learn(self, names: list[str]) -> None:
        """The lattices and own ids of new units, in the order of their numbers."""
        known = self._units
        units = [x[1:] if SPACE in x else SPACE + x for x in names]
        parts = [x.lstrip(SPACE) for x in names]
        base, place_at = len(known.chars.all), len(known.place.all)
        known.odd.update(base + k for k, (x, part, unit) in enumerate(zip(names, parts, units))
                         if SPACE in x or self._sp.normalize(part) != unit)
        known.add_own(self._sp.encode(parts, num_threads=1))
        chars = np.array([len(u) for u in units], np.int64)
        order = np.argsort(chars > LONG_UNIT, kind="stable")          # long ones last
        at = np.empty(len(units), np.int64)
        at[order] = place_at + np.cumsum(chars[order]) - chars[order]
        known.place_at.extend(at)
        known.chars.extend(chars)
        if short := [u for u in units if len(u) <= LONG_UNIT]:
            known.place.extend(self._nodes(short, chars[chars <= LONG_UNIT]))
        for unit in (u for u in units if len(u) > LONG_UNIT):
            x = self.lattice(unit)
            ids = [c[0] if unit[at:e] in self._pieces else self._char_id(c)
                   for at, (ends, codes) in enumerate(zip(x.ends, x.ids)) for e, c in zip(ends, codes)]
            first = len(known.beta.all)
            known.place.extend(np.arange(first, first + len(unit)))
            known.add_nodes(np.zeros(len(unit)), np.array([len(e) for e in x.ends]),
                            [e - at for at, ends in enumerate(x.ends) for e in ends], ids,
                            *(list(chain.from_iterable(v)) for v in (x.sums, x.logs, x.rest)))

    def _nodes(self, units: list[str], chars: np.ndarray) -> np.ndarray:
        """The node of every character of ``units``; new ones are made as ``Lattice`` does, all at once."""
        code = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.int64)
        base = len(self._units.beta.all)
        place, where, left = self._rests(code, chars)                  # the shortest rests come first
        n = len(where)
        if not n:
            return place
        end = where + left
        at, state, single = np.arange(n, dtype=np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
        found = []
        for size in range(1, self._longest + 1):
            key = state << 21 | code[where[at] + size - 1]
            spot = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            hit = self._keys[spot] == key
            at, state = at[hit], self._child[spot[hit]]
            piece = self._piece[state]
            good = piece >= 0
            found.append((at[good], np.full(good.sum(), size, np.int32), piece[good], self._weights[piece[good]]))
            if size == 1:
                single[at[good]] = True
            inside = where[at] + size < end[at]
            at, state = at[inside], state[inside]
            if not len(at):
                break
        bare = np.flatnonzero(~single)                       # the character itself is no piece
        chars_bare, which = np.unique(code[where[bare]], return_inverse=True)
        spelt = [self._byte_edges(chr(c)) for c in chars_bare.tolist()]
        found.append((bare.astype(np.int32), np.ones(len(bare), np.int32), np.array([self._char_id(c) for c, _ in spelt], np.int32)[which],
                      np.array([w for _, w in spelt])[which]))
        start, step, ids, weight = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(start, kind="stable")
        start, step, ids, weight = start[order], step[order], ids[order], weight[order]
        counts = np.bincount(start, minlength=n)
        first = np.cumsum(counts) - counts
        stop = where[start] + step
        to = np.where(stop == end[start], base + n, place[np.minimum(stop, len(place) - 1)])
        beta, logs = np.concatenate((self._units.beta.all, np.zeros(n + 1))), np.empty(len(start))
        for a, b in pairwise(np.searchsorted(left, np.arange(1, left[-1] + 2)).tolist()):
            if a == b:
                continue
            e, cuts, each = slice(first[a], first[b - 1] + counts[b - 1]), first[a:b] - first[a], counts[a:b]
            score = weight[e] + beta[to[e]]
            top = np.maximum.reduceat(score, cuts)
            total = top + np.log(np.add.reduceat(np.exp(score - np.repeat(top, each)), cuts))
            beta[base + a:base + b] = total
            logs[e] = score - np.repeat(total, each)
        sums, run, node, k = np.exp(logs), np.zeros(n), np.arange(n), 0
        while len(node):                                     # the k-th edge of each node
            run = sums[first[node] + k] = run + sums[first[node] + k]
            k += 1
            more = counts[node] > k
            run, node = run[more], node[more]
        sums[first + counts - 1] = 1.0
        rest = np.full(len(logs), -np.inf)
        part = logs < -1e-12
        rest[part] = np.log1p(-np.exp(logs[part]))
        self._units.add_nodes(beta[base:-1], counts, step, ids, sums, logs, rest)
        return place

    def _rests(self, code: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The node of every character of units; of each new node a character that has it, and the rest's length."""
        known, base, made = self._units, len(self._units.beta.all), 0
        place, stop = np.empty(len(code), np.int32), np.cumsum(chars)
        behind = np.zeros(len(chars), np.int64)              # 1 + the node of the rest behind the character; 0: none
        where, lefts, added = [], [], []
        for left in range(1, int(chars.max()) + 1):
            longer = chars >= left
            if not longer.all():
                chars, stop, behind = chars[longer], stop[longer], behind[longer]
            at = stop - left
            key, node = behind << 21 | code[at], np.full(len(at), -1, np.int32)
            old = np.flatnonzero(behind <= base)
            if len(known.keys) and len(old):
                spot = np.minimum(np.searchsorted(known.keys, key[old]), len(known.keys) - 1)
                hit = known.keys[spot] == key[old]
                node[old[hit]] = known.rests[spot[hit]]
            new = np.flatnonzero(node < 0)
            if len(new):
                keys, first, same = np.unique(key[new], return_index=True, return_inverse=True)
                node[new] = base + made + same
                where.append(at[new[first]])
                lefts.append(np.full(len(keys), left))
                added.append(keys)
                made += len(keys)
            place[at] = node
            behind = node + np.int64(1)
        if not made:
            return place, np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate(added)
        order = np.argsort(keys)
        spot = np.searchsorted(known.keys, keys[order])
        known.keys = np.insert(known.keys, spot, keys[order])
        known.rests = np.insert(known.rests, spot, (base + order).astype(np.int32))
        return place, np.concatenate(where), np.concatenate(lefts)

    def _own(self, texts: list, layout: _Layout) -> list[np.ndarray]:
        """The own ids of every text, unit by unit; of the whole text where a unit's depend on it."""
        n, odd = self._units.own_n.all[layout.units], self._units.odd
        at = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        ids = self._units.own.all[np.repeat(self._units.own_at.all[layout.units] - at[:-1], n) + np.arange(at[-1])]
        cuts = at[layout.row_units].tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        if odd:
            hit = np.flatnonzero(np.isin(layout.units, list(odd)))
            for r in set((np.searchsorted(layout.row_units, hit, "right") - 1).tolist()):
                out[r] = np.array(self.encode(texts[r]), np.int32)
        return out

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        """The edges' ids with the byte pieces of characters spelt out."""
        if not len(ids) or ids.min() >= 0:
            return ids
        return np.array([c for i in ids.tolist() for c in ((i,) if i >= 0 else self._char_codes[-1 - i])], np.int32)


class _Path:
    """A complete segmentation: its edges before the nodes it owns, and of these edges, log-probabilities before and open values."""

    __slots__ = ("before", "edges", "place", "start", "open", "done", "log_prob", "value", "top", "best")

    def settle(self) -> None:
        self.top = int(np.argmax(self.open)) if len(self.open) else -1
        self.best = float(self.open[self.top]) if self.top >= 0 else -math.inf


@dataclass
class _Growth:
    """A prefix to be completed: the first node it owns, and the edge taken there (None at the root)."""
    row: int
    before: np.ndarray
    place: int               # character of the first own node
    edge: int | None
    done: tuple              # edges already drawn at that node
    start: float             # its log-probability
    value: float
    draws: np.ndarray


class _Draw:
    """The drawn segmentations of a batch of texts; all rows' paths grow side by side, a piece a step."""

    def __init__(self, units: _Units, codes, layout: _Layout, longest: int, seeds: list[int], k: int):
        self.k, self.codes, self.layout = k, codes, layout
        self.edges = units.edges.all
        self.nodes = np.concatenate((layout.nodes, np.zeros(STRIDE * longest, layout.nodes.dtype)))
        self.edge, self.step, self.id = units.edge.all, units.step.all, units.id.all
        self.sum, self.log, self.rest, self.near = units.sum.all, units.log.all, units.rest.all, units.near.all
        self.limits = layout.unit_at[layout.row_units].tolist()
        self.rng = [np.random.Generator(np.random.PCG64(s)) for s in seeds]

    def run(self) -> list[list[tuple]]:
        out: list = [None] * len(self.rng)
        paths: list[list[_Path]] = [[] for _ in self.rng]
        longest = np.argsort(-np.diff(self.limits), kind="stable").tolist()      # the first to start
        waiting = map(self._start, longest)
        walks = _Walks(self, self.limits[-1])
        while grow := walks.add(waiting):
            following = []
            for g, edges in grow:
                mine = paths[g.row]
                mine.append(self._complete(g, edges))
                if len(mine) != self.k and (x := self._branch(g.row, mine)):
                    following.append(x)
                else:
                    out[g.row], paths[g.row] = self._drawn(mine), []
            waiting = chain(following, waiting)
        return out

    def _start(self, row: int) -> _Growth:
        rng, a, b = self.rng[row], self.limits[row], self.limits[row + 1]
        value = -math.log(rng.standard_exponential())         # the root's Gumbel; its log-probability is 0
        return _Growth(row, np.zeros(0, np.int32), a, None, (), 0.0, value, rng.random(b - a or 1))

    def _drawn(self, mine: list[_Path]) -> list[tuple]:
        kappa = max(p.best for p in mine)
        return [(self.codes(self.id.take(np.concatenate((p.before, p.edges)))), p.log_prob, p.value,
                 1.0 if kappa == -math.inf else -math.expm1(-math.exp(min(p.log_prob - kappa, 50.0)))) for p in mine]

    def _complete(self, g: _Growth, edges: np.ndarray) -> _Path:
        p = _Path()
        p.before, p.place, p.done, p.value = g.before, g.place, g.done, g.value
        p.edges = edges.copy() if g.edge is None else np.concatenate((np.array([g.edge], np.int32), edges))
        sums = np.empty(len(p.edges) + 1)
        sums[0] = g.start
        self.log.take(p.edges, out=sums[1:], mode="clip")
        np.cumsum(sums, out=sums)
        p.start, p.log_prob = sums[:-1], float(sums[-1])
        rest = self.rest.take(p.edges, mode="clip")
        if g.done:
            a, b = self._edges(g.place)
            left = 1.0 - math.fsum(math.exp(self.log[e]) for e in g.done)
            rest[0] = math.log(left) if left > 1e-12 and len(g.done) < b - a else -math.inf
        rest += p.start
        p.open = _truncated(rest, g.value, self.rng[g.row])
        p.settle()
        return p

    def _edges(self, place: int) -> tuple[int, int]:
        node = int(self.layout.nodes[place])
        return int(self.edge[node]), int(self.edge[node]) + int(self.edges[node])

    def _branch(self, row: int, paths: list[_Path]) -> _Growth | None:
        """The next child of the node with the best open value; the node's open value passes to the new path."""
        host, rng = max(paths, key=lambda p: p.best), self.rng[row]
        value, k = host.best, host.top
        if value == -math.inf:
            return None
        done = host.done if k == 0 and host.done else (int(host.edges[k]),)
        place = host.place + int(self.step[host.edges[:k]].sum())
        left = [(e, math.exp(self.log[e])) for e in range(*self._edges(place)) if e not in done]
        goal = rng.random() * math.fsum(w for _, w in left)
        for e, w in left:
            goal -= w
            if goal < 0:
                break
        start = float(host.start[k])
        host.open[k] = -math.inf
        host.settle()
        unit = np.searchsorted(self.layout.unit_at, place, "right") - 1
        return _Growth(row, np.concatenate((host.before, host.edges[:k])), place, e, (*done, e), start, value,
                       rng.random(self.limits[row + 1] - int(self.layout.unit_at[unit])))


class _Walks:
    """Prefixes that are completed side by side: per piece one draw, and the first edge whose sum exceeds it.

    A row's draws and edges lie where its characters do in ``draws`` and ``out``; a row has one walk at a time.
    """

    def __init__(self, draw: _Draw, chars: int):
        self.of = draw
        self.draws, self.out = np.zeros(chars + STRIDE), np.empty(chars + STRIDE, np.int32)
        self.at = self.end = self.now = np.zeros(0, np.int64)
        self.growths: list[_Growth] = []

    def add(self, waiting) -> list[tuple[_Growth, np.ndarray]]:
        """Takes in what waits, as far as there is room, and walks until some are complete: these, with their edges."""
        limits, step, complete, more = self.of.limits, self.of.step, [], []
        for g in islice(waiting, WIDTH - len(self.growths)):
            first, end = limits[g.row], limits[g.row + 1]
            at = g.place if g.edge is None else g.place + int(step[g.edge])
            if at < end:
                self.draws[first:first + len(g.draws)] = g.draws
                self.growths.append(g)
                more.append((at, end, first))
            else:
                complete.append((g, self.out[:0]))
        if more:
            self.at, self.end, self.now = (np.concatenate(x) for x in zip((self.at, self.end, self.now), np.array(more).T))
        while self.growths and not complete:
            going = self._side_by_side() if len(self.growths) > FEW else self._one_by_one()
            complete = [(g, self.out[limits[g.row]:t]) for g, t, more in zip(self.growths, self.now.tolist(), going) if not more]
            if complete:
                self.growths = [g for g, more in zip(self.growths, going) if more]
                self.at, self.end, self.now = self.at[going], self.end[going], self.now[going]
        return complete

    def _side_by_side(self) -> np.ndarray:
        """``STRIDE`` pieces of every walk; what lies beyond a row's end is not kept.  Which ones go on."""
        x, at, end = self.of, self.at, self.end
        node_edge, nodes, sums, step, near = x.edge, x.nodes, x.sum, x.step, x.near
        ones, eight, most = np.uint64(0x0101010101010101), np.uint64(56), np.maximum.reduce
        steps = self.now + np.arange(STRIDE)[:, None]
        draw = self.draws.take(steps)[:, :, None]
        edges, places = np.empty(steps.shape, np.int32), np.empty(steps.shape, np.int64)
        for k in range(STRIDE):
            places[k] = at
            node = nodes.take(at, mode="clip")               # faster than with a check of bounds
            passed = ((near.take(node, axis=0, mode="clip") <= draw[k]).view(np.uint64)[:, 0] * ones >> eight).view(np.int64)     # the bytes' sum
            edge = node_edge.take(node, mode="clip") + passed
            if most(passed) == NEAR:
                more = np.flatnonzero(passed == NEAR)
                more = more[sums[edge[more]] <= draw[k, more, 0]]
                while len(more):
                    edge[more] += 1
                    more = more[sums[edge[more]] <= draw[k, more, 0]]
            edges[k] = edge
            at = at + step.take(edge, mode="clip")
        kept = places < end
        self.out[steps[kept]] = edges[kept]
        self.now = self.now + kept.sum(axis=0)
        self.at = at
        return at < end

    def _one_by_one(self) -> np.ndarray:
        """Every walk to its end."""
        x = self.of
        node_edge, nodes, sums, step = map(memoryview, (x.edge, x.nodes, x.sum, x.step))
        for k, (i, e, t) in enumerate(zip(self.at.tolist(), self.end.tolist(), self.now.tolist())):
            edges = []
            for draw in self.draws[t:t + e - i].tolist():
                edge = node_edge[nodes[i]]
                while sums[edge] <= draw:
                    edge += 1
                edges.append(edge)
                i += step[edge]
                if i >= e:
                    break
            self.now[k] = t + len(edges)
            self.out[t:t + len(edges)] = edges
        return np.zeros(len(self.growths), bool)


def _truncated(mass: np.ndarray, most: float, rng) -> np.ndarray:
    """Largest perturbed value in sets of log-mass ``mass``, given that it is below ``most``."""
    noise = rng.standard_exponential(len(mass))
    part = mass - most
    np.minimum(part, 700, out=part)
    np.exp(part, out=part)
    part += noise
    with np.errstate(divide="ignore"):
        np.log(part, out=part)
    np.subtract(mass, part, out=part)
    part[mass == -np.inf] = -np.inf
    return part


@lru_cache(maxsize=1)
def _sampler(options: SamplingOptions) -> Sampler:
    """The sampler of a Python worker: its tasks share the units it has met."""
    return Sampler(options)


def _slices(batch, column: str):
    """The batch in runs of rows with about ``BATCH_CHARS`` characters (one row at least)."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_CHARS, "right")))
        yield batch.slice(at, end - at)
        at = end


def row_seed(seed: int, *key) -> int:
    return (seed << 32) ^ zlib.crc32(repr(key).encode())


def _repeated(column, times) -> pa.Array:
    return column.take(pa.array(np.repeat(np.arange(len(column)), np.fromiter(times, np.int64, len(column)))))


def _drawn_columns(every: list[list[tuple]], first: int):
    """The rows' segmentations one after the other: their numbers from ``first`` on, ids; these also flat, with offsets."""
    parts = [x[0] for mine in every for x in mine]
    at = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts).astype(np.int32, copy=False)
    sample = pa.array([s for mine in every for s in range(first, first + len(mine))], pa.int32())
    return sample, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)), flat, at


def _scores(every: list[list[tuple]]) -> list[pa.Array]:
    return [pa.array(c, pa.float64()) for c in zip(*(x[1:] for mine in every for x in mine))]


def _by_row(rows: DataFrame, keys: list[str], options: SamplingOptions, source: str, convert, name: str, kind) -> DataFrame:
    """The ``keys`` columns (long) and ``name``, which ``convert`` makes of ``source``, for every row."""
    def run(batches):
        sampler = Sampler(options)
        for batch in batches:
            made = [convert(sampler, x) for x in batch.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(made, kind)], names=[*keys, name])

    spark_kind = "string" if kind == pa.string() else "array<int>"
    schema = ", ".join([*(f"{k} long" for k in keys), f"{name} {spark_kind}"])
    return map_texts(rows.selectExpr(*[f"cast({k} as long) {k}" for k in keys], source), run, schema)


def encode_texts(rows: DataFrame, keys: list[str], options: SamplingOptions) -> DataFrame:
    """The ``keys`` columns (long) and ``ids``, the model's own segmentation of ``text``."""
    return _by_row(rows, keys, options, "text", Sampler.encode, "ids", pa.list_(pa.int32()))


def decode_ids(rows: DataFrame, keys: list[str], options: SamplingOptions) -> DataFrame:
    """The ``keys`` columns (long) and ``text``, what ``ids`` stand for."""
    return _by_row(rows, keys, options, "ids", Sampler.decode, "text", pa.string())


def sample_segmentations(rows: DataFrame, keys: list[str], options: SamplingOptions) -> DataFrame:
    """The ``keys`` columns (long), ``sample``, ``ids``, ``log_prob``, ``perturbed``, ``inclusion``.

    ``rows`` holds the key columns and ``text``; every row gives one output row per sample.
    """
    def run(batches):
        sampler = _sampler(options)
        for batch in (x for whole in batches for x in _slices(whole, "text")):
            key = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            _, drawn = sampler.segment(batch.column("text").to_pylist(), [row_seed(options.seed, *k) for k in key], own=False)
            cols = [_repeated(batch.column(k), map(len, drawn)) for k in keys]
            yield pa.RecordBatch.from_arrays([*cols, *_drawn_columns(drawn, 0)[:2], *_scores(drawn)],
                                             names=[*keys, "sample", "ids", "log_prob", "perturbed", "inclusion"])

    schema = ", ".join(f"{k} long" for k in keys) + \
        ", sample int, ids array<int>, log_prob double, perturbed double, inclusion double"
    rows = rows.selectExpr(*[f"cast({k} as long) {k}" for k in keys], "text")
    return map_texts(rows, run, schema)


def segmentations(rows: DataFrame, keys: list[str], options: SamplingOptions) -> DataFrame:
    """``keys`` (string or long), ``sample``, ``ids``, ``text``, ``log_prob``, ``perturbed``, ``inclusion``.

    Per row of ``rows`` (the key columns and ``text``) one output row with ``sample`` -1, the model's own
    segmentation, and one per drawn segmentation; ``text`` is what ``ids`` decode to.
    """
    kind = {k: t for k, t in rows.select(*keys).dtypes}
    kind = {k: ("string", pa.string()) if t == "string" else ("long", pa.int64()) for k, t in kind.items()}

    some = max(1, 400 // (options.k + 1))

    def run(batches):
        sampler = _sampler(options)
        for batch in (x for whole in batches for x in _slices(whole, "text")):
            key = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            own, drawn = sampler.segment(batch.column("text").to_pylist(), [row_seed(options.seed, *k) for k in key])
            every = [[(ids, None, None, None), *rest] for ids, rest in zip(own, drawn)]
            del own, drawn
            for first in range(0, len(every), some):             # a few rows at a time: little is held twice
                mine, every[first:first + some] = every[first:first + some], [()] * len(every[first:first + some])
                sample, ids, flat, at = _drawn_columns(mine, -1)
                yield pa.RecordBatch.from_arrays(
                    [*(_repeated(batch.column(k).slice(first, some), map(len, mine)) for k in keys), sample, ids,
                     sampler.texts(flat, at), *_scores(mine)],
                    names=[*keys, "sample", "ids", "text", "log_prob", "perturbed", "inclusion"])

    schema = ", ".join(f"{k} {kind[k][0]}" for k in keys) + \
        ", sample int, ids array<int>, text string, log_prob double, perturbed double, inclusion double"
    rows = rows.selectExpr(*[f"cast({k} as {kind[k][0]}) {k}" for k in keys], "text")
    return map_texts(rows, run, schema)
