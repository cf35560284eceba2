"""SentencePiece segmentations sampled without replacement.

All segmentations of a text are the paths of its lattice of pieces.  Gumbel
top-k gives ``k`` distinct ones: each path's log probability plus a Gumbel
variable of its own, the greatest first.  The search never lists paths.  It
keeps disjoint sets of paths ("as this path up to a piece, then another
piece"), each with the greatest perturbed value in it, which is a Gumbel
variable of the set's total probability, cut off at the value of the path it
was split from.  That value is an exact bound, so popping the best set and
drawing its path is A-star search: every pop yields the next sample.

Total probabilities come from the lattice's backward sums.  Where two
characters stand next to each other in no piece, no piece crosses the place
between them: there the lattice falls into units, words for the most part.  A
worker builds a unit's lattice once and numpy steps through all units of many
texts together.

A unigram model's scores are log probabilities.  A BPE model has only ranks;
its pieces get the log probabilities of Zipf's law by rank, bytes the least.

Defined results: null counts as empty text; empty text has one segmentation,
without pieces; a text with fewer segmentations than asked for gives all of
them, each with inclusion 1; equal identifiers draw alike for equal texts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common

MARK = "▁"
#: Closes a unit in a row of units; no text holds it, and no piece.
SENTINEL = 0x110000
CHAR_BITS = 21
#: Edges with a greater probability than this are almost certain.
SURE = 0.999
# Odd steps of the counters that random streams run on.
UNIT, STEP, ROUND, NOISE, OWN = (np.uint64(n) for n in (
    0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165))
#: Lattice nodes that a worker remembers before it starts anew.
MEMO_NODES = 4_000_000


def default_path() -> str:
    """The public SentencePiece model; any model file with byte fallback will do."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Growing:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1 << 16, dtype=dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.room):
            larger = np.empty(max(need, len(self.room) * 3 // 2), dtype=self.room.dtype)
            larger[:self.n] = self.room[:self.n]
            self.room = larger
        self.room[self.n:need] = values
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class Pieces:
    """A model's pieces: which text each stands for and its log weight."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        unigram = bool((np.abs(scores - np.round(scores)) > 1e-6).any())
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = [0] * 256
        self.weight = np.zeros(n)
        whole: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
                self.weight[i] = scores.min() - 10 if unigram else -2 * math.log(n)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
                self.weight[i] = scores[i] if unigram else -math.log(min(n, max(1.0, 1 - scores[i])))
                whole[piece] = i
        #: Pairs of characters that some piece holds next to each other, sorted.
        self.pairs = np.array(sorted({ord(a) << CHAR_BITS | ord(b) for t in whole for a, b in zip(t, t[1:])}), dtype=np.int64)
        low = self.pairs[(self.pairs >> CHAR_BITS < 256) & (self.pairs & (1 << CHAR_BITS) - 1 < 256)]
        self.low_pairs = np.zeros(1 << 16, dtype=bool)
        self.low_pairs[(low >> CHAR_BITS) << 8 | low & 255] = True
        state = {"": 0}
        for piece in whole:
            for k in range(1, len(piece) + 1):
                state.setdefault(piece[:k], len(state))
        #: The trie of pieces: sorted keys (state, character) and the state each leads to.
        steps = sorted((state[t[:-1]] << CHAR_BITS | ord(t[-1]), number) for t, number in state.items() if t)
        self.step_key = np.array([key for key, _ in steps], dtype=np.int64)
        self.step_to = np.array([to for _, to in steps], dtype=np.int64)
        self.piece_at = np.full(len(state), -1, dtype=np.int64)
        for piece, i in whole.items():
            self.piece_at[state[piece]] = i
        #: The state after one character, 0 where no piece begins with it.
        self.after_first = np.zeros(SENTINEL + 1, dtype=np.int32)
        one = self.step_key <= SENTINEL  # keys of the first state
        self.after_first[self.step_key[one]] = self.step_to[one]
        self.spelt = np.empty(n, dtype=object)
        self.spelt[:] = self.bytes_of
        #: Where each step's key is found: its number at the first free slot from its hash on, and -1 at the slots left.
        self.shift = np.uint64(64 - 3 - max(1, len(steps)).bit_length())
        self.slots = np.full((8 << max(1, len(steps)).bit_length()) + len(steps) + 1, -1, dtype=np.int32)
        for number, slot in enumerate(self.slot(self.step_key).tolist()):
            while self.slots[slot] >= 0:
                slot += 1
            self.slots[slot] = number

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * UNIT) >> self.shift).astype(np.int64)

    def step(self, key: np.ndarray) -> np.ndarray:
        """The number of each key among the steps, -1 where there is no such step."""
        slot = self.slot(key)
        number = self.slots[slot]
        other = np.flatnonzero((number >= 0) & (self.step_key[number] != key))
        while len(other):
            slot[other] += 1
            number[other] = self.slots[slot[other]]
            other = other[(number[other] >= 0) & (self.step_key[number[other]] != key[other])]
        return number

    def units(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The texts cut wherever no piece crosses, one after the other, and each text's number of units."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        text, behind = "".join(texts), np.cumsum(lengths)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        a, b = codes[:-1], codes[1:]
        low = (a < 256) & (b < 256)
        joined = self.low_pairs[(a << 8 | b) & 0xFFFF] & low
        high = np.flatnonzero(~low)
        if len(high):
            key = a[high].astype(np.int64) << CHAR_BITS | b[high]
            where = np.searchsorted(self.pairs, key)
            where[where == len(self.pairs)] = 0
            joined[high] = self.pairs[where] == key if len(self.pairs) else False
        joined[behind[(behind > 0) & (behind < len(text))] - 1] = False
        cuts = np.concatenate(([0], np.flatnonzero(~joined) + 1, [len(text)])) if text else np.zeros(1, dtype=np.int64)
        counts = np.diff(np.searchsorted(cuts, behind), prepend=0)
        cuts = cuts.tolist()
        return [text[i:j] for i, j in zip(cuts, cuts[1:])], counts

    def found(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in a text of code points: ``(first place, place behind, id)``; all places walk the trie together."""
        state = self.after_first[codes]
        at, depth = np.flatnonzero(state), 1
        state, out = state[at].astype(np.int64), []
        while True:
            ids = self.piece_at[state]
            ends = ids >= 0
            out.append((at[ends], at[ends] + depth, ids[ends]))
            inside = at + depth < len(codes)
            at, state = at[inside], state[inside]
            if not len(at):
                break
            key = state << CHAR_BITS | codes[at + depth]
            number = self.step(key)
            goes = number >= 0
            at, state, depth = at[goes], self.step_to[number[goes]], depth + 1
        return tuple(np.concatenate(c) for c in zip(*out))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8; the mark in front of the text is not part of it."""
        return b"".join(self.spelt[ids].tolist())[1:]


class FirstNodes(dict):
    """The first node of each unit; a new unit gets the next free ones and waits for its lattice."""

    def __init__(self):
        super().__init__()
        self.free, self.waiting = 0, []

    def __missing__(self, unit: str) -> int:
        node = self[unit] = self.free
        self.free += len(unit) + 1
        self.waiting.append(unit)
        return node


class Lattices:
    """Lattices of units, end to end in flat arrays.

    Nodes are places in a unit; a node's edges are next to each other.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.first_node = FirstNodes()
        self.first_edge = Growing(np.int32)
        #: Of each edge: the probability of the node's edges up to it, and as logs its own and that of all others.
        self.upto, self.log_p, self.log_others = Growing(np.float32), Growing(np.float64), Growing(np.float32)
        self.target, self.id = Growing(np.int32), Growing(np.int32)
        #: Of each edge, the first edge of its target; -1 at the unit's end.
        self.next = Growing(np.int32)
        #: Ids of edges that stand for a character's bytes, by -1 - number.
        self.byte_ids: list[list[int]] = []

    def nodes(self, units: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.first_node.__getitem__, units), np.int64, len(units))
        if self.first_node.waiting:
            self.build(self.first_node.waiting)
            self.first_node.waiting = []
        return found

    def build(self, units: list[str]) -> None:
        """Append the lattices of new units, whose nodes are free; a unit's nodes are its places and the one behind it."""
        first = self.first_edge.n
        lengths = np.array([len(u) for u in units])
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = starts + lengths
        codes = np.full(int(ends[-1]) + 1, SENTINEL, dtype=np.int64)
        at_end = np.zeros(len(codes), dtype=bool)
        at_end[ends] = True
        codes[~at_end] = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        src, dst, edge = self.pieces.found(codes)
        w = self.pieces.weight[edge]
        alone = ~at_end  # places whose character is no piece: its bytes stand for it
        alone[src[dst == src + 1]] = False
        alone = np.flatnonzero(alone)
        if len(alone):
            spelt = [[self.pieces.byte_id[b] for b in chr(c).encode()] for c in codes[alone].tolist()]
            numbers = np.array([x[0] if len(x) == 1 else self.spelling(x) for x in spelt])
            src, dst, edge = np.concatenate((src, alone)), np.concatenate((dst, alone + 1)), np.concatenate((edge, numbers))
            w = np.concatenate((w, [self.pieces.weight[x].sum() for x in spelt]))
        above = np.repeat(ends, lengths + 1) - np.arange(len(codes))
        order = np.argsort(src, kind="stable")
        src, dst, edge, w = src[order], dst[order], edge[order], w[order]
        beta = self.backward(src, dst, w, above)
        log_p = w + beta[dst] - beta[src]
        p = np.exp(log_p)
        begins = np.flatnonzero(np.diff(src, prepend=-1))
        sizes = np.diff(np.append(begins, len(src)))
        cumulative = p.copy()  # node by node, so that a unit's numbers do not depend on the units around it
        for k in range(1, int(sizes.max(initial=0))):
            at = begins[sizes > k] + k
            cumulative[at] += cumulative[at - 1]
        cumulative[begins + sizes - 1] = 1.0
        # Next to an almost certain edge the others are added up themselves: 1 - p would lose them.
        sure = p > SURE
        others = np.repeat(np.add.reduceat(np.where(sure, 0.0, p), begins), sizes)
        with np.errstate(divide="ignore"):
            log_others = np.where(sure, np.log(others), np.log1p(-np.where(sure, 0.5, p)))
        per_node = np.bincount(src, minlength=len(codes))
        first_edge = self.upto.n + np.cumsum(per_node) - per_node
        self.first_edge.extend(first_edge)
        self.next.extend(np.where(at_end[dst], -1, first_edge[dst]))
        self.upto.extend(cumulative)
        self.log_p.extend(log_p)
        self.log_others.extend(np.where(np.repeat(sizes, sizes) > 1, log_others, -np.inf))
        self.target.extend(dst + first)
        self.id.extend(edge)

    def spelling(self, ids: list[int]) -> int:
        """The number of an edge that stands for several byte ids."""
        self.byte_ids.append(ids)
        return -len(self.byte_ids)

    @staticmethod
    def backward(src: np.ndarray, dst: np.ndarray, w: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Log total weight of all ways from each node to its unit's end, the nodes nearest to it first."""
        beta = np.zeros(len(above))
        distance = above[src]
        order = np.argsort(distance, kind="stable")  # edges stay sorted by node within a distance
        cuts = np.flatnonzero(np.diff(distance[order], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            edges = order[a:b]
            begins = np.flatnonzero(np.diff(src[edges], prepend=-1))
            beta[src[edges[begins]]] = np.logaddexp.reduceat(w[edges] + beta[dst[edges]], begins)
        return beta

    def draw(self, begin: np.ndarray, streams: np.ndarray, round_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paths from given nodes, by their first edges (-1: the unit's end), to their units' ends, all units at once.

        ``(unit, edge, noise)`` in order of units and pieces; ``unit`` counts the
        given nodes, ``noise`` is an exponential variable for each piece.
        """
        upto, next_ = self.upto.all, self.next.all
        unit, step = np.flatnonzero(begin >= 0), 0
        edge = begin[unit]
        units, edges, counters = [unit[:0]], [edge[:0]], [streams[:0]]
        while len(unit):
            counter = streams[unit]
            counter += np.uint64((int(offset(ROUND, round_)) + int(offset(STEP, step))) % (1 << 64))
            chance = uniform(counter)
            further = np.flatnonzero(upto[edge] <= chance)
            while len(further):
                edge[further] += 1
                further = further[upto[edge[further]] <= chance[further]]
            units.append(unit)
            edges.append(edge)
            counters.append(counter)
            after = next_[edge]
            going = np.flatnonzero(after >= 0)
            edge, unit, step = after[going], unit[going], step + 1
        # A unit's pieces stand next to each other, one per step it went.
        steps = np.bincount(np.concatenate(units), minlength=len(streams))
        begins = np.cumsum(steps) - steps
        path, counter = np.empty(int(steps.sum()), dtype=edges[-1].dtype), np.empty(int(steps.sum()), dtype=np.uint64)
        for k, (unit, edge, drawn) in enumerate(zip(units[1:], edges[1:], counters[1:])):
            places = begins[unit] + k
            path[places], counter[places] = edge, drawn
        counter += NOISE
        noise = uniform(counter)
        np.log(noise, out=noise)
        return np.repeat(np.arange(len(steps)), steps), path, np.negative(noise, out=noise)

    def ids(self, out: np.ndarray) -> np.ndarray:
        """The ids of edges, given the edges' numbers in ``id``."""
        if len(out) and out.min() < 0:
            out = np.array([i for e in out.tolist() for i in ((e,) if e >= 0 else self.byte_ids[-1 - e])])
        return out.astype("<u4")

    def edges_of(self, node: int) -> tuple[int, int]:
        first = self.first_edge.all
        return int(first[node]), int(first[node + 1]) if node + 1 < len(first) else self.upto.n


def offset(step: np.uint64, times: int) -> np.uint64:
    return np.uint64(int(step) * times % (1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's output function: a random stream by counter, so no draw depends on the rows around it."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def uniform(counters: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    bits = mixed(counters)
    bits >>= np.uint64(12)
    out = bits.astype(np.float64)
    out += 0.5
    out *= 2.0 ** -52
    return out


def cut_gumbel(mass: np.ndarray, bound: np.ndarray | float, noise: np.ndarray) -> np.ndarray:
    """Gumbel variables of given locations, conditioned to lie below ``bound``, from exponential noise."""
    spread = mass - bound
    np.minimum(spread, 700.0, out=spread)
    np.exp(spread, out=spread)
    spread += noise
    np.log(spread, out=spread)
    np.subtract(mass, spread, out=spread)
    return np.minimum(spread, bound, out=spread)


class Leaf:
    """A sampled path and the sets that split off it from place ``since`` on.

    ``upto`` is the log probability of the path up to and with each piece;
    ``before``, from ``since`` on, that of the path in front of each piece.
    """

    def __init__(self, value: float, since: int, units: np.ndarray, edges: np.ndarray, ids: np.ndarray, upto: np.ndarray):
        self.value, self.since, self.units, self.edges, self.ids, self.upto = value, since, units, edges, ids, upto
        self.log_prob = float(upto[-1]) if len(upto) else 0.0
        self.before = self.sets = upto[:0]


class Search:
    """The search of one text: its samples so far and the disjoint sets of all other paths."""

    def __init__(self, lattices: Lattices, starts: np.ndarray, key: np.uint64):
        self.lattices, self.starts = lattices, starts
        self.begin = lattices.first_edge.all[starts]
        with np.errstate(over="ignore"):
            self.streams = mixed(key + UNIT * np.arange(1, len(starts) + 1, dtype=np.uint64))
        self.key = key
        self.leaves: list[Leaf] = []
        #: (value, leaf, place, edges that are taken) of sets at a place where more than one piece is taken.
        self.narrowed: list[tuple] = []

    def scalar(self, number: int) -> float:
        """``uniform`` of a single counter."""
        x = (int(self.key) + int(OWN) * number) % (1 << 64)
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
        return ((x ^ x >> 31) // 4096 + 0.5) * 2.0 ** -52

    def first(self, value: float, units: np.ndarray, edges: np.ndarray, ids: np.ndarray, log_p: np.ndarray) -> None:
        self.leaves.append(Leaf(value, 0, units, edges, ids, np.cumsum(log_p)))

    def first_value(self) -> float:
        return -math.log(-math.log(self.scalar(0)))

    def best(self) -> tuple[float, tuple | None]:
        """The greatest value in any set, and where the set is."""
        best, where = -math.inf, None
        for leaf in self.leaves:
            if len(leaf.sets):
                at = int(leaf.sets.argmax())
                if leaf.sets[at] > best:
                    best, where = float(leaf.sets[at]), (leaf, leaf.since + at, (int(leaf.edges[leaf.since + at]),), None)
        for entry in self.narrowed:
            if entry[0] > best:
                best, where = entry[0], (*entry[1:], entry)
        return best, where

    def branch(self, where: tuple) -> tuple:
        """Take a set: draw its piece at the place of the split.  The rest of its path starts at the given node."""
        leaf, place, used, entry = where
        if entry is None:
            leaf.sets[place - leaf.since] = -math.inf
        else:
            self.narrowed.remove(entry)
        lattices, unit = self.lattices, int(leaf.units[place])
        inside = place and leaf.units[place - 1] == unit
        a, b = lattices.edges_of(int(lattices.target.all[leaf.edges[place - 1]] if inside else self.starts[unit]))
        chance = np.exp(lattices.log_p.all[a:b])
        chance[[e - a for e in used]] = 0.0
        upto = np.cumsum(chance)
        edge = a + int(np.searchsorted(upto, self.scalar(2 * len(self.leaves)) * upto[-1], side="right").clip(0, b - a - 1))
        chance[edge - a] = 0.0
        return leaf, place, (*used, edge), unit, edge, float(chance.sum())

    def add(self, taken: tuple, value: float, units: np.ndarray, edges: np.ndarray, ids: np.ndarray, log_p: np.ndarray) -> None:
        """The path drawn from a set is the next sample; what is left of the set stays in the search."""
        leaf, place, used, unit, edge, left = taken
        number = len(self.leaves)
        # Added up from the path's first piece on, as a path of its own would be.
        own = [float(self.lattices.log_p.all[edge])]
        upto = np.cumsum(np.concatenate((leaf.upto[place - 1:place], own, log_p)))[min(place, 1):]
        self.leaves.append(Leaf(
            value, place + 1, np.concatenate((leaf.units[:place], [unit], units)), np.concatenate((leaf.edges[:place], [edge], edges)),
            np.concatenate((leaf.ids[:place], [self.lattices.id.all[edge]], ids)), np.concatenate((leaf.upto[:place], upto))))
        if left > 0:
            spare = -math.log(self.scalar(2 * number + 1))
            mass = np.array([leaf.before[place - leaf.since] + math.log(left)])
            self.narrowed.append((float(cut_gumbel(mass, value, np.array([spare]))[0]), leaf, place, used))


def top_k(lattices: Lattices, starts: list[np.ndarray], k: int, keys: list[np.uint64]) -> list[tuple[list[Leaf], float]]:
    """Per text up to ``k`` distinct paths in the order of their perturbed values, and the value of the next one.

    Each round draws one path for every text, all of them in one go.
    """
    searches = [Search(lattices, s, key) for s, key in zip(starts, keys)]
    jobs = [(search, None, search.first_value(), 0, search.begin) for search in searches]
    for round_ in range(k):
        if round_:
            jobs = []
            for search in searches:
                value, where = search.best()
                if where is not None:
                    taken = search.branch(where)
                    begin = search.begin[taken[3]:].copy()
                    begin[0] = lattices.next.all[taken[4]]
                    jobs.append((search, taken, value, taken[3], begin))
        if not jobs:
            break
        unit_of, path, noise = lattices.draw(
            np.concatenate([j[4] for j in jobs]), np.concatenate([j[0].streams[j[3]:] for j in jobs]), round_)
        drawn = path, lattices.id.all[path], lattices.log_p.all[path]
        ends = np.cumsum([len(j[4]) for j in jobs])
        cuts = np.searchsorted(unit_of, np.concatenate(([0], ends)))
        before = np.empty(len(path))
        for (search, taken, value, unit, begin), end, a, b in zip(jobs, ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            units = unit_of[a:b] + (unit - (end - len(begin)))
            if taken is None:
                search.first(value, units, *(d[a:b] for d in drawn))
            else:
                search.add(taken, value, units, *(d[a:b] for d in drawn))
            leaf = search.leaves[-1]
            leaf.before = np.subtract(leaf.upto[leaf.since:], drawn[2][a:b], out=before[a:b])
        # The sets that split off the new pieces, of all texts at once.
        values = np.repeat(np.array([j[2] for j in jobs]), np.diff(cuts))
        sets = cut_gumbel(before + lattices.log_others.all[path], values, noise)
        for (search, *_), a, b in zip(jobs, cuts[:-1].tolist(), cuts[1:].tolist()):
            search.leaves[-1].sets = sets[a:b]
    return [(search.leaves, search.best()[0]) for search in searches]


def log_inclusion(log_prob: float, threshold: float) -> float:
    """Log of the probability that a path's perturbed value passes the threshold."""
    if threshold == -math.inf:
        return 0.0
    gap = log_prob - threshold
    if gap < -30:
        return gap
    return math.log(-math.expm1(-math.exp(min(gap, 700.0))))


class Sampler:
    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.lattices = Lattices(self.pieces)

    def sample(self, texts: list[str], k: int, keys: list[int]) -> list[tuple[list[tuple[Leaf, np.ndarray]], float]]:
        """Per text its samples with their ids, and the perturbed value of the next one."""
        lattices = self.lattices
        if lattices.first_edge.n > MEMO_NODES:
            lattices.forget()
        units, counts = self.pieces.units([MARK + t.replace(" ", MARK) if t else "" for t in texts])
        nodes = lattices.nodes(units)
        ends = np.cumsum(counts)
        starts = np.split(nodes, ends[:-1]) if texts else []
        found = top_k(lattices, starts, k, [mixed(np.array([key % (1 << 64)], dtype=np.uint64))[0] for key in keys])
        return [([(leaf, lattices.ids(leaf.ids)) for leaf in leaves], threshold) for leaves, threshold in found]


@lru_cache(maxsize=2)
def sampler(path: str) -> Sampler:
    """The worker's sampler for a model."""
    return Sampler(path)


SAMPLES = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()),
                     ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("log_inclusion", pa.float64()),
                     ("restored", pa.bool_()), ("ids", pa.binary())])
SAMPLES_DDL = ("doc_id bigint, sample int, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, "
               "log_inclusion double, restored boolean, ids binary")


def row_key(seed: int, doc_id: int | None) -> int:
    """64 bits for a row's random stream, the same in every run; different
    identifiers have different ones."""
    named = hashlib.blake2b(f"{seed} {doc_id is None}".encode(), digest_size=8).digest()
    return ((doc_id or 0) ^ int.from_bytes(named, "big")) % (1 << 64)


def sample_segmentations(docs: DataFrame, k: int = 3, model: str | None = None, seed: int = 0, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``k`` distinct segmentations of every text, a row each.

    ``sample`` counts from 1 in falling order of ``perturbed``; ``log_inclusion``
    is the log probability of being among the samples, given the next value;
    ``restored`` tells whether the ids decode to the text (a mark character in
    it reads as a blank); ``ids`` are little-endian unsigned 32-bit.
    """
    path = model or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = sampler(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part, rows = batch.slice(start, 200), []
                doc_ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                keys = [row_key(seed, doc_id) for doc_id in doc_ids]
                for doc_id, text, (samples, threshold) in zip(doc_ids, texts, draw.sample(texts, k, keys)):
                    wanted = text.replace(MARK, " ").encode()
                    for number, (leaf, ids) in enumerate(samples, 1):
                        raw = ids.tobytes()
                        rows.append((doc_id, number, len(ids), zlib.crc32(raw), leaf.log_prob, leaf.value,
                                     log_inclusion(leaf.log_prob, threshold),
                                     draw.pieces.decode(ids) == wanted, raw))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SAMPLES)], schema=SAMPLES)

    return common.rows_of_text(docs, id_col, text_col).mapInArrow(run, SAMPLES_DDL)


def decode_ids(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """With ``text``: what the ids of each row stand for; null ids give null."""
    path = model or default_path()

    @F.pandas_udf("string")
    def decode(column):
        pieces = sampler(path).pieces
        return column.map(lambda raw: None if raw is None else pieces.decode(np.frombuffer(raw, "<u4")).decode(errors="replace"))

    return rows.withColumn("text", decode(F.col(ids_col)))
