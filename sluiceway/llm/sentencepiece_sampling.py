"""Distinct sampled segmentations, as paths arrive or by perturbed search over the lattice of a SentencePiece vocabulary."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from sluiceway.llm.anchored import mixed
from sluiceway.llm.shared import portions

SPACE = "▁"
#: Units whose lattices a worker keeps; when full, it starts anew.
KEPT_UNITS = 250_000
#: Characters of units whose lattices are made together, or one unit that has more.
LEARNT_POINTS = 50_000
#: Of a code point, behind the number of the beginning of a piece that it follows.
POINT_BITS = 21
#: Of the hashes that beginnings of pieces are looked up by, and of draws.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)
HIGH_BITS, LOW_BITS = 18, np.uint64(46)


class Vocabulary:
    """Pieces of a model file with a log weight each.

    A merge vocabulary stores ranks, not probabilities; the weight of rank r is -log(r + 2), the law
    of Zipf, and byte pieces and runs without a rank have the last rank.
    """

    def __init__(self, path: str):
        self.processor = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        plain = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.last = -math.log(size + 2)
        self.weight = {
            model.id_to_piece(i): -math.log(-s + 2) if (s := model.get_score(i)) > -size else self.last for i in plain
        }
        self.longest = max(map(len, self.ids))
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # a text falls into units wherever no piece has the two bytes there, the last of a character and the first
        # of the next one, one after the other; a byte that goes on with a character begins none
        self.joined = np.zeros(2**16, bool)
        self.joined.reshape(256, 256)[:, 0x80:0xC0] = True
        for piece in self.ids:
            self.joined[pairs(np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8))] = True

    def units_of(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct units of texts, which of them those of all texts are, and how many each text has.

        Together a text's units are the text, a space before it, its spaces marked."""
        written = [f" {t.replace(SPACE, ' ')}".encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(written), np.uint8)
        ends = np.cumsum([0, *map(len, written)])
        begins = np.ones(len(data), bool)
        begins[1:] = ~self.joined[pairs(data)]
        begins[ends[:-1][np.diff(ends) > 0]] = True
        cuts = np.append(np.flatnonzero(begins), len(data))
        parts = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        names = pa.compute.replace_substring(coded.dictionary, " ", SPACE)
        return names, coded.indices.to_numpy(), np.diff(np.searchsorted(cuts[:-1], ends))

    def units(self, text: str) -> list[str]:
        """A text's units, in order."""
        names, kinds, _ = self.units_of([text])
        return names.take(pa.array(kinds)).to_pylist()


def pairs(data: np.ndarray) -> np.ndarray:
    """Every two neighbouring bytes as one number."""
    return data[:-1].astype(np.uint16) << 8 | data[1:]


@dataclass
class Edges:
    """Growing arrays with a row per lattice edge of all known units."""

    upto: np.ndarray  # the state's number plus the share of edges up to this one
    log_share: np.ndarray
    to: np.ndarray  # the state it leads to; -1 at a unit's end
    state: np.ndarray
    piece: np.ndarray  # the number of its text in ``Lattices.texts``


@dataclass
class Likely:
    """Growing arrays with a row per known unit, of its path that takes the edge with the largest share everywhere."""

    start: np.ndarray  # the unit's first state
    log_prob: np.ndarray
    begin: np.ndarray  # of its identifiers in ``Lattices.ids``
    size: np.ndarray
    spelt: np.ndarray  # whether its pieces spell the unit


class Lattices:
    """States and edges of known units. An edge's share is its part of the mass of its state's paths."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.plain = [*vocabulary.ids]
        self.weights = np.array([vocabulary.weight[t] for t in self.plain])
        # beginnings of pieces are nodes, the empty one is 0; a node and a character lead to a longer one
        nodes: dict[int, int] = {}
        ends = []
        for text in self.plain:
            node = 0
            for c in text:
                node = nodes.setdefault(node << POINT_BITS | ord(c), len(nodes) + 1)
            ends.append(node)
        keys = np.array([*nodes], np.uint64)
        self.ending = np.full(len(nodes) + 1, -1, np.int32)  # the piece that a node is, or -1
        self.ending[ends] = np.arange(len(ends))
        self.inner = np.zeros(len(nodes) + 1, bool)  # whether pieces go on behind a node
        self.inner[(keys >> np.uint64(POINT_BITS)).astype(np.int64)] = True
        hashes = keys * SPREAD  # no two are equal, as the factor is odd
        self.node = np.argsort(hashes)
        self.hashes = hashes[self.node]
        self.root = np.zeros(0x110000, np.int32)  # the node of each character, or 0
        self.node = (self.node + 1).astype(np.int32)
        single = np.flatnonzero(keys < len(self.root))
        self.root[keys[single].astype(np.int64)] = single + 1
        # the first node whose hash has no smaller high bits, and whether several have the same
        self.begin = np.searchsorted(self.hashes, np.arange(2**HIGH_BITS, dtype=np.uint64) << LOW_BITS).astype(np.int32)
        self.begin = np.minimum(self.begin, len(keys) - 1)
        self.several = np.bincount((self.hashes >> LOW_BITS).astype(np.int64), minlength=2**HIGH_BITS) > 1
        self.clear()

    def clear(self) -> None:
        self.starts: dict[str, int] = {}
        self.known: list[pa.Array] = []  # the same units, in order
        self.states = self.built = self.listed = 0
        none, whole, large = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # each state's first edge, and the number of all edges
        self.likely = whole  # each state's edge with the largest share
        self.rest = none  # the share of the state's other edges
        self.leave = none  # the share of a state's paths that do not take such edges up to the unit's end
        self.edges = Edges(none, none, whole, whole, whole)
        self.paths = Likely(large, none, large, large, np.zeros(0, bool))
        self.ids = np.zeros(0, "<u4")
        self.texts: list[bytes] = [t.encode() for t in self.plain]
        self.sizes = np.zeros(0, np.int64)
        self.single = np.array([self.vocabulary.ids[t] for t in self.plain], "<u4")
        self.characters: dict[str, int] = {}

    def character(self, text: str) -> int:
        """The number of a character without a piece, which is written as bytes."""
        if (n := self.characters.get(text)) is None:
            n = self.characters[text] = len(self.texts)
            self.texts.append(text.encode())
        return n

    def written(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The identifiers of pieces, those written as bytes having several, and the bytes they spell; where
        each piece's begin, and an end."""
        if len(self.sizes) < len(self.texts):
            own = [self.vocabulary.bytes[b] for t in self.texts[len(self.plain) :] for b in t]
            self.flat = np.concatenate([self.single, np.array(own, "<u4")])
            self.sizes = np.array([1] * len(self.plain) + [*map(len, self.texts[len(self.plain) :])], np.int64)
            self.begins = np.cumsum(self.sizes) - self.sizes
            self.spelled = np.frombuffer(b"".join(self.texts), np.uint8)
            self.widths = np.array([*map(len, self.texts)], np.int64)
            self.letters = np.cumsum(self.widths) - self.widths
        ids, id_ends = spans(self.flat, self.begins[numbers], self.sizes[numbers])
        letters, letter_ends = spans(self.spelled, self.letters[numbers], self.widths[numbers])
        return ids, id_ends, letters, letter_ends

    def learn(self, units: list[str]) -> None:
        new = [u for u in dict.fromkeys(units) if u not in self.starts]
        if len(self.starts) + len(new) > KEPT_UNITS:
            self.clear()
            new = [*dict.fromkeys(units)]
        ends = np.cumsum([*map(len, new)])
        start = 0
        while start < len(new):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + LEARNT_POINTS, side="right")))
            self.add(new[start:end])
            start = end

    def rows(self, units: pa.Array) -> np.ndarray:
        """Where different units are in ``paths``; what is not known of them is learnt first."""
        found = pa.compute.index_in(units, value_set=pa.chunked_array(self.known, pa.large_string()))
        if len(self.starts) + found.null_count > KEPT_UNITS:
            self.clear()
            found = pa.nulls(len(units), pa.int32())
        rows = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        rows[rows < 0] = len(self.starts) + np.arange(found.null_count)
        self.learn(units.filter(found.is_null()).to_pylist())
        return rows

    def log_rests(self, edges: np.ndarray) -> np.ndarray:
        """The log share of the other edges of each edge's state together."""
        states = self.edges.state[edges]
        rest = np.where(self.likely[states] == edges, self.rest[states], -np.expm1(self.edges.log_share[edges]))
        with np.errstate(divide="ignore"):
            return np.log(rest)

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the node with each hash is, and whether there is one."""
        high = (hashes >> LOW_BITS).astype(np.int64)
        at = self.begin[high]
        hit = self.hashes[at] == hashes
        more = np.flatnonzero(self.several[high] & ~hit)
        at[more] = np.minimum(np.searchsorted(self.hashes, hashes[more]), len(self.hashes) - 1)
        hit[more] = self.hashes[at[more]] == hashes[more]
        return at, hit

    def found(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places in code points, by place and length, with lengths, numbers and log weights of the pieces there.

        ``left`` says how far it is to the end of the unit. A character without a piece has the weight of its bytes."""
        now = self.root[points]
        live = np.flatnonzero(now)
        now = now[live]
        ending = self.ending[now]
        there = ending >= 0
        places, pieces = [live[there]], [ending[there]]
        weights, lengths = [self.weights[pieces[0]]], [np.ones(len(places[0]), np.int64)]
        bare = np.ones(len(points), bool)
        bare[places[0]] = False
        bare = np.flatnonzero(bare)
        if len(bare):
            kinds, kind = np.unique(points[bare], return_inverse=True)
            numbers = [self.character(chr(c)) for c in kinds.tolist()]
            places.append(bare), lengths.append(np.ones(len(bare), np.int64))
            pieces.append(np.array(numbers, np.int32)[kind])
            weights.append(np.array([len(self.texts[n]) for n in numbers])[kind] * self.vocabulary.last)
        for k in range(1, self.vocabulary.longest):  # pieces of k + 1 characters
            on = np.flatnonzero(self.inner[now] & (left[live] > k))
            live = live[on]
            if not len(live):
                break
            at, hit = self.look((now[on].astype(np.uint64) << np.uint64(POINT_BITS) | points[live + k]) * SPREAD)
            live, now = live[hit], self.node[at[hit]]
            ending = self.ending[now]
            there = ending >= 0
            places.append(live[there]), pieces.append(ending[there]), lengths.append(np.full(len(places[-1]), k + 1))
            weights.append(self.weights[pieces[-1]])
        place, length, piece, weight = (np.concatenate(x) for x in (places, lengths, pieces, weights))
        order = np.argsort(short(place), kind="stable")
        return place[order], length[order], piece[order], weight[order]

    def add(self, units: list[str]) -> None:
        """Put the lattices of units behind the others, from the units' ends: masses of paths, and edges' shares."""
        sizes = np.array([*map(len, units)], np.int64)
        points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.uint64)
        ends, count = np.cumsum(sizes), len(points)
        left = np.repeat(ends, sizes) - np.arange(count)
        place, length, piece, weight = self.found(points, left)
        own = np.arange(count) + np.repeat(np.arange(len(units)), sizes)  # states; a unit has one more for its end
        state = own[place]
        after = state + length
        edges = np.bincount(place, minlength=count)
        heads = np.cumsum(edges) - edges

        # places as far from the end of their units are worked on together
        near = short(left)
        turn, edge_turn = np.argsort(near, kind="stable"), np.argsort(near[place], kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(left)[1:])])
        own_turn, head_turn = own[turn], np.concatenate([[0], np.cumsum(edges[turn])])
        weight_turn, after_turn = weight[edge_turn], after[edge_turn]
        mass = np.zeros(count + len(units))
        cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        for low, high in cuts:
            start, end = head_turn[low], head_turn[high]
            paths = weight_turn[start:end] + mass[after_turn[start:end]]
            mass[own_turn[low:high]] = np.logaddexp.reduceat(paths, head_turn[low:high] - start)
        log_share = weight + mass[after] - mass[state]
        share = np.exp(log_share)
        running = np.cumsum(share)
        upto = running - np.repeat(running[heads] - share[heads], edges)
        upto[heads + edges - 1] = 1.0
        largest = np.flatnonzero(log_share == np.repeat(np.maximum.reduceat(log_share, heads), edges))
        likely = np.empty(count, np.int64)
        likely[place[largest]] = largest
        others = share.copy()
        others[likely] = 0.0
        rest = np.add.reduceat(others, heads)
        leave = np.zeros(len(mass))
        rest_turn, share_turn, likely_after = rest[turn], share[likely[turn]], after[likely[turn]]
        for low, high in cuts:
            leave[own_turn[low:high]] = rest_turn[low:high] + share_turn[low:high] * leave[likely_after[low:high]]

        at, live, steps = ends - sizes, np.arange(len(units)), []
        while len(live):
            taken = likely[at[live]]
            steps.append((live, taken))
            at[live] += length[taken]
            live = live[at[live] < ends[live]]
        taken, _, begins = in_order(steps, len(units))
        ids, id_ends, letters, letter_ends = self.written(piece[taken])
        cut = np.append(begins, len(taken))
        widths = np.add.reduceat(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), ends - sizes, dtype=np.int64)
        wanted = np.frombuffer("".join(units).encode(), np.uint8)
        spelt = alike(letters, letter_ends[cut], wanted, np.concatenate([[0], np.cumsum(widths)]))

        starts, known = self.states + own[ends - sizes], len(self.starts)
        self.starts.update(zip(units, starts.tolist(), strict=True))
        self.known.append(pa.array(units, pa.large_string()))
        path = (
            starts, np.add.reduceat(log_share[taken], begins), self.listed + id_ends[begins],
            id_ends[cut[1:]] - id_ends[begins], spelt,
        )
        old = self.paths
        arrays = old.start, old.log_prob, old.begin, old.size, old.spelt
        self.paths = Likely(*(grown(a, known, b) for a, b in zip(arrays, path, strict=True)))
        self.ids = grown(self.ids, self.listed, ids)
        per_state = np.zeros(len(mass), np.int64)
        per_state[own] = edges
        end = self.built + len(place)
        self.first = grown(self.first, self.states, np.append(end - len(place) + np.cumsum(per_state) - per_state, end))
        self.leave = grown(self.leave, self.states, leave)
        per_state_rest, likely_edge = np.zeros(len(mass)), np.zeros(len(mass), np.int32)
        per_state_rest[own], likely_edge[own] = rest, self.built + likely
        self.rest = grown(self.rest, self.states, per_state_rest)
        self.likely = grown(self.likely, self.states, likely_edge)
        to = np.where(length < left[place], self.states + after, -1)
        old, state = self.edges, self.states + state
        arrays = old.upto, old.log_share, old.to, old.state, old.piece
        new = state + upto, log_share, to.astype(np.int32), state.astype(np.int32), piece.astype(np.int32)
        self.edges = Edges(*(grown(a, self.built, b) for a, b in zip(arrays, new, strict=True)))
        self.states += len(mass)
        self.built, self.listed = end, self.listed + len(ids)


def short(numbers: np.ndarray) -> np.ndarray:
    """The same numbers, none below 0, in two bytes if they fit there; those are sorted faster."""
    return numbers.astype(np.uint16) if numbers.max() < 2**16 else numbers


def in_order(steps: list[tuple[np.ndarray, np.ndarray]], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges of ``count`` walks made together, walk by walk, whose each is, and where each walk begins."""
    owner, taken = (np.concatenate(x) for x in zip(*steps, strict=True))
    sizes = np.bincount(owner, minlength=count)
    order = np.argsort(owner, kind="stable")
    return taken[order], owner[order], np.cumsum(sizes) - sizes


def alike(letters: np.ndarray, cuts: np.ndarray, wanted: np.ndarray, wanted_cuts: np.ndarray) -> np.ndarray:
    """Whether each stretch of letters is the one that is wanted."""
    if np.array_equal(letters, wanted) and np.array_equal(cuts, wanted_cuts):
        return np.ones(len(cuts) - 1, bool)
    found, sought = letters.tobytes(), wanted.tobytes()
    places = zip(cuts[:-1].tolist(), cuts[1:].tolist(), wanted_cuts[:-1].tolist(), wanted_cuts[1:].tolist(), strict=True)
    return np.array([found[a:b] == sought[c:d] for a, b, c, d in places], bool)


def grown(values: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """An array with more values from a place on, and with room for as many again where it has to be a new one."""
    end = used + len(more)
    if end > len(values):
        room = np.empty(2 * end, values.dtype)  # what is not used takes no memory
        room[:used] = values[:used]
        values = room
    values[used:end] = more
    return values


def spans(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of an array one after another, and where each begins there, with the end of all."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    if ends[-1] == len(sizes) and (sizes == 1).all():
        return values[begins], ends
    kind = np.int32 if max(len(values), ends[-1]) < 2**31 else np.int64  # half the memory to go through
    place = np.repeat((begins - ends[:-1]).astype(kind), sizes)
    place += np.arange(ends[-1], dtype=kind)
    return values[place], ends


@dataclass
class Lump:
    """All paths that follow a sampled one up to a step and there take none of the barred edges."""

    top: float  # the largest perturbed log probability among them
    path: Path
    step: int
    barred: tuple[int, ...]


@dataclass
class Sample:
    """A path as it is given out."""

    ids: bytes  # of 4 bytes each, the lowest first
    log_prob: float
    perturbed: float
    spelt: bool  # whether the pieces spell the text, its spaces marked


@dataclass
class Path:
    edges: np.ndarray
    unit: np.ndarray
    logs: np.ndarray  # log shares of the steps
    before: np.ndarray  # log probability of the steps before each
    log_prob: float
    perturbed: float


def truncated(place: np.ndarray, top: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Gumbel values at the given places from uniform draws, none above ``top``."""
    with np.errstate(over="ignore"):
        return place - np.log(np.exp(place - top) - np.log(draw))


class Draws:
    """Uniform draws by a text's seed, the sample's number and a place, so that they do not depend on
    which texts are worked on together."""

    def __init__(self, seeds: np.ndarray):
        self.seeds = mixed(seeds)

    def at(self, text: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What ``of`` takes: the start of a counter for each text and place."""
        return self.seeds[text] + mixed(place.astype(np.uint64) + FACTOR)

    @staticmethod
    def of(at: np.ndarray, sample: int, kind: int, step: int = 0) -> np.ndarray:
        turn = (((step << 24 | sample) << 2 | kind) + 1) * int(FACTOR) % 2**64
        bits = mixed(at + np.uint64(turn))
        return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


#: What a draw is for.
ROOT, STEP, WAY, REST = range(4)


class Batch:
    """Top-down search for the largest perturbed log probabilities, of many texts at once.

    The root's maximum is a Gumbel draw. Of an opened lump the best path is drawn by the edges'
    shares and has the lump's maximum; what is left of it falls into one lump a step, whose maxima
    are Gumbel draws under that of their parent. So opening the best lump again and again gives the
    distinct paths that a draw for every path would have ranked first. Masses are exact, so no lump
    is opened in vain. Each round opens one lump of every text, and walks all their units together.
    """

    def __init__(self, lattices: Lattices, texts: list[list[str]], seeds: np.ndarray):
        self.lattices, self.draws = lattices, Draws(seeds)
        sizes = np.array([len(units) for units in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])  # of each text's units
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.states = np.array([lattices.starts[u] for units in texts for u in units], np.int64)
        self.counters = self.draws.at(self.text, np.arange(len(self.text)) - self.first[self.text] + 1)  # of each unit

    def walk(self, units: np.ndarray, states: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn from each state to its unit's end, in order, and where each is among ``units``."""
        upto, to, first = self.lattices.edges.upto, self.lattices.edges.to, self.lattices.first
        counters = self.counters[units]
        at, live, steps = states.copy(), np.flatnonzero(states >= 0), []
        while len(live):
            draw = Draws.of(counters[live], sample, STEP, len(steps))
            here = at[live]
            taken, target = first[here + 1] - 1, here + draw
            # long pieces come last and have most of the mass, so few go far back
            back = np.flatnonzero((taken > first[here]) & (upto[taken - 1] > target))
            while len(back):
                taken[back] -= 1
                now = taken[back]
                back = back[(now > first[here[back]]) & (upto[now - 1] > target[back])]
            steps.append((live, taken))
            here = to[taken]
            at[live] = here
            live = live[here >= 0]
        if not steps:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, taken = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.argsort(owner, kind="stable")
        return taken[order], owner[order]

    def way(self, lump: Lump, draw: float) -> tuple[int, float]:
        """The edge that a lump's best path takes at its step, and the log share of those it might still take."""
        edges = self.lattices.edges
        state = edges.state[lump.path.edges[lump.step]]
        low, high = self.lattices.first[state : state + 2].tolist()
        shares = {low + n: math.exp(x) for n, x in enumerate(edges.log_share[low:high].tolist()) if low + n not in lump.barred}
        rest = draw * math.fsum(shares.values())
        for chosen, share in shares.items():
            rest -= share
            if rest < 0:
                break
        left = math.fsum(share for edge, share in shares.items() if edge != chosen)
        return chosen, math.log(left) if left > 0 else -math.inf

    def opened(self, lumps: dict[int, Lump | None], tops: dict[int, float], sample: int, want: int) -> dict[int, tuple[Path, list[Lump]]]:
        """By text, the best path of a lump (of all paths if None), and at most ``want`` of the best lumps left of it."""
        edges = self.lattices.edges
        units, states, ways = [], [], {}
        texts = np.array([*lumps], np.int64)
        draws = Draws.of(self.draws.at(texts, np.zeros(len(texts))), sample, WAY).tolist()
        for (text, lump), draw in zip(lumps.items(), draws, strict=True):
            begin = int(self.first[text])
            if lump is not None:
                ways[text] = self.way(lump, draw)
                begin += int(lump.path.unit[lump.step])
            own = np.arange(begin, self.first[text + 1])
            start = self.states[own]
            if lump is not None:
                start[0] = edges.to[ways[text][0]]
            units.append(own), states.append(start)
        counts = np.cumsum([0, *map(len, units)])
        every = np.concatenate([*units, np.zeros(0, np.int64)])
        taken, owner = self.walk(every, np.concatenate([*states, np.zeros(0, np.int64)]), sample)
        local = every[owner] - self.first[self.text[every[owner]]]
        cuts = np.searchsorted(owner, counts)
        paths, places, kept = {}, [], []
        shares, rests = edges.log_share[taken], self.lattices.log_rests(taken)
        for n, (text, lump) in enumerate(lumps.items()):
            own, unit = taken[cuts[n] : cuts[n + 1]], local[cuts[n] : cuts[n + 1]]
            step = 0
            if lump is not None:
                old, step = lump.path, lump.step
                own = np.concatenate([old.edges[:step], [ways[text][0]], own])
                unit = np.concatenate([old.unit[: step + 1], unit])
            logs, cut = shares[cuts[n] : cuts[n + 1]], 0
            if lump is not None:
                cut = step + 1
                logs = np.concatenate([old.logs[:step], [edges.log_share[ways[text][0]]], logs])
            sums = np.cumsum(logs)
            path = Path(own, unit, logs, sums - logs, float(sums[-1]) if len(sums) else 0.0, tops[text])
            place = path.before[step:].copy()
            place[cut - step :] += rests[cuts[n] : cuts[n + 1]]
            if lump is not None:
                place[0] = path.before[step] + ways[text][1]
            paths[text] = path
            places.append(place), kept.append(step)
        sizes = np.array([*map(len, places)], np.int64)
        ends = np.cumsum(sizes)
        flat = np.concatenate([*places, np.zeros(0)])
        number = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
        draw = Draws.of(self.draws.at(np.repeat(texts, sizes), number), sample, REST)
        there = np.isfinite(flat)
        values = np.full(len(flat), -np.inf)
        values[there] = truncated(flat[there], np.repeat([tops[t] for t in lumps], sizes)[there], draw[there])
        out = {}
        for n, (text, lump) in enumerate(lumps.items()):
            own, path, step = values[ends[n] - sizes[n] : ends[n]], paths[text], kept[n]
            best = np.argpartition(-own, want)[:want] if len(own) > want else np.arange(len(own))
            barred = lump.barred if lump is not None else ()
            out[text] = path, [
                Lump(float(own[k]), path, step + int(k), (*barred, int(path.edges[step])) if k == 0 else (int(path.edges[step + k]),))
                for k in best
                if own[k] > -np.inf
            ]
        return out

    def samples(self, count: int) -> list[tuple[list[Path], float]]:
        """Of each text at most ``count`` distinct paths, best first, and the threshold that the next one would have."""
        size = len(self.first) - 1
        root = Draws.of(self.draws.at(np.arange(size), np.zeros(size)), 0, ROOT)
        tops = dict(enumerate((-np.log(-np.log(root))).tolist()))
        paths: list[list[Path]] = [[] for _ in range(size)]
        waiting: list[list[Lump]] = [[] for _ in range(size)]
        lumps: dict[int, Lump | None] = dict.fromkeys(range(size))
        for sample in range(count):
            for text, (path, more) in self.opened(lumps, tops, sample, count).items():
                paths[text].append(path)
                waiting[text] = waiting[text][:count] + more
            if sample == count - 1:
                break
            lumps, tops = {}, {}
            for text, held in enumerate(waiting):
                if held:
                    held.sort(key=lambda x: -x.top)
                    lumps[text] = held.pop(0)
                    tops[text] = lumps[text].top
        return [(found, max((x.top for x in left), default=-math.inf)) for found, left in zip(paths, waiting, strict=True)]


class Sampler:
    """The samples of one text, seeded by a generator."""

    def __init__(self, lattices: Lattices, units: list[str], draw: np.random.Generator):
        self.batch = Batch(lattices, [units], draw.integers(0, 2**63, 1).astype(np.uint64))

    def sample(self, count: int) -> tuple[list[Path], float]:
        return self.batch.samples(count)[0]


class Arrivals:
    """Paths of many texts in the order in which they arrive, one in a unit of time on average.

    Whole paths arrive at the times of a Poisson process, each drawn anew by its probability. So a path's first
    arrival is exponential with its probability as the rate, and minus the log of that time is its perturbed log
    probability: the distinct paths, as they arrive, are those that a draw for every path would have ranked first.
    This is for texts none of whose paths arrives often. A unit takes its likely path unless a draw says otherwise,
    and only units that leave theirs are walked.
    """

    def __init__(self, lattices: Lattices, names: pa.Array, rows: np.ndarray, kinds: np.ndarray, sizes: np.ndarray, seeds: np.ndarray):
        """Units, and where they are among the known; which of them those of all texts are, one text after another;
        and how many each text has, one at least."""
        self.lattices, self.draws, self.kinds, self.sizes = lattices, Draws(seeds), kinds, sizes
        self.first = np.cumsum(sizes) - sizes  # of each text's units
        text = np.repeat(np.arange(len(sizes)), sizes)
        self.counters = self.draws.at(text, np.arange(len(kinds)) - self.first[text] + 1)  # of each unit
        _, offsets, data = names.buffers()
        self.letters = np.frombuffer(data or b"", np.uint8)
        self.letter_ends = np.frombuffer(offsets, np.int64)[names.offset : names.offset + len(names) + 1]
        paths = lattices.paths
        self.states, self.log_prob, self.id_sizes, self.spelt = (x[rows] for x in (paths.start, paths.log_prob, paths.size, paths.spelt))
        self.leave = lattices.leave[self.states]
        self.ids, ends = spans(lattices.ids, paths.begin[rows], self.id_sizes)
        self.begins = ends[:-1]

    @staticmethod
    def fits(lattices: Lattices, rows: np.ndarray, kinds: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
        """Whether it is rare that the same path of a text is twice among so many that arrive."""
        leave = lattices.leave[lattices.paths.start[rows]]
        most = np.log(np.maximum(1 - leave, leave))[kinds]  # no path of a unit has more
        sums = np.zeros(len(sizes))
        held = np.flatnonzero(sizes)
        if len(held):
            sums[held] = np.add.reduceat(most, (np.cumsum(sizes) - sizes)[held])
        return sums <= -math.log(10 * (count + 1))

    def walk(self, states: np.ndarray, counters: np.ndarray, arrival: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn from each unit's first state to its end, not all of them the likely ones, and where each walk begins."""
        lattices, edges = self.lattices, self.lattices.edges
        at, held, live, steps = states.copy(), np.ones(len(states), bool), np.arange(len(states)), []
        while len(live):
            here, bound = at[live], held[live]  # those that have taken likely edges only have to leave them still
            low, taken, likely = lattices.first[here], lattices.first[here + 1] - 1, lattices.likely[here]
            rest = Draws.of(counters[live], arrival, STEP, len(steps)) * np.where(bound, lattices.leave[here], 1.0)
            seek = np.arange(len(live))
            while len(seek):
                now = taken[seek]
                share = np.exp(edges.log_share[now])
                again = np.flatnonzero(bound[seek] & (now == likely[seek]))
                to = edges.to[now[again]]
                share[again] *= np.where(to < 0, 0.0, lattices.leave[to])
                rest[seek] -= share
                seek = seek[(rest[seek] >= 0) & (now > low[seek])]
                taken[seek] -= 1
            steps.append((live, taken))
            held[live] = bound & (taken == likely)
            at[live] = here = edges.to[taken]
            live = live[here >= 0]
        taken, _, begins = in_order(steps, len(states))
        return taken, begins

    def arrive(self, arrival: int, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The path of each of the texts that is its arrival number so: log probabilities, identifiers of all, where
        each path's begin, and an end, and whether each path spells its text."""
        edges, sizes = self.lattices.edges, self.sizes[texts]
        places, ends = spans(np.arange(len(self.kinds)), self.first[texts], sizes)
        counters, kinds = self.counters[places], self.kinds[places]
        log_prob, begins, id_sizes, spelt = (x[kinds] for x in (self.log_prob, self.begins, self.id_sizes, self.spelt))
        leaving, ids = np.flatnonzero(Draws.of(counters, arrival, WAY) < self.leave[kinds]), self.ids
        if len(leaving):
            own = kinds[leaving]
            taken, walks = self.walk(self.states[own], counters[leaving], arrival)
            log_prob[leaving] = np.add.reduceat(edges.log_share[taken], walks)
            new, id_ends, letters, letter_ends = self.lattices.written(edges.piece[taken])
            cuts = np.append(walks, len(taken))
            begins[leaving], id_sizes[leaving] = len(ids) + id_ends[walks], np.diff(id_ends[cuts])
            wanted = spans(self.letters, self.letter_ends[own], self.letter_ends[own + 1] - self.letter_ends[own])
            spelt[leaving] = alike(letters, letter_ends[cuts], *wanted)
            ids = np.concatenate([ids, new])
        flat, id_ends = spans(ids, begins, id_sizes)
        return np.add.reduceat(log_prob, ends[:-1]), flat, id_ends[ends], np.logical_and.reduceat(spelt, ends[:-1])

    def samples(self, count: int) -> list[tuple[list[Sample], float]]:
        """Of each text so many distinct paths, best first, and the threshold that the next one has."""
        texts = np.arange(len(self.sizes))
        times, arrival = np.zeros(len(texts)), 0
        found: list[list[Sample]] = [[] for _ in texts]
        thresholds = [0.0] * len(texts)
        while len(texts):
            times[texts] -= np.log(Draws.of(self.draws.at(texts, np.zeros(len(texts))), arrival, ROOT))
            log_prob, flat, cuts, spelt = self.arrive(arrival, texts)
            more, cuts, log_prob, spelt = [], cuts.tolist(), log_prob.tolist(), spelt.tolist()
            for n, text in enumerate(texts.tolist()):
                path = Sample(flat[cuts[n] : cuts[n + 1]].tobytes(), log_prob[n], -math.log(times[text]), spelt[n])
                if all(path.ids != other.ids for other in found[text]):
                    if len(found[text]) == count:
                        thresholds[text] = path.perturbed
                        continue
                    found[text].append(path)
                more.append(text)
            texts, arrival = np.array(more, np.int64), arrival + 1
        return [*zip(found, thresholds, strict=True)]


_lattices: dict[str, Lattices] = {}


def lattices_for(path: str) -> Lattices:
    if path not in _lattices:
        _lattices[path] = Lattices(Vocabulary(path))
    return _lattices[path]


def searched(lattices: Lattices, texts: list[list[str]], seeds: np.ndarray, count: int) -> list[tuple[list[Sample], float]]:
    """Samples and thresholds of texts, by their units, as ``Batch`` finds them."""
    found = Batch(lattices, texts, seeds).samples(count)
    every = [path.edges for paths, _ in found for path in paths]
    cuts = np.cumsum([0, *map(len, every)])
    numbers = lattices.edges.piece[np.concatenate([*every, np.zeros(0, np.int64)])]
    flat, id_ends, letters, letter_ends = lattices.written(numbers)
    wanted = ["".join(units).encode() for units, (paths, _) in zip(texts, found, strict=True) for _ in paths]
    whole = np.frombuffer(b"".join(wanted), np.uint8)
    spelt = alike(letters, letter_ends[cuts], whole, np.cumsum([0, *map(len, wanted)])).tolist()
    out, at, places = [], 0, id_ends[cuts].tolist()
    for paths, threshold in found:
        own = range(at, at + len(paths))
        at += len(paths)
        out.append((
            [Sample(flat[places[n] : places[n + 1]].tobytes(), p.log_prob, p.perturbed, spelt[n]) for n, p in zip(own, paths, strict=True)],
            threshold,
        ))
    return out


def sampled(lattices: Lattices, texts: list[str], seeds: np.ndarray, count: int) -> list[tuple[list[Sample], float]]:
    """Of each text at most so many distinct samples, best first, and the threshold that the next one would have."""
    names, kinds, sizes = lattices.vocabulary.units_of(texts)
    rows = lattices.rows(names)
    fits = Arrivals.fits(lattices, rows, kinds, sizes, count)
    arriving = Arrivals(lattices, names, rows, kinds[np.repeat(fits, sizes)], sizes[fits], seeds[fits]).samples(count)
    ends = np.cumsum(sizes)
    few = [names.take(pa.array(kinds[ends[n] - sizes[n] : ends[n]])).to_pylist() for n in np.flatnonzero(~fits)]
    others, arriving = iter(searched(lattices, few, seeds[~fits], count) if few else []), iter(arriving)
    return [next(arriving if x else others) for x in fits.tolist()]


def log_inclusion(log_prob: float, threshold: float) -> float:
    """The log of the chance that a path's perturbed value exceeds the threshold."""
    if threshold == -math.inf:
        return 0.0
    gap = log_prob - threshold
    if gap < -30:  # 1 - exp(-x) is x
        return gap
    return math.log(-math.expm1(-math.exp(min(gap, 700.0))))


def sampled_segmentations(
    documents: DataFrame, model: str, count: int, seed: int = 7, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """A row per document and sample: key, ``sample`` (from 0, best first), ``n_pieces``, ``log_prob``,
    ``perturbed``, ``log_inclusion``, ``ids_crc32``, ``round_trip`` and, if asked for, ``ids``.

    Samples of a document are distinct; there are fewer than ``count`` if it has no more. A null or
    empty text has one sample without pieces. Draws are seeded by the key, so equal rows get equal
    samples whatever partition they are in; a null key is a key of its own. ``round_trip`` says
    whether decoding gives the text back; it does not if the text holds the mark of spaces itself.
    Other columns are not read; no documents give no rows. ``model`` is a file every executor has.
    No shuffle.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = lattices_for(model)
        for whole in batches:
            for batch in portions(whole):
                where: list[int] = []
                out: list[list] = [[] for _ in range(8)]
                keys, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
                seeds = [xxhash.xxh3_64_intdigest(f"{seed}:{name}".encode()) for name in keys]
                found = sampled(lattices, texts, np.array(seeds, np.uint64), count)
                for i, (value, (paths, threshold)) in enumerate(zip(texts, found, strict=True)):
                    for n, path in enumerate(paths):
                        where.append(i)
                        row = (
                            n, len(path.ids) // 4, path.log_prob, path.perturbed, log_inclusion(path.log_prob, threshold),
                            zlib.crc32(path.ids), path.spelt and SPACE not in value,
                            np.frombuffer(path.ids, "<u4").tolist() if with_ids else None,
                        )
                        for column, item in zip(out, row, strict=True):
                            column.append(item)
                kinds = (
                    pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()),
                )
                columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)][: 8 if with_ids else 7]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(where, pa.int64())), *columns], names=[key, *names]
                )

    names = ["sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "round_trip"] + ["ids"] * with_ids
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(
        sample,
        f"`{key}` {kind}, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
        "ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids,
    )
