"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text is a lattice of vocabulary pieces. No piece reaches across the start of a word or a
line break, so the lattice is a chain of small ones, one for each word with the spaces
before it, and the lattice of a word is built once and kept for later texts of the task.
A piece weighs ``rank ** -alpha``; backward sums make every edge a conditional
probability.

Segmentations are drawn by a perturbed A* search over regions of the lattice. The whole
lattice is a region whose best perturbed log-probability is Gumbel(0). The region with the
highest value is popped: its path is sampled forward, and what is left of it splits into
the siblings of each edge on the path, which are regions whose values are Gumbels of their
mass truncated below the popped value. Popped paths are distinct and come in the order of
their perturbed values; the next value is the threshold of the inclusion scores. All texts
of a slice advance together in numpy.

Random numbers are a hash of the row's key and the place in the lattice, so a row gets the
same segmentations in any partitioning. Characters without a piece become bytes, also the
visible space mark, so decoding gives back every text exactly. A text with fewer
segmentations than asked for gives all of them, with inclusion 1.

Null and empty texts have one empty segmentation. A null id is key 0, repeated rows get
equal rows, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import byte_view, cut_at, long_rows, mix64, pick, slices

SAMPLES = 2
ALPHA = 0.5
#: Bytes of texts that advance together: a step of theirs takes a thousand times as much.
SLICE = 1 << 17
#: Edges of known units a task keeps, of 21 bytes each.
KEPT = 1_500_000
#: Ids that are decoded together: their places and bytes take some twenty times as much.
DECODED = 1 << 17
UNIT = re.compile(r"\n| *[^ \n]+| +")
BYTE = 3  # id of the piece of byte 0
STEP = np.uint64(0x9FB21C651E98DF25)
#: A Gumbel number of 53 bits is below this; log-probability by which a region may fall
#: behind the best before its number is left out, if it cannot win.
GUMBEL, REACH = 40.0, 50.0


class Vocabulary:
    """Pieces by length as hash tables, their weights, and the bytes of every id."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.raw = [b""] * n
        self.weight = np.zeros(n, np.float32)
        found: dict[int, list[int]] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.raw[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace("▁", " ")
                self.raw[i] = piece.encode()
                self.weight[i] = -alpha * np.log(2 - model.get_score(i))
                if UNIT.fullmatch(piece) is None:
                    raise ValueError(f"piece {piece!r} reaches across words")
                found.setdefault(len(piece), []).append(i)
        self.spelling = pa.array(self.raw, pa.binary())
        self.unknown = float(self.weight.min())
        self.sizes = sorted(found)
        self.tables = {}
        for size, own in found.items():
            text = b"".join(map(self.raw.__getitem__, own)).decode()
            sums = prefix(np.frombuffer(text.encode("utf-32-le"), np.uint32))
            codes = hashes(sums, np.arange(len(own)) * size, size)
            order = np.argsort(codes, kind="stable")
            self.tables[size] = Table(codes[order], np.array(own, np.int32)[order])


class Table:
    """Pieces of one length by their hash."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray) -> None:
        self.codes, self.ids = codes, ids
        places, first, counts = np.unique(self.place(codes), return_index=True, return_counts=True)
        self.near = np.zeros(1 << 17, bool)  # most spans are no piece: a small table says so
        self.near[places] = True
        self.first = np.zeros(1 << 17, np.int32)
        self.first[places] = first
        self.most = int(counts.max())

    @staticmethod
    def place(codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(47)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``codes`` are pieces, their ids)."""
        place = self.place(codes)
        maybe = np.flatnonzero(self.near[place])
        code, where = codes[maybe], self.first[place[maybe]]
        for _ in range(self.most - 1):
            where += self.codes[where] < code  # codes ascend, those of a place lie side by side
            np.minimum(where, len(self.codes) - 1, out=where)
        hit = self.codes[where] == code
        return maybe[hit], self.ids[where[hit]]


@lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float) -> Vocabulary:
    return Vocabulary(path, alpha)


def prefix(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers for hashes of spans."""
    n = len(points)
    odd = 0xD1342543DE82EF95
    powers = np.full(n + 1, odd, np.uint64)
    back = np.full(n + 1, pow(odd, -1, 1 << 64), np.uint64)
    powers[0] = back[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(back, out=back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    return sums, back


def hashes(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, size: int) -> np.ndarray:
    total, back = sums
    return mix64((total[starts + size] - total[starts]) * back[starts])


class Lattice:
    """Edges of distinct units, those of a node next to each other in order of length.

    A unit of n characters has n + 1 nodes; node ``k`` of unit ``u`` starts its
    character ``k``, the last one ends the unit.
    """

    def __init__(self, units: list[str], voc: Vocabulary) -> None:
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(length)
        owner = np.repeat(np.arange(len(units)), length)
        node = np.arange(len(points)) + owner
        left = ends[owner] - np.arange(len(points))
        self.start = ends - length + np.arange(len(units))
        self.stop = self.start + length
        total = len(points) + len(units)
        froms, pieces, sums = [], [], prefix(points)
        single = np.zeros(len(points), bool)
        near = np.arange(len(points))
        for size in voc.sizes:
            near = near[left[near] >= size]
            hit, ids = voc.tables[size].find(hashes(sums, near, size))
            at = near[hit]
            froms.append(node[at])
            pieces.append(ids)
            if size == 1:
                single[at] = True
        bare = np.flatnonzero(~single)
        code = points[bare].astype(np.int64)
        # One byte is a piece; more are marked by the negative of their character.
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        froms.insert(0, node[bare])
        pieces.insert(0, np.where(code < 128, BYTE + code, -code).astype(np.int32))
        extra = [voc.unknown * n_bytes, *(voc.weight[i] for i in pieces[1:])]
        sizes = [np.full(len(f), n) for f, n in zip(froms, [1, *voc.sizes], strict=True)]
        at = np.concatenate(froms)
        order = in_order(at, total)
        self.piece = np.concatenate(pieces)[order]
        self.size = np.concatenate(sizes)[order].astype(np.int8)
        counts = np.bincount(at, minlength=total)
        self.first = np.cumsum(counts) - counts
        self.count = counts
        weight = np.concatenate(extra)[order].astype(np.float64)
        self.solve(node, left, at[order] + self.size, weight)

    def solve(self, node: np.ndarray, left: np.ndarray, to: np.ndarray, weight: np.ndarray) -> None:
        """Conditional probabilities of edges, from sums over what follows them."""
        after = np.zeros(len(self.first))
        # Nodes by how far they are from the end, their edges side by side.
        order = in_order(left, int(left.max(initial=0)) + 1)
        node = node[order]
        count = self.count[node]
        at, heads = spread(self.first[node], count), np.cumsum(count) - count
        to, weight = to[at], weight[at]
        share, upto = weight, np.empty(len(weight))  # the last edge of a node takes what is left
        cuts = np.cumsum(np.bincount(left)) if len(left) else np.zeros(1, np.int64)
        edges = np.append(heads, len(at))[cuts]
        for a, z, e, f in zip(cuts, cuts[1:], edges, edges[1:], strict=False):
            if a == z:
                continue
            own, n, head = node[a:z], count[a:z], heads[a:z] - e
            score = weight[e:f] + after[to[e:f]]
            top = np.maximum.reduceat(score, head)
            mass = np.exp(score - np.repeat(top, n))
            total = np.add.reduceat(mass, head)
            after[own] = top + np.log(total)
            mass /= np.repeat(total, n)
            run = np.cumsum(mass)
            before = run[head] - mass[head]
            share[e:f], upto[e:f] = mass, run - np.repeat(before, n)
        upto[heads + count - 1] = 1.0
        self.share, self.upto = np.empty(len(at)), np.empty(len(at))
        self.share[at], self.upto[at] = share, upto

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node into whose part of (0, 1) its number falls."""
        edge = self.first[node]
        todo = np.flatnonzero(self.upto[edge] <= u)
        now, u = edge[todo], u[todo]
        while len(todo):
            now += 1
            edge[todo] = now
            more = np.flatnonzero(self.upto[now] <= u)
            todo, now, u = todo[more], now[more], u[more]
        return edge

    def rows(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edges, shares) of the nodes as tables; the edges of shorter rows repeat the last."""
        wide = int(self.count[node].max(initial=1))
        at = np.minimum(np.arange(wide), self.count[node][:, None] - 1)
        edges = self.first[node][:, None] + at
        real = np.arange(wide) < self.count[node][:, None]
        return edges, np.where(real, self.share[edges], 0.0)


class Known(defaultdict):
    """Unit -> its number in one growing lattice, which a task keeps from slice to slice.

    Looking up a new unit numbers it; ``solved`` then builds the lattices of the new ones
    together and appends them. Beyond ``KEPT`` edges those that were met most often stay, up
    to half as many edges, and the others are forgotten.
    """

    EDGES, NODES, UNITS = ("piece", "size", "share", "upto"), ("first", "count"), ("start", "stop")

    def __init__(self, voc: Vocabulary) -> None:
        super().__init__()
        self.voc = voc
        self.lattice = Lattice([], voc)
        self.default_factory = count().__next__
        self.used = dict.fromkeys(self.EDGES + self.NODES + self.UNITS, 0)
        self.met = np.zeros(0, np.int64)

    def begin(self) -> None:
        """Before a slice: its units stay until its end."""
        if self.used["piece"] > KEPT:
            self.forget()

    def forget(self) -> None:
        """The arrays stay: what is kept moves to their beginning, the next is written behind."""
        lat, n = self.lattice, self.used["start"]
        start, stop = lat.start[:n], lat.stop[:n]
        first = lat.first[start]
        size = lat.first[stop] - first  # the last node of a unit has no edges
        often = np.argsort(-self.met, kind="stable")
        stay = np.sort(often[np.cumsum(size[often]) <= KEPT // 2])
        names = list(self)
        self.clear()
        self.update(zip(map(names.__getitem__, stay.tolist()), range(len(stay)), strict=True))
        self.default_factory = count(len(stay)).__next__
        self.met = self.met[stay] // 2  # what was met long ago counts less
        start, nodes, first, size = start[stay], stop[stay] - start[stay] + 1, first[stay], size[stay]
        node, edge = spread(start, nodes), spread(first, size)
        first = lat.first[node] - np.repeat(first - (np.cumsum(size) - size), nodes)
        ends = np.cumsum(nodes)
        self.used = dict.fromkeys(self.used, 0)
        for name in self.EDGES:
            self.append(name, getattr(lat, name)[edge])
        self.append("count", lat.count[node])
        self.append("first", first)
        self.append("start", ends - nodes)
        self.append("stop", ends - 1)

    def meet(self, numbers: np.ndarray) -> None:
        met = np.bincount(numbers, minlength=len(self))
        met[: len(self.met)] += self.met
        self.met = met

    def solved(self) -> Lattice:
        """The lattice of all units looked up so far."""
        fresh = list(islice(reversed(self), len(self) - self.used["start"]))[::-1]
        if fresh:
            new = Lattice(fresh, self.voc)
            new.first += self.used["piece"]
            new.start += self.used["first"]
            new.stop += self.used["first"]
            for name in self.used:
                self.append(name, getattr(new, name))
        return self.lattice

    def append(self, name: str, more: np.ndarray) -> None:
        have, used = getattr(self.lattice, name), self.used[name]
        total = used + len(more)
        if total > len(have):
            # Room for all that is kept, at once: pages that nothing is written to cost nothing.
            room = np.empty(max(total, 3 * len(have) // 2, 3 * KEPT // 2), more.dtype)
            room[:used] = have[:used]
            setattr(self.lattice, name, room)
            have = room
        have[used:total] = more
        self.used[name] = total


def mixed(start: np.ndarray, *parts: np.ndarray | int) -> np.ndarray:
    for p in parts:
        start = start + np.asarray(p).astype(np.uint64)
        start *= STEP
        start += np.uint64(1)
        start = mix64(start)
    return start


def key_of(*parts: np.ndarray | int) -> np.ndarray:
    return mixed(np.full(1, 0x243F6A8885A308D3, np.uint64), *parts)


def uniform(key: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key alone."""
    u = (key >> np.uint64(11)).astype(np.float64)
    u += 0.5
    u /= 1 << 53
    return u


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def below(top: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A Gumbel ``value`` conditioned to lie below ``top``."""
    return top - np.logaddexp(0.0, top - value)


class Steps:
    """Edges of paths in order: their node, the edge, its log-probability, and the unit."""

    def __init__(self, *columns: np.ndarray) -> None:
        self.node, self.edge, self.logp, self.unit = self.columns = columns

    def take(self, at: np.ndarray) -> list[np.ndarray]:
        return [x[at] for x in self.columns]


def forward(lat: Lattice, node: np.ndarray, stop: np.ndarray, unit: np.ndarray, key: np.ndarray,
            round_: int) -> tuple[Steps, np.ndarray]:
    """Sample from every node to its stop; the steps, and how many each start has."""
    who = np.flatnonzero(node < stop)
    counts = np.zeros(len(node), np.int64)
    at, end, key = node[who], stop[who], mixed(key, round_, unit)[who]
    parts = []
    while len(who):
        edge = lat.choose(at, uniform(mixed(key, len(parts))))
        parts.append((who, at, edge))
        at = at + lat.size[edge]
        more = at < end
        counts[who[~more]] = len(parts)
        more = np.flatnonzero(more)
        who, at, end, key = who[more], at[more], end[more], key[more]
    first = np.cumsum(counts) - counts
    nodes, edges = (np.empty(int(counts.sum()), np.int64) for _ in range(2))
    for t, (who, at, edge) in enumerate(parts):
        place = first[who] + t
        nodes[place], edges[place] = at, edge
    return Steps(nodes, edges, np.log(lat.share[edges]), np.repeat(unit, counts)), counts


def in_order(values: np.ndarray, top: int) -> np.ndarray:
    """A stable sort of numbers from 0 to below ``top``; small ones are sorted by radix."""
    return np.argsort(values.astype(np.uint16) if top <= 1 << 16 else values, kind="stable")


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, … of every run, one run after the other."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)


def units(text: str) -> list[str]:
    """``UNIT`` on the text and the space before it; texts without double spaces are only split."""
    whole = " " + text
    if "  " in whole or "\0" in whole:
        return UNIT.findall(whole)
    cut = whole.replace(" ", "\0 ").replace("\n", "\0\n\0")
    return list(filter(None, cut.split("\0")))


def segment(
    texts: list[str], keys: np.ndarray, voc: Vocabulary | Known, samples: int
) -> list[list[tuple]]:
    """Per text, up to ``samples`` tuples (ids, log-probability, log inclusion)."""
    known = voc if isinstance(voc, Known) else Known(voc)
    known.begin()
    found = [units(t) if t else [] for t in texts]
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(found)), np.int64)
    known.meet(flat)
    lat = known.solved()
    n_units = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(n_units)
    starts = ends - n_units
    docs = np.arange(len(texts))
    keys = keys.astype(np.int64).view(np.uint64)
    seeds = key_of(keys)

    def suffix(doc: np.ndarray, first: np.ndarray, node: np.ndarray, stop: np.ndarray, round_: int):
        """Paths from a node to the end of its unit, then through the units from ``first``."""
        counts = ends[doc] - first
        rest = spread(first, counts)
        who = np.concatenate([doc, np.repeat(doc, counts)])
        order = in_order(who, len(texts))  # the partial unit of a text comes first
        nodes = np.concatenate([node, lat.start[flat[rest]]])[order]
        stops = np.concatenate([stop, lat.stop[flat[rest]]])[order]
        units = np.concatenate([first - 1, rest])[order]
        who = who[order]
        base = np.where(units >= starts[who], units - starts[who], 0)
        steps, n = forward(lat, nodes, stops, base, seeds[who], round_)
        steps = Steps(steps.node, steps.edge, steps.logp, np.repeat(units, n))
        return steps, np.bincount(who, n, len(texts)).astype(np.int64)

    nothing = np.zeros(len(texts), np.int64)
    steps, counts = suffix(docs, starts, nothing, nothing, 0)
    top = gumbel(uniform(key_of(keys, 0xA5)))
    heaps: list[list[tuple]] = [[] for _ in texts]  # (value, step, shut edges, prefix logp)
    results: list[list[tuple]] = [[] for _ in texts]
    live, lead = docs, nothing  # texts of this round, edges of their paths that are not new
    history = steps
    offset = np.cumsum(counts) - counts
    for round_ in range(samples):
        # ``history`` ends with this round's paths; ``offset`` and ``counts`` place them.
        begin = int(offset[live[0]]) if len(live) else 0  # they lie side by side
        who = np.repeat(live, counts[live])
        logp = history.logp[begin:]
        run = np.cumsum(logp)
        first = np.cumsum(counts[live]) - counts[live]
        before = np.where(first > 0, run[np.maximum(first - 1, 0)], 0.0) if len(run) else np.zeros(len(live))
        prior = run - logp - np.repeat(before, counts[live])
        sums = np.zeros(len(live))
        filled = counts[live] > 0
        if len(run):
            sums[filled] = np.add.reduceat(logp, first[filled])
        for d, total in zip(live.tolist(), sums.tolist(), strict=True):
            results[d].append((int(offset[d]), int(counts[d]), total))
        if len(logp):
            index = np.arange(len(logp)) - np.repeat(first, counts[live])
            fresh = index >= lead[who]
            highest = np.full(len(texts), -np.inf)  # of the new regions of a text
            begun = counts[live] > lead[live]
            highest[live[begun]] = prior[(first + lead[live])[begun]]
            wanted, round_key = samples - round_, mixed(seeds, 0x5A, round_)

            def best(some: np.ndarray, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """From ``some``, the places and values of each text's ``wanted`` highest above its bar."""
                with np.errstate(divide="ignore"):
                    spare = prior[some] + np.log1p(-np.minimum(np.exp(logp[some]), 1.0))
                value = spare + gumbel(uniform(mixed(round_key[who[some]], index[some])))
                real = (spare > -1e300) & (value > bar[who[some]])
                some, value = some[real], value[real]
                order = np.lexsort((-value, who[some]))
                some, value = some[order], value[order]
                n = np.bincount(who[some], minlength=len(texts))
                rank = np.arange(len(some)) - np.repeat(np.cumsum(n) - n, n)
                return some[rank < wanted], value[rank < wanted]

            # No value is above its prior by more than the largest Gumbel: where enough
            # regions near the start of a path beat that, the others need no number.
            at, value = best(np.flatnonzero(fresh & (prior > highest[who] - REACH)), highest - REACH + GUMBEL)
            sure = np.bincount(who[at], minlength=len(texts)) == wanted
            sure |= np.isneginf(highest)
            if not sure.all():
                every = best(np.flatnonzero(fresh & ~sure[who]), np.full(len(texts), -np.inf))
                own = sure[who[at]]
                at, value = (np.concatenate(x) for x in zip((at[own], value[own]), every, strict=True))
            doc, step = who[at], begin + at
            columns = (doc, below(top[doc], value), step, history.edge[step], prior[at])
            for d, v, h, edge, p in zip(*(c.tolist() for c in columns), strict=True):
                heaps[d].append((v, h, (edge,), p))
        if round_ + 1 == samples:
            break
        # Pop the best region of every text that has one.
        picked = [(d, max(heaps[d])) for d in docs.tolist() if heaps[d]]
        picked = [(d, r) for d, r in picked if len(results[d]) == round_ + 1]
        if not picked:
            break
        live = np.array([d for d, _ in picked], np.int64)
        step = np.array([r[1] for _, r in picked], np.int64)
        top = top.copy()
        top[live] = [r[0] for _, r in picked]
        node, unit = history.node[step], history.unit[step]
        edges, share = lat.rows(node)
        for j, (_, r) in enumerate(picked):
            for shut in r[2]:
                share[j, edges[j] == shut] = 0.0
        mass = share.cumsum(1)
        u = uniform(mixed(seeds[live], 0xC3, round_, unit - starts[live])) * mass[:, -1]
        column = np.minimum((mass <= u[:, None]).sum(1), mass.shape[1] - 1)
        edge = edges[np.arange(len(live)), column]
        chance = share[np.arange(len(live)), column]
        left = mass[:, -1] - chance
        prior_at = np.array([r[3] for _, r in picked])
        some = left > 1e-12
        noise = gumbel(uniform(mixed(seeds[live], 0x77, round_)))
        value_left = below(top[live], prior_at + np.log(np.where(some, left, 1.0)) + noise)
        for (d, r), more, v, e in zip(picked, some.tolist(), value_left.tolist(), edge.tolist(), strict=True):
            heaps[d].remove(r)
            if more:
                heaps[d].append((v, r[1], (*r[2], e), r[3]))
        # The new paths: what came before the region, its edge, and a sampled rest.
        parent = np.array([next(o for o, c, _ in results[d] if o <= s < o + c)
                           for (d, r) in picked for s in (r[1],)], np.int64)
        n_head = step - parent
        tail, n_tail = suffix(live, unit + 1, node + lat.size[edge], lat.stop[flat[unit]], round_ + 1)
        head = spread(parent, n_head)
        owner = np.concatenate([np.repeat(live, n_head), live, np.repeat(docs, n_tail)])
        order = in_order(owner, len(texts))
        with np.errstate(divide="ignore"):
            turn = [node, edge, np.log(chance), unit]
        parts = zip(history.take(head), turn, tail.columns, strict=True)
        fresh_steps = [np.concatenate(p)[order] for p in parts]
        counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        offset = len(history.node) + np.cumsum(counts) - counts
        lead = np.zeros(len(texts), np.int64)
        lead[live] = n_head + 1
        both = zip(history.columns, fresh_steps, strict=True)
        history = Steps(*(np.concatenate(pair) for pair in both))
    ids = lat.piece[history.edge]
    out = []
    for d in docs.tolist():
        bar = max((h[0] for h in heaps[d]), default=-np.inf)
        rows = []
        for o, c, total in results[d]:
            # log of 1 - exp(-exp(total - bar)): the chance to lie above the next value.
            score = 0.0 if bar == -np.inf else inclusion(total - bar)
            rows.append((spelled(ids[o : o + c]), total, score))
        out.append(rows)
    return out


def inclusion(gap: float) -> float:
    if gap < -30:
        return gap
    return float(np.log(-np.expm1(-np.exp(min(gap, 30.0)))))


def spelled(ids: np.ndarray) -> np.ndarray:
    """Ids with characters that have no piece written as the ids of their bytes."""
    marked = np.flatnonzero(ids < 0)
    if not len(marked):
        return ids
    parts, at = [], 0
    for m in marked.tolist():
        raw = chr(-int(ids[m])).encode("utf-8", "surrogatepass")
        parts += [ids[at:m], np.frombuffer(raw, np.uint8).astype(np.int32) + BYTE]
        at = m + 1
    return np.concatenate([*parts, ids[at:]])


def decode(ids: list[int], voc: Vocabulary) -> str:
    """The text of a segmentation."""
    return b"".join(map(voc.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


# Spark -----------------------------------------------------------------------------

SCHEMA = (
    "doc_id long, text_crc32 long, segmentations array<array<int>>, logps array<double>, "
    "inclusions array<double>"
)


def encode(
    docs: DataFrame, model: str, samples: int = SAMPLES, alpha: float = ALPHA, seed: int = 0
) -> DataFrame:
    """(doc_id, text_crc32, segmentations, logps, inclusions): sampled without replacement."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(vocabulary(model, alpha))  # a task's own: later stages need the memory
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                raw = [v.as_py() or b"" for v in batch.column(1)]
                texts = [r.decode("utf-8", "replace") for r in raw]
                keys = np.array([k or 0 for k in batch.column(0).to_pylist()], np.int64) ^ seed
                rows = segment(texts, keys, known, samples)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()),
                        nested([[s[0] for s in r] for r in rows]),
                        pa.array([[s[1] for s in r] for r in rows], pa.list_(pa.float64())),
                        pa.array([[s[2] for s in r] for r in rows], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "text_crc32", "segmentations", "logps", "inclusions"],
                )

    rows = pick(long_rows(docs), "doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, SCHEMA)


def nested(rows: list[list[np.ndarray]]) -> pa.Array:
    flat = [x for r in rows for x in r]
    values = pa.array(np.concatenate([np.zeros(0, np.int32), *flat]).astype(np.int32))
    inner = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, flat)]), pa.int32()), values
    )
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), inner)


def rounded(lists: pa.ListArray) -> pa.Array:
    return pa.array([[round(v, 6) for v in own] for own in lists.to_pylist()], pa.list_(pa.float64()))


def by_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch of ``encode``'s rows where their segmentations reach ``DECODED`` ids."""
    lists = batch.column(2)
    first = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    return cut_at(batch, np.append(0, np.cumsum(lists.flatten().value_lengths().to_numpy()))[first], DECODED)


def decoded(encoded: DataFrame, model: str, alpha: float = ALPHA) -> DataFrame:
    """Digests of ``encode``'s rows, with every segmentation decoded and compared.

    Log values are rounded: their last digits depend on what is summed with them.

    (doc_id, n_samples, n_pieces, ids_crc32, logps, inclusions, round_trip)
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(model, alpha)
        for batch in chain.from_iterable(map(by_ids, batches)):
            size, crc, good = [], [], []
            inner = batch.column(2).flatten()
            values = inner.flatten()
            ids = values.to_numpy().astype("<u4")
            cuts = np.append(0, np.cumsum(inner.value_lengths().to_numpy())).tolist()
            # What the pieces spell, one text after the other.
            places, spelt = byte_view(voc.spelling.take(values))
            at, count = 0, batch.column(2).value_lengths().to_pylist()
            for want, n in zip(batch.column(1).to_pylist(), count, strict=True):
                runs = list(zip(cuts[at : at + n], cuts[at + 1 : at + n + 1], strict=True))
                at += n
                size.append([z - a for a, z in runs])
                crc.append([zlib.crc32(ids[a:z].tobytes()) for a, z in runs])
                # The first byte is the space mark before every text.
                texts = [spelt[places[a] + (z > a) : places[z]] for a, z in runs]
                good.append(all(zlib.crc32(t.tobytes()) == want for t in texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in size], pa.int64()),
                    pa.array(size, pa.list_(pa.int64())),
                    pa.array(crc, pa.list_(pa.int64())),
                    *(rounded(batch.column(c)) for c in (3, 4)),
                    pa.array(good, pa.bool_()),
                ],
                names=["doc_id", "n_samples", "n_pieces", "ids_crc32", "logps", "inclusions", "round_trip"],
            )

    return encoded.mapInArrow(
        run,
        "doc_id long, n_samples long, n_pieces array<long>, ids_crc32 array<long>, "
        "logps array<double>, inclusions array<double>, round_trip boolean",
    )
