"""Token-ID files by an adaptive context-mixing range coder.

Ids are cut into blocks of ``BLOCK``. In a block, an order-2 and an order-1 table predict
the next id from the ids before it, each with a confidence; order 0 is a distribution over
single ids and classes of ids, counted on the segment and stored with it. How far the
predictions are to be believed is learned for every combination of confidences: the
mixture's share of "order 2 is right", "order 1 is right" and "neither" is an adaptive
distribution, the last part of it divided by order 0, and a range coder with carry codes
an id at its place in the whole. Models and coder start anew in every block, and a block
holds a checksum of its ids, so any block can be read alone and damage is found.

Numpy codes many blocks in step with each other: one step codes one id of each. A segment
is a row of blocks that holds whole documents, so that files are read in parallel without
a shuffle; segments come in ascending document order. Memory is bounded by a segment of
about ``LANES * BLOCK`` ids, or by one document where that is longer.

Null and empty texts have the end id alone. Documents without an id come first, equal ids
are ordered by text, repeated rows each get a row. An empty table gives no rows, other
columns are ignored.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, count, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import byte_view, long_rows, pick, slices
from weekloom.sources.staging import staged_path

BLOCK = 4096
LANES = 2048
#: Steps that are prepared at once.
STRETCH = 32
SLOTS = 1 << 11
MAGIC = b"IDC3"
HEAD = struct.Struct("<4sII")  # magic, ids, checksum
#: Event probabilities are twelve-bit, those of order 0 are of ``FINE`` bits.
UNIT, RATE = 12, 5
FINE = 18
PAIR = UNIT + FINE
#: A coder's range lies between ``LOW`` and ``HIGH``; it hands out words, ``KEPT`` bits stay.
SENT, KEPT = 32, 30
LOW, HIGH = 1 << KEPT, 1 << KEPT + SENT
#: Ids below this may have an order-0 probability of their own.
TABLE = 1 << 17
#: Classes of ids by length in bits; the other bits of an id are coded evenly.
CLASSES = 29
#: Parts of texts whose ids a task keeps, and that the tokenizer gets in one call.
CACHE, AT_ONCE = 400_000, 500

# Models ----------------------------------------------------------------------------


class Prior:
    """The order-0 distribution that blocks start from.

    Symbols are classes of ids by their length, which any id falls into, and single ids
    with a share of their own. A segment's prior is counted on the segment and stored with
    it; blocks without one start from the classes alone.
    """

    def __init__(self, own: np.ndarray | None = None, shares: np.ndarray | None = None) -> None:
        own = np.zeros(0, np.int64) if own is None else own
        classes = np.arange(CLASSES)
        self.own = own.astype(np.int64)
        self.base = np.concatenate([(1 << classes) - 1, self.own])
        self.extra = np.concatenate([classes, np.zeros(len(own), np.int64)])
        if shares is None:
            likely = np.where(classes < TABLE.bit_length(), classes + 1, 2)
            shares = likely * (1 << FINE) // likely.sum()
            shares[0] += (1 << FINE) - shares.sum()
        self.share = shares.astype(np.int64)
        self.below = np.cumsum(self.share) - self.share
        self.symbol = np.full(TABLE, -1, np.int32)
        self.symbol[self.own] = CLASSES + np.arange(len(own))

    @classmethod
    def of(cls, ids: np.ndarray) -> Prior:
        """Counted on ``ids``; those met once stay in their class."""
        counts = np.bincount(ids[ids < TABLE], minlength=1)
        own = np.flatnonzero(counts > 1)
        if len(own) > TABLE // 2:
            own = np.sort(np.argsort(-counts, kind="stable")[: TABLE // 2])
        rest = np.ones(len(counts), bool)
        rest[own] = False
        left = np.concatenate([np.flatnonzero(rest), ids[ids >= TABLE]])
        weights = np.append(counts[rest], np.ones(len(left) - rest.sum(), np.int64))
        classes = np.bincount(length(left), weights, CLASSES)
        every = np.concatenate([classes, counts[own]])
        room = (1 << FINE) - len(every)
        shares = 1 + (every * room / max(every.sum(), 1)).astype(np.int64)
        shares[shares.argmax()] += (1 << FINE) - shares.sum()
        return cls(own, shares)

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        found = self.symbol[np.minimum(ids, TABLE - 1)]
        rest = (found < 0) | (ids >= TABLE)
        if rest.any():
            found[rest] = length(ids[rest])
        return found

    def targets(self) -> np.ndarray:
        """The symbol of every value below 2^FINE."""
        return np.repeat(np.arange(len(self.share), dtype=np.int32), self.share)

    def dump(self) -> bytes:
        raw = np.concatenate([np.diff(self.own, prepend=0), self.share]).astype("<u4").tobytes()
        return HEAD.pack(MAGIC, len(self.own), zlib.crc32(raw)) + zlib.compress(raw)

    @classmethod
    def load(cls, data: bytes) -> Prior:
        magic, n, crc = HEAD.unpack_from(data)
        try:
            raw = zlib.decompress(data[HEAD.size :])
        except zlib.error as e:
            raise ValueError("damaged prior") from e
        if magic != MAGIC or zlib.crc32(raw) != crc:
            raise ValueError("damaged prior")
        numbers = np.frombuffer(raw, "<u4").astype(np.int64)
        return cls(np.cumsum(numbers[:n]), numbers[n:])


def length(ids: np.ndarray) -> np.ndarray:
    """The class of an id: bits of id + 1, less one."""
    return np.frexp(ids + 1.0)[1] - 1


CLASSES_ONLY = Prior()


class Predictor:
    """Order-1 and order-2 state of ``n`` blocks that advance together.

    An entry of a table holds an id and, in its lowest two bits, the trust in it; for every
    combination of trusts an adaptive distribution tells which order is right. Axes are the
    steps, where there are several, the two orders and the blocks.
    """

    def __init__(self, n: int) -> None:
        self.base = np.arange(2 * n).reshape(2, n) * SLOTS  # of order 2, of order 1
        self.table = np.zeros(2 * n * SLOTS, np.int32)
        self.event_base = np.arange(n) * 32
        self.event = np.full(n * 32, (1 << UNIT) // 3 | (2 << UNIT) // 3 << 16)

    def cut(self, n: int) -> None:
        """Only the first ``n`` blocks go on."""
        self.base, self.event_base = self.base[:, :n], self.event_base[:n]

    def places(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where order 2 and order 1 look after two ids."""
        spread = last * np.int32(0x9E3B)
        own = np.empty((*last.shape[:-1], *self.base.shape), np.int32)
        np.right_shift(before * np.int32(0x2F0B) + spread, 3, out=own[..., 0, :])
        np.right_shift(spread, 2, out=own[..., 1, :])
        own &= SLOTS - 1
        return own + self.base

    def slots(self, entry: np.ndarray, same: np.ndarray) -> np.ndarray:
        """Where the distribution for these trusts is; ``same``: both orders predict one id."""
        trust = entry & 3
        trust <<= SHIFTS
        return trust[..., 0, :] + trust[..., 1, :] + same + self.event_base

    def learn(self, at: np.ndarray, entry: np.ndarray, fresh: np.ndarray) -> None:
        """More trust in a right entry, up to 3, less in a wrong one, ``fresh`` where there is none."""
        apart = entry ^ fresh - 1
        wrong = np.where(entry & 3 > 0, entry - 1, fresh)
        self.table[at] = np.where(apart < 4, np.minimum(apart, 2) + fresh, wrong)

    def shift(self, slot: np.ndarray, both: np.ndarray, goal: np.ndarray) -> None:
        """Towards what came: each half loses a part of itself and gets its goal."""
        self.event[slot] = both - (both >> RATE & HALVES) + goal


SHIFTS = np.array([[3], [1]], np.int32)
#: What the two halves of a distribution, "order 2 is right" and "order 2 or 1 is", get when
#: order 2 is right, order 1 is, neither is. The second half gets more than the first each
#: time, so every event keeps about 2^RATE.
MOST = (1 << UNIT - RATE) - 1
GOALS = np.array([MOST - 1 | MOST << 16, MOST << 16, 1 << 16])
HALVES = ~((1 << RATE) - 1 << 16 - RATE)


class Writer:
    """A range coder for each lane; gives out words of 32 bits.

    A word is kept with the carry that it hands to the one before it, added at the end.
    """

    def __init__(self, n: int, words: int) -> None:
        self.low, self.range = np.zeros(n, np.int64), np.full(n, HIGH, np.int64)
        self.lanes = n
        self.out = np.zeros(n * words, np.int64)  # the first words of all lanes, the second ones
        self.at = np.arange(n)

    def put(self, start: np.ndarray, size: np.ndarray) -> None:
        """Code ``start`` to ``start + size`` of 2^PAIR, in every lane."""
        unit = self.range >> PAIR
        self.low += unit * start
        np.multiply(unit, size, out=self.range)
        self.give(np.flatnonzero(self.range < LOW))

    def put_bits(self, lanes: np.ndarray, bits: np.ndarray, value: np.ndarray) -> None:
        """Code ``value`` of 2^bits in some lanes."""
        unit = self.range[lanes] >> bits
        self.low[lanes] += unit * value
        self.range[lanes] = unit
        self.give(lanes[unit < LOW])

    def give(self, short: np.ndarray) -> None:
        low, at = self.low[short], self.at[short]
        self.out[at] = low >> KEPT
        self.at[short] = at + self.lanes
        self.low[short] = (low & LOW - 1) << SENT
        self.range[short] <<= SENT

    def cut(self, n: int) -> list[bytes]:
        """What the lanes from ``n`` on have written; the others go on."""
        low, at = self.low[n:], self.at[n:]
        self.out[at] = low >> KEPT
        self.out[at + self.lanes] = (low & LOW - 1) << SENT - KEPT
        sizes = at // self.lanes + 2
        upto = np.append(0, np.cumsum(sizes))
        place = np.arange(upto[-1]) - np.repeat(upto[:-1], sizes)
        words = self.out[place * self.lanes + np.repeat(np.arange(n, n + len(at)), sizes)]
        while len(over := np.flatnonzero(words >> SENT)):
            carry = words[over] >> SENT
            words[over] &= (1 << SENT) - 1
            words[over - 1] += carry
        raw, ends = words.astype("<u4").tobytes(), (4 * upto).tolist()
        self.low, self.range, self.at = self.low[:n], self.range[:n], self.at[:n]
        return [raw[a:z] for a, z in zip(ends, ends[1:], strict=False)]


class Reader:
    def __init__(self, payloads: list[bytes]) -> None:
        n, size = len(payloads), max(map(len, payloads), default=0) // 4 + 4
        words = np.zeros((n, size), np.uint32)
        for row, p in zip(words, payloads, strict=True):
            row[: len(p) // 4] = np.frombuffer(p, "<u4", len(p) // 4)
        self.code = (words[:, 0].astype(np.int64) << KEPT) + (words[:, 1] >> SENT - KEPT)
        # What stands behind a word's first KEPT bits, up to those of the next one.
        words[:, :-1] = words[:, :-1] << KEPT | words[:, 1:] >> SENT - KEPT
        self.words, self.at = words.reshape(-1), np.arange(n) * size + 1
        self.range = np.full(n, HIGH, np.int64)

    def cut(self, n: int) -> None:
        self.code, self.range, self.at = self.code[:n], self.range[:n], self.at[:n]

    def take_bits(self, lanes: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Values of 2^bits in some lanes."""
        unit = self.range[lanes] >> bits
        value = np.minimum(self.code[lanes] // unit, (1 << bits) - 1)
        self.code[lanes] -= unit * value
        self.range[lanes] = unit
        self.fill(lanes[unit < LOW])
        return value

    def fill(self, short: np.ndarray) -> None:
        at = self.at[short]
        self.code[short] = self.code[short] << SENT | self.words.take(at, mode="clip")
        self.at[short] = at + 1
        self.range[short] <<= SENT


def stretches(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first step, step behind the last, blocks that have an id at them), a few steps each.

    ``sizes`` fall.
    """
    steps = np.arange(0, int(sizes.max(initial=0)), STRETCH)
    cuts = np.unique(np.concatenate([[0], steps, sizes]))
    left = len(sizes) - np.searchsorted(sizes[::-1], cuts, "right")
    yield from zip(cuts.tolist(), cuts[1:].tolist(), left.tolist(), strict=False)


def encode_lanes(ids: np.ndarray, prior: Prior) -> list[bytes]:
    """Payloads of the blocks of a run.

    As all ids are known, only what a step takes from the one before goes step by step.
    """
    sizes = block_sizes(len(ids))
    n, full = len(sizes), len(ids) // BLOCK
    whole, rest = ids[: full * BLOCK].reshape(full, BLOCK), ids[full * BLOCK :]
    # An event and its symbol cost 27 bits at most, the other bits of an id 28.
    model, out = Predictor(n), Writer(n, 2 * int(sizes.max(initial=0)) + 4)
    done: list[bytes] = []
    tail = np.zeros((2, n), np.int32)
    for a, z, left in stretches(sizes):
        if left < n:
            done, n = out.cut(left) + done, left
            model.cut(n)
        own = np.empty((2 + z - a, n), np.int32)
        own[:2], own[2:, :full] = tail[:, :n], whole[:, a:z].T
        if full < n:  # the last block, as long as it goes
            own[2:, full] = rest[a:z]
        before, last, own, tail = own[:-2], own[1:-1], own[2:], own[-2:]
        places, fresh = model.places(before, last), own << 2 | 1
        entry = np.empty(places.shape, np.int32)
        for at, got, f in zip(places, entry, fresh, strict=True):
            model.table.take(at, out=got, mode="clip")
            model.learn(at, got, f)
        two, one = entry[:, 0] >> 2, entry[:, 1] >> 2
        event = np.where(own == two, 0, 2 - (own == one))
        slots, goals = model.slots(entry, two == one), GOALS.take(event)
        both = np.empty(slots.shape, np.int64)
        for slot, got, goal in zip(slots, both, goals, strict=True):
            model.event.take(slot, out=got, mode="clip")
            model.shift(slot, got, goal)
        first, second = both & 0xFFFF, both >> 16
        symbol, new, share = prior.symbols(own), event == 2, (1 << UNIT) - second
        start = np.where(new, (second << FINE) + prior.below.take(symbol) * share, first * event << FINE)
        wide = np.where(event == 0, first, second - first) << FINE
        size = np.where(new, prior.share.take(symbol) * share, wide)
        step, lane = np.nonzero(new & (symbol < CLASSES))
        classes = symbol[step, lane]
        bits, value = prior.extra[classes], own[step, lane] - prior.base[classes]
        upto = np.searchsorted(step, np.arange(len(own) + 1)).tolist()
        for x, y, begin, some in zip(upto, upto[1:], start, size, strict=False):
            out.put(begin, some)
            if x < y:
                out.put_bits(lane[x:y], bits[x:y], value[x:y])
    return out.cut(0) + done


def decode_lanes(payloads: list[bytes], sizes: np.ndarray, prior: Prior) -> np.ndarray:
    """Columns that begin with the ids of blocks, which come in falling order of size."""
    n = len(payloads)
    model, code, targets = Predictor(n), Reader(payloads), prior.targets()
    # Behind the symbols stands one for ids that order 2 or 1 has told: it takes everything.
    targets = np.append(targets, len(prior.share)).astype(np.int32)
    below, share = np.append(prior.below, 0), np.append(prior.share, 1 << FINE)
    base = np.append(prior.base, 0).astype(np.int32)
    ids = np.zeros((2 + int(sizes.max(initial=0)), n), np.int32)
    for a, z, left in stretches(sizes):
        n = left
        model.cut(n)
        code.cut(n)
        lanes = np.arange(n)
        # By event: what is below it and behind it, and the id that it stands for.
        edge, told = np.zeros((4, n), np.int64), np.empty((3, n), np.int32)
        edge[3] = 1 << UNIT
        for step in range(a, z):
            at = model.places(ids[step, :n], ids[step + 1, :n])
            entry = model.table.take(at)
            np.right_shift(entry, 2, out=told[:2])
            slot = model.slots(entry, told[0] == told[1])
            both = model.event.take(slot)
            np.bitwise_and(both, 0xFFFF, out=edge[1])
            np.right_shift(both, 16, out=edge[2])
            unit = code.range >> PAIR
            wide = unit << FINE
            beyond = code.code // wide >= edge[1:3]
            event = np.add(beyond[0], beyond[1], dtype=np.int64)
            place = event * n + lanes
            begin = edge.take(place)
            code.code -= wide * begin
            unit *= edge.take(place + n) - begin
            inner = np.where(beyond[1], code.code // unit, 1 << FINE)
            symbol = targets.take(inner, mode="clip").astype(np.int64)
            code.code -= unit * below.take(symbol)
            np.multiply(unit, share.take(symbol), out=code.range)
            code.fill(np.flatnonzero(code.range < LOW))
            base.take(symbol, out=told[2], mode="clip")
            some = np.flatnonzero(symbol < CLASSES)
            if len(some):
                told[2, some] += code.take_bits(some, prior.extra[symbol[some]])
            own = told.take(place, out=ids[step + 2, :n], mode="clip")
            model.learn(at, entry, own << 2 | 1)
            model.shift(slot, both, GOALS.take(event))
    return ids[2:]


# Blocks ----------------------------------------------------------------------------


def block_sizes(n: int) -> np.ndarray:
    return np.minimum(n - np.arange(0, n, BLOCK), BLOCK)


def encode(ids: np.ndarray, prior: Prior = CLASSES_ONLY) -> list[bytes]:
    """Blocks of a run of ids below 2^28, each of ``BLOCK`` ids but the last."""
    ids = np.asarray(ids, np.int32)
    out: list[bytes] = []
    for at in range(0, len(ids), LANES * BLOCK):
        own = ids[at : at + LANES * BLOCK]
        payloads, cuts = encode_lanes(own, prior), range(0, len(own), BLOCK)
        out += [headed(own[a : a + BLOCK], p) for a, p in zip(cuts, payloads, strict=True)]
    return out


def headed(ids: np.ndarray, payload: bytes) -> bytes:
    return HEAD.pack(MAGIC, len(ids), zlib.crc32(ids.astype("<u4", copy=False))) + payload


def decode(blocks: list[bytes], prior: Prior = CLASSES_ONLY) -> np.ndarray:
    """The ids of blocks in their order; damage raises ValueError."""
    heads = [HEAD.unpack_from(b) for b in blocks]
    if any(h[0] != MAGIC for h in heads):
        raise ValueError("not a block")
    upto = np.append(0, np.cumsum([h[1] for h in heads], dtype=np.int64)).tolist()
    out = np.empty(upto[-1], np.int32)
    falling = sorted(range(len(blocks)), key=lambda i: -heads[i][1])
    for at in range(0, len(blocks), LANES):
        own = falling[at : at + LANES]
        sizes = np.array([heads[i][1] for i in own])
        columns = decode_lanes([blocks[i][HEAD.size :] for i in own], sizes, prior)
        for few in range(0, len(own), STRETCH):
            rows = np.ascontiguousarray(columns[:, few : few + STRETCH].T)
            for i, row in zip(own[few : few + STRETCH], rows, strict=True):
                row = row[: heads[i][1]]
                if zlib.crc32(row.astype("<u4", copy=False)) != heads[i][2]:
                    raise ValueError("checksum of a block does not hold")
                out[upto[i] : upto[i + 1]] = row
    return out


# Tokens ----------------------------------------------------------------------------


class Encoder:
    """Ids of texts; what stands between spaces is encoded once and kept for a while.

    The vocabulary drops white space and never joins across it, so a text's ids are those
    of its space-separated parts one after the other. Nor does it join marks to the letter
    or digit before them or tell capitals from small letters: a part's ids are those of its
    core in small letters and of the marks behind it. Arrow cuts a batch into parts, the
    different ones into halves and numbers them; only different halves are looked up one by
    one, and a new one that is a word of small letters, which is one unit to the tokenizer as
    it stands, goes past its normalizer and its splitting straight to its model. Beyond ``CACHE`` halves those that were met most often stay, half as many.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The signs that stand for the bytes of a letter in the vocabulary.
        bare = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.signs = {ord(c): "".join(sign for sign, _ in bare(c)) for c in LETTERS} | {10: "\n"}
        #: Half of a part -> its number, which leads to its run of ids.
        self.known: dict[str, int] = {}
        self.ids, self.cuts = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)

    def forget(self) -> None:
        stay = np.sort(np.argsort(-self.met, kind="stable")[: CACHE // 2])
        names = list(self.known)
        self.known = dict(zip(map(names.__getitem__, stay.tolist()), range(len(stay)), strict=True))
        self.met = self.met[stay] // 2  # what was met long ago counts less
        begin, size = self.cuts[stay], self.cuts[stay + 1] - self.cuts[stay]
        self.cuts = np.append(0, np.cumsum(size))
        self.ids = self.ids[runs(begin, size, self.cuts)]

    def learn(self, parts: list[str]) -> None:
        """Encodes new parts: words by the model itself, some hundred others in one call."""
        words = [p for p in parts if WORD.fullmatch(p)]
        bare = "\n".join(words)
        ids, sizes = [], []
        for word in (bare if bare.isascii() else bare.translate(self.signs)).split("\n") if words else ():
            tokens = self.model.tokenize(word)
            ids += [t.id for t in tokens]
            sizes.append(len(tokens))
        n = len(self.ids) + len(ids)
        cuts = [self.cuts, len(self.ids) + np.cumsum(np.array(sizes, np.int64))]
        ids = [self.ids, np.array(ids, np.int32)]
        others = [p for p in parts if not WORD.fullmatch(p)]
        for at in range(0, len(others), AT_ONCE):
            few = others[at : at + AT_ONCE]
            starts = np.cumsum([len(p) + 1 for p in few])
            one = self.tokenizer.encode(" ".join(few), add_special_tokens=False)
            places = np.fromiter(map(itemgetter(0), one.offsets), np.int64)
            cuts.append(np.searchsorted(places, starts) + n)
            ids.append(np.array(one.ids, np.int32))
            n += len(places)
        self.known.update(zip(chain(words, others), count(len(self.known))))
        self.ids, self.cuts = np.concatenate(ids), np.concatenate(cuts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's ids begin, and the end; the ids of all texts)."""
        lists = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        different = lists.flatten().dictionary_encode()
        number = different.indices.to_numpy()
        halves, pairs = halved(different.dictionary)
        if len(self.known) > CACHE:
            self.forget()
        fresh = list(dict.fromkeys(h for h in halves if h not in self.known))
        if fresh:
            self.learn(fresh)
        pairs = np.fromiter(map(self.known.__getitem__, halves), np.int64, len(halves))[pairs]
        times = np.bincount(number, minlength=len(pairs)).repeat(2)
        met = np.bincount(pairs.reshape(-1), times, len(self.known)).astype(np.int64)
        met[: len(self.met)] += self.met
        self.met = met
        # The ids of the different parts one after the other, then those of all.
        begin = self.cuts[pairs]
        size = self.cuts[pairs + 1] - begin
        cuts = np.append(0, np.cumsum(size))
        ids = self.ids[runs(begin.reshape(-1), size.reshape(-1), cuts)]
        begin, size = cuts[:-1:2][number], size.sum(1)[number]
        upto = np.append(0, np.cumsum(size))
        offsets = lists.offsets.to_numpy()
        return upto[offsets - offsets[0]], ids[runs(begin, size, upto)]


def runs(begin: np.ndarray, size: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The places of runs one after the other; ``upto`` is where each comes to lie."""
    at = np.repeat(begin - upto[:-1], size)
    at += np.arange(len(at))
    return at


def halved(parts: pa.StringArray) -> tuple[list[str], np.ndarray]:
    """(halves, the two places in them of each part): ``split`` of all parts at once.

    Parts of characters up to \u00ff are cut by Arrow and numpy, others one by one.
    """
    upto, data = byte_view(parts)
    plain = ~pc.match_substring(parts, "|>").to_numpy(zero_copy_only=False)
    plain[np.searchsorted(upto, np.flatnonzero(data > LATIN), "right") - 1] = False
    lower = pc.utf8_lower(parts.filter(pa.array(plain)))
    upto, data = byte_view(lower)
    core = pc.binary_length(pc.ascii_rtrim(lower, MARKS)).to_numpy()
    end = upto[:-1] + core
    marked = core > 0
    sign = data[end[marked] - 1].astype(np.int64)
    wide = sign > 127  # the second of two bytes
    sign[wide] = (data[end[marked][wide] - 2] & 3) * 64 + (sign[wide] & 63)
    marked[marked] = ALNUM[sign]
    cuts = np.empty(2 * len(core) + 1, np.int32)
    cuts[::2], cuts[1::2] = upto, np.where(marked, end, upto[1:])
    both = pa.StringArray.from_buffers(2 * len(core), pa.py_buffer(cuts), pa.py_buffer(data))
    both = both.dictionary_encode()
    halves = both.dictionary.to_numpy(zero_copy_only=False).tolist()
    pairs = np.empty((len(parts), 2), np.int64)
    pairs[plain] = both.indices.to_numpy().reshape(-1, 2)
    other = parts.filter(pa.array(~plain)).to_numpy(zero_copy_only=False)
    pairs[~plain] = np.arange(len(halves), len(halves) + 2 * len(other)).reshape(-1, 2)
    return halves + list(chain.from_iterable(map(split, other.tolist()))), pairs


def split(part: str) -> tuple[str, str]:
    """(core, marks behind it): encoded one after the other they give the part's ids."""
    if "|>" in part or max(part, default="") > "\u00ff":
        return part, ""  # a special token, or letters whose forms depend on their neighbours
    m = MARKED.fullmatch(part)
    return (m[1].lower(), m[2]) if m else (part.lower(), "")


#: A letter or digit, then other printable ASCII; an apostrophe may begin a unit of its own.
MARKED = re.compile(r"(.*[^\W_])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)
MARKS = string.punctuation.replace("'", "")
#: Small letters that normal form and lower case leave alone: one unit to the tokenizer.
LETTERS = string.ascii_lowercase + "ªµº" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
WORD = re.compile(f"[{LETTERS}]+")
ALNUM = np.array([chr(i).isalnum() for i in range(256)])
#: The largest first byte of a character up to \u00ff.
LATIN = 0xC3


@cache
def encoder(path: str) -> Encoder:
    """One for each worker process: what a task has met, the next one knows."""
    return Encoder(path)


# Spark -----------------------------------------------------------------------------

SEGMENTS = (
    "part long, before long, n long, prior binary, blocks array<binary>, doc_ids array<long>, "
    "sizes array<long>"
)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every text and write the segments to ``path`` in ascending order."""
    schema = pa.schema(
        [("part", pa.int64()), ("before", pa.int64()), ("n", pa.int64()), ("prior", pa.binary()),
         ("blocks", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())),
         ("sizes", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before, held = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            every = np.concatenate(ids)
            prior = Prior.of(every)
            one = {
                "part": part, "before": before, "n": held, "prior": prior.dump(),
                "blocks": encode(every, prior), "doc_ids": pa.concat_arrays(names).to_pylist(),
                "sizes": np.concatenate(sizes).tolist(),
            }
            return pa.RecordBatch.from_pylist([one], schema)

        for whole in batches:
            for batch in slices(whole, 1, 1 << 21):
                starts, flat = coder.encode(text_column(batch.column(1)))
                ends = np.insert(flat, starts[1:], end_id)  # after each text's last id
                if held and held + len(ends) > LANES * BLOCK:  # more would be another row of blocks
                    yield row()
                    before += held
                    ids, names, sizes, held = [], [], [], 0
                ids.append(ends)
                names.append(batch.column(0))
                sizes.append(np.diff(starts) + 1)
                held += len(ends)
        if ids:
            yield row()

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    # A hash of the text divides an id that very many rows repeat.
    keyed = long_rows(rows).withColumn("k", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "k").sortWithinPartitions("doc_id", "k", "text")
    ordered.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, SEGMENTS).write.option(
        "compression", "none"
    ).parquet(path)


def text_column(column: pa.Array) -> pa.Array:
    """Bytes as text; what is no UTF-8 is replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([(v or b"").decode("utf-8", "replace") for v in column.to_pylist()])


def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, ids) of the documents of segments."""
    for batch in batches:
        for i in range(batch.num_rows):
            prior, blocks, start = (batch.column(c)[i].as_py() for c in range(3))
            names, sizes = (batch.column(c)[i].values for c in (3, 4))
            ids, cuts = decode(blocks, Prior.load(prior)), np.append(0, np.cumsum(sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    names,
                    pa.array(start + cuts[:-1], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "start", "ids"],
            )


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, n_tokens, ids_crc32) of the documents of segments."""
    for batch in decoded(batches):
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:z]) for a, z in pairwise(offsets.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()),
             pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def placed(spark, path: str) -> DataFrame:
    """The segments in the files, with the ids of all documents before them as start."""
    rows = spark.read.schema(SEGMENTS).parquet(path)
    # One row a partition of the writing job; inside it the writer has counted.
    totals, starts, total = rows.groupBy("part").agg(F.sum("n").alias("n")), [], 0
    for r in totals.orderBy("part").collect():
        starts.append((r.part, total))
        total += r.n
    table = spark.createDataFrame(starts, "part long, first long")
    start = F.col("first") + F.col("before")
    return rows.join(F.broadcast(table), "part").select(
        "prior", "blocks", start.alias("start"), "doc_ids", "sizes"
    )


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids, decoded from the files."""
    return placed(spark, path).mapInArrow(decoded, "doc_id long, start long, ids array<int>")


def read_digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the same ids, none of which leave the task."""
    return placed(spark, path).mapInArrow(
        digests, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def id_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encode, write, read back."""
    path = staged_path(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
