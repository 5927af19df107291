"""Sampled segmentations against the enumerated lattice, and exact decoding."""

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from weekloom.llm import pieces
from weekloom.llm.common import slices

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def voc():
    return pieces.vocabulary(PATH, 0.3)


def every(text, voc):
    """{ids: probability} over all segmentations, by plain recursion."""
    table = {r.decode(): i for i, r in enumerate(voc.raw) if voc.weight[i] != 0}

    def walk(rest):
        if not rest:
            yield (), 0.0
        known = [n for n in range(1, len(rest) + 1) if rest[:n] in table]
        if rest and 1 not in known:
            raw = rest[0].encode()
            for tail, w in walk(rest[1:]):
                yield tuple(b + pieces.BYTE for b in raw) + tail, w + voc.unknown * len(raw)
        for n in known:
            i = table[rest[:n]]
            for tail, w in walk(rest[n:]):
                yield (i, *tail), w + float(voc.weight[i])

    rows = dict(walk(" " + text))
    total = math.log(sum(map(math.exp, rows.values())))
    return {k: math.exp(w - total) for k, w in rows.items()}


def ids(rows):
    return [tuple(r[0].tolist()) for r in rows]


@pytest.mark.parametrize("text", ["ab", "the\nit", "a  b", "é梦", "to a"])
def test_probabilities_and_distinct_samples(voc, text):
    want = every(text, voc)
    (rows,) = pieces.segment([text], np.array([5]), voc, 12)
    got = ids(rows)
    assert len(set(got)) == len(got) == min(12, len(want))
    for r in rows:
        assert math.isclose(math.exp(r[1]), want[tuple(r[0].tolist())], rel_tol=1e-4)
    if len(want) <= 12:
        assert set(got) == set(want) and all(r[2] == 0.0 for r in rows)


def test_frequencies_follow_sampling_without_replacement(voc):
    text, n = "the it", 4000
    want = every(text, voc)
    drawn = pieces.segment([text] * n, np.arange(n), voc, 2)
    first = collections.Counter(ids(r)[0] for r in drawn)
    second = collections.Counter(ids(r)[1] for r in drawn)
    for s, p in want.items():
        assert abs(first[s] / n - p) < 0.035
        after = sum(q * p / (1 - q) for o, q in want.items() if o != s)
        assert abs(second[s] / n - after) < 0.035
    # The weights 1/inclusion estimate the whole mass without bias.
    mass = [sum(math.exp(r[1] - r[2]) for r in rows) for rows in drawn]
    assert abs(sum(mass) / n - 1) < 0.06


def texts():
    rng = random.Random(3)
    parts = ["Hello", "wörld", "▁", "梦想", "😀", "\t", "12", "x" * 40, "\x00", "\r", "é", "don't"]
    out = ["".join(rng.choice(parts) + rng.choice([" ", "\n", "", "  "]) for _ in range(60)) for _ in range(40)]
    return out + ["", " ", "\n", "   lead", "trail   ", "▁▁", "a" * 20_000, "lorem ipsum " * 20_000]


def test_decoding_is_exact_and_independent_of_the_slice(voc):
    own = texts()
    keys = np.arange(len(own))
    together = pieces.segment(own, keys, voc, 2)
    for i, (t, rows) in enumerate(zip(own, together, strict=True)):
        assert all(pieces.decode(r[0].tolist(), voc) == t for r in rows)
        (alone,) = pieces.segment([t], keys[i : i + 1], voc, 2)
        assert ids(alone) == ids(rows)
    plain = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert plain.decode(together[0][0][0].tolist()).replace(" ", "") == own[0].replace("▁", "▁").replace(" ", "")


def test_query_rows(spark):
    docs = [(i, t, 1) for i, t in enumerate(texts())]
    docs += [(900, None, 1), (None, "null id", 1), docs[2], docs[2]]
    df = spark.createDataFrame(docs, "doc_id long, text string, logps int")
    got = pieces.decoded(pieces.encode(df.repartition(4), PATH), PATH).collect()
    assert len(got) == len(docs) and all(r.round_trip for r in got)
    again = pieces.decoded(pieces.encode(df.repartition(2), PATH), PATH).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].n_pieces == [0] and by_id[900].inclusions == [0.0]
    for r in got:
        assert r.n_samples == len(set(r.ids_crc32)) and all(x <= 0 for x in r.inclusions)
    assert pieces.encode(df.filter("doc_id > 999"), PATH).count() == 0


def test_texts_of_a_batch_advance_in_bounded_memory(voc):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    own = [" ".join(rng.choice(words) for _ in range(400)).encode() for _ in range(450)]
    batch = pa.record_batch([pa.array(range(len(own))), pa.array(own)], ["doc_id", "text"])
    known, rows = pieces.Known(voc), 0
    pieces.segment(["room"], np.array([1]), known, 2)  # for the kept units, untouched pages
    tracemalloc.start()
    for part in slices(batch, 1, pieces.SLICE):
        plain = [t.decode() for t in part.column(1).to_pylist()]
        rows += len(pieces.segment(plain, part.column(0).to_numpy(), known, 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(own) and peak < 100 << 20


def test_decoding_a_batch_takes_the_memory_of_a_part_of_it(voc):
    class Encoded:
        def mapInArrow(self, run, schema):
            return run

    drawn = pieces.segment(["the quick brown fox " * 500], np.array([1]), voc, 2)[0]
    one = [r[0] for r in drawn]
    rows, crc = 300, zlib.crc32(("the quick brown fox " * 500).encode())
    scores = pa.array([[0.0] * len(one)] * rows, pa.list_(pa.float64()))
    batch = pa.record_batch(
        [pa.array(range(rows)), pa.array([crc] * rows), pieces.nested([one] * rows), scores, scores],
        ["doc_id", "text_crc32", "segmentations", "logps", "inclusions"],
    )
    run = pieces.decoded(Encoded(), PATH, 0.3)
    tracemalloc.start()
    parts = list(run(iter([batch.slice(0, 0), batch.slice(1, 1), batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = [r for p in parts for r in p.to_pylist()]
    assert [r["doc_id"] for r in got] == [1, *range(rows)] and all(r["round_trip"] for r in got)
    assert {tuple(r["n_pieces"]) for r in got} == {tuple(map(len, one))}
    assert peak < batch.column(2).nbytes


def test_what_is_forgotten_leaves_its_room_to_what_comes(voc, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 100)
    known, own = pieces.Known(voc), ["some words", "other words entirely", "some words"]
    first = ids(pieces.segment(own[:1], np.array([7]), known, 2)[0])
    pieces.segment(["x" * 400], np.array([1]), known, 2)
    room = known.lattice.piece
    assert known.used["piece"] > 100
    again = ids(pieces.segment(own[2:], np.array([7]), known, 2)[0])
    assert again == first and known.lattice.piece is room and known.used["piece"] < 100


def test_units_met_often_are_not_solved_again(voc, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 400)
    known, solved = pieces.Known(voc), []
    plain = pieces.Lattice
    monkeypatch.setattr(pieces, "Lattice", lambda own, voc: solved.extend(own) or plain(own, voc))
    first = None
    for i in range(40):
        own = ["often here", "".join(chr(97 + (7 * i + j * j) % 26) for j in range(60 + i))]
        got = [ids(r) for r in pieces.segment(own, np.array([7, i]), known, 2)]
        assert got == [ids(r) for r in pieces.segment(own, np.array([7, i]), voc, 2)]
        first = first or got[0]
        assert got[0] == first and known.used["piece"] < 2 * pieces.KEPT
        assert list(known.values()) == list(range(len(known))) and len(known.met) == len(known)
    # Once in the shared lattice; the others were solved for the 40 fresh ones.
    assert solved.count(" often") == 41 and solved.count(" here") == 41


def test_regions_left_out_could_not_win(voc, monkeypatch):
    own = texts()
    keys = np.arange(len(own))
    want = pieces.segment(own, keys, voc, 4)
    # Nothing is left out, or everything but the first edges, which then do not suffice.
    for reach in (1e9, 41.0, 0.0):
        monkeypatch.setattr(pieces, "REACH", reach)
        got = pieces.segment(own, keys, voc, 4)
        assert [ids(r) for r in got] == [ids(r) for r in want]
        assert [[x[1:] for x in r] for r in got] == [[x[1:] for x in r] for r in want]


def test_units_are_those_of_the_pattern():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice([" ", "\n", "a", "b", "\0", "é", "\t", "word"][rng.randrange(2):]) for _ in range(rng.randrange(1, 12)))
        assert pieces.units(text) == pieces.UNIT.findall(" " + text)
