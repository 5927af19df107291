"""Exact round trips of the id coder, and its files against plain encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from weekloom.llm import idcoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences():
    rng = np.random.default_rng(4)
    yield []
    yield [0]
    yield [65535] * 5000
    yield rng.integers(0, 49408, 20_000)
    yield np.tile(rng.integers(0, 49408, 700), 40)
    yield rng.integers(0, 1 << 28, 9000)
    yield rng.zipf(1.3, 30_000) % 50_000
    yield [(1 << 28) - 1, 0, 65536, 65535]


@pytest.mark.parametrize("ids", list(sequences()), ids=range(8))
def test_round_trip(ids):
    ids = np.array(ids, np.int32)
    blocks = idcoder.encode(ids)
    assert (idcoder.decode(blocks) == ids).all() and len(blocks) == -(-len(ids) // idcoder.BLOCK)
    # Blocks are independent of each other.
    for i, b in enumerate(blocks[:2]):
        own = ids[i * idcoder.BLOCK : (i + 1) * idcoder.BLOCK]
        assert (idcoder.decode([b]) == own).all()


def test_repeats_cost_less_than_noise():
    rng = np.random.default_rng(1)
    noise, again = rng.integers(0, 49408, 8192), np.tile(rng.integers(0, 49408, 64), 128)
    size = lambda ids: sum(map(len, idcoder.encode(ids)))
    assert size(again) < 0.25 * size(noise) < 0.25 * 2.3 * 8192


@pytest.mark.parametrize("ids", list(sequences()), ids=range(8))
def test_round_trip_with_a_prior_of_the_run(ids):
    ids = np.array(ids, np.int32)
    prior = idcoder.Prior.load(idcoder.Prior.of(ids).dump())
    assert prior.share.sum() == 1 << idcoder.FINE and prior.share.min() > 0
    assert (idcoder.decode(idcoder.encode(ids, prior), prior) == ids).all()


def test_shorter_than_the_order_0_entropy_of_ids_with_context():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.4, 400_000) % 40_000
    follow = rng.permutation(40_000)
    for i in np.flatnonzero(rng.random(len(ids)) < 0.4)[1:].tolist():
        ids[i] = follow[ids[i - 1]]
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    prior = idcoder.Prior.of(ids)
    bits = 8 * (len(prior.dump()) + sum(map(len, idcoder.encode(ids, prior)))) / len(ids)
    assert bits < entropy


def test_damage_is_found():
    (block,) = idcoder.encode(np.arange(3000))
    for at in (0, idcoder.HEAD.size + 5, idcoder.HEAD.size + 900):
        bad = bytearray(block)
        bad[at] ^= 0x55
        with pytest.raises(ValueError):
            idcoder.decode([bytes(bad)])
    dump = bytearray(idcoder.Prior.of(np.arange(3000) // 3).dump())
    dump[-5] ^= 0x55
    with pytest.raises(ValueError):
        idcoder.Prior.load(bytes(dump))


def texts():
    rng = random.Random(2)
    parts = ["end.", "END!?", "É).", "ŐŰ,", "İ.", "ΑΣ.", "'s.", "a'", "1.", "x²;", "q̈.", "ß%&", "Ǆ:", "<|endoftext|>."]
    parts += ["Hello", "wörld", "it's", "<|endoftext|>", "##", "é", "é", "́x", "12", "😀", "\x1cq", "a b", "ΑΣ"]
    gaps = [" ", "\n", "\t", "", "  ", "\r\n", " "]
    docs = [(i, "".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randrange(1, 80)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n"), (None, "none"), docs[4], docs[4], (-5, "first?")]
    return docs + [(103, "lorem ipsum dolor " * 9000), (104, "x" * 50_000)]


def test_parts_encode_as_the_whole_text():
    coder, plain = idcoder.Encoder(PATH), Tokenizer.from_file(PATH)
    own = [t or "" for _, t in texts()]
    for _ in range(2):  # the second time from what is known
        cuts, ids = coder.encode(pa.array(own))
        got = [ids[a:z].tolist() for a, z in zip(cuts, cuts[1:], strict=False)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in own]


def test_files_hold_the_ids_in_order(spark, monkeypatch):
    monkeypatch.setattr(idcoder, "LANES", 2)
    plain = Tokenizer.from_file(PATH)
    docs = texts()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, part int")
    got = idcoder.id_file_digests(df.repartition(4), PATH).collect()
    want, at = [], {}
    for doc_id, text in docs:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((str(doc_id), len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    total = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == total
        total += r.n_tokens
        at.setdefault(r.doc_id, r.start)
    order = [d for d, _ in sorted(at.items(), key=lambda x: x[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert idcoder.id_file_digests(df, PATH).count() == 0


def test_halves_are_those_of_the_single_part():
    rng = random.Random(6)
    signs = ["a", "B", "7", ".", "'", "_", "|>", "<|", "\x7f", "\x1c", "é", "Ő", "İ", "²", ")", "-"]
    parts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 7))) for _ in range(4000)]
    parts = sorted(set(parts))
    for own in (parts, parts[:1], [], ["é"], ["x."]):
        halves, pairs = idcoder.halved(pa.array(own, pa.string()))
        assert [(halves[a], halves[b]) for a, b in pairs.tolist()] == [idcoder.split(p) for p in own]


def test_blocks_of_all_sizes_advance_together(monkeypatch):
    rng = np.random.default_rng(8)
    ids = rng.zipf(1.3, 3 * idcoder.BLOCK + 700).astype(np.int64) % 50_000
    prior = idcoder.Prior.of(ids)
    alone = [b for i in range(0, len(ids), idcoder.BLOCK) for b in idcoder.encode(ids[i : i + idcoder.BLOCK], prior)]
    calls, passes = [], (idcoder.encode_lanes, idcoder.decode_lanes)
    for f in passes:
        monkeypatch.setattr(idcoder, f.__name__, lambda *a, f=f: calls.append(f.__name__) or f(*a))
    blocks = idcoder.encode(ids, prior)
    assert blocks == alone and (idcoder.decode(blocks, prior) == ids).all()
    assert calls == ["encode_lanes", "decode_lanes"]
    # Also in another order, with two short ones and an empty one.
    order = [3, 0, 2, 3, 1]
    empty = idcoder.headed(np.zeros(0, np.int32), b"")
    got = idcoder.decode([*(blocks[i] for i in order), empty], prior)
    assert (got == np.concatenate([ids[i * idcoder.BLOCK : (i + 1) * idcoder.BLOCK] for i in order])).all()


def test_parts_met_often_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(idcoder, "CACHE", 20)
    coder, plain, learnt = idcoder.Encoder(PATH), Tokenizer.from_file(PATH), []
    learn = coder.learn
    coder.learn = lambda parts: learnt.extend(parts) or learn(parts)
    for i in range(30):
        own = ["often, often here. " + " ".join(f"w{i}x{j}!" for j in range(6)), None, f"  {i}ö here."]
        cuts, ids = coder.encode(pa.array(own))
        got = [ids[a:z].tolist() for a, z in zip(cuts, cuts[1:], strict=False)]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in own]
        assert len(coder.known) == len(coder.cuts) - 1 == len(coder.met) < 40
    assert learnt.count("often") == learnt.count("here") == learnt.count(",") == 1


def test_words_of_small_letters_go_straight_to_the_model():
    rng = random.Random(9)
    words = list(idcoder.LETTERS) + ["".join(rng.choices(idcoder.LETTERS, k=rng.randrange(2, 15))) for _ in range(3000)]
    coder, plain = idcoder.Encoder(PATH), Tokenizer.from_file(PATH)
    coder.learn([""])
    coder.tokenizer = None
    cuts, ids = coder.encode(pa.array(words))
    for w, a, z in zip(words, cuts, cuts[1:], strict=False):
        assert ids[a:z].tolist() == plain.encode(w, add_special_tokens=False).ids


def test_a_run_of_many_blocks_is_one_pass(monkeypatch):
    monkeypatch.setattr(idcoder, "BLOCK", 16)
    ids = np.random.default_rng(5).zipf(1.3, 16 * 1149 + 5).astype(np.int64) % 50_000
    prior, calls = idcoder.Prior.of(ids), []
    for f in (idcoder.encode_lanes, idcoder.decode_lanes):
        monkeypatch.setattr(idcoder, f.__name__, lambda *a, f=f: calls.append(f.__name__) or f(*a))
    blocks = idcoder.encode(ids, prior)
    assert len(blocks) == 1150 and (idcoder.decode(blocks, prior) == ids).all()
    assert calls == ["encode_lanes", "decode_lanes"]


def test_carries_reach_over_many_words():
    rng, n, steps = np.random.default_rng(7), 300, 60
    top = 1 << idcoder.PAIR
    out, low, size = idcoder.Writer(n, 2 * steps + 4), [0] * n, [idcoder.HIGH] * n
    for _ in range(steps):
        wide = rng.choice([32, 1 << 12, top // 3, top - 64], n)
        begin = np.where(rng.random(n) < 0.8, top - wide, rng.integers(0, top - wide + 1))
        for i in range(n):
            unit = size[i] >> idcoder.PAIR
            low[i], size[i] = low[i] + unit * int(begin[i]), unit * int(wide[i])
            while size[i] < idcoder.LOW:
                low[i], size[i] = low[i] << idcoder.SENT, size[i] << idcoder.SENT
        out.put(begin, wide)
    assert out.range.tolist() == size
    for got, want in zip(out.cut(0), low, strict=True):
        words = [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)]
        value = sum(w << 32 * (len(words) - 1 - i) for i, w in enumerate(words))
        assert value >> idcoder.SENT - idcoder.KEPT == want


def test_decoded_ids_stay_in_their_task(spark):
    df = spark.createDataFrame([(i, f"word {i}") for i in range(9)], "doc_id long, text string")
    plan = idcoder.id_file_digests(df, PATH)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
