"""SimHash links against all pairs of fingerprints."""

import random

import pytest
import xxhash

from weekloom.llm import simhash


def reference_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_components(prints, radius):
    """Smallest id reachable, by comparing all pairs."""
    names = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= radius and names[j] < names[i]:
                    names[i], changed = names[j], True
    least = {}
    for (doc, _), n in zip(prints, names, strict=True):
        if doc is not None:
            least[n] = min(doc, least.get(n, doc))
    return [least.get(n) for n in names]


def texts():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(vocab) for _ in range(120)) for _ in range(12)]
    docs = []
    for i in range(90):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        docs.append((100 + i, " ".join(words)))
    docs += [(7, None), (3, ""), (9, "  \t"), (None, ""), (5, "One"), (6, "one"), (4, "a b c")]
    docs += [docs[0], docs[0], (None, docs[1][1]), (1, "x " * 40_000), (2, "Ünï " * 9)]
    return docs


@pytest.mark.parametrize("most", [simhash.MAX_SHARD, 3])
def test_components_equal_all_pairs(spark, most):
    docs = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = simhash.near_duplicates(df, most=most).collect()
    prints = [(d, reference_print(t)) for d, t in docs]
    want = [
        (d, f"{p:016x}", c)
        for (d, p), c in zip(prints, reference_components(prints, 4), strict=True)
    ]
    assert sorted(map(repr, ((r[1], r[2], r[3]) for r in got))) == sorted(map(repr, want))
    assert len({c for *_, c in want}) < len(want)


def test_one_of_each_component_stays(spark):
    docs = [(d, t, i) for i, (d, t) in enumerate(texts())]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp int")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    prints = [(d, reference_print(t)) for d, t, _ in docs]
    found = [r.doc_id for r in kept.collect()]
    assert sorted(found) == sorted(set(reference_components(prints, 4)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    for n in (100, 3_000_000, 10**9):
        masks = simhash.shard_masks(n, 4)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(flips & m == 0 for m in masks)
    assert len(simhash.shard_masks(10**9, 4)) > len(simhash.shard_masks(100, 4))


def test_tree_finds_what_a_scan_finds():
    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.Tree()
    for v in values:
        tree.add(v)
    for q in range(0, 4096, 97):
        want = sorted({v for v in values if (v ^ q).bit_count() <= 3})
        assert sorted(tree.within(q, 3)) == want
