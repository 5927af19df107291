"""Nearest examples against plain cosine, and held-out accuracy of the votes."""

import random
import zlib

import numpy as np
import pytest

from weekloom.llm import toxicity


def plain_nearest(scale, rows, texts, k):
    def unit(ids, counts):
        w = (1 + np.log(np.array(counts, float))) * scale[ids]
        return dict(zip(ids, (w / np.sqrt(w @ w)).tolist(), strict=True))

    have = [unit(r[1], r[2]) for r in rows]
    out = []
    for ids, counts in texts:
        own = unit(ids, counts)
        sums = [sum(own[i] * x[i] for i in own.keys() & x.keys()) for x in have]
        scored = [(-round(s, 12), j) for j, s in enumerate(sums) if s > 0]
        out.append([j for _, j in sorted(scored)[:k]])
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("dense", [1, 64, 10**6])
def test_block_max_search_is_exact(seed, dense, monkeypatch):
    """Whatever share of the terms is held as a matrix: all, the frequent ones, none."""
    monkeypatch.setattr(toxicity, "DENSE", dense)
    rng = random.Random(seed)
    scale = np.array([rng.uniform(0.2, 2) * (30 if i % 40 == 0 else 1) for i in range(300)])
    often = [rng.paretovariate(1) for _ in range(300)]

    def vector():
        own = sorted(set(rng.choices(range(300), often, k=rng.choice([1, 5, 60]))))
        return own, [rng.randrange(1, 9) for _ in own]

    rows = [(i, *vector(), i % 2) for i in range(500)] + [(900 + i, [3], [1], 1) for i in range(200)]
    cuts = np.cumsum([0] + [len(r[1]) for r in rows])
    ids, counts = (np.array([x for r in rows for x in r[c]]) for c in (1, 2))
    toxic = np.array([r[3] for r in rows])
    index = toxicity.Examples([r[0] for r in rows], toxic, cuts, ids, counts, scale, 0.1)
    texts = [vector() for _ in range(90)] + [([3], [2])]
    got = [[j for _, j in found] for found in index.nearest(texts, 15)]
    assert got == plain_nearest(scale, rows, texts, 15)


def corpus():
    rng = random.Random(9)
    good = [f"w{''.join(rng.choice('abcdef') for _ in range(4))}" for _ in range(80)]
    bad = ["nastyone", "vilething", "uglyword"]
    docs, labels = [], []
    for i in range(500):
        words = [rng.choice(good) for _ in range(rng.randrange(5, 60))]
        toxic = int(i % 6 == 0)
        if toxic:
            words += [rng.choice(bad) + rng.choice(["", "s", "ish"]) for _ in range(4)]
        rng.shuffle(words)
        docs.append((i, " ".join(words).title()))
        if i % 5 != 1:
            labels.append((i, 1, toxic))
    docs += [(900, None), (901, ""), (902, "nastyone " * 20_000), docs[6], docs[6], (None, docs[12][1])]
    return docs, labels, {d for d in range(500) if d % 6 == 0} | {902}


def test_held_out_documents(spark):
    docs, labels, toxic = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, toxic int")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (77777, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(df.repartition(3), marks).collect()
    assert len(got) == len(docs)
    for r in got:
        want = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == want and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.doc_id is not None:
            assert r.predicted == (r.doc_id in toxic), r.doc_id
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    kept = toxicity.drop_toxic(df, marks)
    assert kept.columns == df.columns
    assert kept.count() == sum(not r.predicted for r in got)


def test_labels_of_held_out_documents_are_never_read(spark):
    docs, labels, _ = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    turned = [(d, q, 1 - t if held(d) else t) for d, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (
        toxicity.toxicity(df, spark.createDataFrame(x, schema)).collect() for x in (labels, turned)
    )
    assert sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 1, 1)]])
def test_few_labels(spark, labels):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity(df, marks).collect()] == [0, 0]
    assert toxicity.toxicity(df.filter("doc_id > 5"), marks).count() == 0


def test_a_rare_toxic_term_beside_a_strong_one(spark):
    rng = random.Random(4)
    plain = [f"plain{rng.randrange(50)} word{rng.randrange(50)} more" for _ in range(900)]
    rows = [(i, t, 0) for i, t in enumerate(plain[:600])]
    rows += [(1000 + i, t + " foul", 1) for i, t in enumerate(plain[600:800])]
    rows += [(2000 + i, t + " vile", 1) for i, t in enumerate(plain[800:840])]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    fresh = spark.createDataFrame(
        [(9000 + i, t + w) for i, (t, w) in enumerate(zip(plain[840:], [" foul", " vile", ""] * 20))],
        "doc_id long, text string",
    )
    got = toxicity.toxicity(df.unionByName(fresh), marks).filter("doc_id >= 9000").collect()
    assert {r.doc_id for r in got if r.predicted} == {r.doc_id for r in got if (r.doc_id - 9000) % 3 < 2}


def test_every_text_that_shares_a_term_has_evidence(spark):
    docs, labels, _ = corpus()
    more = [(950, "w"), (951, "unheardof"), (952, docs[3][1].split()[0])]
    df = spark.createDataFrame(docs + more, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(df, marks).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    known = {d for d, _, _ in labels if not held(d)}
    words = {w for d, t in docs if d in known for w in toxicity.terms(t)}
    texts = {d: t for d, t in docs + more}
    for r in got:
        assert bool(r.evidence) == bool(words & set(toxicity.terms(texts[r.doc_id]))), r.doc_id
        assert set(r.evidence) <= known


def test_scores_are_probabilities(spark):
    """Words that are toxic in so many of a hundred texts: scores come near these shares."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        share = rng.choice([0.1, 0.5, 0.9])
        words = [f"mark{int(share * 10)}", *(f"w{rng.randrange(400)}" for _ in range(6))]
        rows.append((i, " ".join(w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words), share, int(rng.random() < share)))
    df = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    score = {r.doc_id: (r.score, r.held_out) for r in toxicity.toxicity(df, marks).collect()}
    for share in (0.1, 0.5, 0.9):
        own = [score[i][0] for i, _, s, _ in rows if s == share and score[i][1]]
        assert abs(sum(own) / len(own) - share) < 0.08
