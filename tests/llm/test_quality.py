"""Counts of the quality rules by brute force, the verdict on held-out labels."""

import collections
import math
import random
import re

import pytest

from weekloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    seen = collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    marked = set()
    for i in range(len(ws) - 4):
        if seen[tuple(ws[i : i + 5])] > 1:
            marked.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(ws) < 10 or 100 * len(marked) > 20 * len(ws)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (
        len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(marked), failed,
    )


def corpus():
    rng = random.Random(4)
    good = ["the", "of", "river", "stone", "walk", "été", "garden", "light", "says"]
    junk = [w + "###" for w in good] + ["click", "buy", "$$$", "now!!"]
    docs, labels = [], []
    for i in range(200):
        low = i % 4 == 0
        words = [rng.choice(junk if low else good) for _ in range(rng.randrange(12, 90))]
        if i % 7 == 0:
            words += words[:20]
        docs.append((i, "".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words)))
        if i % 3:
            labels.append((i, 0 if low else 1, 0))
    docs += [(900, None), (901, ""), (902, " \n\n"), (903, "a b c d e " * 3000)]
    docs += [(904, "x\ny\nx\n\nx " * 4), (905, "w" * 200_000), docs[3], docs[3], (None, docs[5][1])]
    return docs, labels


def test_counts_and_verdict(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.quality(df, marks).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    have = sorted((str(r.doc_id), *[r[f] for f in fields]) for r in got)
    assert have == sorted((str(d), *brute(t)) for d, t in docs)
    assert all(not r.kept for r in got if r.base_failed)
    truth = {d: q for d, q, _ in labels}
    judged = [(r.kept, bool(truth[r.doc_id])) for r in got if r.doc_id in truth and not r.base_failed]
    assert sum(a == b for a, b in judged) > 0.95 * len(judged)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0)], [(None, 1, 0), (77, 5, 0)]])
def test_without_labels_the_rules_decide(spark, labels):
    docs = [(1, "one two three four five six seven eight nine ten"), (2, "short")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, half int, t int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.quality(df, marks).collect()}
    assert got == {1: True, 2: False}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality(docs, labels).count() == 0


def test_every_label_counts(spark):
    # Labels of the negative hashes alone, 25,000 of them low, would keep the texts of kind b.
    good, junk = [f"g{i}" for i in range(12)], [f"j{i}" for i in range(12)]
    texts = {"a": junk, "m": good[:4] + junk[:8], "b": good[:7] + junk[:5], "g": good}
    kind = "CASE WHEN id >= 60000 THEN 'm' WHEN id >= 50000 THEN 'g' WHEN xxhash64(id) < 0 THEN 'a' ELSE 'b' END"
    words = " ".join(f"WHEN '{k}' THEN '{' '.join(t)}'" for k, t in texts.items())
    rows = spark.range(60_100).selectExpr("id AS doc_id", f"{kind} AS kind", "int(id >= 50000) AS quality")
    docs = rows.selectExpr("doc_id", f"CASE kind {words} END AS text")
    got = quality.quality(docs, rows.select("doc_id", "quality")).join(rows, "doc_id")
    seen = {r.kind: r for r in got.groupBy("kind").agg({"kept": "max", "score": "max"}).collect()}
    assert {k: r["max(kept)"] for k, r in seen.items()} == {"a": False, "m": False, "b": False, "g": True}
    # The mean over the grams of kind g, counted by hand: smoothed by one, over all trusted ones.
    half = rows.filter("pmod(xxhash64(doc_id), 2) = 0 AND quality = 1").groupBy("kind").count()
    n, t = dict(rows.groupBy("kind").count().collect()), dict(half.collect())
    raw, trusted = collections.Counter(), collections.Counter()
    for k, words in texts.items():
        for gram in [*words, *zip(words, words[1:], strict=False)]:
            raw[gram] += n[k]
            trusted[gram] += t.get(k, 0)
    total = lambda c: quality.BUCKETS + sum(c.values())
    own = [*good, *zip(good, good[1:], strict=False)]
    logs = [math.log((1 + trusted[x]) / (1 + raw[x]) * total(raw) / total(trusted)) for x in own]
    assert seen["g"]["max(score)"] == pytest.approx(sum(logs) / len(logs), abs=1e-3)
