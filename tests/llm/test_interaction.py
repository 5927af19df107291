"""The filter audit against counting every order of a small corpus by hand."""

import random
import re
from collections import defaultdict
from itertools import permutations

from weekloom.llm import interaction

SCHEMA = "doc_id long, text string, source string"


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts = defaultdict(list)
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        twin = doc_id is not None and any(
            d is not None and d < doc_id and (t or "") == text for d, t, _ in docs
        )
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": twin,
        }
        failed = {k for k, v in failed.items() if v}
        parts[source or ""].append((failed, doc_id in good, doc_id in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = rows
            for k, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                kept = [r for r in left if x not in r[0]]
                failing = sum(x in r[0] for r in rows)
                out[part, "".join(order), k] = [
                    len(kept), len(gone), failing - len(gone),
                    sum(r[0] == {x} for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
                shapley[x] += len(gone)
                left = kept
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return out


def result(docs):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {
        (r.part, r.filter_order, r.step): [r[n] for n in names] for r in docs.collect()
    }


def corpus(n=160):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(90)] + ["Été", "BIG", "ß", "x#", "a$b"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(n)]
    docs = [(i, rng.choice(texts[:60] + texts), f"s{i % 3}") for i in range(n)]
    docs += [(500, None, None), (501, "", None), (502, " \n\t", "s0"), (503, "", "s1")]
    docs += [docs[7], docs[7], (7, docs[7][1], "s2"), (None, docs[9][1], "s0"), (None, None, None)]
    docs += [(504, "long " * 60_000, "s1"), (505, "long " * 60_000, "s1"), (1000, "a b", None)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, n, 2)]
    return docs, labels


def test_every_order(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(interaction.audit(df, marks)) == brute(docs, labels)


def test_hot_groups_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(interaction, "LEAST_HOT", 4)
    docs, labels = corpus(60)
    docs += [(2000 + i, "the same text", f"s{i % 2}") for i in range(90)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(interaction.audit(df, marks)) == brute(docs, labels)


def test_null_and_conflicting_labels_and_other_columns(spark):
    docs = [(1, "A B C", "x"), (2, "A B C", "x"), (3, "", "x")]
    labels = [(1, 1, None), (1, 0, 1), (None, 1, 1), (9, 1, 1)]
    rows = [(d, t, s, "0", 1, "h") for d, t, s in docs]
    names = SCHEMA + ", TEXT string, bits int, h1 string"
    marks = spark.createDataFrame(
        [(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string"
    )
    got = result(interaction.audit(spark.createDataFrame(rows, names), marks))
    assert got == brute(docs, [(1, 1, 1)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    assert result(interaction.audit(one, labels)) == brute([(1, "a", "x")], [])
