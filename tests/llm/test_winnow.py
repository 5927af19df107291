"""Winnowing against every window of every item, by brute force."""

import hashlib
import random
import re

import pytest

from weekloom.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items):
    ws, hit, ids = words(text), set(), set()
    for item, body in items:
        iw = words(body)
        k = min(10, len(iw))
        if not k:
            continue
        windows = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)}
        for i in range(len(ws) - k + 1):
            if tuple(ws[i : i + k]) in windows:
                hit.update(range(i, i + k))
                ids.add("" if item is None else str(item))
    return len(ws), len(hit), ",".join(sorted(ids))


def case():
    rng = random.Random(5)
    vocab = ["a", "bé", "C3", "the", "of", "x9", "ß", "und"]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    items = [(i, prose(rng.choice([12, 20, 40]))) for i in range(12)]
    items += [(50, "one two THREE"), (51, ""), (52, None), (None, prose(15)), (3, prose(11))]
    items += [(60, "a"), (61, "zz " * 30), (62, items[0][1])]
    docs = [(i, prose(rng.choice([3, 9, 10, 11, 60, 300]))) for i in range(40)]
    for i in range(40, 70):
        body = rng.choice([x for _, x in items if x])
        cut = body.split()[rng.randrange(3) :]
        docs.append((i, f"{prose(5)}!{'-'.join(cut).upper()}?{prose(7)}"))
    docs += [(70, None), (71, ""), (72, "zz " * 2000), (73, "zz " * 9), (None, items[1][1])]
    docs += [docs[45], docs[45], (74, " \x00ONE_two\tthree"), (75, "x" * 300_000)]
    return docs, items


@pytest.mark.parametrize("most", [winnow.MAX_INDEX_WORDS, 120])
def test_hits_equal_all_windows(spark, most):
    docs, items = case()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.contamination(df, bench, most=most).collect()
    have = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got
    )
    want = []
    for doc_id, text in docs:
        n, hit, ids = brute(text, items)
        want.append((str(doc_id), n, hit, ids, hit > 0))
    assert have == sorted(want)
    assert any(w[2] for w in want) and not all(w[2] for w in want)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnow.contamination(docs, none).count() == 0
    rows = spark.createDataFrame(
        [(1, "a b c", 7, "t", 2)], "doc_id long, text string, key int, spans string, n_words int"
    )
    (r,) = winnow.contamination(rows, none).collect()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (3, 0, 0, False)
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert winnow.drop_contaminated(rows, bench).count() == 0
    assert winnow.drop_contaminated(rows, none).columns == rows.columns


def test_long_items_are_cut_without_losing_a_window(spark):
    body = " ".join(f"w{i}" for i in range(5000))
    bench = spark.createDataFrame([(1, body)], "item_id long, text string")
    docs = spark.createDataFrame([(1, body.upper())], "doc_id long, text string")
    for most in (winnow.MAX_INDEX_WORDS, 1500):
        (r,) = winnow.contamination(docs, bench, most=most).collect()
        assert (r.n_words, r.n_hit, r["items"]) == (5000, 5000, ["1"])
    assert hashlib.sha256(b"1").hexdigest()
