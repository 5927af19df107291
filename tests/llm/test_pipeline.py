"""The pipeline on a small corpus whose every decision is planted."""

import random
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Tables in a folder; text by id, and the fate each id was planted for."""
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    rows, fate, labels = [], {}, []

    def add(text, what):
        rows.append((len(rows), text, "en", f"src{len(rows) % 3}", len(text or "")))
        fate[len(rows) - 1] = what
        return len(rows) - 1

    for i in range(240):
        toxic = i % 4 == 0
        bad = " ".join(rng.choice(["vileword", "nastyterm", "uglyphrase"]) for _ in range(4))
        at = add(f"{prose(30)} {bad} {prose(9)}" if toxic else prose(40), "toxic" if toxic else "kept")
        labels.append((at, 1, int(toxic)))
    original = add(prose(300), "kept")
    add(rows[original][1], "copy")
    add(rows[original][1].upper(), "copy")
    items = [(i, prose(25)) for i in range(4)]
    for _, body in items:
        add(f"{prose(20)} {body[7:]} {prose(20)}", "leak")
    private = add(f"{prose(20)} write to jane.doe@example.com or 10.1.2.3 {prose(5)}", "redacted")
    add(None, "kept")
    folder = tmp_path_factory.mktemp("tables")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return str(folder), {r[0]: r[1] for r in rows}, fate, private


def test_every_planted_decision_takes_effect(spark, corpus):
    folder, texts, fate, private = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder).cache()
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == columns
    gone = lambda a, b: set(a) - set(b)
    planted = lambda *what: {d for d, w in fate.items() if w in what}
    assert gone(texts, seen["toxicity"]) == planted("toxic")
    assert gone(seen["toxicity"], seen["near_dedup"]) == planted("copy")
    assert gone(seen["near_dedup"], seen["decontamination"]) == planted("leak")
    assert set(seen["personal_data"]) == set(seen["decontamination"]) == set(seen["sentencepiece"])
    clean = {d: r.text for d, r in seen["personal_data"].items()}
    assert re.search(r"write to <EMAIL> or <IP> ", clean.pop(private))
    assert all(clean[d] == texts[d] for d in clean)
    assert all(r.round_trip and r.n_samples >= 1 for r in seen["sentencepiece"].values())


def test_run_gives_what_the_stages_give(spark, corpus):
    folder, _, fate, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    want = {d for d, w in fate.items() if w in ("kept", "redacted")}
    assert {r.doc_id for r in got.collect()} == want
    assert entry.queries()["pipeline"].__wrapped__ is corpus_pipeline.run


def test_empty_documents(spark, corpus, tmp_path):
    folder = corpus[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{name}.parquet"
        )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
