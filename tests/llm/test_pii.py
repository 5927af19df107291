"""Base identifiers by plain Python, and spans that only their context reveals."""

import random
import re

from weekloom.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def right(kind, x):
    digits = re.sub("[^0-9]", "", x)
    if kind == "ip":
        return all(int(p) <= 255 for p in x.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(t - 9 * (t > 9) for t in twice) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if right(kind, m.group()):
                found.append((m.start(), rank, m.end()))
    return sorted(found)


def texts():
    rng = random.Random(8)
    parts = [
        "a@b.c", "é.x+1@Mail-9.example.com..d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.255",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (961) 555-6946", "+49 30 1234567",
        "+1(2)3", "@", "a@b", "x@y.z@w.v", "12", "99999999999999999999", "+", "…", "😀", "+1 2+3 4567890 12",
        "378282246310005", "1.1.1", "😀a@b.co",
    ]
    out = [(i, "".join(rng.choice(parts) + rng.choice([" ", "\n", "", ", ", "é"]) for _ in range(40)))
           for i in range(60)]
    out += [(100, None), (101, ""), (102, "7" * 30_000), (103, "a" * 30_000 + "@b.c"), out[3], out[3]]
    out += [(104, "a@b" + ".c" * 20_000), (None, "q@w.e"), (105, "1 " * 20_000), (106, "+1" * 9_000)]
    return out


def test_base_spans_equal_plain_python(spark):
    docs = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = pii.personal_data(df).collect()
    have = sorted((str(r.doc_id), [tuple(x) for x in r.base]) for r in got)
    assert have == sorted((str(d), brute(t)) for d, t in docs)
    for r in got:
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.spans}


def test_context_reveals_unseen_identifiers(spark):
    docs = [(i, f"word {i} then reach me u{i}@mail.example.com now") for i in range(30)]
    docs += [(100, "Please reach me jane2024(at)mail now"), (101, "the part number jx-20245 now")]
    docs += [(102, "again the jane2024(at)mail address")]
    df = spark.createDataFrame(
        [(*d, "x", 3) for d in docs], "doc_id long, text string, key string, base int"
    )
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.personal_data(df).collect()}
    assert spans[100][0][:2] == (16, 0)
    assert not spans[101]
    assert spans[102]
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[5] == "word 5 then reach me <EMAIL> now"
    assert clean[100].startswith("Please reach me <EMAIL>")
    assert clean[101] == docs[31][1]


def test_redaction_of_overlaps_and_empty_tables(spark):
    rows = [(1, "+1 (961) 555-6946 a@b.c 10.0.0.1.x@y.z!", 99), (2, None, None), (3, "none", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert not re.search("[0-9]|@", out[1].text)
    assert out[1].n_chars == len(out[1].text)
    assert (out[2].text, out[2].n_chars, out[3].text) == (None, None, "none")
    assert pii.redact(df).columns == df.columns
    assert pii.personal_data(df.filter("doc_id > 9")).count() == 0


def found_in(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: [tuple(x) for x in r.spans] for r in pii.personal_data(df).collect()}


def test_bootstrapping_goes_on_until_a_round_adds_nothing(spark):
    docs, sizes = [], [2048, 512, 128, 32, 8, 2]
    for level, size in enumerate(sizes):
        for i in range(size):
            value = f"u{i}@mail.example.com" if level == 0 else f"l{level}n{i + 1000}(at)mail"
            for word in "abcdef"[max(level - 1, 0) : level + 1]:
                docs.append((level, f"see {word}{word} {value} now"))
    df = spark.createDataFrame(docs, "level long, text string").selectExpr("level doc_id", "text")
    got = pii.personal_data(df).selectExpr("doc_id", "size(spans) n").collect()
    assert {r.doc_id: r.n for r in got if r.n != 1} == {}
    assert len(got) == len(docs)


def test_neighbours_are_context_and_length_is_no_limit(spark):
    docs = [(i, f"pair 7777 u{i}@mail.example.com 55 now") for i in range(30)]
    docs += [(i, f"then reach me u{i}@mail.example.com now") for i in range(30, 60)]
    long = "x" * 70 + "2024(at)mail"
    docs += [(100, "pair 8888 jane2024(at)mail 66 now"), (101, f"then reach me {long} now")]
    spans = found_in(spark, docs)
    assert spans[100] == [(10, 0, 26)]
    assert spans[101] == [(14, 0, 14 + len(long))]
