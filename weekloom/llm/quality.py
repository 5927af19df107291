"""Quality rules with a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed to ``BUCKETS``. One multinomial over the buckets is
counted on all documents, another on trusted ones (labelled quality 1); both are smoothed
by one. A document's score is the mean log ratio of its n-grams. The threshold is the cut
that separates labelled documents best, so it depends on the given tables alone, and every
document is judged by it. Rules on length and repetition come first and always hold.

Every label counts: a hash of the id deals labelled documents to two halves, one fits the
trusted counts, the other the threshold. Without labels of both classes in either half the
score is 0 or the threshold is absent, and only the rules decide.

Null and empty texts have no words and fail the length rule. Repeated rows each get a row,
documents with conflicting labels count as low quality, labels of unknown documents are
ignored, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import pick
from weekloom.sources.staging import stage

BUCKETS = 10_000
WINDOW = 5
MIN_WORDS = 10
#: Percent of words in repeated windows beyond which a document fails.
MAX_REPEAT = 20
#: Scores are binned to find the threshold.
BIN = 0.01

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def halved_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, half) of every labelled document."""
    clean = pick(labels, "doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    return (
        clean.groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    )


def with_grams(docs: DataFrame) -> DataFrame:
    """``docs(…, words)`` with ``grams``: buckets of all words, then of all word pairs."""
    bucket = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")
    pairs = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda w, i: bucket(w, F.get("words", i + 1)),
    )
    return docs.withColumn("grams", F.concat(F.transform("words", lambda w: bucket(w)), pairs))


def with_words(docs: DataFrame) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    return docs.withColumn("words", F.coalesce(found, F.array().cast("array<string>")))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float] | None:
    """Per bucket, log of trusted over raw probability; None without a trusted document."""
    trusted = labels.filter("quality = 1 AND half = 0").select("doc_id", F.lit(1).alias("t"))
    # Labels grow with the documents: the same join at every size, none by broadcast.
    flagged = docs.join(trusted.hint("merge"), "doc_id", "left")
    counts = (
        with_grams(with_words(flagged))
        # Outer: the plain form adds a filter on the array, which would repeat its making.
        .select(F.explode_outer("grams").alias("g"), "t")
        .filter("g IS NOT NULL")
        .groupBy("g")
        .agg(F.count("*").alias("raw"), F.count("t").alias("trusted"))
        .collect()  # BUCKETS rows at most
    )
    raw, good = [1] * BUCKETS, [1] * BUCKETS
    for r in counts:
        raw[r.g] += r.raw
        good[r.g] += r.trusted
    if sum(good) == BUCKETS:
        return None
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [math.log(a) - math.log(b) + shift for a, b in zip(good, raw, strict=True)]


def repeated_words(windows: str, ordered: str) -> Column:
    """Words covered by windows that occur twice or more.

    ``ordered`` holds (hash, position) sorted, or null where no window repeats.
    """
    near = lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (
        F.get(ordered, i + 1)["h"] == x["h"]
    )
    places = F.array_sort(F.transform(F.filter(ordered, near), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, p: F.struct(
            (s["n"] + p + WINDOW - F.greatest(p, s["end"])).alias("n"),
            (p + WINDOW).alias("end"),
        ),
        lambda s: s["n"],
    )
    return F.coalesce(F.when(F.col(ordered).isNotNull(), covered), F.lit(0)).cast("long")


def measures(docs: DataFrame, weights: list[float] | None) -> DataFrame:
    """Counts, rules and score of every document; keeps the other columns but the text."""
    plain = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(plain, "\n", -1), lambda x: x.rlike(WORD))
    step = with_grams(with_words(docs)).withColumn("lines", lines)
    n = F.size("words")
    # A constant of the plan: one number for each of BUCKETS.
    table = F.expr("array(" + ",".join(f"{w!r}D" for w in weights or [0.0] * BUCKETS) + ")")
    total = F.aggregate("grams", F.lit(0.0), lambda s, g: s + F.get(table, g))
    hashes = F.transform(
        F.slice("words", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, WINDOW)]),
    )
    step = step.select(
        *[c for c in docs.columns if c != "text"],
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(plain, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(plain) - F.length(F.translate(plain, SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0).alias("score"),
        hashes.alias("windows"),
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    numbered = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("ordered", F.when(repeats, F.array_sort(numbered)))
    step = step.withColumn("n_repeat_words", repeated_words("windows", "ordered"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")
    )
    return step.drop("windows", "ordered").withColumn("base_failed", failed)


def threshold(scored: DataFrame, labels: DataFrame) -> float | None:
    """The cut between labelled documents of the held half with the best balance.

    ``scored(doc_id, score, base_failed)``; of equal cuts the lowest.
    """
    held = labels.filter("half = 1").select("doc_id", "quality")
    bins = (
        scored.filter("NOT base_failed")
        .select("doc_id", "score")
        .join(held.hint("merge"), "doc_id")
        .select(F.floor(F.col("score") / BIN).alias("b"), "quality")
        .groupBy("b")
        .agg(
            F.sum(F.col("quality")).alias("good"),
            F.sum(1 - F.col("quality")).alias("bad"),
        )
        .orderBy("b")
        .collect()  # scores are bounded by the log of the counts: a few thousand bins
    )
    good, bad = sum(r.good for r in bins), sum(r.bad for r in bins)
    if not good or not bad:
        return None
    best, cut, lost, caught = -1.0, None, 0, 0
    for r in bins:
        balance = caught / bad - lost / good
        if balance > best:
            best, cut = balance, r.b * BIN
        lost, caught = lost + r.good, caught + r.bad
    return cut


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its counts, ``score``, ``base_failed`` and ``kept``."""
    rows = pick(docs, "doc_id", "text")
    labelled = stage(halved_labels(labels), "quality-labels")
    weights = log_ratios(rows, labelled)
    scored = stage(measures(rows, weights), "quality-scores")
    cut = None if weights is None else threshold(scored, labelled)
    passed = F.lit(True) if cut is None else F.col("score") >= cut
    return scored.withColumn("kept", ~F.col("base_failed") & passed)
