"""How filters overlap and what their order changes.

Five filters look at whole texts (null: empty; words are runs without white space):
A too few words, B too few distinct words, C too many capitals, D a symbol, E the same text
under a smaller doc_id. The copies come from an existential self-join: a left-semi join
of each row with its table on hash, exact text and smaller doc_id. Its ids are united with
those of the other failures, one bit a filter, and documents are counted by part, bit
combination and label. Every order of the filters follows from these 32 counts a part.

Only rows whose hash occurs under several ids carry their text into the join. Its right
side holds one row a text, that of the smallest doc_id, made by a partial aggregation, so
a group of copies is never paired with itself. Hashes of many rows are hot: their list,
of bounded length, is broadcast, and their rows are dealt over salts that the right side
repeats.

A document of a null doc_id is compared with none and has no labels; ids that repeat are
not smaller than each other, each of their rows counts; of conflicting labels the larger
one holds. A null source is the empty part. An empty table gives no rows, other columns
are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import pick
from weekloom.sources.staging import stage

FILTERS = "ABCDE"
LEAST_WORDS = 50
#: Percent of words that must be distinct, and of characters that may be capitals.
DISTINCT, CAPITALS = 65, 5
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
ALL = (1 << len(FILTERS)) - 1
COPY = 1 << FILTERS.index("E")
#: A hash is hot beyond so many rows, or beyond one row in ``MOST_HOT`` of a large table,
#: so that no more than ``MOST_HOT`` hashes are. Its rows go to salts of that many rows.
LEAST_HOT, MOST_HOT = 1000, 100_000
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("n", "good", "toxic")


def failures(text: str) -> Column:
    """Bits of the filters A to D that a text fails, from ``words`` and the text."""
    n = F.size("words")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < DISTINCT * n,
        100 * capitals > CAPITALS * F.length(text),
        F.col(text).rlike(SYMBOLS),
    ]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)]
    return sum(bits[1:], bits[0])


def hashes(text: str) -> list[Column]:
    """128 bits that equal texts share."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("weekloom"), text).alias("h2")]


def whole(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text) without nulls but in doc_id."""
    return pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def examined(docs: DataFrame) -> DataFrame:
    """(doc_id, part, h1, h2, bits): every row with its failures of A to D."""
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    rows = whole(docs).withColumn("words", words)
    return rows.select("doc_id", "part", *hashes("text"), failures("text").alias("bits"))


def copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, part, h1, h2) of documents whose text a smaller doc_id has, too."""
    groups = rows.filter("doc_id IS NOT NULL").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    shared = stage(groups.filter("low < high").select("h1", "h2", "n"), "audit-shared")
    rows_a_salt = max(LEAST_HOT, rows.count() // MOST_HOT)
    salts = F.ceil(F.col("n") / rows_a_salt).cast("int")
    hot = shared.filter(F.col("n") > rows_a_salt).select("h1", "h2", salts.alias("salts"))
    over = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    dealt = F.pmod(F.xxhash64("doc_id", "part"), F.coalesce("salts", F.lit(1))).cast("int")
    suspects = (
        whole(docs)
        .filter("doc_id IS NOT NULL")
        .select("*", *hashes("text"))
        .join(F.broadcast(hot), ["h1", "h2"], "left")  # MOST_HOT rows at most
        .withColumn("salt", dealt)
        .join(
            shared.withColumn("salts", salts).select("h1", "h2", over),
            ["h1", "h2", "salt"],
            "left_semi",
        )
    )
    first = suspects.groupBy("h1", "h2", "text", "salts").agg(F.min("doc_id").alias("low"))
    first = first.withColumn("salts", F.coalesce("salts", F.lit(1))).select(
        "h1", "h2", over, F.col("text").alias("same"), "low"
    )
    earlier = (
        (suspects.h1 == first.h1)
        & (suspects.h2 == first.h2)
        & (suspects.salt == first.salt)
        & (suspects.text == first.same)
        & (first.low < suspects.doc_id)
    )
    return suspects.join(first, earlier, "left_semi").select("doc_id", "part", "h1", "h2")


def label_flags(labels: DataFrame) -> DataFrame:
    flags = [F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")]
    known = pick(labels, "doc_id", "quality", "toxic").filter("doc_id IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*flags)


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters they fail."""
    rows = stage(examined(docs), "audit-rows")
    found = copies(docs, rows)
    united = rows.withColumn("n", F.lit(1)).unionByName(
        found.withColumn("bits", F.lit(COPY)).withColumn("n", F.lit(0))
    )
    # Rows that repeat id, part and text fail alike and are counted by n.
    each = united.groupBy("doc_id", "part", "h1", "h2").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )
    marked = each.join(label_flags(labels), "doc_id", "left")
    return marked.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        *[F.coalesce(F.sum(F.when(F.col(c) == 1, F.col("n"))), F.lit(0)).alias(name)
          for c, name in (("quality", "good"), ("toxic", "toxic"))],
    )


def steps(combined: DataFrame) -> DataFrame:
    """Every step of every order of the filters, for every part of ``combined``.

    ``clear_x[s]`` counts the documents that fail no filter of the set s; what a filter
    removes after a set is the difference of two of them.
    """
    clear = [
        F.array(*[
            F.sum(F.when(F.col("bits").bitwiseAND(s) == 0, F.col(c)).otherwise(0))
            for s in range(ALL + 1)
        ]).alias(f"clear_{c}")
        for c in COUNTS
    ]
    # Of the orders, a document's k failed filters come first equally often.
    share = F.get(F.array(*[F.lit(len(ORDERS) // k if k else 0) for k in range(6)]), F.bit_count("bits"))
    shapley = F.array(*[
        F.sum(F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.col("n") * share).otherwise(0))
        for i in range(len(FILTERS))
    ]).alias("shapleys")
    parts = combined.groupBy("part").agg(*clear, shapley)
    orders = F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order")
    placed = parts.select("*", orders).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )
    place = lambda i: F.ascii(F.substring("filter_order", i, F.lit(1))) - ord("A")
    before = F.aggregate(
        F.sequence(F.lit(0), F.col("step") - 1),
        F.lit(0),
        lambda s, i: F.when(i == 0, s).otherwise(s + F.pow(F.lit(2), place(i)).cast("int")),
    )
    placed = placed.withColumn("before", before).withColumn("place", place(F.col("step")))
    placed = placed.withColumn("bit", F.pow(F.lit(2), F.col("place")).cast("int"))
    at = lambda c, s: F.get(f"clear_{c}", s)
    after = F.col("before") + F.col("bit")
    removed = {c: at(c, F.col("before")) - at(c, after) for c in COUNTS}
    failing = at("n", F.lit(0)) - at("n", F.col("bit"))
    columns = {
        "kept": at("n", after),
        "removed": removed["n"],
        "redundant": failing - removed["n"],
        "unique_fails": at("n", ALL - F.col("bit")) - at("n", F.lit(ALL)),
        "good_lost": removed["good"],
        "toxic_lost": removed["toxic"],
        "shapley": F.get("shapleys", F.col("place")),
    }
    counts = [v.cast("long").alias(k) for k, v in columns.items()]
    return placed.select("part", "filter_order", F.col("step").cast("int"), *counts)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    return steps(combinations(docs, labels))
