"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base identifiers (email, ip, card, phone) are found by pattern and are the seeds. Every
identifier-like token and every seed is an instance; the words around it give lexical
patterns. The graph of distinct (pattern, instance) edges is scored in rounds: a pattern's
confidence for a kind is the share of its instances already known as that kind, an
unknown instance combines the confident patterns it occurs with by noisy-or, and the
instances beyond ``ACCEPT`` are known in the next round, until a round adds none. Words
around an occurrence are those of the text, identifier-like neighbours included.
Occurrences of accepted instances are added to the base spans, which always stay.

A pattern that occurs everywhere is one partial aggregate, an instance joins its patterns
by key; no group is collected. Lookbehind and ``\\G`` keep a pattern from starting within
a run that cannot match earlier, and possessive groups keep long runs off the stack.

Positions are code points. Null and empty texts have no spans. Repeated rows each get a
row, a null id is kept, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import pick, row_key
from weekloom.sources.staging import stage

#: Known instances that a pattern needs before it says anything.
SUPPORT = 5
#: Share of a pattern's instances that must be known, and the score of an accepted instance.
CONFIDENT = 0.8
ACCEPT = 0.9

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that they start and repeat linearly.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Characters of context before and after a match.
BEFORE, AFTER = 80, 40
#: Prefix sums of match lengths go by blocks, so that they stay cheap for many matches.
BLOCK = 256


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, x: Column) -> Column:
    digits = F.regexp_replace(x, "[^0-9]", "")
    if kind == "ip":

        def small(part: Column) -> Column:
            t = F.regexp_replace(part, "^0+", "")
            return (F.length(t) < 3) | ((F.length(t) == 3) & (t <= "255"))

        return F.forall(F.split(x, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def checked(kind: str) -> Column:
    return F.filter(kind, lambda x: valid(kind, x["value"]))


def located(df: DataFrame, text: str, patterns: dict[str, str], when: dict[str, Column]) -> DataFrame:
    """Adds per name an array of (start, end, value, before, after); drops the text.

    Every step is a projection of its own, so that no match is searched for twice.
    """
    keep = [c for c in df.columns if c != text]
    hits = {n: F.regexp_extract_all(text, F.lit(p), F.lit(0)) for n, p in patterns.items()}
    df = df.select(*keep, text, *[F.when(when[n], h).alias(f"m_{n}") for n, h in hits.items()])
    gaps = {n: F.when(F.size(f"m_{n}") > 0, F.split(text, p, -1)) for n, p in patterns.items()}
    df = df.select(*keep, *[f"m_{n}" for n in hits], *[g.alias(f"s_{n}") for n, g in gaps.items()])
    return reduce(placed, patterns, df)


def placed(df: DataFrame, name: str) -> DataFrame:
    """Matches ``m_name`` and the gaps ``s_name`` around them become positions."""
    m, s, sizes, sums = (f"{c}_{name}" for c in ("m", "s", "n", "b"))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda t, x: t + x)

    def place(x: Column, i: Column) -> Column:
        upto = i * 2 + 1
        b = F.floor(upto / BLOCK).cast("int")
        start = total(F.slice(sums, F.lit(1), b)) + total(
            F.slice(sizes, b * BLOCK + 1, upto - b * BLOCK)
        )
        return F.struct(
            start.alias("start"),
            (start + F.length(x)).alias("end"),
            x.alias("value"),
            before(i).alias("before"),
            after(i).alias("after"),
        )

    # A match and its gap have two characters at least, so half as many matches as
    # characters of context reach far enough.
    def before(i: Column) -> Column:
        gap, first = F.get(s, i), F.greatest(i - BEFORE // 2, F.lit(0))
        near = F.transform(F.slice(m, first + 1, i - first), lambda x, j: F.concat(F.get(s, first + j), x))
        text = F.when(F.length(gap) >= BEFORE, gap).otherwise(F.concat(F.array_join(near, ""), gap))
        return F.substring(text, -BEFORE, BEFORE)

    def after(i: Column) -> Column:
        gap = F.get(s, i + 1)
        near = F.transform(
            F.slice(m, i + 2, F.lit(AFTER // 2)), lambda x, j: F.concat(x, F.get(s, i + j + 2))
        )
        text = F.when(F.length(gap) >= AFTER, gap).otherwise(F.concat(gap, F.array_join(near, "")))
        return F.substring(text, 1, AFTER)

    both = F.transform(m, lambda x, i: F.array(F.length(F.get(s, i)), F.length(x)))
    df = df.withColumn(sizes, F.when(F.col(s).isNotNull(), F.flatten(both)))
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))
    added = F.transform(blocks, lambda b: total(F.slice(sizes, b * BLOCK + 1, BLOCK)))
    df = df.withColumn(sums, F.when(F.col(sizes).isNotNull(), added))
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    found = F.when(F.col(sizes).isNotNull(), F.transform(m, place))
    return df.withColumn(name, F.coalesce(found, F.array().cast(kind))).drop(m, s, sizes, sums)


def around(x: Column) -> list[Column]:
    """Patterns of an occurrence: the word before, two words before, the words around."""
    shape = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    words = F.split(F.trim(F.regexp_replace(shape(x["before"]), r"\s+", " ")), " ")
    one = F.element_at(words, -1)
    two = F.coalesce(F.get(words, F.size(words) - 2), F.lit(""))
    after = F.regexp_extract(shape(x["after"]), r"^\s*(\S+)", 1)
    return [
        F.when(one != "", F.concat(F.lit("1 "), one)),
        F.when((one != "") & (two != ""), F.concat(F.lit("2 "), two, F.lit(" "), one)),
        F.when((one != "") & (after != ""), F.concat(F.lit("3 "), one, F.lit(" _ "), after)),
    ]


def occurrences(docs: DataFrame) -> DataFrame:
    """(key, doc_id, base, seen): base spans, and all instances with their patterns."""
    rows = pick(docs, "doc_id", "text").select(
        row_key().alias("key"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]"))
    at, plus = F.contains("text", F.lit("@")), F.contains("text", F.lit("+"))
    when = {
        "email": at,
        "ip": F.col("digit"),
        "card": F.col("digit"),
        "phone": plus & F.col("digit"),
        "token": F.col("digit") | at,
    }
    found = located(rows, "text", PATTERNS | {"token": TOKEN}, when)
    found = found.select(
        "key", "doc_id", "token",
        *[checked(k).alias(k) for k in KINDS],
    )

    def seed(kind: str) -> Column:
        return F.transform(
            kind,
            lambda x: F.struct(
                x["start"],
                F.lit(KINDS.index(kind)).alias("rank"),
                x["end"],
                F.lower(x["value"]).alias("value"),
                F.array_compact(F.array(*around(x))).alias("patterns"),
            ),
        )

    found = found.withColumn("base", F.array_sort(F.concat(*[seed(k) for k in KINDS])))

    def bare(x: Column) -> Column:
        left = F.regexp_replace(x["value"], r"^[^\p{L}0-9@+]+", "")
        core = F.regexp_replace(left, r"[^\p{L}0-9]+$", "")
        start = x["start"] + F.length(x["value"]) - F.length(left)
        return F.struct(
            start.alias("start"),
            F.lit(-1).alias("rank"),
            (start + F.length(core)).alias("end"),
            F.lower(core).alias("value"),
            F.array_compact(F.array(*around(x))).alias("patterns"),
        )

    found = found.withColumn("token", F.transform("token", bare))
    digits = lambda v: F.length(v) - F.length(F.translate(v, "0123456789", ""))
    like = F.filter(
        "token",
        lambda t: (F.length(t["value"]) >= 5)
        & ((digits(t["value"]) >= 4) | F.contains(t["value"], F.lit("@")))
        & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])),
    )
    return found.select("key", "doc_id", "base", like.alias("other"))


def accepted(edges: DataFrame) -> DataFrame:
    """(value, rank): instances that the pattern graph makes known, beyond the seeds.

    ``edges(pattern, value, rank)`` are distinct per pattern and value; rank -1: unknown.
    """
    seeds = edges.filter("rank >= 0").select("value", "rank").distinct()
    known = seeds.withColumn("fresh", F.lit(False))
    while True:  # every round but the last makes one more of the values known
        graph = edges.select("pattern", "value").join(
            known.groupBy("value").agg(F.min("rank").alias("rank")), "value", "left"
        )
        shares = [F.count(F.when(F.col("rank") == r, 1)).alias(f"n{r}") for r in range(len(KINDS))]
        best = F.greatest(*[f"n{r}" for r in range(len(KINDS))])
        which = reduce(
            lambda rest, r: F.when(F.col(f"n{r}") == F.col("known"), r).otherwise(rest),
            reversed(range(len(KINDS))),
            F.lit(None).cast("int"),
        )
        good = (
            graph.groupBy("pattern")
            .agg(F.count("*").alias("n"), *shares)
            .withColumn("known", best)
            .withColumn("conf", F.col("known") / F.col("n"))
            .filter((F.col("known") >= SUPPORT) & (F.col("conf") >= CONFIDENT))
            .select("pattern", "conf", which.alias("kind"))
        )
        # Smoothed, so that a pattern never counts as certain.
        doubt = F.log(1 - F.col("conf") * 0.99)
        votes = (
            graph.filter("rank IS NULL")
            .select("pattern", "value")
            .join(good, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(doubt))).alias("score"))
            .groupBy("value")
            .agg(F.max(F.struct("score", -F.col("kind"))).alias("top"))
            .filter(F.col("top.score") >= ACCEPT)
            .select("value", (-F.col("top.col2")).cast("int").alias("rank"))
        )
        found = stage(votes, "pii-found")
        if found.isEmpty():
            return known.filter("fresh").select("value", "rank")
        known = stage(known.unionByName(found.withColumn("fresh", F.lit(True))), "pii-known")


def personal_data(docs: DataFrame) -> DataFrame:
    """(key, doc_id, base, spans): arrays of (start, rank, end) ordered by start and kind."""
    rows = stage(occurrences(docs), "pii-rows")
    seen = rows.select(F.explode(F.concat("base", "other")).alias("x"))
    pairs = seen.select(F.explode("x.patterns").alias("pattern"), "x.value", "x.rank")
    edges = stage(pairs.groupBy("pattern", "value").agg(F.max("rank").alias("rank")), "pii-edges")
    known = accepted(edges)
    other = rows.select("key", F.explode("other").alias("x")).select("key", "x.*")
    more = (
        other.drop("rank", "patterns")
        .join(known, "value")
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "rank", "end")).alias("more"))
    )
    plain = F.transform("base", lambda x: F.struct(x["start"], x["rank"], x["end"]))
    joined = rows.select("key", "doc_id", plain.alias("base")).join(more, "key", "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return joined.select(
        "key",
        "doc_id",
        "base",
        F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"),
    )


def span_string(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"])
    )
    return F.array_join(one, ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars follows."""
    plain = [f"_{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, plain, strict=False))
    found = personal_data(docs).filter(F.size("spans") > 0)
    found = found.groupBy("key").agg(F.first("spans").alias("_spans"))  # equal for equal keys
    keyed = docs.toDF(*plain).withColumn("key", row_key(names["doc_id"], names["text"]))
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col(names["text"])

    def put(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        tag = F.when(x["start"] >= s["at"], F.get(tags, x["rank"])).otherwise("")
        return F.struct(
            F.concat(s["out"], gap, tag).alias("out"), F.greatest(s["at"], x["end"]).alias("at")
        )

    clean = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        put,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    done = keyed.join(found, "key", "left").withColumn(
        names["text"], F.when(F.col("_spans").isNull(), text).otherwise(clean)
    )
    if "n_chars" in names:
        size = F.length(names["text"]).cast(docs.schema["n_chars"].dataType)
        done = done.withColumn(
            names["n_chars"], F.when(F.col("_spans").isNull(), F.col(names["n_chars"])).otherwise(size)
        )
    return done.select(*plain).toDF(*docs.columns)
