"""URL filters: host rules first, gradient-boosted trees on lexical features for the rest.

A rule is a host and a path, written ``host/path``; it fits the host and its subdomains
where the url's path starts with the rule's, and the longest fitting rule decides. The
urls that rules decide are the labelled ones: at most ``MAX_LABELLED`` of each verdict
(those of the smallest hash) train the trees, every other url is judged by them. The
features are lengths, depth, character shares, entropy, parameter counts and the smoothed
block rate of the host's suffix among the training urls, at most two per training row, so
the table of suffixes that is broadcast has that bound. A training url takes these rates
from the other folds of the training urls: its own verdict is in none of its features.

A null url, and one without ``://``, has an empty host and path, no rule, and is judged by
the trees like any other. Repeated rows each get a row. Where the labelled urls have one
verdict only, it holds for the rest; where there are none, the verdict is allow. An empty
table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import pick
from weekloom.sources.staging import stage

MAX_LABELLED = 5_000
TREES = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.3, "seed": 7}
#: Weight of the overall rate in a suffix's rate, in urls.
PRIOR = 10.0
#: Training urls take suffix rates from the other folds.
FOLDS = 5
FEATURES = [
    "url_chars", "host_chars", "path_chars", "host_labels", "depth", "params", "fragment",
    "digit_share", "host_digits", "hyphens", "other_share", "longest_label", "entropy",
    "secure", "suffix_rate", "wide_suffix_rate",
]


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """``allow com/`` and the like; the path begins at the first slash."""
    rules = []
    for line in lines:
        verdict, place = line.split(None, 1)
        host, slash, rest = place.partition("/")
        if verdict not in ("allow", "block") or not slash or not host:
            raise ValueError(f"not a rule: {line!r}")
        rules.append(Rule(verdict, host.lower(), slash + rest))
    return rules


def parts(url: str) -> tuple[Column, Column]:
    """(host, path) of a url column; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper = "".join(map(chr, range(65, 91)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def decide(rules: list[Rule], what: str) -> Column:
    """The given field of the longest fitting rule, null where none fits."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        host = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        out = F.when(host & F.col("path").startswith(r.path), getattr(r, what)).otherwise(out)
    return out


def lexical(df: DataFrame) -> DataFrame:
    """``df(url, host, path, …)`` with the features that need no statistics."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    count = lambda c, drop: F.length(c) - F.length(F.translate(c, drop, ""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    df = df.withColumn("_chars", F.split(url, ""))
    shares = F.transform(
        F.array_distinct("_chars"),
        lambda c: F.size(F.filter("_chars", lambda x: x == c)) / F.size("_chars"),
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda t, p: t - p * F.log2(p))
    return df.select(
        *[c for c in df.columns if c != "_chars"],
        F.length(url).alias("url_chars"),
        F.length("host").alias("host_chars"),
        F.length("path").alias("path_chars"),
        F.size(labels).alias("host_labels"),
        count("path", "/").alias("depth"),
        F.when(query == "", 0).otherwise(count(query, "&") + 1).alias("params"),
        F.contains(url, F.lit("#")).cast("int").alias("fragment"),
        (count(url, "0123456789") / n).alias("digit_share"),
        count("host", "0123456789").alias("host_digits"),
        count("host", "-").alias("hyphens"),
        (F.length(F.regexp_replace(url, r"[A-Za-z0-9/.:]", "")) / n).alias("other_share"),
        F.array_max(F.transform(labels, lambda x: F.length(x))).alias("longest_label"),
        entropy.alias("entropy"),
        url.startswith("https:").cast("int").alias("secure"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.substring_index("host", ".", -2).alias("wide_suffix"),
    )


def with_rates(df: DataFrame, train: DataFrame, folded: bool = False) -> DataFrame:
    """Adds the block rates of both suffixes in ``train``; unseen ones get the overall rate.

    ``folded`` is for the training urls themselves: the rates of a url come from the other
    folds alone, so that no url meets its own verdict in a feature.
    """
    total = train.agg(F.avg("label").alias("r")).first()["r"]
    for name in ("suffix", "wide_suffix"):
        blocked, n = F.sum("label").alias("blocked"), F.count("*").alias("n")
        rates = train.groupBy(name).agg(blocked, n)  # at most one row for each training url
        if folded:
            own = train.groupBy(name, "fold").agg(F.sum("label").alias("b"), F.count("*").alias("m"))
            rates = own.join(rates, name).select(
                name, "fold", (F.col("blocked") - F.col("b")).alias("blocked"), (F.col("n") - F.col("m")).alias("n")
            )
        rate = (F.col("blocked") + PRIOR * total) / (F.col("n") + PRIOR)
        rates = rates.withColumn(f"{name}_rate", rate).drop("blocked", "n")
        keys = [name, "fold"] if folded else [name]
        df = df.join(F.broadcast(rates), keys, "left").fillna(total, [f"{name}_rate"])
    return df


def judge(pages: DataFrame, rules: list[Rule], most: int = MAX_LABELLED) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, block_score): one row per page."""
    host, path = parts("url")
    rows = pick(pages, "page_id", "url").select(
        "page_id", "url", host.alias("host"), path.alias("path")
    )
    rows = rows.withColumns({"rule": decide(rules, "text"), "ruled": decide(rules, "verdict")})
    known = rows.filter("rule IS NOT NULL").withColumn("h", F.xxhash64("url"))
    samples = [
        known.filter(F.col("ruled") == v).orderBy("h", "url", "page_id").limit(most)
        for v in ("allow", "block")
    ]
    # Bounded and in one fixed order, so that the trees do not depend on partitions.
    train = lexical(samples[0].unionByName(samples[1])).withColumn(
        "label", (F.col("ruled") == "block").cast("double")
    ).withColumn("fold", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)))
    train = stage(train.coalesce(1).sortWithinPartitions("h", "url", "page_id"), "url-labels")
    seen = {r.ruled for r in train.select("ruled").distinct().collect()}
    keep = ["page_id", "url", "host", "path", "rule"]
    if len(seen) < 2:
        only = F.lit(next(iter(seen), "allow"))
        return rows.select(
            *keep, F.coalesce("ruled", only).alias("verdict"), F.lit(None).cast("double").alias("block_score")
        )
    pack = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fitted = stage(
        with_rates(train, train, folded=True).orderBy("h", "url", "page_id").coalesce(1).select("label", *FEATURES),
        "url-train",
    )
    model = GBTClassifier(maxBins=64, **TREES).fit(pack.transform(fitted).select("features", "label"))
    wide = pack.transform(with_rates(lexical(rows), train))
    scored = model.transform(wide)
    return scored.select(
        *keep,
        F.coalesce("ruled", F.when(F.col("prediction") > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.get(vector_to_array("probability"), 1).alias("block_score"),
    )
