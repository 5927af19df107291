"""Tree ensembles as tables of nodes, walked by one array expression.

A row is a node: ``feature`` and ``threshold`` send a row of features to node ``left``
(not above the threshold) or ``right``; a leaf has no feature and a ``value``, the share of
its tree already weighted. The number of rows is bounded by the model's parameters, never
by the data, so an ensemble travels as one constant of the plan and a prediction is a
projection without a shuffle, also for features that an expression has just made.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.arrays import bound
from weekloom.sources.staging import staged_path

NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left int, right int, "
    "value double, gain double, rows long, depth int"
)

ENSEMBLE = "trees array<array<struct<f:int,t:double,l:int,r:int,v:double>>>, steps array<int>"


def node_table(model: GBTRegressionModel, features: list[str]) -> DataFrame:
    """The nodes of fitted boosted trees; ``depth`` bounds the steps to any leaf."""
    spark = SparkSession.active()
    path = staged_path(spark, "trees")
    model.write().save(path)
    named = F.array(*[F.lit(f) for f in features])
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    inner = F.col("n.leftChild") >= 0
    at = F.col("n.split.featureIndex")
    return (
        spark.read.parquet(f"{path}/data")
        .select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
        .select(
            "tree",
            F.col("n.id").alias("node"),
            F.when(inner, F.get(named, at)).alias("feature"),
            F.when(inner, F.get("n.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.when(inner, F.col("n.leftChild")).alias("left"),
            F.when(inner, F.col("n.rightChild")).alias("right"),
            F.when(~inner, F.col("n.prediction") * F.get(weights, F.col("tree"))).alias("value"),
            F.when(inner, F.col("n.gain")).alias("gain"),
            F.col("n.rawCount").alias("rows"),
            F.lit(model.getOrDefault("maxDepth")).alias("depth"),
        )
    )


def packed(nodes: DataFrame, features: list[str]) -> Column:
    """The whole ensemble as one constant of the plan: an array of trees, each of nodes.

    The driver meets the nodes, whose number the model's parameters bound. A leaf points to
    itself, so a walk may take more steps than its tree is deep.
    """
    place = {f: i for i, f in enumerate(features)}
    trees: dict[int, list[list]] = {}
    depth = 0
    for r in nodes.orderBy("tree", "node").collect():
        left, right = (r.node if n is None else n for n in (r.left, r.right))
        row = [place.get(r.feature, 0), r.threshold, left, right, r.value or 0.0]
        trees.setdefault(r.tree, []).append(row)
        depth = max(depth, r.depth)
    fields = ("f", "t", "l", "r", "v")
    whole = {
        "trees": [[dict(zip(fields, n, strict=True)) for n in tree] for tree in trees.values()],
        "steps": list(range(depth)),
    }
    return F.from_json(F.lit(json.dumps(whole)), ENSEMBLE)


def walk(x: Column, ensemble: Column) -> Column:
    """The ensemble's value for the feature array ``x``; both are evaluated once."""

    def leaf(tree: Column, v: Column, steps: Column) -> Column:
        def step(n: Column, _: Column) -> Column:
            return F.get(tree, F.when(F.get(v, n["f"]) <= n["t"], n["l"]).otherwise(n["r"]))

        return F.aggregate(steps, F.get(tree, F.lit(0)), step, lambda n: n["v"])

    return bound(
        x,
        lambda v: F.aggregate(
            ensemble["trees"], F.lit(0.0), lambda total, tree: total + leaf(tree, v, ensemble["steps"])
        ),
    )


def mean_split_trees(
    rows: DataFrame, pairs: list[tuple[str, str]], target: str, rate: float = 0.5
) -> DataFrame:
    """Boosted trees of two levels that split at the means of a pair of features each.

    No search: a tree is one aggregate over ``rows``, its leaves are the mean of what the
    trees before it leave, times ``rate``. A cheap model of any number of rows, and one that
    can be written down in SQL.
    """
    names = list(dict.fromkeys(f for pair in pairs for f in pair))
    means = rows.agg(*[F.avg(f).alias(f) for f in names]).first()
    # Between two thousandths, where neither whole numbers nor money amounts lie.
    cuts = {f: math.floor(means[f] * 1000) / 1000 + 0.0005 for f in names}
    left_over, nodes = F.col(target), []
    for k, (first, second) in enumerate(pairs):
        side = lambda f: (F.col(f) > cuts[f]).cast("int")
        place = side(first) * 2 + side(second)
        found = rows.groupBy(place.alias("leaf")).agg(F.avg(left_over).alias("mean")).collect()
        leaves = {r.leaf: rate * r.mean for r in found}
        value = [leaves.get(i, 0.0) for i in range(4)]
        left_over = left_over - F.get(F.array(*[F.lit(v) for v in value]), place)
        inner = [(0, first, 1, 4), (1, second, 2, 3), (4, second, 5, 6)]
        nodes += [(k, n, f, cuts[f], a, b, None, None, None, 2) for n, f, a, b in inner]
        nodes += [
            (k, n, None, None, None, None, v, None, None, 2)
            for n, v in zip((2, 3, 5, 6), value, strict=True)
        ]
    return rows.sparkSession.createDataFrame(nodes, NODE_SCHEMA)


def importance(nodes: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): shares of the gains, weighted by rows; unused features have 0."""
    every = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    gains = nodes.filter("feature IS NOT NULL").groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("rows")).alias("gain")
    )
    total = gains.agg(F.sum("gain")).scalar()
    share = F.coalesce(F.try_divide("gain", total), F.lit(0.0))
    return every.join(gains, "feature", "left").select("feature", share.alias("importance"))
