"""Pooled boosted trees over all series."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.arrays import bound, push
from weekloom.models import state as recursion
from weekloom.models import treetable
from weekloom.operators.encode import encode_keys
from weekloom.operators.features import TREE_FEATURES, complete_cases
from weekloom.operators.horizon import weeks_after
from weekloom.sources.staging import stage
from weekloom.spec import DEFAULT, FORECAST_WEEKS, PanelSpec

NAME = "gbt"

# Learning parameters.
DEFAULT_PARAMS = {
    "maxIter": 100,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 10,
    "seed": 42,
}


class PooledTrees:
    """One gradient-boosted model for every series, with the series code as a feature.

    Rows stay distributed throughout: codes are a table, training rows are a persisted
    DataFrame, and prediction for all series at once is a projection. The trees are a table
    of nodes, too: recursion walks it inside one expression, importances are sums over it,
    and a model without the library's own object predicts from it.
    """

    def __init__(self, spec: PanelSpec = DEFAULT, **params):
        self.spec = spec
        self.params = {**DEFAULT_PARAMS, **params}
        self.model: GBTRegressionModel | None = None
        self.codes: DataFrame | None = None
        self.nodes: DataFrame | None = None

    @classmethod
    def of_nodes(cls, nodes: DataFrame, codes: DataFrame, spec: PanelSpec = DEFAULT) -> PooledTrees:
        """A model that is nothing but its tables."""
        out = cls(spec)
        out.nodes, out.codes = nodes, codes
        return out

    def _coded(self, df: DataFrame) -> DataFrame:
        return df.join(self.codes, list(self.spec.keys))

    @staticmethod
    def _array(columns: dict[str, Column] | None = None) -> Column:
        values = {c: F.col(c) for c in TREE_FEATURES} if columns is None else columns
        return F.array(*[values[c].cast("double") for c in TREE_FEATURES])

    def _vector(self) -> Column:
        return array_to_vector(self._array())

    def _walked(self) -> Column:
        ensemble = treetable.packed(self.nodes, TREE_FEATURES)
        return bound(ensemble, lambda e: treetable.walk(self._array(), e))

    def fit(self, featured: DataFrame) -> PooledTrees:
        """Fit on a feature panel with a ``split`` column; val rows stop the boosting."""
        train = featured.filter(F.col("split") == "train")
        self.codes = stage(encode_keys(train, self.spec.keys), "codes")
        both = featured.filter(F.col("split").isin("train", "val"))
        rows = complete_cases(self._coded(both), TREE_FEATURES)
        rows = rows.select(
            self._vector().alias("features"),
            F.col(self.spec.target).cast("double").alias("label"),
            (F.col("split") == "val").alias("is_val"),
        )
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.model = GBTRegressor(
                featuresCol="features",
                labelCol="label",
                validationIndicatorCol="is_val",
                **self.params,
            ).fit(rows)
        finally:
            rows.unpersist()
        self.nodes = treetable.node_table(self.model, TREE_FEATURES)
        return self

    def predict_onestep(self, featured: DataFrame) -> DataFrame:
        """Predictions for rows whose features exist already."""
        rows = complete_cases(self._coded(featured), TREE_FEATURES)
        if self.model is None:
            scored = rows.withColumn("prediction", self._walked())
        else:
            scored = self.model.transform(rows.withColumn("features", self._vector()))
        return scored.select(
            *self.spec.cell, F.lit(NAME).alias("model"), F.col("prediction").alias("forecast")
        )

    def predict_recursive(
        self, panel: DataFrame, horizon: int = FORECAST_WEEKS, origin: Column | None = None
    ) -> DataFrame:
        """``horizon`` weeks ahead for all series, each step fed by the one before.

        The whole recursion is one fold expression per series: a step walks the node table
        on the features it has just built. No loop over jobs, no shuffle between steps.
        """
        spec = self.spec
        state = self._coded(recursion.history_state(panel, spec, origin))

        def advance(acc: Column, step: Column, ensemble: Column) -> Column:
            row = recursion.next_features(
                acc["hist"],
                acc["total"],
                acc["n"],
                weeks_after(F.col("last_date"), step),
                F.col("origin"),
            )
            x = self._array({**row, "state_encoded": F.col("state_encoded")})
            return bound(
                treetable.walk(x, ensemble),
                lambda value: F.struct(
                    push(acc["hist"], value, recursion.HISTORY).alias("hist"),
                    (acc["total"] + value).alias("total"),
                    (acc["n"] + 1).alias("n"),
                    F.concat(acc["path"], F.array(value)).alias("path"),
                ),
            )

        start = F.struct(
            F.col("hist").alias("hist"),
            F.col("hist_sum").alias("total"),
            F.col("hist_count").alias("n"),
            F.array().cast("array<double>").alias("path"),
        )
        steps = F.sequence(F.lit(1), F.lit(horizon))
        path = bound(
            treetable.packed(self.nodes, TREE_FEATURES),
            lambda ensemble: F.aggregate(
                steps, start, lambda acc, k: advance(acc, k, ensemble), lambda acc: acc["path"]
            ),
        )
        return recursion.unroll(state.select(*spec.keys, "last_date", path.alias("path")), NAME, spec)

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), most important first."""
        shares = treetable.importance(self.nodes, TREE_FEATURES)
        return shares.orderBy(F.col("importance").desc(), "feature")

    def save(self, path: str) -> None:
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: PanelSpec = DEFAULT) -> PooledTrees:
        nodes, codes = (spark.read.parquet(f"{path}/{name}") for name in ("nodes", "codes"))
        return cls.of_nodes(nodes, codes, spec)
