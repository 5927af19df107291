"""Pooled linear regression on windows of scaled feature rows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.arrays import dot, push
from weekloom.models import state as recursion
from weekloom.operators.features import SEQUENCE_FEATURES, build_features, complete_cases
from weekloom.operators.horizon import weeks_after
from weekloom.operators.scale import (
    fit_features,
    fit_target,
    unscale_target,
    unscaled,
)
from weekloom.operators.sequence import sequence_windows
from weekloom.sources.staging import stage
from weekloom.spec import DEFAULT, FORECAST_WEEKS, SEQUENCE_LENGTH, PanelSpec

NAME = "seq_linear"


class SequenceRegression:
    """Ridge regression from the last 12 scaled feature rows to the next scaled value.

    The normal equations are one distributed pass over the windows, whatever the
    number of series.
    """

    def __init__(self, spec: PanelSpec = DEFAULT, reg_param: float = 0.001):
        self.spec = spec
        self.reg_param = reg_param
        self.model: LinearRegressionModel | None = None
        self.target_stats: DataFrame | None = None
        self.feature_stats: DataFrame | None = None

    def _windows(self, featured: DataFrame) -> DataFrame:
        windows = sequence_windows(
            featured, self.target_stats, self.feature_stats, spec=self.spec
        )
        return windows.withColumn("features", array_to_vector(F.flatten("seq")))

    def fit(self, featured: DataFrame) -> SequenceRegression:
        """Fit scalers and model on the train rows of a panel with a ``split`` column.

        The normal equations are one pass, but the fit also counts its rows for the
        degrees of freedom; the windows are kept (spilling to disk) for that second read.
        """
        train = featured.filter(F.col("split") == "train")
        self.target_stats = stage(fit_target(train, self.spec), "target-stats")
        self.feature_stats = stage(fit_features(train, SEQUENCE_FEATURES), "feature-stats")
        rows = self._windows(train).select(
            "features", F.col("target_scaled").cast("double").alias("label")
        )
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.model = LinearRegression(
                regParam=self.reg_param, elasticNetParam=0.0, solver="normal"
            ).fit(rows)
        finally:
            rows.unpersist()
        return self

    def predict_onestep(self, featured: DataFrame) -> DataFrame:
        """Predictions for every row preceded by a full window, in original units."""
        scored = self.model.transform(self._windows(featured))
        back = unscale_target(scored, self.target_stats, "prediction", "forecast", self.spec)
        return back.select(*self.spec.cell, F.lit(NAME).alias("model"), "forecast")

    def _scaled_vector(self, columns: dict[str, Column], ranges: Column) -> Column:
        parts = []
        for c in SEQUENCE_FEATURES:
            lo, hi = ranges[c]["lo"], ranges[c]["hi"]
            width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
            parts.append(((columns[c] - lo) / width).cast("float"))
        return F.array(*parts)

    def predict_recursive(
        self, panel: DataFrame, horizon: int = FORECAST_WEEKS, origin: Column | None = None
    ) -> DataFrame:
        """``horizon`` weeks ahead for all series at once.

        The window ends at the last known row and predicts the next value; the feature
        row of that week is then built from the values before it and pushed. A linear
        model is an inner product, so the whole recursion is one fold expression per
        series: no loop over jobs, no shuffle between steps.
        """
        spec, keys = self.spec, list(self.spec.keys)
        ranges = self.feature_stats.select(F.struct(*SEQUENCE_FEATURES).alias("ranges")).scalar()
        featured = build_features(panel.select(*spec.columns), spec, origin)
        recent = F.lead(spec.time, SEQUENCE_LENGTH).over(spec.series()).isNull()
        usable = complete_cases(featured, SEQUENCE_FEATURES).withColumns(
            {"_recent": recent, "_ranges": ranges}
        )
        vector = self._scaled_vector({c: F.col(c) for c in SEQUENCE_FEATURES}, F.col("_ranges"))
        windows = (
            usable.filter("_recent")
            .select(*keys, F.struct(spec.time, vector.alias("v")).alias("_row"))
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
            .filter(F.size("_rows") == SEQUENCE_LENGTH)
            .select(*keys, F.transform("_rows", lambda r: r["v"]).alias("window"))
        )
        state = (
            recursion.history_state(panel, spec, origin)
            .join(windows, keys)
            .join(self.target_stats, keys)
            .withColumn("_ranges", ranges)
        )
        weights = [float(w) for w in self.model.coefficients]
        intercept = F.lit(float(self.model.intercept))

        def advance(acc: Column, step: Column) -> Column:
            scaled = dot(F.flatten(acc["window"]), weights) + intercept
            value = unscaled(scaled, F.col("lo"), F.col("hi"))
            row = recursion.next_features(
                acc["hist"],
                acc["total"],
                acc["n"],
                weeks_after(F.col("last_date"), step),
                F.col("origin"),
            )
            fresh = self._scaled_vector(row, F.col("_ranges"))
            return F.struct(
                push(acc["hist"], value, recursion.HISTORY).alias("hist"),
                (acc["total"] + value).alias("total"),
                (acc["n"] + 1).alias("n"),
                push(acc["window"], fresh, SEQUENCE_LENGTH).alias("window"),
                F.concat(acc["path"], F.array(value)).alias("path"),
            )

        start = F.struct(
            F.col("hist").alias("hist"),
            F.col("hist_sum").alias("total"),
            F.col("hist_count").alias("n"),
            F.col("window").alias("window"),
            F.array().cast("array<double>").alias("path"),
        )
        steps = F.sequence(F.lit(1), F.lit(horizon))
        path = F.aggregate(steps, start, advance, lambda acc: acc["path"])
        return recursion.unroll(state.select(*keys, "last_date", path.alias("path")), NAME, spec)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.target_stats.write.mode("overwrite").parquet(f"{path}/target_stats")
        self.feature_stats.write.mode("overwrite").parquet(f"{path}/feature_stats")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: PanelSpec = DEFAULT) -> SequenceRegression:
        out = cls(spec)
        out.model = LinearRegressionModel.load(f"{path}/model")
        out.target_stats = spark.read.parquet(f"{path}/target_stats")
        out.feature_stats = spark.read.parquet(f"{path}/feature_stats")
        return out
