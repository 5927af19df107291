"""Lookups over stored results, as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.text import lookup_key
from weekloom.operators.guards import absent, require_tables
from weekloom.operators.selection import winner_counts

TABLES = ("forecasts", "selection", "metrics")


class ForecastStore:
    """Stored forecasts, selection, metrics and an optional leaderboard.

    ``save`` adds the folded key and sorts by it within files, so a lookup's filter is
    an equality on a stored column: it reaches the Parquet scan and skips row groups.
    """

    def __init__(
        self,
        forecasts: DataFrame,
        selection: DataFrame,
        metrics: DataFrame,
        leaderboard: DataFrame | None = None,
        key: str = "state",
    ):
        self.key = key
        self.forecasts = self._keyed(forecasts)
        self.selection = self._keyed(selection)
        self.metrics = self._keyed(metrics)
        self.leaderboard = leaderboard

    def _keyed(self, df: DataFrame) -> DataFrame:
        if "lookup_key" in df.columns:
            return df
        return df.withColumn("lookup_key", lookup_key(F.col(self.key)))

    def save(self, path: str) -> None:
        for name in TABLES:
            table = getattr(self, name).repartitionByRange("lookup_key")
            table = table.sortWithinPartitions("lookup_key")
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        if self.leaderboard is not None:
            self.leaderboard.write.mode("overwrite").parquet(f"{path}/leaderboard")

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str = "state") -> ForecastStore:
        """Open stored tables; all missing required ones are named in one error."""
        require_tables({name: f"{path}/{name}" for name in TABLES}, spark)
        try:
            board = spark.read.parquet(f"{path}/leaderboard")
        except AnalysisException as failure:
            if not absent(failure):
                raise
            board = None
        tables = [spark.read.parquet(f"{path}/{name}") for name in TABLES]
        return cls(*tables, leaderboard=board, key=key)

    def register(self, prefix: str = "") -> None:
        """Offer the tables to SQL as temporary views."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")
        if self.leaderboard is not None:
            self.leaderboard.createOrReplaceTempView(f"{prefix}leaderboard")

    def _one(self, df: DataFrame, state: str) -> DataFrame:
        return df.filter(F.col("lookup_key") == state.strip().lower())

    def require(self, state: str) -> str:
        """The series' key as given, or KeyError where no table of the store has it."""
        for table in (self.forecasts, self.selection):
            if not self._one(table, state).isEmpty():
                return state
        raise KeyError(f"no series {state.strip()!r}")

    def states(self) -> DataFrame:
        return self.forecasts.select(self.key).distinct().orderBy(self.key)

    def forecast(self, state: str) -> DataFrame:
        """The dated forecasts of one series; no rows when the series is unknown.

        ``store.forecast(store.require(name))`` rejects an unknown name instead.
        """
        rows = self._one(self.forecasts, state)
        return rows.select(self.key, "date", "forecast", "model_used").orderBy("date")

    def forecast_response(self, state: str) -> DataFrame:
        """One row: the series, its number of weeks and its ordered forecast points."""
        return self._nested(self._one(self.forecasts, state))

    def all_forecasts(self) -> DataFrame:
        """One row per series with its ordered forecast points."""
        return self._nested(self.forecasts)

    def _nested(self, rows: DataFrame) -> DataFrame:
        points = F.array_sort(F.collect_list(F.struct("date", "forecast", "model_used")))
        return rows.groupBy(self.key).agg(
            F.count(F.lit(1)).alias("horizon_weeks"), points.alias("forecasts")
        )

    def model_info(self, state: str | None = None) -> DataFrame:
        """Selection of one or all series with the metrics of every model nested."""
        chosen, scores = self.selection, self.metrics
        if state is not None:
            chosen, scores = self._one(chosen, state), self._one(scores, state)
        entry = F.struct("model", "mae", "rmse", "smape", "mase")
        nested = scores.groupBy(self.key).agg(
            F.array_sort(F.collect_list(entry)).alias("all_models")
        )
        return chosen.join(nested, self.key, "left").select(
            self.key,
            "best_model",
            "best_smape",
            "best_mae",
            "second_model",
            "ensemble_eligible",
            F.coalesce("all_models", F.array().cast(nested.schema["all_models"].dataType)).alias(
                "all_models"
            ),
        )

    def leaderboard_wins(self) -> DataFrame:
        """The leaderboard with the number of series each model won, 0 when none."""
        wins = winner_counts(self.selection).withColumnRenamed("best_model", "model")
        return self.leaderboard.join(wins, "model", "left").select(
            "model",
            "median_smape",
            "mean_smape",
            "median_mae",
            "median_mase",
            F.coalesce("states_won", F.lit(0)).alias("states_won"),
        )
