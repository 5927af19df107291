"""Names of the columns that make a table a panel, and the fixed run settings."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Window, WindowSpec

# The weekly run settings every result depends on.
LAGS = (1, 7, 30, 52)
ROLLING_WINDOWS = (4, 8, 13)
SEASON = 52
SEQUENCE_LENGTH = 12
FORECAST_WEEKS = 8
BACKTEST_FOLDS = 3
BACKTEST_WEEKS = 13
ENSEMBLE_RATIO = 1.5
SMAPE_FLOOR = 0.01
MIN_TRAIN_ROWS = 20


@dataclass(frozen=True)
class PanelSpec:
    """A panel has one row per (keys, time); every operator takes its names from here.

    After ``weekly_mean`` a series holds at most one row per calendar week, so a
    window over ``keys`` is bounded by the length of the calendar (about 52 rows a
    year) however many raw records a key had. That bound is what makes the
    per-series windows in this package safe for hot keys.
    """

    keys: tuple[str, ...] = ("state",)
    time: str = "date"
    target: str = "sales"

    @property
    def cell(self) -> list[str]:
        return [*self.keys, self.time]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.time, self.target]

    def series(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.time)

    def whole_series(self) -> WindowSpec:
        """The full series as a frame; shares partitioning and sort with ``series``."""
        return self.series().rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )

    def with_key(self, name: str) -> PanelSpec:
        return replace(self, keys=(*self.keys, name))


DEFAULT = PanelSpec()
