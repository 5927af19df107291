"""Forecast error aggregates; each is NULL when no row qualifies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(actual: Column, forecast: Column) -> Column:
    return F.avg(F.abs(actual - forecast))


def rmse(actual: Column, forecast: Column) -> Column:
    return F.sqrt(F.avg((actual - forecast) * (actual - forecast)))


def mape(actual: Column, forecast: Column) -> Column:
    return F.avg(F.when(actual != 0, F.abs((actual - forecast) / actual))) * 100


def smape(actual: Column, forecast: Column) -> Column:
    scale = F.abs(actual) + F.abs(forecast)
    return F.avg(F.when(scale > 0, F.lit(2.0) * F.abs(actual - forecast) / scale)) * 100
