"""User-defined per-series models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weekloom.spec import DEFAULT, FORECAST_WEEKS, PanelSpec


class SeriesModel(Protocol):
    """What a user model must offer; one object is made per series, on the executor.

    ``dump`` and a ``load`` that reads it back are needed to store models only,
    ``predict_insample`` (a value per row of the history it is given) to diagnose them.
    """

    def fit(self, history: pd.DataFrame) -> SeriesModel: ...

    def predict(self, horizon: int) -> list[float]: ...

    def predict_insample(self, history: pd.DataFrame) -> list[float | None]: ...

    def dump(self) -> bytes: ...


Loader = Callable[[bytes], SeriesModel]


def key_fields(df: DataFrame, spec: PanelSpec) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in spec.keys]


def fit_each(
    history: DataFrame,
    make_model: Callable[[], SeriesModel],
    name: str,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """(keys, model, state_bytes, last time, n_train, error): one stored model per series.

    The table is the model: it is written and read like any other, and grows with the
    number of series only. A series that fails keeps its row with the error and no state.
    """
    keys, time, target = list(spec.keys), spec.time, spec.target
    schema = T.StructType(
        key_fields(history, spec)
        + [
            T.StructField("model", T.StringType()),
            T.StructField("state_bytes", T.BinaryType()),
            T.StructField(time, history.schema[time].dataType),
            T.StructField("n_train", T.LongType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def one_series(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(time).reset_index(drop=True)
        state, error = None, None
        try:
            state = make_model().fit(rows[[time, target]]).dump()
        except Exception as failure:  # one bad series must not end the run
            error = repr(failure)
        out = {k: rows[k].iloc[0] for k in keys}
        last = {time: rows[time].iloc[-1], "n_train": len(rows)}
        return pd.DataFrame([{**out, "model": name, "state_bytes": state, **last, "error": error}])

    return history.select(*spec.columns).groupBy(*keys).applyInPandas(one_series, schema)


def save_models(models: DataFrame, path: str) -> None:
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def predict_each(
    models: DataFrame, load: Loader, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """(keys, time, model, forecast, error) from stored models: a pass without a shuffle."""
    keys, time = list(spec.keys), spec.time
    schema = T.StructType(
        key_fields(models, spec)
        + [
            T.StructField(time, models.schema[time].dataType),
            T.StructField("model", T.StringType()),
            T.StructField("forecast", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                head = {k: row[k] for k in keys} | {"model": row["model"]}
                try:
                    if row["error"] is not None:
                        raise ValueError(row["error"])
                    values = [float(v) for v in load(bytes(row["state_bytes"])).predict(horizon)]
                    last = pd.Timestamp(row[time])
                    out += [
                        {**head, time: (last + pd.Timedelta(weeks=i)).date(), "forecast": v, "error": None}
                        for i, v in enumerate(values, 1)
                    ]
                except Exception as failure:
                    out.append({**head, time: None, "forecast": None, "error": repr(failure)})
            yield pd.DataFrame(out, columns=schema.names)

    return models.mapInPandas(run, schema)


def insample_each(
    models: DataFrame, history: DataFrame, load: Loader, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """(keys, time, model, fitted, error): stored models beside the histories they belong to.

    Models and histories meet by a cogroup on the keys. A model without a history gives no
    row; a history without a model, with one that failed, or one that offers no in-sample
    values gives a single row with the reason.
    """
    keys, time, target = list(spec.keys), spec.time, spec.target
    schema = T.StructType(
        key_fields(history, spec)
        + [
            T.StructField(time, history.schema[time].dataType),
            T.StructField("model", T.StringType()),
            T.StructField("fitted", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def one_series(stored: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(time).reset_index(drop=True)
        out = []
        records = stored.to_dict("records") or [{"model": None, "error": "no stored model"}]
        for row in records if len(rows) else []:
            head = {k: rows[k].iloc[0] for k in keys} | {"model": row["model"]}
            try:
                if row["error"] is not None:
                    raise ValueError(row["error"])
                values = load(bytes(row["state_bytes"])).predict_insample(rows[[time, target]])
                if values is None or len(values) != len(rows):
                    raise ValueError("no in-sample value for every row")
                out += [
                    {**head, time: day, "fitted": None if v is None else float(v), "error": None}
                    for day, v in zip(rows[time], values, strict=True)
                ]
            except Exception as failure:
                out.append({**head, time: None, "fitted": None, "error": repr(failure)})
        return pd.DataFrame(out, columns=schema.names)

    left = models.select(*keys, "model", "state_bytes", "error").groupBy(*keys)
    right = history.select(*spec.columns).groupBy(*keys)
    return left.cogroup(right).applyInPandas(one_series, schema)


def fit_predict_each(
    history: DataFrame,
    make_model: Callable[[], SeriesModel],
    name: str,
    horizon: int = FORECAST_WEEKS,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """(keys, time, model, forecast, error): every series fitted on its own.

    Only for models Spark cannot express: it costs a Python worker. A group is one
    weekly series, whose length the calendar bounds. A series that fails yields one
    row with its error and never stops the others.
    """
    keys, time, target = list(spec.keys), spec.time, spec.target
    types = {f.name: f.dataType for f in history.schema.fields}
    schema = T.StructType(
        [T.StructField(k, types[k]) for k in keys]
        + [
            T.StructField(time, types[time]),
            T.StructField("model", T.StringType()),
            T.StructField("forecast", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def one_series(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(time).reset_index(drop=True)
        out = {k: rows[k].iloc[0] for k in keys}
        try:
            values = [float(v) for v in make_model().fit(rows[[time, target]]).predict(horizon)]
            last = pd.Timestamp(rows[time].iloc[-1])
            days = [(last + pd.Timedelta(weeks=i + 1)).date() for i in range(len(values))]
            out.update({time: days, "model": name, "forecast": values, "error": None})
            frame = pd.DataFrame(out)
        except Exception as failure:  # one bad series must not end the run
            out.update({time: [None], "model": name, "forecast": [None], "error": repr(failure)})
            frame = pd.DataFrame(out)
        return frame[[*keys, time, "model", "forecast", "error"]]

    return history.select(*spec.columns).groupBy(*keys).applyInPandas(one_series, schema)
