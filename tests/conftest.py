import math
import os
import random
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekloom.sources.staging import drop_staged  # noqa: E402

PANEL_SCHEMA = "state string, date date, sales double"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("weekloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staged")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()


def series(start, weeks, base, seed, amplitude=100.0, noise=20.0):
    rng = random.Random(seed)
    first = date.fromisoformat(start)
    return [
        (
            first + timedelta(weeks=i),
            max(base + amplitude * math.sin(2 * math.pi * i / 52) + rng.gauss(0, noise), 1.0),
        )
        for i in range(weeks)
    ]


def panel_rows(start="2019-01-05", weeks=120, bases=None):
    bases = bases or {"StateA": 500.0, "StateB": 300.0}
    out = []
    for k, (state, base) in enumerate(bases.items()):
        out += [(state, d, v) for d, v in series(start, weeks, base, 42 + k, 50.0, 10.0)]
    return out


@pytest.fixture(scope="session")
def tiny_rows():
    return panel_rows()


@pytest.fixture(scope="session")
def tiny_panel(spark, tiny_rows):
    df = spark.createDataFrame(tiny_rows, PANEL_SCHEMA).cache()
    df.count()
    return df
