from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from cellarium.model import CELL_SCHEMA
from cellarium.plans.skew import BROADCAST_ROWS_SETTING, HOT_ROWS_SETTING, tune


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("cellarium-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    return session


@pytest.fixture(params=["ordinary", "hot"])
def skewed(spark, request):
    """Runs a test twice; the second time keys of more than five rows count as hot
    and nothing is broadcast by measured size."""
    if request.param == "hot":
        spark.conf.set(HOT_ROWS_SETTING, "5")
        spark.conf.set(BROADCAST_ROWS_SETTING, "0")
    yield spark
    spark.conf.unset(HOT_ROWS_SETTING)
    spark.conf.unset(BROADCAST_ROWS_SETTING)


def b(value):
    return value.encode() if isinstance(value, str) else value


@pytest.fixture(scope="session")
def make_cells(spark):
    def make(rows):
        data = [(b(r), f, b(q), ts, b(v)) for r, f, q, ts, v in rows]
        return spark.createDataFrame(data, CELL_SCHEMA)

    return make


@pytest.fixture(scope="session")
def make_log(spark):
    """Mutations as dicts; unnamed fields are null."""
    names = ["row", "family", "qualifier", "ts", "value", "seq", "op", "amount"]
    schema = (
        "row binary, family string, qualifier binary, ts bigint, value binary, "
        "seq bigint, op string, amount bigint"
    )

    def make(mutations):
        rows = []
        for m in mutations:
            row = [m.get(n) for n in names]
            rows.append([b(x) if n in ("row", "qualifier", "value") else x
                         for n, x in zip(names, row, strict=True)])
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def listed():
    """Cells of a DataFrame as sorted plain tuples."""

    def read(df):
        rows = df.select("row", "family", "qualifier", "ts", "value").collect()
        return sorted(
            (bytes(r[0]).decode("latin1"), r[1], bytes(r[2]).decode("latin1"), r[3],
             None if r[4] is None else bytes(r[4]).decode("latin1"))
            for r in rows
        )

    return read
