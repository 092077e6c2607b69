"""The Spark session of the tests and the comparison with DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def build_session(cores: int = 8) -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tesselar")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted_rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.select_dtypes("datetime").columns:
        frame[name] = frame[name].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def assert_same_rows(actual: DataFrame, expected: pd.DataFrame) -> None:
    left, right = _sorted_rows(actual.toPandas()), _sorted_rows(expected)
    assert list(left.columns) == list(right.columns)
    assert len(left) == len(right)
    for name in left.columns:
        assert left[name].dtype == right[name].dtype, name
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=1e-9, atol=1e-9)
