"""Chunked running totals against pandas, with one key that holds most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tesselar.operators import skew
from tesselar.operators.folds import chunks_for
from tesselar.operators.ordered import CHUNK, chunk, finish, key_totals, running, trailing
from tesselar.operators.skew import PARTS, ROWS_PER_TASK, find_hot_keys, rows_of_part, skew_join


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n))
    return pd.DataFrame({"key": key, "seq": rng.permutation(n), "v": rng.integers(-5, 6, n)})


@pytest.mark.parametrize("rows_per_chunk", [50, 400, 10_000])
def test_running_and_totals(spark, frame, rows_per_chunk):
    chunked = chunk(spark.createDataFrame(frame), ["key"], ["seq"], rows_per_chunk)
    assert bool(chunked.hot) == (rows_per_chunk < 10_000)
    done = running(chunked, sums={"total": F.col("v")}, maxima={"top": F.when(F.col("v") < 4, F.col("v"))})
    done = running(done, maxima={"peak": F.col("total")})
    done = key_totals(done, sums={"whole": F.col("v")}, minima={"least": F.col("total")})
    result = finish(done).toPandas().sort_values("seq").reset_index(drop=True)
    expected = frame.sort_values("seq").reset_index(drop=True)
    by_key = expected.groupby("key")
    total = by_key["v"].cumsum()
    assert (result["total"] == total).all()
    top = expected["v"].where(expected["v"] < 4).groupby(expected["key"]).cummax()
    top = top.groupby(expected["key"]).ffill()
    pd.testing.assert_series_equal(result["top"], top, check_names=False, check_dtype=False)
    assert (result["peak"] == total.groupby(expected["key"]).cummax()).all()
    assert (result["whole"] == by_key["v"].transform("sum")).all()
    assert (result["least"] == total.groupby(expected["key"]).transform("min")).all()


@pytest.mark.parametrize("n", [1, 3, 7])
@pytest.mark.parametrize("rows_per_chunk", [5, 50, 10_000])
def test_trailing(spark, frame, n, rows_per_chunk):
    small = frame.head(600)
    chunked = chunk(spark.createDataFrame(small), ["key"], ["seq"], rows_per_chunk)
    result = finish(trailing(chunked, F.col("v"), n, "latest")).toPandas().sort_values("seq")
    seen = {}
    for row in result.itertuples():
        values = seen.setdefault(row.key, [])
        values.append(row.v)
        assert list(row.latest) == values[-n:]


def test_no_chunk_holds_a_hot_key(spark, frame):
    chunked = chunk(spark.createDataFrame(frame), ["key"], ["seq"], 100)
    sizes = chunked.df.groupBy("key", CHUNK).count().toPandas()
    assert sizes["count"].max() <= 200
    assert chunked.df.count() == len(frame)


def test_timestamps_order_chunks(spark):
    df = spark.range(500).select(
        F.lit("a").alias("key"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts")
    )
    counted = running(chunk(df, ["key"], ["ts"], 50), sums={"n": F.lit(1)})
    rows = finish(counted).orderBy("ts").select("n").toPandas()
    assert rows["n"].tolist() == list(range(1, 501))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [20, 10_000])
def test_skew_join(spark, frame, how, rows_per_task):
    lookup = pd.DataFrame({"key": range(0, 40, 2), "name": [f"n{k}" for k in range(0, 40, 2)]})
    facts = spark.createDataFrame(frame)
    joined = skew_join(
        facts, spark.createDataFrame(lookup), ["key"], ["seq"], how, rows_per_task
    ).toPandas()
    expected = frame.merge(lookup, on="key", how=how)
    order = ["seq"]
    joined["name"] = joined["name"].astype(object).where(joined["name"].notna(), None)
    expected["name"] = expected["name"].astype(object).where(expected["name"].notna(), None)
    pd.testing.assert_frame_equal(
        joined[["key", "seq", "v", "name"]].sort_values(order).reset_index(drop=True),
        expected.sort_values(order).reset_index(drop=True),
    )


def test_hot_keys_are_the_large_ones(spark, frame):
    hot = find_hot_keys(spark.createDataFrame(frame), ["key"], 200)
    assert [row["key"] for row in hot.table.collect()] == [0]
    assert hot.rows == (frame["key"] == 0).sum()


ODD = [(key, order, value) for key in ("a", None) for order, value in zip("bbbbbacdefgh", [1.0, 2.0, None, 4.0, 5.0, 6.0, None, 8.0, 9.0, 10.0, None, 12.0])]


@pytest.mark.parametrize("rows_per_chunk", [2, 5])
def test_hot_path_equals_plain_path(spark, rows_per_chunk):
    """Null keys, text orders, ties on the first order column and null values."""
    rows = [(key, order, at, value) for at, (key, order, value) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "key STRING, o STRING, at LONG, v DOUBLE")

    def result(size):
        done = running(chunk(df, ["key"], ["o", "at"], size), sums={"n": F.lit(1).cast("long")})
        done = key_totals(trailing(done, F.col("v"), 3, "latest"), sums={"whole": F.col("n")})
        return {row["at"]: row.asDict() for row in finish(done).collect()}

    assert result(rows_per_chunk) == result(1000)
    parts = chunk(df, ["key"], ["o", "at"], rows_per_chunk).df.groupBy("key", CHUNK).count()
    assert parts.agg(F.max("count")).first()[0] <= 2 * rows_per_chunk + 1


def test_folds_of_many_rows_get_larger_chunks_not_more(spark):
    """Spark stores at most 100,000 buckets; a bucket costs a task and a file."""
    assert chunks_for(spark, 6_000_000, 50) == PARTS
    assert chunks_for(spark, 2000, 50) == 40
    assert chunks_for(spark, 100 * PARTS * ROWS_PER_TASK, 50) == 100 * PARTS
    assert rows_of_part(10**12, 50, 500_000) == 500_000


def test_chunks_of_many_rows(spark, frame):
    """A range costs a task, a file and a share of the sample that the driver takes."""
    chunked = chunk(spark.createDataFrame(frame), ["key"], ["seq"], 2)
    assert 100 < chunked.hot_rows().agg(F.max(CHUNK)).first()[0] <= PARTS
    total = finish(running(chunked, sums={"n": F.lit(1)})).toPandas().sort_values("seq")
    assert (total["n"] == total.groupby("key").cumcount() + 1).all()


def test_parts_of_many_facts(spark, frame, monkeypatch):
    seen, parts = [], skew._parts
    monkeypatch.setattr(skew, "_parts", lambda rows: seen.append(rows) or parts(rows))
    lookup = spark.range(40).select(F.col("id").alias("key"), F.col("id").alias("name"))
    assert skew_join(spark.createDataFrame(frame), lookup, ["key"], ["seq"], "inner", 1).count() == len(frame)
    assert seen == [-(-len(frame) // PARTS)]
