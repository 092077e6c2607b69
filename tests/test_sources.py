"""Readers and writers on small hand-written files."""

import pytest
from pyspark.sql import functions as F

from tesselar.operators.factors import init_factors, observed_ids
from tesselar.operators.grid import assign_blocks
from tesselar.sources.factors import read_factors_csv, write_factors_csv
from tesselar.sources.logs import explode_log
from tesselar.sources.ratings import (
    line_count,
    read_blocks,
    read_movielens,
    parse_ratings,
    read_ratings,
    write_blocks,
)


def test_ratings_ignore_further_tokens(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("1,2,3.5\n0,7,4,978300760,more\n 5, 6, 1e0\n")
    rows = read_ratings(spark, str(path)).orderBy("i").collect()
    assert [tuple(row) for row in rows] == [(0, 7, 4.0), (1, 2, 3.5), (5, 6, 1.0)]
    assert line_count(spark, str(path)).first()["lines"] == 3


@pytest.mark.parametrize("bad", ["", "1,2", "a,2,3", "1,2,"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_rating_lines_raise(spark, tmp_path, bad, ansi):
    path = tmp_path / "ratings.csv"
    path.write_text(f"1,2,3\n{bad}\n4,5,6\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a rating line"):
            read_ratings(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_movielens_files(spark, tmp_path):
    (tmp_path / "ratings.dat").write_text("1::1193::5::978300760\n")
    (tmp_path / "users.dat").write_text("1::F::1::10::48067\n2::M::56::16::02460-1234\n")
    (tmp_path / "movies.dat").write_bytes(
        'Xy"z'.join(["1::Toy ", " (1995)::Animation|Children's|Comedy\n"]).encode("latin-1")
        + "73::Misérables, Les (1995)::Drama\n".encode("latin-1")
    )
    rating = read_movielens(spark, str(tmp_path / "ratings.dat"), "ratings").select(
        "user_id", "movie_id", "rating", F.unix_seconds("ts")
    )
    assert tuple(rating.first()) == (1, 1193, 5.0, 978300760)
    users = read_movielens(spark, str(tmp_path / "users.dat"), "users").orderBy("user_id").collect()
    assert [tuple(row) for row in users] == [(1, "F", 1, 10, "48067"), (2, "M", 56, 16, "02460-1234")]
    movies = read_movielens(spark, str(tmp_path / "movies.dat"), "movies").orderBy("movie_id").collect()
    assert tuple(movies[0]) == (1, 'Toy Xy"z (1995)', ["Animation", "Children's", "Comedy"])
    assert tuple(movies[1]) == (73, "Misérables, Les (1995)", ["Drama"])


@pytest.mark.parametrize("single_file", [True, False])
def test_factor_files_keep_positions_over_splits(spark, tmp_path, single_file):
    ids = spark.range(500).select(F.lit("W").alias("role"), "id")
    factors = init_factors(ids, 3, 1)
    path = str(tmp_path / "factors")
    write_factors_csv(factors, path, "W", single_file)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = {row["id"]: row["vec"] for row in read_factors_csv(spark, path, "W").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert read == {row["id"]: row["vec"] for row in factors.collect()}


def test_blocks_read_back(spark, tmp_path):
    rows = [(i % 13, i % 7, float(i % 5)) for i in range(300)]
    blocked = assign_blocks(spark.createDataFrame(rows, "i LONG, j LONG, r DOUBLE"), 3).drop("s")
    path = str(tmp_path / "blocks")
    write_blocks(blocked, path)
    assert sorted(map(tuple, read_blocks(spark, path).collect())) == sorted(map(tuple, blocked.collect()))
    one = read_blocks(spark, path).filter("rb = 1 and cb = 2")
    assert "PartitionFilters: [isnotnull(rb" in one._jdf.queryExecution().toString()


def test_log_lines_up_to_the_last_newline(spark):
    runs = spark.createDataFrame(
        [(1, "a\nb\n"), (2, "a\nlost"), (3, ""), (4, "\n\nx\n")], "run_id LONG, text STRING"
    )
    rows = explode_log(runs).orderBy("run_id", "seq").collect()
    assert [tuple(row) for row in rows] == [
        (1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (4, 0, ""), (4, 1, ""), (4, 2, "x"),
    ]


def test_observed_ids(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 5, 3.0)], "i LONG, j LONG, r DOUBLE")
    found = sorted(map(tuple, observed_ids(df).collect()))
    assert found == [("H", 2), ("H", 5), ("W", 1)]


@pytest.mark.parametrize("line", ["1,2,5d", "1,2,5f", "1,2,0x1p3", "1,2,", "1.0,2,3"])
def test_lines_that_are_no_ratings(spark, line):
    with pytest.raises(Exception, match="not a rating line"):
        parse_ratings(spark.createDataFrame([(line,)], "line STRING")).collect()
