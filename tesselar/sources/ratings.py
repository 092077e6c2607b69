"""Rating files, the ``::``-separated rating data set, block files, line counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.sources.lines import numbered_lines

MOVIELENS_SCHEMAS = {
    "ratings": "user_id LONG, movie_id LONG, rating DOUBLE, seconds LONG",
    "users": "user_id LONG, gender STRING, age INT, occupation INT, zip_code STRING",
    "movies": "movie_id LONG, title STRING, genre_list STRING",
}


#: What may stand for a number: no type letters, no hexadecimal digits.
NUMBER = {
    "long": r"\A\s*[+-]?\d+\s*\z",
    "double": r"(?i)\A\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)\s*\z",
}


def _required(tokens: Column, position: int, kind: str) -> Column:
    token = F.get(tokens, F.lit(position))
    parsed = F.when(token.rlike(NUMBER[kind]), token.try_cast(kind))
    problem = F.concat(F.lit("not a rating line: "), F.col("line"))
    return F.coalesce(parsed, F.raise_error(problem).cast(kind))


def parse_ratings(lines: DataFrame, *kept: str) -> DataFrame:
    """``i,j,r[,...]`` lines to rows, with the columns ``kept``. Further tokens are ignored; a bad or blank line raises."""
    # A limit of 4 leaves everything after the third comma unsplit.
    tokens = F.split(F.col("line"), ",", 4)
    return lines.select(
        _required(tokens, 0, "long").alias("i"),
        _required(tokens, 1, "long").alias("j"),
        _required(tokens, 2, "double").alias("r"),
        *kept,
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return parse_ratings(spark.read.text(path).withColumnRenamed("value", "line"))


def read_numbered_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The ratings with ``number``, the place of their line in the file, for training in file order."""
    return parse_ratings(numbered_lines(spark, path), "number")


def line_count(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).agg(F.count("*").alias("lines"))


def read_movielens(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of ``ratings``, ``users``, ``movies`` from its ``::``-separated file."""
    raw = spark.read.csv(
        path,
        schema=MOVIELENS_SCHEMAS[table],
        sep="::",
        quote="",
        encoding="ISO-8859-1",
        mode="FAILFAST",
    )
    if table == "ratings":
        return raw.select("user_id", "movie_id", "rating", F.timestamp_seconds("seconds").alias("ts"))
    if table == "movies":
        return raw.select("movie_id", "title", F.split("genre_list", r"\|").alias("genres"))
    return raw


def write_blocks(blocked: DataFrame, path: str) -> None:
    """One folder per (row block, column block). The rebalance splits large blocks over files."""
    blocked.hint("rebalance", "rb", "cb").write.partitionBy("rb", "cb").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    schema = "i LONG, j LONG, r DOUBLE, rb INT, cb INT"
    return spark.read.schema(schema).parquet(path)
