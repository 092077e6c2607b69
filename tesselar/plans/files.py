"""Training and scoring from text files to text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesselar.operators.evaluate import model_error
from tesselar.operators.factors import dense_ids, init_factors
from tesselar.plans.train import TrainingParams, train_factors
from tesselar.sources.factors import read_factors_csv, write_factors_csv
from tesselar.sources.ratings import read_numbered_ratings, read_ratings
from tesselar.workspace import materialize


def train_files(
    spark: SparkSession, ratings_path: str, w_path: str, h_path: str, params: TrainingParams
) -> DataFrame:
    """Train on a rating file, write both factor files and return the training log.

    Every id from 0 to the largest gets a line, so that a line's position is its id. With ``order=("number",)`` the
    samples of a block are learned in the order of the file.
    """
    in_file_order = "number" in params.order
    ratings = read_numbered_ratings(spark, ratings_path) if in_file_order else read_ratings(spark, ratings_path)
    ratings = materialize(ratings, "ratings")
    start = init_factors(dense_ids(ratings), params.rank, params.seed)
    factors, log = train_factors(ratings, params, start)
    write_factors_csv(factors, w_path, "W")
    write_factors_csv(factors, h_path, "H")
    return log


def score_files(spark: SparkSession, w_path: str, h_path: str, ratings_path: str) -> DataFrame:
    """Squared error, count and RMSE of two factor files on a rating file."""
    factors = read_factors_csv(spark, w_path, "W").unionByName(read_factors_csv(spark, h_path, "H"))
    return model_error(
        materialize(read_ratings(spark, ratings_path), "ratings"), materialize(factors, "factors")
    )
