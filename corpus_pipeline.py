"""A corpus pipeline: documents are filtered for quality and toxicity, thinned of near duplicates, freed from
benchmark passages and packed into sequences.

Every stage is a function of (spark, docs, sf_dir). ``run`` writes what a stage returns to the shared folder and reads
it back as the next stage's documents. All stages but the last return the columns of ``documents``, whatever their names.
Null and empty texts, null ids and repeated rows are rows like others; each stage says what becomes of them. An empty
table passes every stage as an empty table. Texts of any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.llm import decontamination, near_duplicates, packing, quality_model, toxicity
from tesselar.llm.training import free_name
from tesselar.workspace import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold, all columns.

    Equal texts have equal scores, so repeated rows stay or go together; all null, empty and blank texts share one
    score. Learned from labelled rows of ``docs`` outside the held-out fold; without any, every score is 0.5.
    """
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "score")
    scored = quality_model.score_quality(docs, model, score)
    return scored.where(F.col(score) >= quality_model.PREDICT).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not predict to be toxic, all columns.

    Null and empty texts have no match and the score of such texts. Learned from labelled rows of ``docs`` outside the
    held-out fold.
    """
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "score")
    scored = toxicity.score_toxicity(docs, model, score)
    return scored.where(F.col(score) < toxicity.PREDICT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of copies and near copies, all columns.

    A null id comes last; of rows with one id the first as written stays. Blank texts are copies only of those with their
    id, and of none where it is null.
    """
    return near_duplicates.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, all columns.

    Null and empty texts hold none and stay; every repeated row is judged on its own.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_documents(docs, benchmark)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequence and place.

    A null or empty text is its end id; repeated rows and rows without an id are packed each.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: Trained models have no SQL twin; tests/llm/test_pipeline.py compares the stages with brute force where they have one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
