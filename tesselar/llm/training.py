"""Labelled rows to fit on, and the rows held out from every fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by the number of folds; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of at most ``limit`` labelled rows that are not held out.

    The sample is a fixed pseudo-random choice of label rows. It is bounded, so it is broadcast to the scan of the
    documents and no text is shuffled. Null labels and null ids are left out.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    rows = rows.orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id", "label").limit(limit)
    return documents.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "label")


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A copy of ``schema`` with one more field."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or a longer name that no column of ``frame`` has (in any case)."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
