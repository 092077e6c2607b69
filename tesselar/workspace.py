"""Intermediate tables in the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"


def root_dir(spark: SparkSession) -> str:
    """The session's shared folder; a local one only for a local master that names none."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tesselar-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{root_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as Parquet and return the written rows, cut off from their lineage."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once; later reads start from the written table, also after lost executors."""
    return write_table(df, new_path(df.sparkSession, name))


@dataclass(frozen=True)
class BucketedTable:
    """A table in the session's catalog, stored in buckets below the shared folder."""

    spark: SparkSession
    name: str
    path: str
    schema: StructType

    def read(self) -> DataFrame:
        """The table with its buckets: joins and groups on the bucket column need no shuffle."""
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """The same rows without the catalog."""
        return self.spark.read.schema(self.schema).parquet(self.path)


def bucket_keys(spark: SparkSession, n: int) -> tuple[int, ...]:
    """For each of ``n`` buckets a number that Spark's bucketing puts there."""
    found: dict[int, int] = {}
    tried = 16 * n
    while len(found) < n:
        number = F.col("id").cast("int")
        keys = spark.range(tried).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("bucket")).agg(F.min(number).alias("number"))
        found = {row["bucket"]: row["number"] for row in keys.collect()}
        tried *= 2
    return tuple(found[bucket] for bucket in range(n))


def write_buckets(
    df: DataFrame, path: str, buckets: int, column: str, partition_by: str | None = None, sort_by: str | None = None, mode: str = "errorifexists", **options: str
) -> BucketedTable:
    """Store ``df`` in ``buckets`` by ``column``. Every task writes to the buckets of its rows; nothing is shuffled."""
    name = f"tesselar_{uuid.uuid4().hex}"
    writer = df.write.mode(mode).format("parquet").options(**options).option("path", path).bucketBy(buckets, column)
    if sort_by:
        writer = writer.sortBy(sort_by)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return BucketedTable(df.sparkSession, name, path, df.schema)


def append_buckets(table: BucketedTable, df: DataFrame, buckets: int, column: str, partition_by: str, **options: str) -> None:
    """Add ``df`` to a table of ``write_buckets``; nothing is shuffled."""
    writer = df.write.mode("append").format("parquet").options(**options).option("path", table.path).bucketBy(buckets, column)
    writer.partitionBy(partition_by).saveAsTable(table.name)


def drop_partition(table: BucketedTable, column: str, value: int) -> None:
    """Forget a partition and delete its files, whose rows are read no more."""
    table.spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({column} = {value})")
    context = table.spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{table.path}/{column}={value}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def drop_table(table: BucketedTable) -> None:
    """Forget the table; its files stay, as those of any table with a path of its own."""
    table.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
