"""Running a stream over the data that is there into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tesselar.workspace import new_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process all available input in append mode and return the written rows.

    Rows, offsets and state go to the shared folder. The query keeps the state store provider it
    is started with; the session setting is put back at once.
    """
    spark = stream.sparkSession
    home = new_path(spark, name)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{home}/rows")
            .option("checkpointLocation", f"{home}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")
