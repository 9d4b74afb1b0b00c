"""The same operators over streams of records.

The stateful operators need ``transformWithStateInPandas`` and therefore the
RocksDB state store provider (``STATE_STORE``).
"""

from pyspark.sql import DataFrame

from spillway.session import scratch

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process what a stream has to offer now into a table of the shared folder."""
    spark = stream.sparkSession
    path = scratch(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch(spark, f"{name}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
