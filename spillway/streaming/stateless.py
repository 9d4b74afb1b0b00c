"""Filter, normalise and mask records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from spillway.operators.normalize import to_entries, with_wire_text
from spillway.plans.normalise_logs import wanted


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream of raw records from a folder of Parquet files; ``max_files`` bounds the work per trigger."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def normalised(records: DataFrame, config: DataFrame, **masking) -> DataFrame:
    """Wire entries of a record stream.

    ``config`` is a static table: Spark reads it again for every micro-batch,
    so changed settings apply from the next one on.
    """
    return with_wire_text(to_entries(wanted(records, config), **masking))


def write_entries(entries: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        entries.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
