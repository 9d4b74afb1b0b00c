"""What the operators of this package share: readers, Arrow helpers, interval arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from spillway.session import configure

#: Rows handed to a Python worker at once; texts may be long.
ROWS_PER_BATCH = "500"
#: Bits of a sieve: so many a key, and 8 MB at most (as a power of two). A bitmap of Spark's has 2 ** 15.
SIEVE_BITS, SIEVE_MOST, BITMAP = 64, 26, 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table, read as it lies."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(f, schema)


def sieve(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test of values: false only for those that are not in ``keys``, so that few of the others need a join.

    A key sets one bit of a bitmap, which is broadcast. Its size is bounded: of very many keys it lets more
    of the others pass, and loses none. ``keys`` is read twice and should be stored.
    """
    bits = 1 << min(SIEVE_MOST, max(BITMAP, (SIEVE_BITS * keys.count()).bit_length()))

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(bits).cast("long"))

    # Spark numbers the bits of its bitmaps from 1.
    at = keys.select((place(F.col(key)) + 1).alias("at")).withColumn("part", F.bitmap_bucket_number("at")).repartition("part")
    table = np.zeros(bits >> 3, np.uint8)
    for r in at.groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect():
        lo = (r.part - 1) << BITMAP >> 3
        table[lo : lo + (1 << BITMAP >> 3)] = np.frombuffer(r.bits, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(at: pd.Series) -> pd.Series:
        x = at.to_numpy()
        return pd.Series((shared.value[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1)

    return lambda value: passes(place(value))


def utf8(column: pa.Array) -> list[bytes | None]:
    """Values of a string column as UTF-8, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as sorted, disjoint, non-touching ones."""
    if len(starts) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, s[1:] > e[:-1]]
    return s[first], e[np.r_[np.nonzero(first)[0][1:] - 1, len(s) - 1]]
