"""Numbering and running aggregates over ordered domains of any size.

A plain ``Window.partitionBy(domain)`` puts a whole domain into one task, which
fails when one app or token holds a third of all rows. Here rows are range
partitioned on (domain, order), aggregated per partition, and only one carry
row per partition is folded in sequence:

1. ``stage`` range-partitions, sorts, numbers and writes the (narrow) rows;
2. per (domain, partition) totals are aggregated, a prefix over partitions
   gives what each partition inherits;
3. a window inside (domain, partition) adds the local part.

``number_once`` counts while it writes, so that numbering alone needs neither the
window nor its shuffle. No task ever sees more than one range partition, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spillway.session import materialise

_IN_PARTITION = (1 << 33) - 1

#: Estimated bytes of a range partition, beyond which there are more of them than the session asks for.
PARTITION_BYTES = 256 << 20


def range_partitions(df: DataFrame, target: int = PARTITION_BYTES) -> int:
    """Range partitions for ``df``: the session's number, or more where Spark's size estimate asks for it.

    The estimate is the smaller of the plan's and of all that it reads (a join's is a product); a plan
    with a leaf of unknown size keeps the session's number.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = df._jdf.queryExecution().optimizedPlan()
    found = plan.collectLeaves()
    leaves = [int(str(found.apply(k).stats().sizeInBytes())) for k in range(found.size())]
    if any(size >= 1 << 62 for size in leaves):
        return least
    return max(least, -(-min(int(str(plan.stats().sizeInBytes())), sum(leaves)) // target))


def stage(df: DataFrame, domain: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` with ``_part`` and ``_pos``, fixed in the shared folder.

    (domain, order) must identify a row. Pass only the columns the scan needs;
    payload is joined back afterwards so that it moves once.
    """
    keys = [*domain, *order]
    placed = df.repartitionByRange(partitions or range_partitions(df), *keys).sortWithinPartitions(*keys)
    return materialise(
        placed.withColumn("_pos", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()),
        "ordered",
    )


@dataclass(frozen=True)
class Scan:
    """A running aggregate: ``sum``, ``max``, ``min`` or ``last`` (non-null) of ``value``.

    ``before`` leaves the current row out. A ``sum`` starts at 0, the others
    at NULL.
    """

    kind: str
    value: Column
    before: bool = False

    def aggregate(self, value: Column) -> Column:
        if self.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), F.col("_pos")))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](value)

    def running(self, value: Column, window) -> Column:
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return self.aggregate(value).over(window)

    def combine(self, carried: Column, local: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
        if self.kind == "last":
            return F.coalesce(local, carried)
        return (F.greatest if self.kind == "max" else F.least)(carried, local)


def scan(staged: DataFrame, domain: Sequence[str], scans: dict[str, Scan]) -> DataFrame:
    """Add one running aggregate per entry of ``scans`` to staged rows."""
    names = list(scans)
    values = staged.select("*", *[scans[n].value.alias(f"_v_{n}") for n in names])

    totals = values.groupBy(*domain, "_part").agg(
        F.min("_pos").alias("_first"), *[scans[n].aggregate(F.col(f"_v_{n}")).alias(f"_t_{n}") for n in names]
    )
    earlier = Window.partitionBy(*domain).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the domain a partition begins with can have rows in an earlier one:
    # one carry row per partition, so its size is bounded by the partition count.
    carried = (
        totals.select(
            "_part",
            "_first",
            *[scans[n].running(F.col(f"_t_{n}"), earlier).alias(f"_c_{n}") for n in names],
        )
        .filter(F.col("_first").bitwiseAND(F.lit(_IN_PARTITION)) == 0)
    )

    block = Window.partitionBy(*domain, "_part").orderBy("_pos")
    upto = block.rowsBetween(Window.unboundedPreceding, 0)
    ahead = block.rowsBetween(Window.unboundedPreceding, -1)
    local = values.select(
        *staged.columns,
        F.min("_pos").over(block).alias("_first"),
        *[scans[n].running(F.col(f"_v_{n}"), ahead if scans[n].before else upto).alias(f"_l_{n}") for n in names],
    )
    return local.join(F.broadcast(carried), ["_part", "_first"], "left").select(
        *staged.columns,
        *[scans[n].combine(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n in names],
    )


def number_rows(staged: DataFrame, domain: Sequence[str], name: str = "_rn") -> DataFrame:
    """Add the 0-based position of each staged row inside its domain."""
    return scan(staged, domain, {name: Scan("sum", F.lit(1).cast("bigint"), before=True)})


def domain_starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Marks rows whose ``keys`` differ from those of the row before; the first row is left unmarked."""
    new = np.zeros(rows.num_rows, bool)
    for key in keys:
        column = rows[key].combine_chunks()
        codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def number_once(df: DataFrame, domain: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based position ``_rn`` of each row inside its domain, fixed in the shared folder.

    (domain, order) must identify a row. Rows are counted within their domain and partition as they are
    written; what the first domain of a partition has in earlier ones comes by a broadcast of a row per partition.
    """
    domain, keys = list(domain), [*domain, *order]
    placed = (
        df.repartitionByRange(partitions or range_partitions(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, head = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            # The row before tells whether its domain goes on.
            new = domain_starts(rows if last is None else pa.concat_tables([last, rows]), domain)[int(last is not None):]
            here, begins = np.arange(batch.num_rows), np.nonzero(new)[0]
            local = here - np.maximum.accumulate(np.where(new, here, 0))
            goes_on = begins[0] if len(begins) else batch.num_rows
            local[:goes_on] += seen
            heads = np.full(batch.num_rows, head)
            heads[goes_on:] = False
            last, seen, head = rows.slice(batch.num_rows - 1), int(local[-1]) + 1, bool(heads[-1])
            counted = rows.append_column("_local", pa.array(local, pa.int64())).append_column("_head", pa.array(heads, pa.bool_()))
            yield from counted.combine_chunks().to_batches()

    schema = T.StructType([*placed.schema.fields, T.StructField("_local", T.LongType()), T.StructField("_head", T.BooleanType())])
    ordered = materialise(placed.mapInArrow(count, schema), "ordered")
    earlier = Window.partitionBy(*domain).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialise(
        ordered.groupBy(*domain, "_part")
        .agg(F.max("_head").alias("_head"), (F.max("_local") + 1).alias("_n"))
        .select("_part", "_head", F.sum("_n").over(earlier).alias("_before"))
        .filter("_head AND _before IS NOT NULL"),
        "carried",
    )
    rn = F.col("_local") + F.when(F.col("_head"), F.coalesce("_before", F.lit(0))).otherwise(0)
    return ordered.join(F.broadcast(carried.drop("_head")), "_part", "left").select(*df.columns, rn.alias("_rn"))


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
