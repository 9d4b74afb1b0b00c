"""Job backlog and failed-job stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spillway.constants import DELIVERY_JOB
from spillway.sources.deadletter import containers


def _text(payload: Column, path: str) -> Column:
    return F.try_variant_get(payload, path, "string")


def is_own_backlog(payload: Column, job: str = DELIVERY_JOB) -> Column:
    """The payload's command is the delivery job."""
    return F.coalesce(_text(payload, "$.data.commandName") == job, F.lit(False))


def is_own_failed(payload: Column, name: Column | None = None, job: str = DELIVERY_JOB) -> Column:
    """The payload *is* the delivery job by structure; mentioning it elsewhere does not count."""
    own = F.coalesce(_text(payload, "$.displayName") == job, F.lit(False)) | is_own_backlog(payload, job)
    return own if name is None else own | F.coalesce(name == job, F.lit(False))


def job_entries(payload: Column) -> Column:
    """``data.entries`` of a payload as JSON text (arrays and objects only); NULL when unreadable."""
    return containers(F.try_variant_get(payload, "$.data.entries", "array<variant>"))


def split_backlog(jobs: DataFrame, job: str = DELIVERY_JOB) -> DataFrame:
    """Add ``own``, ``entries`` (NULL when foreign) and ``n_entries`` to backlog rows.

    A job that is not the delivery job, or whose entries cannot be read, is
    foreign: it keeps its payload and goes back to the backlog.
    """
    parsed = jobs.withColumn("_p", F.try_parse_json("payload"))
    found = parsed.withColumn(
        "entries", F.when(is_own_backlog(F.col("_p"), job), job_entries(F.col("_p")))
    ).drop("_p")
    return found.withColumn("own", F.col("entries").isNotNull()).withColumn(
        "n_entries", F.coalesce(F.when(F.col("own"), F.size("entries")), F.lit(0)).cast("bigint")
    )


def failed_stores(*stores: DataFrame) -> DataFrame:
    """Union of the failed-job stores, a missing ``name`` or other column as NULL."""
    first, *rest = stores
    for store in rest:
        first = first.unionByName(store, allowMissingColumns=True)
    return first


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    id_range: tuple[int, int],
    partitions: int,
    columns: Sequence[str] = ("id", "payload"),
    **options: str,
) -> DataFrame:
    """Scan a failed-job table in id ranges read in parallel."""
    low, high = id_range
    return (
        spark.read.jdbc(url, table, column="id", lowerBound=low, upperBound=high, numPartitions=partitions, properties=options)
        .select(*columns)
    )
