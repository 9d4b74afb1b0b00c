"""When the batches of a run are due."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spillway.operators.ordering import Scan, number_rows, scan, stage


def div(a: Column, b: Column) -> Column:
    """Whole quotient of non-negative numbers."""
    return F.floor(a / b).cast("bigint")


def default_rate(limit: int) -> int:
    """Batches per minute when none is asked for: 90 % of the limit."""
    return max(1, limit * 9 // 10) if limit > 0 else 0


def due_delay(n: Column, rate: int, start: Column) -> Column:
    """Seconds until the n-th (0-based) batch of a run; all at once without a rate."""
    return start + div(n * 60, F.lit(rate)) if rate > 0 else F.lit(0).cast("bigint")


def schedule_start(waiting: Column, last_due: Column, now: Column, rate: int, explicit: int | None = None) -> Column:
    """Delay of a run's first batch: behind everything the target queue already holds.

    ``waiting`` jobs drain at ``rate``; ``last_due`` is the latest delayed job's
    epoch second (NULL: none).
    """
    if rate <= 0:
        return F.lit(0).cast("bigint")
    if explicit is not None:
        return F.lit(max(0, explicit)).cast("bigint")
    after_last = F.coalesce(F.ceil(last_due).cast("bigint") - now + 60 // rate, F.lit(0))
    return F.greatest(F.lit(0), div(waiting * 60, F.lit(rate)), after_last)


def queue_state(jobs: DataFrame, queue: Sequence[str] = ("queue",), due: str = "due_at") -> DataFrame:
    """Jobs waiting and the latest due time, per queue."""
    return jobs.groupBy(*queue).agg(F.count(F.lit(1)).alias("waiting"), F.max(due).alias("last_due"))


def schedule(batches: DataFrame, run: Sequence[str], order: Sequence[str], rate: int, start: str) -> DataFrame:
    """Number the batches of each run and add ``due_in`` seconds.

    ``start`` is a column of ``batches`` holding the run's start delay.
    """
    numbered = number_rows(stage(batches, run, order), run, "batch_no")
    return numbered.select(*batches.columns, "batch_no", due_delay(F.col("batch_no"), rate, F.col(start)).alias("due_in"))


def claimed_chunks(
    chunks: DataFrame,
    run: Sequence[str],
    chunk: str,
    rate: int,
    start: str,
    *,
    max_chunks: int | None = None,
    max_ahead_min: int | None = None,
) -> DataFrame:
    """Chunks a run takes, with the number of its first batch.

    Reads ``n_batches`` per chunk. A run stops before the first chunk whose
    first batch would be due beyond the horizon; due times never fall, so that
    is a plain filter.
    """
    placed = scan(
        stage(chunks, run, [chunk]),
        run,
        {"first_batch": Scan("sum", F.col("n_batches"), before=True), "_no": Scan("sum", F.lit(1).cast("bigint"), before=True)},
    )
    due = due_delay(F.col("first_batch"), rate, F.col(start))
    keep = F.lit(True)
    if max_chunks is not None:
        keep = keep & (F.col("_no") < max(1, max_chunks))
    if rate > 0 and max_ahead_min is not None:
        keep = keep & (due <= max(0, max_ahead_min) * 60)
    return placed.select(*chunks.columns, "first_batch", due.alias("due_in"), keep.alias("claimed"))


def first_batches(numbered: DataFrame, limit: int, batch_no: str = "batch_no") -> DataFrame:
    """Batches one run may send; 0 means no limit. The complement waits for the next run."""
    return numbered if limit <= 0 else numbered.filter(F.col(batch_no) < limit)
