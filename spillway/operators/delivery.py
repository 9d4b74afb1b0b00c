"""What an observed attempt means and what happens next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spillway.constants import (
    ATTEMPT_TIMEOUT,
    DRAIN_BACKOFF_CAP,
    DRAIN_MAX_FAILURES,
    MIN_RETRY_WINDOW,
    QUEUE_BACKOFF,
    STOP_STATUSES,
    WORKER_GRACE,
)
from spillway.functions.text import clip, retry_after_seconds, trim_blanks
from spillway.operators.ordering import Scan, scan, stage
from spillway.session import materialise


def _success(status: Column) -> Column:
    return F.coalesce((status >= 200) & (status < 300), F.lit(False))


def _refused(status: Column) -> Column:
    """A client error that waiting does not cure."""
    return F.coalesce((status >= 400) & (status < 500) & ~status.isin(408, 429), F.lit(False))


def outcome_queue(status: Column) -> Column:
    """Outcome on the worker's path; a NULL status is a transport error."""
    return (
        F.when(_success(status), "success")
        .when(F.coalesce(status == 429, F.lit(False)), "rate_limited")
        .when(_refused(status), "park")
        .otherwise("retry")
    )


def outcome_drain(status: Column) -> Column:
    """Outcome on the dead-letter path: configuration errors stop the run, nothing is skipped."""
    return (
        F.when(_success(status), "success")
        .when(F.coalesce(status == 429, F.lit(False)), "rate_limited")
        .when(F.coalesce(status.isin(STOP_STATUSES), F.lit(False)), "stop")
        .when(_refused(status), "reject")
        .otherwise("retry")
    )


def queue_backoff(attempt: Column) -> Column:
    steps = F.array(*[F.lit(s) for s in QUEUE_BACKOFF])
    return F.coalesce(F.when(attempt >= 1, F.get(steps, (attempt - 1).cast("int"))), F.lit(QUEUE_BACKOFF[-1])).cast("bigint")


def retry_deadline(enqueued: Column, delay: Column, window: Column) -> Column:
    """Epoch second until which a batch is retried."""
    return enqueued + F.greatest(F.lit(0), delay) + F.greatest(F.lit(MIN_RETRY_WINDOW), window)


def worker_deadline(deadline: Column, now: Column, window: Column) -> Column:
    """When the worker itself gives up: a day after the batch's own deadline."""
    return F.coalesce(deadline, now + F.greatest(F.lit(MIN_RETRY_WINDOW), window)) + WORKER_GRACE


def fits_before(now: Column, delay: Column, deadline: Column) -> Column:
    """A whole attempt still fits after ``delay``; a job without a deadline always fits."""
    return deadline.isNull() | (now + delay + ATTEMPT_TIMEOUT <= deadline)


def next_action(attempts: DataFrame) -> DataFrame:
    """Add ``action`` (done, release, park), ``delay`` and ``reason`` to observed attempts.

    Reads ``status, retry_after, body, attempt, now, retry_deadline, sync``.
    """
    status, now, deadline = F.col("status"), F.col("now"), F.col("retry_deadline")
    body = F.coalesce("body", F.lit(""))
    # Step by step, so that each part is worked out once per row.
    known = attempts.withColumns(
        {
            "_outcome": outcome_queue(status),
            "_expired": ~fits_before(now, F.lit(0), deadline),
            "_cause": F.when(status.isNull(), F.concat(F.lit("Ingest unreachable: "), body)).otherwise(
                F.concat(F.lit("Ingest responded HTTP "), status.cast("string"))
            ),
        }
    ).withColumn(
        "_delay",
        F.when(F.col("_outcome") == "rate_limited", retry_after_seconds(F.col("retry_after"), now)).otherwise(
            queue_backoff(F.col("attempt"))
        ),
    ).withColumn(
        "_obstacle",
        F.when(deadline.isNull(), "job without a deadline is not retried")
        .when(F.col("sync"), "sync queue can't retry")
        .when(~fits_before(now, F.col("_delay"), deadline), "retry window exhausted"),
    )
    outcome, expired, obstacle, cause = (F.col(c) for c in ("_outcome", "_expired", "_obstacle", "_cause"))
    action = (
        F.when(expired, "park")
        .when(outcome == "success", "done")
        .when(outcome == "park", "park")
        .when(obstacle.isNull(), "release")
        .otherwise("park")
    )
    reason = (
        F.when(expired, "Retry window exhausted while waiting in the queue")
        .when(outcome == "success", F.lit(None))
        .when(outcome == "park", trim_blanks(F.concat(cause, F.lit(" "), clip(body))))
        .otherwise(F.concat_ws("; ", cause, obstacle))
    )
    retried = ~expired & outcome.isin("rate_limited", "retry") & obstacle.isNull()
    return known.select(
        *attempts.columns,
        action.alias("action"),
        F.when(retried, F.col("_delay")).alias("delay"),
        reason.alias("reason"),
    )


def park_route(dead_letter_path: Column, written: Column) -> Column:
    """Where a parked batch ends up."""
    return (
        F.when(dead_letter_path.isNull() | (dead_letter_path == ""), "dropped")
        .when(written, "dead_letter")
        .otherwise("failed_store")
    )


def drain_backoff(attempts: DataFrame, run: Sequence[str], order: Sequence[str], status: str = "status") -> DataFrame:
    """Consecutive failures, wait and stop flag of each attempt of a drain run.

    Success and rejection reset the count, a rate-limited attempt leaves it
    alone; the fifth failure in a row stops the run, and what was recorded
    after that is marked ``after_stop``.
    """
    kind = outcome_drain(F.col(status))
    staged = stage(attempts.withColumn("_kind", kind), run, order)
    failed = (F.col("_kind") == "retry").cast("bigint")
    so_far = scan(staged, run, {"_failed": Scan("sum", failed)})
    # The running count never falls, so its value at the last reset is a running maximum.
    since = scan(
        so_far, run, {"_base": Scan("max", F.when(F.col("_kind").isin("success", "reject"), F.col("_failed")))}
    )
    counted = since.withColumn("failures", F.col("_failed") - F.coalesce("_base", F.lit(0)))
    stops = (F.col("_kind") == "stop") | (failed == 1) & (F.col("failures") >= DRAIN_MAX_FAILURES)
    # A scan reads its input twice; storing keeps chained scans from doubling each time.
    stored = materialise(counted.withColumn("stops", stops), "failures")
    done = scan(stored, run, {"_stopped": Scan("max", stops.cast("bigint"), before=True)})
    wait = F.when(
        (failed == 1) & ~F.col("stops"), F.least(F.lit(DRAIN_BACKOFF_CAP), F.pow(F.lit(2), F.col("failures"))).cast("bigint")
    )
    return done.select(
        *attempts.columns,
        F.col("_kind").alias("outcome"),
        "failures",
        wait.alias("wait_sec"),
        "stops",
        (F.coalesce("_stopped", F.lit(0)) > 0).alias("after_stop"),
    )
