"""Repack a backlog of small jobs into full, paced batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from spillway.constants import DELIVERY_JOB, MAX_BYTES, MAX_CHUNK, MAX_ENTRIES
from spillway.functions.text import text_json_bytes
from spillway.operators import packing, pacing
from spillway.operators.delivery import retry_deadline
from spillway.operators.ordering import number_rows, stage
from spillway.session import materialise
from spillway.sources.deadletter import unnest_entries
from spillway.sources.jobs import split_backlog


def chunk_jobs(jobs: DataFrame, chunk: int = 1000) -> DataFrame:
    """Number each queue's jobs in order and cut them into chunks.

    Read payloads (``split_backlog``) before this, where the scan's tasks share the work, not behind its join.
    """
    size = max(1, min(MAX_CHUNK, chunk))
    numbered = number_rows(stage(jobs.select("queue", "seq"), ["queue"], ["seq"]), ["queue"], "job_no")
    placed = numbered.select("queue", "seq", "job_no", pacing.div(F.col("job_no"), F.lit(size)).alias("chunk"))
    return jobs.join(placed, ["queue", "seq"], "inner")


def job_entry_rows(jobs: DataFrame) -> DataFrame:
    """Entries of the readable jobs with their sizes, stored once for the passes of packing."""
    rows = unnest_entries(jobs, ["queue", "chunk", "job_no"])
    return materialise(rows.withColumn("entry_bytes", text_json_bytes(F.col("entry"))), "job-entries")


def pack_jobs(entries: DataFrame, **limits) -> DataFrame:
    """Pack ``job_entry_rows`` inside their chunk, which holds at most 5000 jobs; the rest is flushed at its end."""
    return packing.pack(
        entries, ["queue", "chunk"], ["job_no", "pos"], size=F.col("entry_bytes"), bounded=True, **limits
    )


def acknowledged(jobs: DataFrame, queued: DataFrame) -> DataFrame:
    """Jobs of a chunk that are done once ``queued`` entries of it have been scheduled.

    Reads ``queue, chunk, job_no, n_entries`` and ``queue, chunk, queued``. A
    foreign job is done with the jobs before it. Chunks hold at most 5000 jobs.
    """
    w = Window.partitionBy("queue", "chunk").orderBy("job_no").rowsBetween(Window.unboundedPreceding, 0)
    needed = jobs.withColumn("needs", F.sum("n_entries").over(w))
    return needed.join(queued, ["queue", "chunk"], "left").withColumn(
        "done", F.col("needs") <= F.coalesce("queued", F.lit(0))
    )


def return_foreign(backlog: DataFrame, foreign: DataFrame) -> DataFrame:
    """``foreign`` jobs moved behind the last job of their queue, in their old order."""
    tail = backlog.groupBy("queue").agg(F.max("seq").alias("_last"))
    numbered = number_rows(stage(foreign, ["queue"], ["seq"]), ["queue"])
    return numbered.join(tail, "queue", "inner").select(
        *foreign.columns, (F.col("_last") + F.col("_rn") + 1).alias("new_seq")
    )


@dataclass
class Repacked:
    """Result tables of one run."""

    batches: DataFrame
    entries: DataFrame
    assigned: DataFrame
    backlog: DataFrame
    totals: DataFrame


def rebatch_backlog(
    jobs: DataFrame,
    waiting: DataFrame,
    now: Column,
    *,
    chunk: int = 1000,
    rate: int,
    start_delay: int | None = None,
    max_chunks: int | None = None,
    max_ahead_min: int | None = None,
    retry_window: int = 3600,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
    job: str = DELIVERY_JOB,
) -> Repacked:
    """Repack ``jobs`` (``queue, seq, payload``) behind what the target holds.

    ``waiting`` is the target's state per source queue: ``queue, waiting,
    last_due``. ``now`` is an epoch second.
    """
    # The payload stays behind; it is joined to what goes back to the backlog.
    chunked = materialise(chunk_jobs(split_backlog(jobs, job).drop("payload"), chunk), "jobs")
    entries = job_entry_rows(chunked)
    packed = materialise(pack_jobs(entries, batch_size=batch_size, max_bytes=max_bytes), "packed")
    keys = ["queue", "chunk"]
    batches = packed.groupBy(*keys, "batch_start").agg(
        F.count(F.lit(1)).alias("n_entries"), F.sum("size").alias("n_bytes")
    )
    per_chunk = (
        chunked.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("jobs"),
            F.sum("n_entries").alias("entries"),
            F.count_if(~F.col("own")).alias("returned"),
        )
        .join(batches.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_batches")), keys, "left")
        .fillna(0, ["n_batches"])
        .join(waiting, "queue", "left")
        .withColumn(
            "start_in",
            pacing.schedule_start(F.coalesce("waiting", F.lit(0)), F.col("last_due"), now, rate, start_delay),
        )
        .drop("waiting", "last_due")
    )
    chunks = materialise(
        pacing.claimed_chunks(
            per_chunk, ["queue"], "chunk", rate, "start_in", max_chunks=max_chunks, max_ahead_min=max_ahead_min
        ),
        "chunks",
    )
    claimed = chunks.filter("claimed")
    numbered = number_rows(
        stage(batches, keys, ["batch_start"]), keys, "_in_chunk"
    )
    due = (
        numbered.join(claimed.select(*keys, "first_batch", "start_in"), keys, "inner")
        .withColumn("batch_no", F.col("first_batch") + F.col("_in_chunk"))
        .withColumn("due_in", pacing.due_delay(F.col("batch_no"), rate, F.col("start_in")))
        .withColumn("retry_deadline", retry_deadline(now, F.col("due_in"), F.lit(retry_window)))
        .select(*keys, "batch_start", "batch_no", "n_entries", "n_bytes", "due_in", "retry_deadline")
    )
    marked = chunked.join(claimed.select(*keys, F.lit(True).alias("_taken")), keys, "left")
    kept = marked.filter(F.col("_taken").isNull()).select("queue", "seq", F.col("seq").alias("new_seq"))
    foreign = marked.filter(F.col("_taken") & ~F.col("own")).select("queue", "seq")
    left = kept.unionByName(return_foreign(jobs, foreign))
    backlog = jobs.select("queue", "seq", "payload").join(left, ["queue", "seq"], "inner")
    return Repacked(due, entries, packed, backlog, repack_totals(claimed))


def repack_totals(chunks: DataFrame) -> DataFrame:
    """Jobs, entries, batches and returned jobs per chunk and per queue in one pass."""
    return (
        chunks.rollup("queue", "chunk")
        .agg(
            F.sum("jobs").alias("jobs"),
            F.sum("entries").alias("entries"),
            F.sum("n_batches").alias("batches"),
            F.sum("returned").alias("returned"),
        )
        .filter(F.col("queue").isNotNull())
    )
