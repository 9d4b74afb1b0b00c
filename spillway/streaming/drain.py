"""Resumable drain of a dead-letter folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from spillway.constants import MAX_BYTES, MAX_ENTRIES
from spillway.operators import packing
from spillway.plans.drain import decode, pack_dead_letters
from spillway.session import materialise
from spillway.sources import deadletter

Sink = Callable[[DataFrame, int], None]


def epoch_sink(path: str) -> Sink:
    """Keeps what a trigger sends under its number; one that is repeated after a crash replaces what it had left.

    Spark's commit puts a marker into the folder last, so a folder without it is a write that broke off.
    """

    def send(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{epoch}")

    return send


def _numbered(spark: SparkSession, path: str, marker: str = "") -> set[int]:
    """The numbers among a folder's names, of those that hold ``marker`` where it is given; none if there is no folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    where = hadoop(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in files.listStatus(where)] if files.exists(where) else []
    return {int(n) for n in names if n.isdigit() and (not marker or files.exists(hadoop(f"{path}/{n}/{marker}")))}


def read_epochs(spark: SparkSession, path: str, schema: StructType | str, checkpoint: str | None = None) -> DataFrame:
    """What ``epoch_sink`` has committed: every batch once, as it is named by trigger and ``batch_id``.

    With the ``checkpoint`` of the drain that is all it sent, or an error: the drain has ended its last trigger, and the
    folder holds every trigger of it and no other. Without, it is what was sent so far, and only the last trigger may
    be lacking: they come one after the other from 0, so one below a committed one has been lost.
    """
    done = _numbered(spark, path, "_SUCCESS")
    if checkpoint is None:
        due = set(range(max(done, default=-1) + 1))
    else:
        # A trigger is noted in ``offsets`` before it runs and in ``commits`` after; old notes are deleted, the last one stays.
        begun, ended = (max(_numbered(spark, f"{checkpoint}/{log}"), default=-1) for log in ("offsets", "commits"))
        started = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
        if not started.getFileSystem(spark._jsc.hadoopConfiguration()).exists(started):
            raise RuntimeError(f"no drain has used the checkpoint {checkpoint}")
        if begun != ended:
            raise RuntimeError(f"the drain of the checkpoint {checkpoint} broke off in trigger {begun}")
        due = set(range(begun + 1))
        if done - due:
            raise RuntimeError(f"{path} holds triggers {sorted(done - due)}, which the checkpoint {checkpoint} doesn't know")
    if due - done:
        raise RuntimeError(f"{path} lacks triggers {sorted(due - done)}, which were sent")
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in sorted(done)]) if done else spark.createDataFrame([], schema)


def drain(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    send: Sink,
    quarantine: Sink,
    *,
    max_files: int | None = None,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
) -> StreamingQuery:
    """Drain every file once; a crashed run resumes at the trigger it was in.

    ``send`` receives batches (``run, batch_id, entries``) and ``quarantine``
    the unreadable lines. Delivery is at least once: after a crash the last
    trigger is repeated with the same ``batch_id`` values, by which a sink can
    recognise what it already has. ``max_files`` bounds the work per trigger.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        "value",
    )

    def trigger(batch: DataFrame, epoch: int) -> None:
        # One table per trigger: positions must not change between the passes below. A trigger may hold few files,
        # and lines of one kind pack to little; dealt out over all cores, a line at a time, they are decoded by all.
        named = batch.withColumn("line", F.monotonically_increasing_id())
        placed = materialise(named.repartition(max(2, batch.sparkSession.sparkContext.defaultParallelism)), "lines")
        keyed = placed.withColumn("run", F.lit(epoch).cast("bigint"))
        entries, plan = pack_dead_letters(
            decode(keyed, ["run", *deadletter.LINE_ID]),
            ["run"],
            deadletter.LINE_ID,
            batch_size=batch_size,
            max_bytes=max_bytes,
        )
        packed = packing.attach(entries, plan.drop("size"), ["run", *deadletter.LINE_ID, "pos"])
        batches = packing.assemble(packed, ["run"]).withColumn(
            "batch_id", F.concat_ws("/", F.col("run").cast("string"), F.col("batch_start").cast("string"))
        )
        quarantine(deadletter.quarantine(placed), epoch)
        send(batches, epoch)

    return (
        lines.writeStream.foreachBatch(trigger)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
