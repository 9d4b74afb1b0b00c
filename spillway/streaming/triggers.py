"""Batches and rate limits over streams, for keys of any size.

Every trigger runs the batch operators, which range-partition and scan, and leaves one
small row per key for the next: a limiter's clock, or the batch that is still open.

State is a log: a trigger writes the rows of the keys that it changed, and every
``COMPACT`` triggers one table of all keys that still matter. What came before that
table is deleted. Event time (the latest time seen) goes along with it: it fires
timers of keys that get no input and lets old keys expire.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spillway.constants import MAX_BYTES, MAX_ENTRIES
from spillway.operators import limiter, packing
from spillway.operators.ordering import Scan, same, scan, stage
from spillway.session import configure, materialise, scratch
from spillway.streaming.stateful import BATCH_SCHEMA

CLOCK = "token string, tat long, paused long"
OPEN = "app string, proc string, first_ms long, entries array<struct<seq:long,size:long>>"
META = "now long, since long"
#: Triggers between two tables of the whole state.
COMPACT = 16
#: How long a limiter's clock is kept after it has run out.
GRACE_MS = 60_000


@dataclass(frozen=True)
class Step:
    """``run`` makes (output, changed state rows) of a trigger's rows and the state before it.

    ``keys`` name a state row; of rows with the same keys the latest counts, and one that isn't ``alive`` is none.
    ``time`` is a row's event time in ms. ``timers`` makes (output, changed state rows) of the state and
    the latest event time, ``expired`` tells of a state row and that time whether it can be forgotten.
    """

    run: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]
    state: str
    out: str
    keys: Sequence[str] = ("token",)
    alive: str = "true"
    time: Column | None = None
    timers: Callable[[DataFrame, int], tuple[DataFrame, DataFrame]] | None = None
    expired: Callable[[int], Column] | None = None


def run_triggers(stream: DataFrame, step: Step, name: str) -> DataFrame:
    """Process what a stream has to offer now into a table of the shared folder."""
    spark = stream.sparkSession
    path = scratch(spark, name)
    start_triggers(stream, step, path, scratch(spark, f"{name}-checkpoint")).awaitTermination()
    return read_triggers(spark, step, path)


def read_triggers(spark: SparkSession, step: Step, path: str) -> DataFrame:
    return spark.read.schema(step.out).parquet(f"{path}/out/*/*") if _made(spark, f"{path}/out") else spark.createDataFrame([], step.out)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _made(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def _forget(spark: SparkSession, path: str, before: int) -> None:
    """Deletes the numbered folders below ``before``."""
    files, where = _at(spark, path)
    if files.exists(where):
        for found in files.listStatus(where):
            if found.getPath().getName().isdigit() and int(found.getPath().getName()) < before:
                files.delete(found.getPath(), True)


def state_before(spark: SparkSession, step: Step, path: str, epoch: int) -> tuple[DataFrame, int, int]:
    """(state, latest event time, epoch of the last whole table) that trigger ``epoch`` starts from."""
    if not epoch:
        return spark.createDataFrame([], step.state), -(1 << 62), 0
    now, since = spark.read.schema(META).parquet(f"{path}/meta/{epoch - 1}").first()
    parts = [spark.read.schema(step.state).parquet(f"{path}/state/{n}").withColumn("_epoch", F.lit(n)) for n in range(since, epoch)]
    return latest(step, parts), now, since


def latest(step: Step, parts: Sequence[DataFrame]) -> DataFrame:
    """The last row of each key that is alive; ``parts`` have their ``_epoch``."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    columns = [c for c in rows.columns if c != "_epoch"]
    if len(parts) > 1:
        row = F.struct(*columns)
        rows = rows.groupBy(*step.keys).agg(F.max_by(row, "_epoch").alias("_row")).select("_row.*")
    return rows.select(*columns).where(step.alive)


def start_triggers(stream: DataFrame, step: Step, path: str, checkpoint: str, compact: int | None = None):
    """The query that does so; a trigger that is repeated after a crash replaces what it had written."""
    every = compact or COMPACT

    def trigger(batch: DataFrame, epoch: int) -> None:
        spark = configure(batch.sparkSession)
        state, now, since = state_before(spark, step, path, epoch)
        if epoch:
            _forget(spark, f"{path}/state", since)
            _forget(spark, f"{path}/meta", epoch - 1)
        if step.time is not None:
            now = max(now, batch.agg(F.max(step.time)).first()[0] or now)
        out, after = step.run(batch, state)
        out.write.mode("overwrite").parquet(f"{path}/out/{epoch}/rows")
        log, n = f"{path}/state/{epoch}", epoch
        if step.timers is not None:
            after = materialise(after, "changed")
            due, closed = step.timers(latest(step, [state.withColumn("_epoch", F.lit(0)), after.withColumn("_epoch", F.lit(1))]), now)
            due.write.mode("overwrite").parquet(f"{path}/out/{epoch}/timers")
            ended = same(after, closed, step.keys)
            after = after.join(closed, ended, "left_anti").unionByName(closed)
        if epoch - since >= every:
            after = latest(step, [state.withColumn("_epoch", F.lit(0)), after.withColumn("_epoch", F.lit(1))])
            if step.expired is not None:
                after = after.where(~step.expired(now))
            since = n
        after.write.mode("overwrite").parquet(log)
        spark.createDataFrame([(now, since)], META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta/{epoch}")

    return stream.writeStream.foreachBatch(trigger).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _touched(state: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of the keys that a trigger's rows have."""
    seen = rows.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    agree = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return state.join(seen, agree, "left_semi")


def _clocks(state: DataFrame, *later: DataFrame) -> DataFrame:
    """One row per token; clocks and pauses never run back."""
    for df in later:
        state = state.unionByName(df, allowMissingColumns=True)
    return state.groupBy("token").agg(F.max("tat").alias("tat"), F.max("paused").alias("paused"))


def _run_out(now: int) -> Column:
    """A clock in the past decides nothing any more; it is kept for ``GRACE_MS``, for requests that come late."""
    return F.greatest(F.coalesce("tat", F.lit(0)), F.coalesce("paused", F.lit(0))) + GRACE_MS <= now


def _limiting(run, out: str) -> Step:
    return Step(run, CLOCK, out, time=F.col("at_ms").cast("bigint"), expired=_run_out)


def _requests(batch: DataFrame, per_minute: int | str, *more: Column) -> DataFrame:
    limit = F.col(per_minute) if isinstance(per_minute, str) else F.lit(per_minute)
    return batch.select(
        F.col("token").cast("string").alias("token"), F.col("seq").cast("bigint").alias("seq"), F.col("at_ms").cast("bigint").alias("at_ms"),
        limit.cast("bigint").alias("_limit"), *more,
    )


def shaping(per_minute: int | str) -> Step:
    """Departure time of each request of ``token, seq, at_ms``.

    ``per_minute`` is a number or names a column, constant per token; a limit of 0, negative or null delays nothing.
    """

    def run(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = _requests(batch, per_minute)
        # A request one interval before the carried clock leaves the clock just there.
        limits = rows.groupBy(F.col("token").alias("_token")).agg(F.max("_limit").alias("_limit"))
        own = state.join(limits, F.col("token").eqNullSafe(F.col("_token"))).where("_limit > 0")
        carried = own.select("token", F.lit(None).cast("bigint").alias("seq"), (F.col("tat") - limiter.interval_ms(F.col("_limit"))).alias("at_ms"), "_limit", F.lit(0).alias("_new"))
        both = carried.unionByName(rows.withColumn("_new", F.lit(1)))
        shaped = materialise(limiter.shape(both, ["token"], ["_new", "at_ms", "seq"], "at_ms", "_limit", clock=True), "shaped")
        out = shaped.where("_new = 1").select("token", "seq", "at_ms", "departs_ms")
        return out, _clocks(_touched(state, rows, ["token"]), shaped.where("_limit > 0").select("token", F.col("clock_ms").alias("tat")))

    return _limiting(run, "token string, seq long, at_ms long, departs_ms long")


def policing(per_minute: int | str, **blocks) -> Step:
    """Grant or refuse each request of ``token, seq, at_ms, pause_sec``.

    ``per_minute`` is a number or names a column, constant per token; a limit of 0, negative or null grants all.
    ``pause_sec`` is what the answer to the request asked all senders to wait (0: nothing); later requests of
    a limited token honour it.
    """

    def run(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        until = F.when(F.col("pause_sec") > 0, F.col("at_ms") + F.col("pause_sec").cast("bigint") * 1000).cast("bigint").alias("paused")
        rows = materialise(_requests(batch, per_minute, until), "requests")
        free = rows.where("coalesce(_limit, 0) <= 0").select("token", "seq", "at_ms", F.lit(True).alias("granted"))
        rows = rows.where("_limit > 0")
        own = _touched(state, rows, ["token"])
        both = own.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        before = {"_tat": Scan("max", F.col("tat"), before=True), "_until": Scan("max", F.col("paused"), before=True)}
        known = scan(stage(both, ["token"], ["_new", "at_ms", "seq"]), ["token"], before).where("_new = 1")
        asked = known.select("token", "seq", "at_ms", "paused", "_limit", "_tat", "_until")
        policed = materialise(
            limiter.police(asked, ["token"], ["at_ms", "seq"], "at_ms", "_limit", paused_until_ms="_until", carried_ms="_tat", **blocks), "policed"
        )
        out = policed.select("token", "seq", "at_ms", "granted").unionByName(free)
        return out, _clocks(own, policed.select("token", F.col("clock_ms").alias("tat"), "paused"))

    return _limiting(run, "token string, seq long, at_ms long, granted boolean")


def batching(batch_size: int = MAX_ENTRIES, max_bytes: int = MAX_BYTES, flush_interval: int = 10, tick: bool = False, **blocks) -> Step:
    """Batches of ``app, proc, seq, ts, entry_bytes``, closed by count, bytes or age.

    By age a batch closes with the arrival that finds it too old, or (``tick``) by a timer: once event time, which
    entries of any key carry on, is ``flush_interval`` after its first entry, before later ones.
    """
    keys, limit, age = ["app", "proc"], packing.entry_limit(batch_size), max(0, flush_interval)

    def run(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        # Entries of an open batch are packed again, before the new ones and all at the time of the first.
        asked = batch.select(*[F.col(k).cast("string").alias(k) for k in keys])
        held = _touched(state, asked, keys).select(*keys, "first_ms", F.posexplode("entries").alias("_held", "e")).select(
            *keys, "_held", F.col("first_ms").alias("ms"), F.col("e.seq").alias("seq"), F.col("e.size").alias("entry_bytes")
        )
        new = batch.select(
            *[F.col(k).cast("string").alias(k) for k in keys], F.lit(MAX_ENTRIES).alias("_held"), F.unix_millis("ts").alias("ms"),
            F.col("seq").cast("bigint").alias("seq"), F.col("entry_bytes").cast("bigint").alias("entry_bytes"),
        )
        packed = packing.pack(
            held.unionByName(new), keys, ["_held", "ms", "seq"], batch_size=batch_size, size=F.col("entry_bytes"), max_bytes=max_bytes,
            at=F.timestamp_millis("ms"), flush_interval=flush_interval, tick=tick, **blocks,
        )
        batches = materialise(packed.groupBy(*keys, "batch_start").agg(F.array_sort(F.collect_list(F.struct("rn", "seq", "size", "ms"))).alias("e")), "batches")
        first, last = F.element_at("e", 1)["ms"], F.element_at("e", -1)["ms"]
        old = F.floor(last / 1000) - F.floor(first / 1000) >= age
        at_end = batches.groupBy(*keys).agg(F.max_by("e", "batch_start").alias("e"), F.max("batch_start").alias("batch_start"))
        full = F.size("e") >= limit
        still = materialise(at_end.where(~(full if tick else full | old)), "open")
        out = batches.join(still, same(batches, still, [*keys, "batch_start"]), "left_anti").select(
            *keys, F.element_at("e", 1)["seq"].alias("batch_first"), F.size("e").alias("n_entries"),
            F.aggregate("e", F.lit(0).cast("bigint"), lambda n, x: n + x["size"]).alias("n_bytes"), first.alias("first_ms"),
            F.col("e.seq").alias("seqs"),
        )
        opened = still.select(*keys, first.alias("first_ms"), F.transform("e", lambda x: F.struct(x["seq"].alias("seq"), x["size"].alias("size"))).alias("entries"))
        ended = at_end.join(still, same(at_end, still, keys), "left_anti").select(*keys)
        return out, opened.unionByName(ended, allowMissingColumns=True)

    def timers(state: DataFrame, now: int) -> tuple[DataFrame, DataFrame]:
        due = materialise(state.where(F.floor(F.lit(now) / 1000) - F.floor(F.col("first_ms") / 1000) >= age), "due")
        out = due.select(
            *keys, F.element_at("entries", 1)["seq"].alias("batch_first"), F.size("entries").alias("n_entries"),
            F.aggregate("entries", F.lit(0).cast("bigint"), lambda n, x: n + x["size"]).alias("n_bytes"), "first_ms", F.col("entries.seq").alias("seqs"),
        )
        return out, due.select(*keys, F.lit(None).cast("bigint").alias("first_ms"), F.lit(None).cast("array<struct<seq:long,size:long>>").alias("entries"))

    return Step(run, OPEN, BATCH_SCHEMA, keys=keys, alive="first_ms IS NOT NULL", time=F.unix_millis("ts"), timers=timers if tick else None)
