"""The streaming operators over the events as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators.normalize import to_entries, with_wire_text
from spillway.operators import pacing
from spillway.plans import adapters as A
from spillway.plans.catalog.packing import OWN_LIMIT_SQL, AGE, DOMAIN, EVENT_BASE, FLAGSHIP_BASE, LIMIT, REQUEST_SQL, T_MS, TAU_MS, pack_sql
from spillway.plans.catalog.records import ENTRY_SQL
from spillway.plans.catalog.registry import query
from spillway.streaming import run_available
from spillway.streaming.stateless import normalised
from spillway.streaming.triggers import batching, policing, run_triggers, shaping


@query("stream_entries", f"WITH {A.RAW_SQL} SELECT app, seq, {ENTRY_SQL} AS entry FROM raw")
def stream_entries(spark, d):
    stream = with_wire_text(to_entries(A.records_of(A.event_stream(spark, d)))).select("app", "seq", "entry")
    return run_available(stream, "stream-entries")


@query("stream_wanted", f"WITH {FLAGSHIP_BASE} SELECT app, seq, entry FROM base")
def stream_wanted(spark, d):
    """The same behind all filters."""
    stream = normalised(A.records_of(A.event_stream(spark, d)), A.app_config(spark, d)).select("app", "seq", "entry")
    return run_available(stream, "stream-wanted")


@query("stream_batches_age", pack_sql(EVENT_BASE, DOMAIN, 10, size=4096, age=AGE) + f""",
b AS (SELECT app, proc, batch_start, min_by(seq, rn) AS first_seq, count(*) AS n_entries, CAST(sum(sz) AS BIGINT) AS n_bytes,
        max(sec) - min(sec) AS span FROM packed GROUP BY ALL),
m AS (SELECT *, max(batch_start) OVER (PARTITION BY app, proc) AS last FROM b)
SELECT CAST(app AS VARCHAR) AS app, CAST(proc AS VARCHAR) AS proc, first_seq, n_entries, n_bytes FROM m
WHERE batch_start < last OR n_entries = 10 OR span >= {AGE}
""")
def stream_batches_age(spark, d):
    """Batches that also close by age, with the entry that finds them too old."""
    rows = A.records_of(A.event_stream(spark, d)).select(
        *DOMAIN, "seq", "ts", (F.lit(200) + F.col("seq") * 37 % 900).alias("entry_bytes")
    )
    out = run_triggers(rows, batching(batch_size=10, max_bytes=4096, flush_interval=AGE), "stream-batches-age")
    return out.select(
        "app", "proc", F.col("batch_first").alias("first_seq"), F.col("n_entries").cast("bigint").alias("n_entries"), "n_bytes"
    )


@query("stream_batches_timer", pack_sql(EVENT_BASE, DOMAIN, 10, size=4096, age=AGE, tick=True) + f""",
b AS (SELECT app, proc, batch_start, min_by(seq, rn) AS first_seq, count(*) AS n_entries, CAST(sum(sz) AS BIGINT) AS n_bytes, min(sec) AS since FROM packed GROUP BY ALL),
m AS (SELECT *, max(batch_start) OVER (PARTITION BY app, proc) AS last FROM b)
SELECT CAST(app AS VARCHAR) AS app, CAST(proc AS VARCHAR) AS proc, first_seq, n_entries, n_bytes FROM m
WHERE batch_start < last OR n_entries = 10 OR (SELECT max(sec) FROM packed) - since >= {AGE}
""")
def stream_batches_timer(spark, d):
    """Batches that close on time, by a timer where no further entry of their process comes."""
    rows = A.records_of(A.event_stream(spark, d)).select(
        *DOMAIN, "seq", "ts", (F.lit(200) + F.col("seq") * 37 % 900).alias("entry_bytes")
    )
    out = run_triggers(rows, batching(batch_size=10, max_bytes=4096, flush_interval=AGE, tick=True), "stream-batches-timer")
    return out.select(
        "app", "proc", F.col("batch_first").alias("first_seq"), F.col("n_entries").cast("bigint").alias("n_entries"), "n_bytes"
    )


@query("stream_shape", f"""
WITH RECURSIVE {REQUEST_SQL},
served AS (
  SELECT token, seq, rn, t AS departs_ms, t + {T_MS} AS tat FROM req WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, greatest(q.t, s.tat - {TAU_MS}), greatest(s.tat, q.t) + {T_MS}
  FROM served s JOIN req q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT CAST(token AS VARCHAR) AS token, seq, departs_ms FROM served
""")
def stream_shape(spark, d):
    rows = A.event_stream(spark, d).select(
        (F.col("user_id") % 4).alias("token"), F.col("event_id").alias("seq"), pacing.div(F.col("ms"), F.lit(200)).alias("at_ms")
    )
    return run_triggers(rows, shaping(LIMIT), "stream-shape").select("token", "seq", "departs_ms")


@query("stream_batches", pack_sql(EVENT_BASE, DOMAIN, 10, size=4096) + """,
b AS (SELECT app, proc, batch_start, min_by(seq, rn) AS first_seq, count(*) AS n_entries, CAST(sum(sz) AS BIGINT) AS n_bytes FROM packed GROUP BY ALL),
m AS (SELECT *, max(batch_start) OVER (PARTITION BY app, proc) AS last FROM b)
SELECT CAST(app AS VARCHAR) AS app, CAST(proc AS VARCHAR) AS proc, first_seq, n_entries, n_bytes FROM m WHERE batch_start < last OR n_entries = 10
""")
def stream_batches(spark, d):
    """Batches that have closed; what is still open waits for the next entry."""
    rows = A.records_of(A.event_stream(spark, d)).select(
        *DOMAIN, "seq", "ts", (F.lit(200) + F.col("seq") * 37 % 900).alias("entry_bytes")
    )
    # A month of events: the age limit is out of the way.
    out = run_triggers(rows, batching(batch_size=10, max_bytes=4096, flush_interval=10**9), "stream-batches")
    return out.select(
        "app", "proc", F.col("batch_first").alias("first_seq"), F.col("n_entries").cast("bigint").alias("n_entries"), "n_bytes"
    )


@query("stream_police", f"""
WITH RECURSIVE {REQUEST_SQL},
seen AS (
  SELECT token, seq, rn, t + {T_MS} AS tat, CAST(1 AS BIGINT) AS granted FROM req WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, CASE WHEN s.tat - {TAU_MS} <= q.t THEN greatest(s.tat, q.t) + {T_MS} ELSE s.tat END,
         CAST(s.tat - {TAU_MS} <= q.t AS BIGINT)
  FROM seen s JOIN req q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT CAST(token AS VARCHAR) AS token, seq, granted FROM seen
""")
def stream_police(spark, d):
    rows = A.event_stream(spark, d).select(
        (F.col("user_id") % 4).alias("token"), F.col("event_id").alias("seq"),
        pacing.div(F.col("ms"), F.lit(200)).alias("at_ms"), F.lit(0).alias("pause_sec"),
    )
    out = run_triggers(rows, policing(LIMIT), "stream-police")
    return out.select("token", "seq", F.col("granted").cast("bigint").alias("granted"))


@query("stream_police_per_token", f"""
WITH RECURSIVE {OWN_LIMIT_SQL},
seen AS (
  SELECT token, seq, rn, t + step AS tat, CAST(1 AS BIGINT) AS granted FROM lim WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, CASE WHEN s.tat - q.tol <= q.t THEN greatest(s.tat, q.t) + q.step ELSE s.tat END,
         CAST(s.tat - q.tol <= q.t AS BIGINT)
  FROM seen s JOIN lim q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT CAST(token AS VARCHAR) AS token, seq, granted FROM seen
""")
def stream_police_per_token(spark, d):
    token = F.col("user_id") % 4
    rows = A.event_stream(spark, d).select(
        token.alias("token"), F.col("event_id").alias("seq"), pacing.div(F.col("ms"), F.lit(200)).alias("at_ms"), F.lit(0).alias("pause_sec"),
        F.when(token < 3, 6 + token * 5).otherwise(0).alias("per_minute"),
    )
    out = run_triggers(rows, policing("per_minute"), "stream-police-per-token")
    return out.select("token", "seq", F.col("granted").cast("bigint").alias("granted"))
