"""Batches, rate limits and schedules over event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators import limiter, packing as P, pacing
from spillway.operators.normalize import to_entries, with_wire_text
from spillway.operators.ordering import number_rows, stage
from spillway.operators.rejection import bisect
from spillway.plans import adapters as A
from spillway.plans.catalog.records import ENTRY_SQL
from spillway.plans.catalog.registry import query
from spillway.plans.normalise_logs import normalise_logs
from spillway.sources.ingest import request_bodies

DOMAIN = ["app", "proc"]
ORDER = ["ts", "seq"]
BYTES = 4096
AGE = 3600


def _sized(spark, d):
    rows = A.raw_log(spark, d).select(*DOMAIN, "seq", "ts")
    return rows.withColumn("sz", F.lit(200) + F.col("seq") * 37 % 900)


def pack_sql(base: str, dom: list[str], n: int | str, size: int | None = None, age: int | str | None = None, tick: bool = False) -> str:
    """Greedy packing as a chain of batch starts, followed row by row.

    ``base`` defines a table ``base`` with the domain, ``seq, rn, sz, sec``.
    """
    keys = ", ".join(dom)
    on = lambda x, y: " AND ".join(f"{x}.{c} = {y}.{c}" for c in dom)
    ends = [f"rn + {n}"]
    if size is not None:
        # Rows whose end stays within the budget of a batch opened here, this one in any case.
        ends.append(
            f"rn + count(*) OVER (PARTITION BY {keys} ORDER BY e RANGE BETWEEN CURRENT ROW AND greatest({size} - sz, 0) FOLLOWING)"
        )
    if age is not None:
        old = f"count(*) OVER (PARTITION BY {keys} ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND {age} - 1 FOLLOWING)"
        ends.append(old if tick else f"{old} + 1")
    return f"""
WITH RECURSIVE {base},
pre AS (SELECT *, CAST(sum(sz) OVER (PARTITION BY {keys} ORDER BY rn) AS BIGINT) AS e FROM base),
nxt AS (SELECT {keys}, rn, least({', '.join(ends)}) AS nx FROM pre),
chain AS (
  SELECT DISTINCT {keys}, CAST(0 AS BIGINT) AS st FROM base
  UNION ALL
  SELECT {', '.join('c.' + c for c in dom)}, CAST(n.nx AS BIGINT) FROM chain c JOIN nxt n ON {on('n', 'c')} AND n.rn = c.st
),
packed AS (SELECT b.*, max(c.st) OVER (PARTITION BY {', '.join('b.' + c for c in dom)} ORDER BY b.rn) AS batch_start
  FROM base b LEFT JOIN chain c ON {on('b', 'c')} AND b.rn = c.st)
"""


EVENT_BASE = f"""{A.RAW_SQL},
base AS (SELECT app, proc, seq, ts, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn,
         200 + seq * 37 % 900 AS sz, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM raw)"""
ROWS = "SELECT app, proc, seq, CAST(batch_start AS BIGINT) AS batch_start FROM packed"


@query("pack_count", f"""
WITH {A.RAW_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw)
SELECT app, proc, seq, rn // 100 * 100 AS batch_start FROM n
""")
def pack_count(spark, d):
    """A size of 500 is capped at 100."""
    return P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER, 500).select(*DOMAIN, "seq", "batch_start")


@query("pack_bytes", pack_sql(EVENT_BASE, DOMAIN, 10, size=BYTES) + ROWS)
def pack_bytes(spark, d):
    packed = P.pack(_sized(spark, d), DOMAIN, ORDER, batch_size=10, size=F.col("sz"), max_bytes=BYTES)
    return packed.select(*DOMAIN, "seq", "batch_start")


@query("pack_age_push", pack_sql(EVENT_BASE, DOMAIN, 10, age=AGE) + ROWS)
def pack_age_push(spark, d):
    packed = P.pack(_sized(spark, d), DOMAIN, ORDER, batch_size=10, at=F.col("ts"), flush_interval=AGE)
    return packed.select(*DOMAIN, "seq", "batch_start")


@query("pack_age_tick", pack_sql(EVENT_BASE, DOMAIN, 10, size=BYTES, age=AGE, tick=True) + ROWS)
def pack_age_tick(spark, d):
    packed = P.pack(
        _sized(spark, d), DOMAIN, ORDER, batch_size=10, size=F.col("sz"), max_bytes=BYTES,
        at=F.col("ts"), flush_interval=AGE, tick=True,
    )
    return packed.select(*DOMAIN, "seq", "batch_start")


@query("pack_bytes_blocks", pack_sql(EVENT_BASE, DOMAIN, 10, size=BYTES) + ROWS)
def pack_bytes_blocks(spark, d):
    """Blocks so small that every process is cut into many, whose functions are composed over levels."""
    packed = P.pack(_sized(spark, d), DOMAIN, ORDER, batch_size=10, size=F.col("sz"), max_bytes=BYTES, block_rows=12)
    return packed.select(*DOMAIN, "seq", "batch_start")


@query("pack_age_blocks", pack_sql(EVENT_BASE, DOMAIN, 10, age=AGE) + ROWS)
def pack_age_blocks(spark, d):
    packed = P.pack(_sized(spark, d), DOMAIN, ORDER, batch_size=10, at=F.col("ts"), flush_interval=AGE, block_rows=100)
    return packed.select(*DOMAIN, "seq", "batch_start")


UNIT_BASE = f"""{A.RAW_SQL},
base AS (SELECT app, proc, seq // 50 AS unit_id, seq, ts,
         row_number() OVER (PARTITION BY app, proc, seq // 50 ORDER BY ts, seq) - 1 AS rn,
         200 + seq * 37 % 900 AS sz, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM raw)"""


@query("pack_units", pack_sql(UNIT_BASE, [*DOMAIN, "unit_id"], 4, size=BYTES)
       + "SELECT app, proc, unit_id, seq, CAST(batch_start AS BIGINT) AS batch_start FROM packed")
def pack_units(spark, d):
    """The end of a request, command or worker closes its batch."""
    rows = _sized(spark, d).withColumn("unit_id", F.floor(F.col("seq") / 50).cast("bigint"))
    packed = P.pack(rows, [*DOMAIN, "unit_id"], ORDER, batch_size=4, size=F.col("sz"), max_bytes=BYTES)
    return packed.select(*DOMAIN, "unit_id", "seq", "batch_start")


@query("pack_unbuffered", f"""
WITH {A.RAW_SQL}, cmd AS (SELECT *, CASE WHEN seq % 5 = 0 THEN seq END AS unit FROM raw),
n AS (SELECT *, row_number() OVER (PARTITION BY app, proc, unit ORDER BY ts, seq) - 1 AS rn FROM cmd),
b AS (SELECT app, proc, unit, rn // 100 AS batch, count(*) AS n_entries FROM n GROUP BY ALL)
SELECT app, proc, count(*) AS batches, CAST(sum(n_entries) AS BIGINT) AS entries, max(n_entries) AS largest FROM b GROUP BY ALL
""")
def pack_unbuffered(spark, d):
    command = F.when(F.col("seq") % 5 == 0, "schedule:work").otherwise("queue:work")
    rows = A.raw_log(spark, d).withColumn("unit", P.unbuffered_key(command, F.col("seq")))
    packed = P.pack_by_count(rows, [*DOMAIN, "unit"], ORDER)
    batches = packed.groupBy(*DOMAIN, "unit", "batch_start").agg(F.count(F.lit(1)).alias("n_entries"))
    return batches.groupBy(*DOMAIN).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("n_entries").alias("entries"), F.max("n_entries").alias("largest")
    )


@query("batch_summary", pack_sql(EVENT_BASE, DOMAIN, 10, size=BYTES) + """
SELECT app, proc, CAST(batch_start AS BIGINT) AS batch_start, count(*) AS n_entries, CAST(sum(sz) AS BIGINT) AS n_bytes,
       epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM packed GROUP BY ALL
""")
def batch_summary(spark, d):
    packed = P.pack(_sized(spark, d), DOMAIN, ORDER, batch_size=10, size=F.col("sz"), max_bytes=BYTES)
    out = P.summarise_batches(packed, DOMAIN)
    return out.select(
        *DOMAIN, "batch_start", "n_entries", "n_bytes",
        F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"),
    )


@query("ingest_body", f"""
WITH {A.RAW_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn, {ENTRY_SQL} AS entry FROM raw)
SELECT app, proc, rn // 20 * 20 AS batch_start, count(*) AS n_entries,
       '{{"logs":[' || string_agg(entry, ',' ORDER BY rn) || ']}}' AS body
FROM n GROUP BY app, proc, rn // 20 * 20
""")
def ingest_body(spark, d):
    entries = with_wire_text(to_entries(A.raw_log(spark, d))).select(*DOMAIN, *ORDER, "entry")
    plan = P.pack_by_count(entries, DOMAIN, ORDER, 20)
    return request_bodies(P.attach(entries, plan, [*DOMAIN, *ORDER]), DOMAIN)


@query("split_halves", f"""
WITH RECURSIVE {A.RAW_SQL},
n AS (SELECT app, proc, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw),
b AS (SELECT app, proc, rn // 100 AS batch, count(*) AS n FROM n GROUP BY ALL),
piece AS (
  SELECT app, proc, batch, CAST(0 AS BIGINT) AS low, n AS size FROM b
  UNION ALL
  SELECT app, proc, batch, h.low, h.size FROM piece,
    LATERAL (VALUES (low, (size + 1) // 2), (low + (size + 1) // 2, size - (size + 1) // 2)) AS h(low, size)
  WHERE piece.size > 30
)
SELECT app, proc, batch, low, size FROM piece WHERE size <= 30
""")
def split_halves(spark, d):
    """An endpoint that takes 30 entries at most makes every larger batch fall into halves."""
    packed = P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER).withColumn("batch", pacing.div(F.col("rn"), F.lit(100)))
    sizes = packed.groupBy(*DOMAIN, "batch").agg(F.count(F.lit(1)).alias("n"))
    rows = packed.join(sizes, [*DOMAIN, "batch"]).withColumn("pos", F.col("rn") % 100)
    return P.halve(rows, "pos", "n", 30).select(*DOMAIN, "batch", F.col("piece").alias("low"), "size").distinct()


@query("bisect_rejected", f"""
WITH RECURSIVE {A.RAW_SQL},
r AS (SELECT app, proc, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn, seq % 97 = 0 AS bad FROM raw),
e AS (SELECT app || '-' || proc || '-' || rn // 100 AS batch_id, rn % 100 AS pos, bad FROM r),
piece AS (
  SELECT batch_id, CAST(0 AS BIGINT) AS low, count(*) AS size, bool_or(bad) AS refused FROM e GROUP BY batch_id
  UNION ALL
  SELECT h.batch_id, h.low, h.size, h.refused FROM (
    SELECT p.batch_id, CASE WHEN e.pos < p.low + (p.size + 1) // 2 THEN p.low ELSE p.low + (p.size + 1) // 2 END AS low,
           count(*) AS size, bool_or(e.bad) AS refused
    FROM piece p JOIN e ON e.batch_id = p.batch_id AND e.pos >= p.low AND e.pos < p.low + p.size
    WHERE p.refused AND p.size > 1
    GROUP BY p.batch_id, p.low, p.size, 2) h
)
SELECT batch_id, low AS piece, size, CAST(refused AS BIGINT) AS quarantined FROM piece WHERE NOT (refused AND size > 1)
""")
def bisect_rejected(spark, d):
    packed = P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER)
    rows = packed.select(
        F.concat_ws("-", "app", "proc", pacing.div(F.col("rn"), F.lit(100))).alias("batch_id"),
        (F.col("rn") % 100).alias("pos"), "seq",
    )
    out = bisect(rows, F.col("seq") % 97 == 0)
    return out.groupBy("batch_id", "piece", "size").agg(F.max(F.col("quarantined").cast("bigint")).alias("quarantined"))


# ------------------------------------------------------------ limits and paces

LIMIT = 11
TOKEN = ["token"]
REQUEST_SQL = """
req AS (SELECT user_id % 4 AS token, event_id AS seq, epoch_us(ts) // 200000 AS t,
        row_number() OVER (PARTITION BY user_id % 4 ORDER BY epoch_us(ts) // 200000, event_id) - 1 AS rn FROM events)"""
T_MS, TAU_MS = limiter.limits(LIMIT)


def _requests(spark, d):
    return A.events(spark, d).select(
        (F.col("user_id") % 4).alias("token"), F.col("event_id").alias("seq"), pacing.div(F.col("ms"), F.lit(200)).alias("t")
    )


@query("gcra_params", """
SELECT CAST(p_partkey AS BIGINT) AS part, CAST(p_size * 10 - 10 AS BIGINT) AS per_minute,
  CASE WHEN p_size > 1 THEN CAST(ceil(60000.0 / (p_size * 10 - 10)) AS BIGINT) ELSE -1 END AS interval_ms,
  CASE WHEN p_size > 1 THEN CAST((ceil((p_size * 10 - 10) / 10.0) - 1) * ceil(60000.0 / (p_size * 10 - 10)) AS BIGINT) ELSE -1 END AS tolerance_ms
FROM part
""")
def gcra_params(spark, d):
    """A limit of 0 means unlimited: no interval at all."""
    per_minute = (F.col("p_size") * 10 - 10).cast("bigint")
    return A.table(spark, d, "part").select(
        F.col("p_partkey").alias("part"), per_minute.alias("per_minute"),
        F.coalesce(limiter.interval_ms(per_minute), F.lit(-1)).alias("interval_ms"),
        F.coalesce(limiter.tolerance_ms(per_minute), F.lit(-1)).alias("tolerance_ms"),
    )


@query("gcra_shape", f"""
WITH RECURSIVE {REQUEST_SQL},
served AS (
  SELECT token, seq, rn, t, t AS departs_ms, t + {T_MS} AS tat FROM req WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, q.t, greatest(q.t, s.tat - {TAU_MS}), greatest(s.tat, q.t) + {T_MS}
  FROM served s JOIN req q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, departs_ms, departs_ms - t AS waits_ms FROM served
""")
def gcra_shape(spark, d):
    return limiter.shape(_requests(spark, d), TOKEN, ["t", "seq"], "t", LIMIT).select(
        "token", "seq", "departs_ms", "waits_ms"
    )


@query("gcra_police", f"""
WITH RECURSIVE {REQUEST_SQL},
seen AS (
  SELECT token, seq, rn, t + {T_MS} AS tat, CAST(1 AS BIGINT) AS granted FROM req WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, CASE WHEN s.tat - {TAU_MS} <= q.t THEN greatest(s.tat, q.t) + {T_MS} ELSE s.tat END,
         CAST(s.tat - {TAU_MS} <= q.t AS BIGINT)
  FROM seen s JOIN req q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, granted FROM seen
""")
def gcra_police(spark, d):
    out = limiter.police(_requests(spark, d), TOKEN, ["t", "seq"], "t", LIMIT)
    return out.select("token", "seq", F.col("granted").cast("bigint").alias("granted"))


# Tokens with limits of their own; the last is unlimited.
OWN_LIMIT_SQL = f"""{REQUEST_SQL},
lim AS (SELECT *, CASE WHEN token = 3 THEN 0 ELSE CAST(ceil(60000.0 / (6 + token * 5)) AS BIGINT) END AS step,
        CASE WHEN token = 3 THEN 0 ELSE CAST((ceil((6 + token * 5) / 10.0) - 1) * ceil(60000.0 / (6 + token * 5)) AS BIGINT) END AS tol FROM req)"""


def _own_limits(spark, d):
    return _requests(spark, d).withColumn("per_minute", F.when(F.col("token") < 3, 6 + F.col("token") * 5).otherwise(0))


@query("gcra_shape_per_token", f"""
WITH RECURSIVE {OWN_LIMIT_SQL},
served AS (
  SELECT token, seq, rn, t, t AS departs_ms, t + step AS tat FROM lim WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, q.t, greatest(q.t, s.tat - q.tol), greatest(s.tat, q.t) + q.step
  FROM served s JOIN lim q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, departs_ms, departs_ms - t AS waits_ms FROM served
""")
def gcra_shape_per_token(spark, d):
    return limiter.shape(_own_limits(spark, d), TOKEN, ["t", "seq"], "t", "per_minute").select(
        "token", "seq", "departs_ms", "waits_ms"
    )


@query("gcra_police_per_token", f"""
WITH RECURSIVE {OWN_LIMIT_SQL},
seen AS (
  SELECT token, seq, rn, t + step AS tat, CAST(1 AS BIGINT) AS granted FROM lim WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, CASE WHEN s.tat - q.tol <= q.t THEN greatest(s.tat, q.t) + q.step ELSE s.tat END,
         CAST(s.tat - q.tol <= q.t AS BIGINT)
  FROM seen s JOIN lim q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, granted FROM seen
""")
def gcra_police_per_token(spark, d):
    """Blocks of 150 requests, so that limits also reach composed blocks."""
    out = limiter.police(_own_limits(spark, d), TOKEN, ["t", "seq"], "t", "per_minute", block_rows=150)
    return out.select("token", "seq", F.col("granted").cast("bigint").alias("granted"))


@query("gcra_police_paused", f"""
WITH RECURSIVE {REQUEST_SQL},
paused AS (SELECT *, max(CASE WHEN seq % 50 = 0 THEN t + (seq % 7) * 20000 ELSE 0 END)
             OVER (PARTITION BY token ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM req),
seen AS (
  SELECT token, seq, rn, t + {T_MS} AS tat, CAST(1 AS BIGINT) AS granted FROM paused WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn,
         CASE WHEN s.tat - {TAU_MS} <= q.t AND q.until <= q.t THEN greatest(s.tat, q.t) + {T_MS} ELSE s.tat END,
         CAST(s.tat - {TAU_MS} <= q.t AND q.until <= q.t AS BIGINT)
  FROM seen s JOIN paused q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, granted FROM seen
""")
def gcra_police_paused(spark, d):
    """Every 50th answer asks all senders of the token to pause; later requests honour it."""
    from spillway.operators.ordering import Scan, scan

    asked = F.when(F.col("seq") % 50 == 0, F.col("t") + F.col("seq") % 7 * 20_000).otherwise(0)
    staged = stage(_requests(spark, d), TOKEN, ["t", "seq"])
    known = scan(staged, TOKEN, {"until": Scan("max", asked, before=True)}).drop("_pos", "_part")
    out = limiter.police(known, TOKEN, ["t", "seq"], "t", LIMIT, paused_until_ms="until")
    return out.select("token", "seq", F.col("granted").cast("bigint").alias("granted"))


@query("pause_merge", f"""
WITH {REQUEST_SQL}
SELECT token, seq, coalesce(max(CASE WHEN seq % 10 > 0 THEN t + seq % 10 * 7000 END) OVER (PARTITION BY token ORDER BY rn), 0) AS paused_until_ms FROM req
""")
def pause_merge(spark, d):
    rows = _requests(spark, d).withColumn("ask", F.col("seq") % 10 * 7)
    return limiter.pauses(rows, TOKEN, ["t", "seq"], "t", "ask").select("token", "seq", "paused_until_ms")


@query("window_audit", f"""
WITH {REQUEST_SQL}, m AS (SELECT token, t, count(*) AS requests FROM req GROUP BY ALL)
SELECT token, t, requests,
       CAST(sum(requests) OVER (PARTITION BY token ORDER BY t RANGE BETWEEN 59999 PRECEDING AND CURRENT ROW) AS BIGINT) AS in_window FROM m
""")
def window_audit(spark, d):
    return limiter.requests_in_window(_requests(spark, d), TOKEN, ["t"], "t")


@query("inline_pacing", f"""
WITH RECURSIVE {REQUEST_SQL},
sent AS (
  SELECT token, seq, rn, t AS slot_ms FROM req WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, greatest(q.t, s.slot_ms + {T_MS}) FROM sent s JOIN req q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, slot_ms FROM sent
""")
def inline_pacing(spark, d):
    return limiter.pace_inline(_requests(spark, d), TOKEN, ["t", "seq"], "t", LIMIT).select("token", "seq", "slot_ms")


# Runs with deadlines, and answers of which one asks for a long wait.
STOP_SQL = f"""{REQUEST_SQL},
ask AS (SELECT *, CASE WHEN token = 1 THEN 8520336000 + 6000000 WHEN token = 3 THEN 8520336000 + 12960000 END AS deadline,
               CASE WHEN token IN (2, 3) AND seq > 600 AND seq % 50 < 10 THEN 601 ELSE seq % 601 END AS wait FROM req)"""


@query("inline_stops", f"""
WITH RECURSIVE {STOP_SQL},
sent AS (
  SELECT token, seq, rn, t AS slot, coalesce(t >= deadline, false) AS unsent, coalesce(t >= deadline, false) OR wait > 600 AS stopped FROM ask WHERE rn = 0
  UNION ALL
  SELECT q.token, q.seq, q.rn, greatest(q.t, s.slot + {T_MS}), s.stopped OR coalesce(greatest(q.t, s.slot + {T_MS}) >= q.deadline, false),
         s.stopped OR coalesce(greatest(q.t, s.slot + {T_MS}) >= q.deadline, false) OR q.wait > 600
  FROM sent s JOIN ask q ON q.token = s.token AND q.rn = s.rn + 1
)
SELECT token, seq, CASE WHEN NOT unsent THEN slot END AS slot_ms FROM sent
""")
def inline_stops(spark, d):
    """Inline pacing that stops at a run's deadline and after an answer that asks to wait too long."""
    token, seq, base = F.col("token"), F.col("seq"), 8_520_336_000
    deadline = F.when(token == 1, F.lit(base + 6_000_000)).when(token == 3, F.lit(base + 12_960_000))
    wait = F.when(token.isin(2, 3) & (seq > 600) & (seq % 50 < 10), 601).otherwise(seq % 601)
    rows = _requests(spark, d).withColumns({"deadline": deadline, "wait": wait})
    out = limiter.pace_inline(rows, TOKEN, ["t", "seq"], "t", LIMIT, deadline_ms="deadline", wait_sec="wait", max_wait=600)
    return out.select("token", "seq", "slot_ms")


@query("pace_schedule", f"""
WITH {A.RAW_SQL}, n AS (SELECT app, proc, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw),
b AS (SELECT app, proc, rn // 10 * 10 AS batch_start FROM n GROUP BY ALL),
o AS (SELECT *, row_number() OVER (ORDER BY app, proc, batch_start) - 1 AS batch_no FROM b)
SELECT app, proc, batch_start, batch_no, 30 + 60 * batch_no // 45 AS due_in FROM o
""")
def pace_schedule(spark, d):
    """All batches of one run in one order, without a single-task sort."""
    batches = (
        P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER, 10).select(*DOMAIN, "batch_start").distinct()
        .withColumn("run", F.lit(0)).withColumn("start_in", F.lit(30).cast("bigint"))
    )
    out = pacing.schedule(batches, ["run"], [*DOMAIN, "batch_start"], pacing.default_rate(50), "start_in")
    return out.select(*DOMAIN, "batch_start", "batch_no", "due_in")


@query("batch_limit", f"""
WITH {A.RAW_SQL}, n AS (SELECT app, proc, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw),
b AS (SELECT app, proc, rn // 10 AS batch_no, count(*) AS n_entries FROM n GROUP BY ALL)
SELECT app, proc, batch_no, n_entries FROM b WHERE batch_no < 7
""")
def batch_limit(spark, d):
    """At most seven batches per process and run."""
    packed = P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER, 10)
    batches = packed.groupBy(*DOMAIN, pacing.div(F.col("rn"), F.lit(10)).alias("batch_no")).agg(F.count(F.lit(1)).alias("n_entries"))
    return pacing.first_batches(batches, 7)


# ------------------------------------------------------------------- flagship

FLAGSHIP_BASE = f"""{A.RAW_SQL}, {A.CONFIG_SQL},
kept AS (SELECT raw.* FROM raw JOIN config USING (app)
  WHERE url IS NOT NULL AND url NOT IN ('', '0') AND token IS NOT NULL AND token NOT IN ('', '0')
    AND NOT coalesce(lower(trim(enabled)) IN ('false', '0', 'off', 'no', ''), false)
    AND {A.RANK_SQL.format('level_name')} >= coalesce({A.RANK_SQL.format('channel_level')}, 300)
    AND ({A.RANK_SQL.format('min_level')} IS NULL OR {A.RANK_SQL.format('level_name')} >= {A.RANK_SQL.format('min_level')})),
wired AS (SELECT app, proc, seq, ts, {ENTRY_SQL} AS entry FROM kept),
base AS (SELECT app, proc, seq, entry, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn,
         strlen(entry) + length(entry) - length(replace(entry, '/', '')) + 1 AS sz,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM wired)"""


@query("normalise_logs", pack_sql(FLAGSHIP_BASE, DOMAIN, 100, size=BYTES, age=AGE) + """
SELECT app, proc, seq, entry, CAST(sz AS BIGINT) AS entry_bytes, rn, CAST(batch_start AS BIGINT) AS batch_start FROM packed
""")
def normalise(spark, d):
    out = normalise_logs(A.raw_log(spark, d), A.app_config(spark, d), max_bytes=BYTES, flush_interval=AGE)
    return out.select(*DOMAIN, "seq", "entry", "entry_bytes", "rn", "batch_start")


PER_APP_BASE = FLAGSHIP_BASE.replace(
    "base AS (SELECT app,", "base AS (SELECT 10 + app % 5 * 20 AS own_n, 600 + app * 300 AS own_age, app,"
)


@query("normalise_logs_per_app", pack_sql(PER_APP_BASE, DOMAIN, "own_n", size=BYTES, age="own_age") + """
SELECT app, proc, seq, entry, CAST(sz AS BIGINT) AS entry_bytes, rn, CAST(batch_start AS BIGINT) AS batch_start FROM packed
""")
def normalise_per_app(spark, d):
    app = F.col("app")
    config = A.app_config(spark, d).withColumns({"batch_size": 10 + app % 5 * 20, "flush_interval_sec": 600 + app * 300})
    out = normalise_logs(A.raw_log(spark, d), config, max_bytes=BYTES, per_app=True)
    return out.select(*DOMAIN, "seq", "entry", "entry_bytes", "rn", "batch_start")


@query("batch_numbers", f"""
WITH {A.RAW_SQL}, n AS (SELECT app, proc, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw),
b AS (SELECT app, proc, rn // 50 * 50 AS batch_start, count(*) AS n_entries FROM n GROUP BY ALL)
SELECT app, proc, batch_start, n_entries, row_number() OVER (PARTITION BY app, proc ORDER BY batch_start) - 1 AS batch_no FROM b
""")
def batch_numbers(spark, d):
    packed = P.pack_by_count(A.raw_log(spark, d), DOMAIN, ORDER, 50)
    batches = packed.groupBy(*DOMAIN, "batch_start").agg(F.count(F.lit(1)).alias("n_entries"))
    return number_rows(stage(batches, DOMAIN, ["batch_start"]), DOMAIN, "batch_no").drop("_pos", "_part")
