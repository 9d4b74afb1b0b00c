"""Outcomes, retries and row rejections of observed attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.functions.text import retry_after_seconds
from spillway.operators import delivery as D, pacing, rejection as R
from spillway.plans import adapters as A
from spillway.plans.catalog.registry import query

_ROW = "job, attempt, part, supp"
_KEYS = ["job", "attempt", "part", "supp"]
OUTCOME_QUEUE_SQL = """CASE WHEN status BETWEEN 200 AND 299 THEN 'success' WHEN status = 429 THEN 'rate_limited'
  WHEN status BETWEEN 400 AND 499 AND status <> 408 THEN 'park' ELSE 'retry' END"""
OUTCOME_DRAIN_SQL = """CASE WHEN status BETWEEN 200 AND 299 THEN 'success' WHEN status = 429 THEN 'rate_limited'
  WHEN status IN (401, 403, 404, 405) THEN 'stop' WHEN status BETWEEN 400 AND 499 AND status <> 408 THEN 'reject' ELSE 'retry' END"""
BACKOFF_SQL = "CASE attempt WHEN 1 THEN 10 WHEN 2 THEN 30 WHEN 3 THEN 120 ELSE 300 END"
RETRY_SQL = "asked"


@query("outcome_queue", f"WITH {A.ATTEMPTS_SQL} SELECT {_ROW}, {OUTCOME_QUEUE_SQL} AS outcome FROM attempts")
def outcome_queue(spark, d):
    return A.attempts(spark, d).select(*_KEYS, D.outcome_queue(F.col("status")).alias("outcome"))


@query("outcome_drain", f"WITH {A.ATTEMPTS_SQL} SELECT {_ROW}, {OUTCOME_DRAIN_SQL} AS outcome FROM attempts")
def outcome_drain(spark, d):
    return A.attempts(spark, d).select(*_KEYS, D.outcome_drain(F.col("status")).alias("outcome"))


@query("retry_after", f"WITH {A.ATTEMPTS_SQL} SELECT {_ROW}, CAST({RETRY_SQL} AS BIGINT) AS seconds FROM attempts")
def retry_after(spark, d):
    return A.attempts(spark, d).select(*_KEYS, retry_after_seconds(F.col("retry_after"), F.col("now")).alias("seconds"))


@query("backoff_queue", f"WITH {A.ATTEMPTS_SQL} SELECT {_ROW}, CAST({BACKOFF_SQL} AS BIGINT) AS delay FROM attempts")
def backoff_queue(spark, d):
    return A.attempts(spark, d).select(*_KEYS, D.queue_backoff(F.col("attempt")).alias("delay"))


@query("deadlines", f"""
WITH {A.ATTEMPTS_SQL}
SELECT {_ROW}, now + greatest(0, attempt * 10 - 20) + greatest(60, supp % 120) AS deadline,
       coalesce(retry_deadline, now + greatest(60, supp % 120)) + 86400 AS worker_deadline FROM attempts
""")
def deadlines(spark, d):
    window = F.col("supp") % 120
    return A.attempts(spark, d).select(
        *_KEYS,
        D.retry_deadline(F.col("now"), F.col("attempt") * 10 - 20, window).alias("deadline"),
        D.worker_deadline(F.col("retry_deadline"), F.col("now"), window).alias("worker_deadline"),
    )


@query("deadline_fit", f"""
WITH {A.ATTEMPTS_SQL}
SELECT {_ROW}, CAST(retry_deadline IS NULL OR now + {BACKOFF_SQL} + 30 <= retry_deadline AS BIGINT) AS fits FROM attempts
""")
def deadline_fit(spark, d):
    fits = D.fits_before(F.col("now"), D.queue_backoff(F.col("attempt")), F.col("retry_deadline"))
    return A.attempts(spark, d).select(*_KEYS, fits.cast("bigint").alias("fits"))


@query("next_action", f"""
WITH {A.ATTEMPTS_SQL},
o AS (SELECT *, {OUTCOME_QUEUE_SQL} AS outcome,
        CASE WHEN status = 429 THEN {RETRY_SQL} ELSE {BACKOFF_SQL} END AS wait,
        CASE WHEN status IS NULL THEN 'Ingest unreachable:  ' || body || ' ' ELSE 'Ingest responded HTTP ' || status END AS cause FROM attempts),
b AS (SELECT *, coalesce(now + 30 > retry_deadline, false) AS expired,
        CASE WHEN retry_deadline IS NULL THEN 'job without a deadline is not retried' WHEN sync THEN 'sync queue can''t retry'
             WHEN now + wait + 30 > retry_deadline THEN 'retry window exhausted' END AS obstacle FROM o)
SELECT {_ROW},
  CASE WHEN expired THEN 'park' WHEN outcome = 'success' THEN 'done' WHEN outcome = 'park' OR obstacle IS NOT NULL THEN 'park' ELSE 'release' END AS action,
  CAST(CASE WHEN NOT expired AND outcome IN ('retry', 'rate_limited') AND obstacle IS NULL THEN wait ELSE -1 END AS BIGINT) AS delay,
  CASE WHEN expired THEN 'Retry window exhausted while waiting in the queue' WHEN outcome = 'success' THEN '-'
       WHEN outcome = 'park' THEN cause || '  ' || body ELSE cause || coalesce('; ' || obstacle, '') END AS reason
FROM b
""")
def next_action(spark, d):
    out = D.next_action(A.attempts(spark, d))
    return out.select(
        *_KEYS, "action", F.coalesce("delay", F.lit(-1)).cast("bigint").alias("delay"), F.coalesce("reason", F.lit("-")).alias("reason")
    )


@query("park_route", f"""
WITH {A.ATTEMPTS_SQL}
SELECT {_ROW}, CASE WHEN job % 3 = 0 THEN 'dropped' WHEN supp % 2 = 0 THEN 'dead_letter' ELSE 'failed_store' END AS route FROM attempts
""")
def park_route(spark, d):
    path = F.when(F.col("job") % 3 != 0, "/logs/dead.log")
    return A.attempts(spark, d).select(*_KEYS, D.park_route(path, F.col("supp") % 2 == 0).alias("route"))


@query("backoff_drain", f"""
WITH {A.ATTEMPTS_SQL},
k AS (SELECT supp, job, attempt, part, {OUTCOME_DRAIN_SQL} AS outcome,
        row_number() OVER (PARTITION BY supp ORDER BY job, attempt, part) AS rn FROM attempts),
g AS (SELECT *, count(*) FILTER (WHERE outcome IN ('success', 'reject')) OVER (PARTITION BY supp ORDER BY rn) AS resets FROM k),
f AS (SELECT *, count(*) FILTER (WHERE outcome = 'retry') OVER (PARTITION BY supp, resets ORDER BY rn) AS failures FROM g),
s AS (SELECT *, outcome = 'stop' OR (outcome = 'retry' AND failures >= 5) AS stops FROM f)
SELECT supp, job, attempt, part, outcome, failures,
  CASE WHEN outcome = 'retry' AND NOT stops THEN CAST(least(60, pow(2, failures)) AS BIGINT) ELSE -1 END AS wait_sec,
  CAST(stops AS BIGINT) AS stops,
  CAST(coalesce(bool_or(stops) OVER (PARTITION BY supp ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS BIGINT) AS after_stop
FROM s
""")
def backoff_drain(spark, d):
    rows = A.attempts(spark, d).select("supp", "job", "attempt", "part", "status")
    out = D.drain_backoff(rows, ["supp"], ["job", "attempt", "part"])
    return out.select(
        "supp", "job", "attempt", "part", "outcome", "failures",
        F.coalesce("wait_sec", F.lit(-1)).cast("bigint").alias("wait_sec"),
        F.col("stops").cast("bigint").alias("stops"), F.col("after_stop").cast("bigint").alias("after_stop"),
    )


@query("attempts_per_job", f"""
WITH {A.ATTEMPTS_SQL}, j AS (SELECT job, count(*) AS n FROM attempts GROUP BY job)
SELECT count(*) AS jobs, CAST(sum(n) AS BIGINT) AS attempts, max(n) AS most, count(*) FILTER (WHERE n > 2) AS over_two FROM j
""")
def attempts_per_job(spark, d):
    per_job = A.attempts(spark, d).groupBy("job").agg(F.count(F.lit(1)).alias("n"))
    return per_job.agg(
        F.count(F.lit(1)).alias("jobs"), F.sum("n").alias("attempts"), F.max("n").alias("most"),
        F.count_if(F.col("n") > 2).alias("over_two"),
    )


# ------------------------------------------------------------- rejected rows

NAMED_BODY = (
    '{"message":"bad","errors":{"logs.3.level":["bad level","worse"],"logs.17":"gone","logs.900.level":["x"],'
    '"other":["y"],"logs.3.message":[true,{"a":1}]}}'
)
REASONS_SQL = """(VALUES
  (CAST(3 AS BIGINT), 'HTTP 422: logs.3.level: bad level; logs.3.level: worse; logs.3.message: 1; logs.3.message: {"a":1}'),
  (CAST(17 AS BIGINT), 'HTTP 422: logs.17: gone')) AS named(pos, reason)"""
BATCHES_SQL = """
entries AS (SELECT 'b-' || (o_orderkey // 50) AS batch_id, o_orderkey // 50 AS b, o_orderkey % 50 AS pos, o_orderkey AS key FROM orders),
batches AS (SELECT batch_id, b, count(*) AS n FROM entries GROUP BY ALL)"""


def _entries(spark, d):
    key = F.col("o_orderkey")
    return A.table(spark, d, "orders").select(
        F.concat(F.lit("b-"), pacing.div(key, F.lit(50))).alias("batch_id"), (key % 50).alias("pos"), key.alias("key")
    )


def _responses(spark, d):
    """Refusals naming some rows, all rows or none; every fourth batch is accepted."""
    batches = _entries(spark, d).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_entries"))
    b = F.substring_index("batch_id", "-", -1).cast("bigint")
    each = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n_entries") - 1),
        lambda i: F.concat(F.lit('"logs.'), i.cast("string"), F.lit('.x":["e"]')),
    )
    body = (
        F.when(b % 4 == 0, F.lit(NAMED_BODY))
        .when(b % 4 == 1, F.concat(F.lit('{"errors":{'), F.array_join(each, ","), F.lit("}}")))
        .otherwise("too large")
    )
    return batches.select("batch_id", "n_entries", F.lit(422).alias("status"), body.alias("body"), b.alias("b")).filter(
        F.col("b") % 4 != 3
    )


@query("invalid_rows", f"""
WITH {BATCHES_SQL}
SELECT batch_id, pos, reason FROM batches, {REASONS_SQL} WHERE b % 4 = 0 AND pos < n
UNION ALL SELECT batch_id, pos, 'HTTP 422: logs.' || pos || '.x: e' FROM entries WHERE b % 4 = 1
""")
def invalid_rows(spark, d):
    return R.invalid_rows(_responses(spark, d))


@query("refused_order", f"""
WITH {BATCHES_SQL},
i AS (SELECT batch_id, pos, reason FROM batches, {REASONS_SQL} WHERE b % 4 = 0 AND pos < n
      UNION ALL SELECT batch_id, pos, 'HTTP 422: logs.' || pos || '.x: e' FROM entries WHERE b % 4 = 1)
SELECT batch_id, count(*) AS n_refused, string_agg(pos || ' ' || reason, chr(10) ORDER BY pos) AS refused FROM i GROUP BY batch_id
""")
def refused_order(spark, d):
    out = R.refused_in_order(R.invalid_rows(_responses(spark, d)))
    lines = F.transform("refused", lambda r: F.concat_ws(" ", r["pos"].cast("string"), r["reason"]))
    return out.select("batch_id", "n_refused", F.array_join(lines, "\n").alias("refused"))


@query("rejected_rows", f"""
WITH {BATCHES_SQL}
SELECT e.batch_id, e.pos, key, reason FROM entries e JOIN {REASONS_SQL} ON e.pos = named.pos WHERE b % 4 = 0
UNION ALL SELECT batch_id, pos, key, 'HTTP 422: logs.' || pos || '.x: e' FROM entries WHERE b % 4 = 1
""")
def rejected_rows(spark, d):
    return R.rejected_entries(_entries(spark, d), R.invalid_rows(_responses(spark, d))).select("batch_id", "pos", "key", "reason")


@query("remaining_rows", f"""
WITH {BATCHES_SQL}
SELECT batch_id, key, row_number() OVER (PARTITION BY batch_id ORDER BY pos) - 1 AS new_pos FROM entries
WHERE NOT (b % 4 = 0 AND pos IN (3, 17)) AND b % 4 <> 1
""")
def remaining_rows(spark, d):
    return R.remaining_entries(_entries(spark, d), R.invalid_rows(_responses(spark, d))).select("batch_id", "key", "new_pos")


@query("rejection_resolve", f"""
WITH {BATCHES_SQL}, j AS (SELECT e.*, n, named.reason AS named FROM entries e JOIN batches USING (batch_id)
  LEFT JOIN {REASONS_SQL} ON e.pos = named.pos AND e.b % 4 = 0 WHERE e.b % 4 <> 3),
k AS (SELECT *, CASE WHEN b % 4 = 1 THEN n ELSE count(named) OVER (PARTITION BY batch_id) END AS k FROM j),
f AS (SELECT *, CASE WHEN k > 0 AND k < n THEN CASE WHEN named IS NOT NULL THEN 'quarantine' ELSE 'resend' END
             WHEN k = 0 AND n > 1 THEN 'split' ELSE 'quarantine' END AS fate FROM k)
SELECT batch_id, pos, key, fate, CASE WHEN fate = 'split' THEN CAST(pos >= (n + 1) // 2 AS BIGINT) ELSE -1 END AS half FROM f
""")
def rejection_resolve(spark, d):
    out = R.resolve(_entries(spark, d), _responses(spark, d))
    return out.select("batch_id", "pos", "key", "fate", F.coalesce("half", F.lit(-1)).cast("bigint").alias("half"))


@query("rejection_messages", f"""
WITH {BATCHES_SQL}
SELECT count(*) AS n_rows, count(DISTINCT reason) AS n_reasons FROM (
  SELECT reason FROM batches, {REASONS_SQL} WHERE b % 4 = 0 AND pos < n
  UNION ALL SELECT 'HTTP 422: logs.' || pos || '.x: e' FROM entries WHERE b % 4 = 1)
""")
def rejection_messages(spark, d):
    rows = R.invalid_rows(_responses(spark, d))
    per_reason = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return per_reason.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_reasons"))
