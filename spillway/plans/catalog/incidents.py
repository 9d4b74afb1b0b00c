"""Exception groups, deploys that resolve them, regressions and outages."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators import incidents as I
from spillway.operators.trail import request_trail
from spillway.plans import adapters as A
from spillway.plans.catalog.registry import query
from spillway.streaming import run_available

#: Seconds between heartbeats.
BEAT = 1800


@query("next_deploy", f"""
WITH {A.OCCURRENCES_SQL}
SELECT app, seq, (SELECT min(version) FROM deploys d WHERE d.app = o.app AND d.ts > o.ts) AS version FROM occurrences o
""")
def next_deploy(spark, d):
    found = I.next_deploys(A.occurrences(spark, d), A.deploys(spark, d))
    return found.select("app", "seq", F.col("deploy.version").alias("version"))


@query("exception_groups", f"""
WITH {A.OCCURRENCES_SQL}
SELECT app, fingerprint, coalesce(any_value(class), '') AS class, any_value(template) AS template, coalesce(any_value(frame), '') AS frame, count(*) AS n,
       count(DISTINCT message) + CAST(count(*) > count(message) AS BIGINT) AS n_messages,
       min(epoch_us(ts)) AS first_us, min(seq) AS first_seq, max(epoch_us(ts)) AS last_us, max(seq) AS last_seq, arg_max(message, seq) AS last_message
FROM occurrences GROUP BY app, fingerprint
""")
def exception_groups(spark, d):
    return I.group_exceptions(A.occurrences(spark, d)).select(
        "app", "fingerprint", "class", "template", "frame", "n", "n_messages", F.unix_micros("first.ts").alias("first_us"), F.col("first.seq").alias("first_seq"),
        F.unix_micros("last.ts").alias("last_us"), F.col("last.seq").alias("last_seq"), F.col("last.message").alias("last_message"),
    )


@query("group_resolution", f"""
WITH {A.OCCURRENCES_SQL},
g AS (SELECT app, fingerprint, count(*) AS n, max(ts) AS last FROM occurrences GROUP BY app, fingerprint),
r AS (SELECT *, (SELECT min(version) FROM deploys d WHERE d.app = g.app AND d.ts > g.last) AS version FROM g)
SELECT app, fingerprint, n, version, CASE WHEN version IS NULL THEN 'open' ELSE 'resolved' END AS state FROM r
""")
def group_resolution(spark, d):
    found = I.resolved_groups(I.group_exceptions(A.occurrences(spark, d)), A.deploys(spark, d))
    return found.select("app", "fingerprint", "n", F.col("deploy.version").alias("version"), "state")


@query("group_regressions", f"""
WITH RECURSIVE {A.OCCURRENCES_SQL},
signals AS (
  SELECT app, fingerprint, ts, 1 AS kind, CAST(seq AS VARCHAR) AS id FROM occurrences
  UNION ALL
  SELECT DISTINCT g.app, g.fingerprint, d.ts, 0, CAST(d.version AS VARCHAR) FROM (SELECT DISTINCT app, fingerprint FROM occurrences) g JOIN deploys d ON d.app = g.app
), q AS (
  SELECT *, row_number() OVER (PARTITION BY app, fingerprint ORDER BY ts, kind, id) AS rn FROM signals
), walk AS (
  SELECT app, fingerprint, ts, kind, id, rn, 'new' AS before, CASE kind WHEN 1 THEN 'open' ELSE 'new' END AS after FROM q WHERE rn = 1
  UNION ALL
  SELECT q.app, q.fingerprint, q.ts, q.kind, q.id, q.rn, w.after,
         CASE WHEN q.kind = 0 THEN CASE w.after WHEN 'new' THEN 'new' ELSE 'resolved' END
              ELSE CASE w.after WHEN 'new' THEN 'open' WHEN 'open' THEN 'open' ELSE 'reopened' END END
  FROM walk w JOIN q ON q.app = w.app AND q.fingerprint = w.fingerprint AND q.rn = w.rn + 1
)
SELECT app, fingerprint, epoch_us(ts) AS at_us, id, before, after FROM walk WHERE before <> after
""")
def group_regressions(spark, d):
    found = I.regressions(A.occurrences(spark, d), A.deploys(spark, d))
    return found.select("app", "fingerprint", F.unix_micros("ts").alias("at_us"), "id", "before", "after")


BEATS_SQL = f"""
beats AS (SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'main' ELSE 'app-' || (user_id % 8) END AS app, epoch_us(ts) AS us FROM events),
ends AS (SELECT app, us AS last_us, us + CAST({I.MISSED * BEAT} AS BIGINT) * 1000000 AS offline_us, lead(us) OVER (PARTITION BY app ORDER BY us) AS back_us,
                (SELECT max(us) FROM beats) AS until FROM beats)"""


@query("offline_gaps", f"""
WITH {BEATS_SQL}
SELECT app, last_us, offline_us, back_us FROM ends WHERE offline_us <= coalesce(back_us, until)
""")
def offline_gaps(spark, d):
    gaps = I.outages(A.beats(A.events(spark, d)), BEAT)
    return gaps.select("app", F.unix_micros("last").alias("last_us"), F.unix_micros("offline_at").alias("offline_us"), F.unix_micros("back_at").alias("back_us"))


@query("stream_offline", f"""
WITH {BEATS_SQL},
-- A watermark counts milliseconds.
seen AS (SELECT *, until // 1000 * 1000 AS mark FROM ends)
SELECT app, last_us, offline_us FROM seen WHERE offline_us <= least(coalesce(back_us, mark), mark)
""")
def stream_offline(spark, d):
    """Apps that go offline, told while the stream runs."""
    gaps = run_available(I.closed_sessions(A.beats(A.event_stream(spark, d)), BEAT), "stream-offline")
    return gaps.select("app", F.unix_micros("last").alias("last_us"), F.unix_micros("offline_at").alias("offline_us"))


@query("request_trail", """
WITH l AS (
  SELECT CASE WHEN conv_id % 3 = 0 THEN 'req-main' ELSE 'req-' || (conv_id % 200) END AS request_id, conv_id, turn, coalesce(role, '') || ': ' || coalesce(text, '') AS line
  FROM conversations
), q AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY conv_id, turn, line) - 1 AS rn FROM l)
SELECT request_id, rn // 20 AS page, min(rn) AS first, count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY rn)) AS lines_sha256
FROM q GROUP BY request_id, rn // 20
""")
def trail(spark, d):
    """Turns as log lines; one request has a third of them."""
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    request = F.when(F.col("conv_id") % 3 == 0, "req-main").otherwise(F.concat(F.lit("req-"), F.col("conv_id") % 200))
    rows = A.table(spark, d, "conversations").select(request.alias("request_id"), "conv_id", "turn", line.alias("line"))
    pages = request_trail(rows, "request_id", ["conv_id", "turn", "line"], F.col("line"), page_rows=20)
    return pages.select("request_id", "page", "first", "n", F.sha2(F.array_join("entries", "\n"), 256).alias("lines_sha256"))
