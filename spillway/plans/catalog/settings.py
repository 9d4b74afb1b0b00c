"""Effective configuration, heartbeats and deploys."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators.config import effective_config, etag_changes
from spillway.plans import adapters as A
from spillway.plans.catalog.registry import query
from spillway.sources.ingest import deploy_markers

# One input per rule: in range, above, below, not a number, absent.
REMOTES = [
    '{"httpTimeoutSeconds":12,"flushIntervalSeconds":25,"batchSize":64,"minLevel":"notice","enabled":true}',
    '{"httpTimeoutSeconds":"21","flushIntervalSeconds":61,"batchSize":"33","minLevel":["x"],"enabled":"no"}',
    '{"httpTimeoutSeconds":-4,"flushIntervalSeconds":0,"batchSize":9,"captureQueries":"on","enabled":null}',
    '{"httpTimeoutSeconds":"soon","flushIntervalSeconds":null,"batchSize":-1,"slowQueryThresholdMs":75}',
    '{"batchSize":250,"captureScheduled":null,"sampleRate":0.25,"contextTypeWhitelist":["mail","http"]}',
    '{"batchSize":null,"heartbeatIntervalSeconds":45,"redactionPatterns":7}',
    '{"batchSize":"lots","captureJobs":"no","redactionPatterns":["/[a-f]{4}/"]}',
    None,
]
# What each of REMOTES comes to, as rows in the same order.
EFFECTIVE = [
    # enabled, beat, queries, jobs, mails, scheduled, slow, timeout, flush, size, min_level, rate, types, patterns
    ("true", None, "false", "true", "true", "true", "1000", 12000, 25, 64, "notice", None, None, None),
    ("no", None, "false", "true", "true", "true", "1000", 20000, 60, 33, None, None, None, None),
    (None, None, "on", "true", "true", "true", "1000", 1000, 1, 10, None, None, None, None),
    ("true", None, "false", "true", "true", "true", "75", 5000, 10, 100, None, None, None, None),
    ("true", None, "false", "true", "true", None, "1000", 5000, 10, 250, None, "0.25", '["mail","http"]', None),
    ("true", "45", "false", "true", "true", "true", "1000", 5000, 10, 100, None, None, None, None),
    ("true", None, "false", "no", "true", "true", "1000", 5000, 10, 100, None, None, None, '["/[a-f]{4}/"]'),
    ("true", None, "false", "true", "true", "true", "1000", 5000, 10, 100, None, None, None, None),
]
COLUMNS = [
    "enabled", "heartbeat_interval_seconds", "capture_queries", "capture_jobs", "capture_mails", "capture_scheduled",
    "slow_query_ms", "timeout_ms", "flush_interval_sec", "batch_size", "min_level", "sample_rate",
    "context_type_whitelist", "redaction_patterns",
]


def _lit(v) -> str:
    return "CAST(NULL AS VARCHAR)" if v is None else str(v) if isinstance(v, int) else f"'{v}'"


_VALUES = ", ".join(f"({i}, {', '.join(_lit(v) for v in row)})" for i, row in enumerate(EFFECTIVE))


@query("effective_config", f"""
SELECT CAST(n_nationkey AS BIGINT) AS app, {', '.join('CAST(' + c + ' AS BIGINT) AS ' + c if c in ('timeout_ms', 'flush_interval_sec', 'batch_size') else c for c in COLUMNS)}
FROM nation JOIN (VALUES {_VALUES}) AS v(i, {', '.join(COLUMNS)}) ON n_nationkey % 8 = i
""")
def effective(spark, d):
    n = F.col("n_nationkey")
    remote = F.get(F.array(*[F.lit(r) for r in REMOTES]), (n % 8).cast("int"))
    apps = A.table(spark, d, "nation").select(n.cast("bigint").alias("app"), remote.alias("remote"))
    out = effective_config(apps)
    return out.select(
        "app", *[F.col(c).cast("bigint") if c in ("timeout_ms", "flush_interval_sec", "batch_size") else F.col(c) for c in COLUMNS]
    )


@query("etag_changes", """
WITH beats AS (SELECT user_id % 25 AS app, event_id AS seq, CASE WHEN event_id % 3 > 0 THEN 'v' || event_id // 400 END AS etag FROM events),
c AS (SELECT *, last_value(etag IGNORE NULLS) OVER (PARTITION BY app ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cached FROM beats)
SELECT app, seq, coalesce(cached, '-') AS cached_etag, CAST(etag IS NOT NULL AND (cached IS NULL OR cached <> etag) AS BIGINT) AS refresh FROM c
""")
def etags(spark, d):
    i = F.col("event_id")
    beats = A.events(spark, d).select(
        (F.col("user_id") % 25).alias("app"), i.alias("seq"),
        F.when(i % 3 > 0, F.concat(F.lit("v"), F.floor(i / 400))).alias("etag"),
    )
    out = etag_changes(beats, ["app"], ["seq"])
    return out.select(
        "app", "seq", F.coalesce("cached_etag", F.lit("-")).alias("cached_etag"), F.col("refresh").cast("bigint").alias("refresh")
    )


@query("deploy_markers", """
SELECT p_partkey AS part, '{"version":"v' || p_size || '"' || CASE WHEN p_partkey % 2 = 0 THEN ',"commitSha":"c' || p_partkey || '"' ELSE '' END ||
  ',"success":' || CASE WHEN p_partkey % 3 = 0 THEN 'false' ELSE 'true' END ||
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ',"metadata":{"brand":"' || p_brand || '","name":"' || p_name || '=' || p_type || '","k":""}' END || '}' AS marker
FROM part
""")
def markers(spark, d):
    k = F.col("p_partkey")
    pairs = F.array(
        F.concat(F.lit("brand="), "p_brand"), F.lit("name=first"), F.lit("=nokey"), F.lit("novalue"),
        F.concat(F.lit("name="), "p_name", F.lit("="), "p_type"), F.lit("k="),
    )
    deploys = A.table(spark, d, "part").select(
        k.alias("part"), F.concat(F.lit("v"), "p_size").alias("version"),
        F.when(k % 2 == 0, F.concat(F.lit("c"), k)).alias("commit_sha"), (k % 3 != 0).alias("success"),
        F.when(k % 4 == 0, F.array(F.lit("junk"))).otherwise(pairs).alias("pairs"),
    )
    return deploy_markers(deploys).select("part", "marker")
