"""Filters and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.constants import DELIVERY_JOB, MESSAGE_BYTES
from spillway.functions.text import (
    ascii_json,
    clip,
    finite_or_zero,
    json_bytes,
    rfc3339_ms,
    valid_utf8,
)
from spillway.operators import filters, normalize as N
from spillway.operators.ordering import number_rows, stage
from spillway.plans import adapters as A
from spillway.plans.catalog.registry import query
from spillway.session import materialise

WIDE_LOG_SQL = """
log AS (SELECT user_id % 25 AS app, event_id AS seq,
        CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'critical'
             WHEN 'signup' THEN 'warning' WHEN 'view' THEN 'notice' ELSE 'info' END AS level_name FROM events)"""


def _log(spark, d):
    return A.events(spark, d).select(
        (F.col("user_id") % 25).alias("app"),
        F.col("event_id").alias("seq"),
        A.level_of(F.col("event_type")).alias("level_name"),
    )


def _configured(spark, d, *settings):
    return filters.with_config(_log(spark, d), A.app_config(spark, d).select("app", *settings))


@query("configured_apps", f"""
WITH {WIDE_LOG_SQL}, {A.CONFIG_SQL}
SELECT log.app, seq FROM log JOIN config USING (app)
WHERE url IS NOT NULL AND url NOT IN ('', '0') AND token IS NOT NULL AND token NOT IN ('', '0')
""")
def configured_apps(spark, d):
    rows = _configured(spark, d, "url", "token")
    return rows.filter(filters.configured(F.col("url"), F.col("token"))).select("app", "seq")


@query("kill_switch", f"""
WITH {WIDE_LOG_SQL}, {A.CONFIG_SQL}
SELECT log.app, seq FROM log LEFT JOIN config USING (app)
WHERE NOT coalesce(lower(trim(enabled)) IN ('false', '0', 'off', 'no', ''), false)
""")
def kill_switch(spark, d):
    return _configured(spark, d, "enabled").filter(filters.switched_on(F.col("enabled"))).select("app", "seq")


@query("channel_level", f"""
WITH {WIDE_LOG_SQL}, {A.CONFIG_SQL}
SELECT log.app, seq FROM log LEFT JOIN config USING (app)
WHERE {A.RANK_SQL.format('level_name')} >= coalesce({A.RANK_SQL.format('channel_level')}, 300)
""")
def channel_level(spark, d):
    rows = _configured(spark, d, "channel_level")
    return rows.filter(filters.passes_channel(F.col("level_name"), F.col("channel_level"))).select("app", "seq")


@query("min_level", f"""
WITH {WIDE_LOG_SQL}, {A.CONFIG_SQL}
SELECT log.app, seq FROM log LEFT JOIN config USING (app)
WHERE {A.RANK_SQL.format('min_level')} IS NULL OR {A.RANK_SQL.format('level_name')} >= {A.RANK_SQL.format('min_level')}
""")
def min_level(spark, d):
    rows = _configured(spark, d, "min_level")
    return rows.filter(filters.passes_min_level(F.col("level_name"), F.col("min_level"))).select("app", "seq")


@query("own_failure", f"""
SELECT event_id FROM events
WHERE NOT (event_id % 5 = 0
  OR (event_id % 5 IN (1, 2) AND CASE WHEN event_id % 3 = 0 THEN event_id % 2 = 0 ELSE event_id % 4 = 0 END))
""")
def own_failure(spark, d):
    i = F.col("event_id")
    cls = (
        F.when(i % 5 == 0, "DeliveryFailed").when(i % 5 == 1, "MaxAttemptsExceeded")
        .when(i % 5 == 2, "TimeoutExceeded").otherwise("RuntimeError")
    )
    job = F.when(i % 3 == 0, F.when(i % 2 == 0, DELIVERY_JOB).otherwise("App\\Jobs\\Other"))
    message = F.concat(F.when(i % 4 == 0, DELIVERY_JOB).otherwise("App\\Jobs\\Other"), F.lit(" has timed out."))
    return A.events(spark, d).filter(~filters.is_own_failure(cls, job, message)).select("event_id")


@query("job_failure_mute", """
SELECT o_orderkey AS job FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def job_failure_mute(spark, d):
    name = F.when(F.col("o_orderpriority") == "5-LOW", DELIVERY_JOB).otherwise("App\\Jobs\\Other")
    return A.table(spark, d, "orders").filter(filters.is_foreign_job(name)).select(F.col("o_orderkey").alias("job"))


@query("slow_query", """
SELECT event_id, CAST(round(value * 100) AS BIGINT) AS duration FROM events WHERE value >= 100
""")
def slow_query(spark, d):
    return A.events(spark, d).filter(filters.is_slow(F.col("value"), 100)).select(
        "event_id", F.round(F.col("value") * 100).cast("bigint").alias("duration")
    )


@query("capture_flags", """
WITH kinds AS (SELECT event_id, user_id % 25 AS app,
    CASE event_type WHEN 'error' THEN 'job' WHEN 'view' THEN 'query' WHEN 'signup' THEN 'mail' ELSE 'scheduled' END AS kind FROM events),
flags AS (SELECT n_nationkey AS app, CASE n_nationkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'off' END AS flag FROM nation)
SELECT event_id, kind FROM kinds LEFT JOIN flags USING (app)
WHERE lower(coalesce(flag, CASE kind WHEN 'query' THEN 'false' ELSE 'true' END)) NOT IN ('false', '0', 'off', 'no', '')
""")
def capture_flags(spark, d):
    kind = (
        F.when(F.col("event_type") == "error", "job").when(F.col("event_type") == "view", "query")
        .when(F.col("event_type") == "signup", "mail").otherwise("scheduled")
    )
    n = F.col("n_nationkey").cast("bigint")
    flag = F.when(n % 3 == 0, "true").when(n % 3 == 1, "off")
    config = A.table(spark, d, "nation").select(n.alias("app"), *[flag.alias(c) for c in ("fq", "fj", "fs", "fm")])
    rows = A.events(spark, d).select("event_id", (F.col("user_id") % 25).alias("app"), kind.alias("kind"))
    kept = filters.is_captured(F.col("kind"), F.col("fq"), F.col("fj"), F.col("fs"), F.col("fm"))
    return filters.with_config(rows, config).filter(kept).select("event_id", "kind")


@query("request_id_valid", r"""
WITH rids AS (SELECT event_id, CASE event_id % 8
    WHEN 0 THEN 'req-' || event_id WHEN 1 THEN 'bad id ' || event_id WHEN 2 THEN repeat('x', 128)
    WHEN 3 THEN repeat('x', 129) WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'ok:' || event_id || chr(10)
    ELSE 'a.b_c:' || event_id END AS rid FROM events)
SELECT event_id, CAST(coalesce(length(rid) BETWEEN 1 AND 128 AND NOT regexp_matches(rid, '[^A-Za-z0-9._:-]'), false) AS BIGINT) AS valid FROM rids
""")
def request_id_valid(spark, d):
    i = F.col("event_id")
    rid = (
        F.when(i % 8 == 0, F.concat(F.lit("req-"), i)).when(i % 8 == 1, F.concat(F.lit("bad id "), i))
        .when(i % 8 == 2, F.repeat(F.lit("x"), 128)).when(i % 8 == 3, F.repeat(F.lit("x"), 129))
        .when(i % 8 == 4, "").when(i % 8 == 5, F.lit(None))
        .when(i % 8 == 6, F.concat(F.lit("ok:"), i, F.lit("\n"))).otherwise(F.concat(F.lit("a.b_c:"), i))
    )
    return A.events(spark, d).select("event_id", filters.is_valid_request_id(rid).cast("bigint").alias("valid"))


@query("request_id_assign", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'req-' || event_id ELSE '-' END AS kept,
       CAST(event_id % 2 AS BIGINT) AS fresh, CAST(1 AS BIGINT) AS holders FROM events
""")
def request_id_assign(spark, d):
    """Fresh ids are random: what is checked is the ids kept, the shape of new ones and that no two rows share one."""
    i = F.col("event_id")
    rid = F.when(i % 2 == 0, F.concat(F.lit("req-"), i)).otherwise(F.concat(F.lit("no good "), i))
    # Stored, as a recomputed id would be another one.
    given = materialise(A.events(spark, d).select("event_id", rid.alias("rid"), filters.request_id_or_new(rid).alias("request_id")), "ids")
    holders = given.groupBy("request_id").agg(F.count(F.lit(1)).alias("holders"))
    fresh = F.col("request_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return given.join(holders, "request_id").select(
        "event_id", F.when(F.col("request_id") == F.col("rid"), F.col("rid")).otherwise("-").alias("kept"),
        fresh.cast("bigint").alias("fresh"), "holders",
    )


@query("level_fold", f"""
WITH {A.RAW_SQL}
SELECT app, CASE WHEN level_name IN ('error', 'critical') THEN 'ERROR' WHEN level_name = 'warning' THEN 'WARN' ELSE 'INFO' END AS level,
       count(*) AS n FROM raw GROUP BY ALL
""")
def level_fold(spark, d):
    rows = A.raw_log(spark, d).select("app", N.fold_level(F.col("level_name")).alias("level"))
    return rows.groupBy("app", "level").agg(F.count(F.lit(1)).alias("n"))


@query("rfc3339_ms", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS stamp FROM events
""")
def rfc3339(spark, d):
    return A.events(spark, d).select("event_id", rfc3339_ms(F.col("ts")).alias("stamp"))


MASKED_CONTEXT_SQL = """
'{"k":' || k || ',"type":' || coalesce('"' || type || '"', 'null') ||
CASE WHEN request_id IS NULL THEN ',"request_id":null' ELSE '' END ||
',"who":"[EMAIL]","session_token":"[REDACTED]"}'"""

ENTRY_SQL = f"""
'{{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00","level":"' ||
CASE WHEN level_name IN ('error', 'critical') THEN 'ERROR' WHEN level_name = 'warning' THEN 'WARN' ELSE 'INFO' END ||
'","message":"' || message || '","host":"' || host || '"' ||
coalesce(',"requestId":"' || request_id || '"', '') ||
CASE WHEN type = 'query' THEN ',"contextType":"query"' ELSE '' END ||
',"context":' || {MASKED_CONTEXT_SQL} || '}}'"""


@query("wire_entry", f"WITH {A.RAW_SQL} SELECT app, seq, {ENTRY_SQL} AS entry FROM raw")
def wire_entry(spark, d):
    return N.with_wire_text(N.to_entries(A.raw_log(spark, d))).select("app", "seq", "entry")


@query("entry_size", f"""
WITH {A.RAW_SQL}, wired AS (SELECT app, seq, {ENTRY_SQL} AS e FROM raw)
SELECT app, seq, CAST(strlen(e) + length(e) - length(replace(e, '/', '')) + 1 AS BIGINT) AS entry_bytes FROM wired
""")
def entry_size(spark, d):
    return N.with_wire_text(N.to_entries(A.raw_log(spark, d))).select("app", "seq", "entry_bytes")


@query("entry_size_unicode", r"""
WITH j AS (SELECT doc_id, CAST(to_json({'text': text}) AS VARCHAR) AS e FROM documents)
SELECT doc_id, CAST(length(e) + 5 * length(regexp_replace(e, '[\x00-\x7F]', '', 'g'))
  + 6 * length(regexp_replace(e, '[^\x{10000}-\x{10FFFF}]', '', 'g')) + length(e) - length(replace(e, '/', '')) + 1 AS BIGINT) AS entry_bytes
FROM j
""")
def entry_size_unicode(spark, d):
    docs = A.table(spark, d, "documents")
    return docs.select("doc_id", json_bytes(ascii_json(F.struct("text"))).alias("entry_bytes"))


@query("context_type", f"""
WITH {A.RAW_SQL}, kinds AS (SELECT seq, ['exception','query','job','mail','http','scheduled','video','Query',NULL][seq % 9 + 1] AS kind FROM raw)
SELECT seq, kind AS given, CASE WHEN kind IN ('exception','query','job','mail','http','scheduled') THEN kind END AS context_type FROM kinds
""")
def context_type(spark, d):
    kinds = F.array(*[F.lit(v) for v in ["exception", "query", "job", "mail", "http", "scheduled", "video", "Query", None]])
    kind = F.get(kinds, (F.col("event_id") % 9).cast("int"))
    return A.events(spark, d).select(
        F.col("event_id").alias("seq"), kind.alias("given"), N.context_type(kind).alias("context_type")
    )


@query("request_id_promote", f"""
WITH {A.RAW_SQL}
SELECT seq, coalesce(request_id, '-') AS request_id, CAST(request_id IS NULL AS BIGINT) AS still_in_context FROM raw
""")
def request_id_promote(spark, d):
    rows = N.to_entries(A.raw_log(spark, d))
    return rows.select(
        "seq",
        F.coalesce("requestId", F.lit("-")).alias("request_id"),
        F.contains("context", F.lit('"request_id":')).cast("bigint").alias("still_in_context"),
    )


@query("empty_context", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"k":"' || json_extract_string(props, '$.k') || '"}' ELSE '-' END AS context FROM events
""")
def empty_context(spark, d):
    """Maps without a key, and missing ones, leave no context behind."""
    e = A.events(spark, d)
    k = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"))
    i = F.col("event_id")
    ctx = F.when(i % 3 == 0, k).when(i % 3 == 1, F.map_filter(k, lambda _k, _v: F.lit(False)))
    rows = e.select(
        F.lit(0).alias("app"), F.lit(0).alias("proc"), i.alias("seq"), "ts", F.lit("info").alias("level_name"),
        F.lit("m").alias("message"), F.lit("h").alias("host"), ctx.alias("context"),
    )
    return N.to_entries(rows).select(F.col("seq").alias("event_id"), F.coalesce("context", F.lit("-")).alias("context"))


@query("exception_flatten", """
WITH e AS (SELECT event_id, event_type = 'error' AS thrown, json_extract_string(props, '$.k') AS k, user_id FROM events)
SELECT event_id, CASE WHEN thrown THEN 'exception' ELSE '-' END AS context_type,
  CASE WHEN thrown THEN '{"class":"RuntimeError","message":"failed for [EMAIL]","file":"/app/a.php","line":' || (event_id % 90)
    || ',"trace":["#0 a","#1 b"],"order_id":"' || k || '","password":"[REDACTED]"}'
  ELSE '{"order_id":"' || k || '","class":"mine","password":"[REDACTED]"}' END AS context
FROM e
""")
def exception_flatten(spark, d):
    e = A.events(spark, d)
    exc = F.when(
        F.col("event_type") == "error",
        F.struct(
            F.lit("RuntimeError").alias("class"),
            F.concat(F.lit("failed for u"), "user_id", F.lit("@example.com")).alias("message"),
            F.lit("/app/a.php").alias("file"),
            (F.col("event_id") % 90).cast("int").alias("line"),
            F.lit("#0 a\n#1 b").alias("trace"),
        ),
    )
    ctx = F.create_map(
        F.lit("order_id"), F.get_json_object("props", "$.k"), F.lit("class"), F.lit("mine"),
        F.lit("password"), F.lit("hunter2"),
    )
    rows = e.select(
        F.lit(0).alias("app"), F.lit(0).alias("proc"), F.col("event_id").alias("seq"), "ts",
        F.lit("error").alias("level_name"), F.lit("m").alias("message"), F.lit("h").alias("host"),
        ctx.alias("context"), exc.alias("exc"),
    )
    return N.to_entries(rows).select(
        F.col("seq").alias("event_id"), F.coalesce("contextType", F.lit("-")).alias("context_type"), "context"
    )


@query("trace_truncate", """
SELECT doc_id, CAST(least(30, len(string_split(text, chr(10)))) AS BIGINT) AS lines,
       md5(array_to_string(list_slice(string_split(text, chr(10)), 1, 30), chr(10))) AS digest FROM documents
""")
def trace_truncate(spark, d):
    lines = N.trace_lines(F.col("text"))
    return A.table(spark, d, "documents").select(
        "doc_id", F.size(lines).cast("bigint").alias("lines"), F.md5(F.array_join(lines, "\n")).alias("digest")
    )


@query("text_truncate", "SELECT doc_id, substring(text, 1, 500) AS reason FROM documents")
def text_truncate(spark, d):
    return A.table(spark, d, "documents").select("doc_id", clip(F.col("text")).alias("reason"))


@query("sanitise_values", """
SELECT event_id, CASE WHEN event_id % 4 IN (0, 1, 2) THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS cents,
       event_type || CASE WHEN event_id % 2 = 0 THEN chr(65533) ELSE '' END || 'x' AS label FROM events
""")
def sanitise_values(spark, d):
    i = F.col("event_id")
    value = (
        F.when(i % 4 == 0, F.lit(float("nan"))).when(i % 4 == 1, F.lit(float("inf")))
        .when(i % 4 == 2, F.lit(float("-inf"))).otherwise(F.col("value"))
    )
    raw = F.concat(
        F.encode("event_type", "utf-8"), F.when(i % 2 == 0, F.unhex(F.lit("B1"))).otherwise(F.unhex(F.lit(""))),
        F.encode(F.lit("x"), "utf-8"),
    )
    return A.events(spark, d).select(
        "event_id",
        F.round(finite_or_zero(value) * 100).cast("bigint").alias("cents"),
        valid_utf8(raw.cast("string")).alias("label"),
    )


@query("fifo_sequence", f"""
WITH {A.RAW_SQL}
SELECT app, proc, seq, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw
""")
def fifo_sequence(spark, d):
    rows = A.raw_log(spark, d).select("app", "proc", "ts", "seq")
    return number_rows(stage(rows, ["app", "proc"], ["ts", "seq"]), ["app", "proc"], "rn").select("app", "proc", "seq", "rn")


# ----------------------------------------------------------- event projections

def _base(spark, d, *extra):
    return A.events(spark, d).select(
        (F.col("user_id") % 8).alias("app"), (F.col("user_id") % 4).alias("proc"), F.col("event_id").alias("seq"),
        "ts", F.lit("h").alias("host"), *extra,
    )


def _shown(rows):
    return N.to_entries(rows).select(
        "seq", "level", "message", F.coalesce("contextType", F.lit("-")).alias("context_type"), "context"
    )


def _exc(cls: str):
    return F.struct(
        F.lit(cls).alias("class"), F.lit("boom").alias("message"), F.lit("f.php").alias("file"),
        F.lit(7).alias("line"), F.lit("#0 x").alias("trace"),
    )


EXC_SQL = '"class":"Boom","message":"boom","file":"f.php","line":7,"trace":["#0 x"]'


@query("job_failed_record", f"""
SELECT event_id AS seq, 'ERROR' AS level, 'Queue job failed' AS message, 'exception' AS context_type,
  '{{{EXC_SQL},"type":"job","connection":"redis","queue":"q' || (user_id % 3) || '","attempts":' || (event_id % 5) || '}}' AS context
FROM events
""")
def job_failed_record(spark, d):
    rows = _base(
        spark, d,
        F.when(F.col("event_id") % 2 == 0, "App\\Jobs\\A").alias("job_class"),
        F.lit("redis").alias("connection"),
        F.concat(F.lit("q"), F.col("user_id") % 3).alias("queue"),
        (F.col("event_id") % 5).alias("attempts"),
        _exc("Boom").alias("exc"),
    )
    return _shown(N.job_failed_records(rows))


@query("mail_record", """
SELECT event_id AS seq, 'INFO' AS level, 'Mail sent' AS message, 'mail' AS context_type,
  '{"type":"mail","subject":"Re: ' || event_type || '","to":["[EMAIL]","[EMAIL]"],"from":' ||
  CASE WHEN event_id % 2 = 0 THEN '"[EMAIL]"' ELSE 'null' END || ',"messageId":"<[EMAIL]>","data":{"k":' || json_extract_string(props, '$.k') || '}}' AS context
FROM events
""")
def mail_record(spark, d):
    address = lambda c: F.struct(c.alias("address"))
    rows = _base(
        spark, d,
        F.concat(F.lit("Re: "), "event_type").alias("subject"),
        F.array(address(F.lit("a.b@example.com")), address(F.concat(F.lit("u"), "user_id", F.lit("@example.org")))).alias("to"),
        F.when(F.col("event_id") % 2 == 0, F.array(address(F.lit("no-reply@example.com")))).otherwise(
            F.array().cast("array<struct<address:string>>")
        ).alias("from"),
        F.concat(F.lit("<"), "event_id", F.lit("@mail.example.com>")).alias("message_id"),
        F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k")).alias("data"),
    )
    return _shown(N.mail_records(rows))


@query("slow_query_record", """
SELECT event_id AS seq, 'INFO' AS level, 'Slow query' AS message, 'query' AS context_type,
  '{"type":"query","sql":"select * from t where mail = ''[EMAIL]''","bindings":["' || user_id || '"],"durationMs":' ||
  CAST(round(value * 100) AS BIGINT) || ',"connection":"main"}' AS context
FROM events WHERE CAST(round(value * 100) AS BIGINT) >= 1000
""")
def slow_query_record(spark, d):
    rows = _base(
        spark, d,
        F.lit("select * from t where mail = 'x@example.com'").alias("sql"),
        F.array(F.col("user_id").cast("string")).alias("bindings"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        F.lit("main").alias("connection"),
    )
    return _shown(N.slow_query_records(rows.filter(filters.is_slow(F.col("duration_ms")))))


@query("scheduled_record", f"""
SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'WARN' END AS level,
  CASE WHEN event_type = 'error' THEN 'Scheduled task failed' ELSE 'Scheduled task skipped' END AS message,
  CASE WHEN event_type = 'error' THEN 'exception' ELSE 'scheduled' END AS context_type,
  CASE WHEN event_type = 'error' THEN '{{{EXC_SQL},"type":"scheduled","command":"run:' || (user_id % 9) || '","reason":null}}'
       ELSE '{{"type":"scheduled","command":"' || CASE WHEN event_type = 'view' THEN 'unknown' ELSE 'run:' || (user_id % 9) END
            || '","exception":null,"reason":null}}' END AS context
FROM events
""")
def scheduled_record(spark, d):
    kind = F.col("event_type")
    rows = _base(
        spark, d,
        F.when(kind == "error", "Console\\ScheduledTaskFAILED").otherwise("Console\\ScheduledTaskSkipped").alias("event_class"),
        F.when(kind != "view", F.concat(F.lit("run:"), F.col("user_id") % 9)).alias("command"),
        F.lit(None).cast("string").alias("reason"),
        F.when(kind == "error", _exc("Boom")).alias("exc"),
    )
    return _shown(N.scheduled_records(rows))


@query("uncaught_record", """
SELECT event_id AS seq, 'ERROR' AS level, CASE WHEN event_id % 2 = 0 THEN 'RuntimeError' ELSE 'boom ' || event_id END AS message,
  CASE WHEN event_id % 5 = 0 THEN '-' ELSE 'exception' END AS context_type,
  CASE WHEN event_id % 5 = 0 THEN '{"order_id":"' || user_id || '","exception":"mine"}'
  ELSE '{"class":"RuntimeError","message":"' || CASE WHEN event_id % 2 = 0 THEN '' ELSE 'boom ' || event_id END ||
       '","file":"f.php","line":7,"trace":["#0 x"],"order_id":"' || user_id || '"}' END AS context
FROM events
""")
def uncaught_record(spark, d):
    i = F.col("event_id")
    exc = F.struct(
        F.lit("RuntimeError").alias("class"),
        F.when(i % 2 == 0, "").otherwise(F.concat(F.lit("boom "), i)).alias("message"),
        F.lit("f.php").alias("file"), F.lit(7).alias("line"), F.lit("#0 x").alias("trace"),
    )
    order = F.create_map(F.lit("order_id"), F.col("user_id").cast("string"))
    mine = F.map_concat(order, F.create_map(F.lit("exception"), F.lit("mine")))
    rows = _base(spark, d, exc.alias("exc"), F.when(i % 5 == 0, mine).otherwise(order).alias("context"))
    return _shown(N.uncaught_records(rows))


@query("message_clip", r"""
WITH m AS (
  SELECT doc_id, 'é€🙂' || text || text AS t, hex(encode('é€🙂' || text || text)) AS h FROM documents
), c AS (
  SELECT doc_id, CASE WHEN length(h) <= 32768 THEN h
    WHEN substr(h, 32769, 1) IN ('8', '9', 'A', 'B') THEN regexp_replace(left(h, 32768), '[C-F][0-9A-F]([89AB][0-9A-F]){0,3}$', '') ELSE left(h, 32768) END AS h FROM m
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, sha256(decode(unhex(h))) AS message_sha256 FROM c
""")
def message_clip(spark, d):
    """Long messages cut to whole characters of the bytes that the service keeps."""
    docs = A.table(spark, d, "documents")
    text = F.concat(F.lit("é€🙂"), "text", "text")
    rows = docs.select("doc_id", F.lit("error").alias("level_name"), F.lit(0).cast("timestamp").alias("ts"), text.alias("message"), F.lit("h").alias("host"), F.lit("{}").alias("context"))
    out = N.to_entries(rows, redact_message=False, carry=["doc_id"], max_message_bytes=MESSAGE_BYTES)
    return out.select("doc_id", F.octet_length("message").cast("bigint").alias("n_bytes"), F.sha2("message", 256).alias("message_sha256"))
