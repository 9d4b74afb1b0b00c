"""Given tables as inputs of the operators; every derivation is deterministic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spillway.constants import DELIVERY_JOB
from spillway.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read as it lies."""
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant and ``ms`` as epoch milliseconds."""
    return with_instants(table(spark, sf_dir, "events"))


def with_instants(e: DataFrame) -> DataFrame:
    return e.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("ms", F.unix_millis("ts"))


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The same events as a stream, be the table one file or a folder of them.

    ``max_files`` bounds a trigger. Rules that follow the order of arrival then see the
    files one after the other, so set it only where that is the order of time.
    """
    root = sf_dir.rstrip("/")
    schema = configure(spark).read.parquet(f"{root}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_instants(reader.parquet(f"{root}/events.parque[t]"))


def level_of(event_type: Column) -> Column:
    return (
        F.when(event_type == "error", "error")
        .when(event_type == "purchase", "critical")
        .when(event_type == "signup", "warning")
        .when(event_type == "view", "notice")
        .otherwise("info")
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw log records with a typed context."""
    return records_of(events(spark, sf_dir))


def records_of(e: DataFrame) -> DataFrame:
    return e.select(
        (F.col("user_id") % 8).alias("app"),
        (F.col("user_id") % 4).alias("proc"),
        F.col("event_id").alias("seq"),
        "ts",
        level_of(F.col("event_type")).alias("level_name"),
        F.concat("event_type", F.lit(" user "), "user_id").alias("message"),
        F.concat(F.lit("host-"), F.col("user_id") % 16).alias("host"),
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.when(F.col("event_id") % 3 == 0, "query")
            .when(F.col("event_id") % 3 == 1, "video")
            .alias("type"),
            F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("req-"), "event_id")).alias("request_id"),
            F.concat(F.lit("user"), "user_id", F.lit("@example.com")).alias("who"),
            F.concat(F.lit("tok-"), "event_id").alias("session_token"),
        ).alias("context"),
    )


# The same records for the oracle.
RAW_SQL = """
raw AS (
  SELECT user_id % 8 AS app, user_id % 4 AS proc, event_id AS seq, ts,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'critical'
              WHEN 'signup' THEN 'warning' WHEN 'view' THEN 'notice' ELSE 'info' END AS level_name,
         event_type || ' user ' || user_id AS message,
         'host-' || (user_id % 16) AS host,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_id % 3 WHEN 0 THEN 'query' WHEN 1 THEN 'video' END AS type,
         CASE WHEN event_id % 2 = 0 THEN 'req-' || event_id END AS request_id,
         'user' || user_id || '@example.com' AS who
  FROM events
)"""


def app_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as apps with their delivery settings; at most one row per app."""
    n = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        n.alias("app"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, "").when(n % 7 == 2, "0").otherwise("https://logs.example.com").alias("url"),
        F.when(n % 11 == 5, "").otherwise("t-1").alias("token"),
        F.get(F.array(*[F.lit(v) for v in ENABLED_VALUES]), (n % len(ENABLED_VALUES)).cast("int")).alias("enabled"),
        F.get(F.array(*[F.lit(v) for v in CHANNEL_LEVELS]), (n % len(CHANNEL_LEVELS)).cast("int")).alias("channel_level"),
        F.get(F.array(*[F.lit(v) for v in MIN_LEVELS]), (n % len(MIN_LEVELS)).cast("int")).alias("min_level"),
    )


ENABLED_VALUES = ["true", "false", "0", "1", "OFF", "no", "maybe", None, " False ", "yes"]
CHANNEL_LEVELS = ["debug", "info", "Notice", "warning", "warn", "ERROR", "chatty", None]
MIN_LEVELS = ["WARN", "error", "info", None, "loud", "critical"]


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


CONFIG_SQL = f"""
config AS (
  SELECT CAST(n_nationkey AS BIGINT) AS app,
         CASE n_nationkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' ELSE 'https://logs.example.com' END AS url,
         CASE WHEN n_nationkey % 11 = 5 THEN '' ELSE 't-1' END AS token,
         {_sql_list(ENABLED_VALUES)}[n_nationkey % {len(ENABLED_VALUES)} + 1] AS enabled,
         {_sql_list(CHANNEL_LEVELS)}[n_nationkey % {len(CHANNEL_LEVELS)} + 1] AS channel_level,
         {_sql_list(MIN_LEVELS)}[n_nationkey % {len(MIN_LEVELS)} + 1] AS min_level
  FROM nation
)"""

RANK_SQL = (
    "CASE lower({0}) WHEN 'debug' THEN 100 WHEN 'info' THEN 200 WHEN 'notice' THEN 250 WHEN 'warning' THEN 300 "
    "WHEN 'warn' THEN 300 WHEN 'error' THEN 400 WHEN 'critical' THEN 500 WHEN 'alert' THEN 550 "
    "WHEN 'emergency' THEN 600 END"
)


def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a job backlog: every seventh job is foreign, every eleventh payload is broken."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    entry = F.struct(F.lit("ERROR").alias("level"), F.concat(F.lit("m-"), key).alias("message"))
    entries = F.when(key % 3 == 0, F.array(entry, entry)).otherwise(F.array(entry))
    command = F.when(key % 7 == 0, F.lit("App\\Jobs\\SendReceipt")).otherwise(F.lit(DELIVERY_JOB))
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("u-"), key % 5000).alias("uuid"),
            command.alias("displayName"),
            F.struct(command.alias("commandName"), entries.alias("entries")).alias("data"),
        )
    )
    return o.select(
        F.concat(F.lit("backlog-"), F.col("o_custkey") % 2).alias("queue"),
        key.alias("seq"),
        F.when(key % 11 == 0, F.lit("{not json")).otherwise(payload).alias("payload"),
    )


BACKLOG_SQL = """
jobs AS (
  SELECT 'backlog-' || (o_custkey % 2) AS queue, o_orderkey AS seq,
         o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AS own,
         CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS n_entries
  FROM orders
)"""


def failed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as two failed-job stores that share uuids."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    own, other = F.lit(DELIVERY_JOB), F.lit("App\\Jobs\\SendReceipt")
    entry = F.array(F.struct(F.concat(F.lit("m-"), key).alias("message")))
    in_table = F.to_json(
        F.struct(
            F.concat(F.lit("u-"), key % 4000).alias("uuid"),
            F.when(key % 4 == 0, own).otherwise(other).alias("displayName"),
            F.struct(
                F.when(key % 6 == 0, own).otherwise(other).alias("commandName"),
                F.when(key % 5 != 0, entry).alias("entries"),
                # Naming the class in a value does not make the job ours.
                F.when(key % 9 == 0, own).alias("note"),
            ).alias("data"),
        )
    )
    common = [key.alias("id"), in_table.alias("payload")]
    first = o.filter(key % 2 == 0).select(F.lit("database").alias("store"), F.lit(None).cast("string").alias("name"), *common)
    second = o.filter(key % 2 == 1).select(
        F.lit("listing").alias("store"), F.when(key % 10 == 1, own).otherwise(other).alias("name"), *common
    )
    return first.unionByName(second)


FAILED_SQL = """
failed AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'database' ELSE 'listing' END AS store, o_orderkey AS id,
         'u-' || (o_orderkey % 4000) AS uuid,
         o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 OR (o_orderkey % 2 = 1 AND o_orderkey % 10 = 1) AS own,
         o_orderkey % 5 <> 0 AS readable
  FROM orders
)"""

STATUSES = [200, 201, 302, 400, 401, 404, 408, 413, 422, 429, 500, 503]
NOW_SEC = 1_788_172_200  # 2026-08-31 10:30:00 UTC


def retry_header(kind: Column, quantity: Column) -> Column:
    """Seconds, a date or something spoilt, as the row's quantity has it."""
    date = F.date_format(F.timestamp_seconds(F.lit(NOW_SEC - 100) + quantity * 20), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    text = quantity.cast("string")
    return (
        F.when(kind == 0, text).when(kind == 1, F.concat(F.lit(" "), text, F.lit(" "))).when(kind == 2, F.concat(F.lit("-"), text))
        .when(kind == 3, date).when(kind == 4, F.replace(date, F.lit("GMT"), F.lit("UTC"))).when(kind == 5, F.concat(text, F.lit("s")))
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as delivery attempts; the order is the job."""
    li = table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    mix = order * 7 + line
    status = F.when(mix % 13 == 12, F.lit(None)).otherwise(
        F.get(F.array(*[F.lit(s) for s in STATUSES]), (mix % 13).cast("int"))
    )
    return li.select(
        order.alias("job"),
        line.alias("attempt"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        status.cast("bigint").alias("status"),
        retry_header(mix % 7, F.col("l_quantity").cast("bigint")).alias("retry_after"),
        F.concat(F.lit(" body of "), order, F.lit(" ")).alias("body"),
        F.lit(NOW_SEC).cast("bigint").alias("now"),
        F.when(order % 17 == 0, F.lit(None)).otherwise(F.lit(NOW_SEC) + (order % 5) * 60 - 30).cast("bigint").alias("retry_deadline"),
        (order % 19 == 0).alias("sync"),
    )


ATTEMPTS_SQL = f"""
attempts AS (
  SELECT l_orderkey AS job, CAST(l_linenumber AS BIGINT) AS attempt, l_partkey AS part, l_suppkey AS supp,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 13 = 12 THEN NULL
              ELSE {STATUSES}[(l_orderkey * 7 + l_linenumber) % 13 + 1] END AS status,
         CASE (l_orderkey * 7 + l_linenumber) % 7 WHEN 0 THEN CAST(l_quantity AS BIGINT) WHEN 1 THEN CAST(l_quantity AS BIGINT) WHEN 2 THEN 1
              WHEN 3 THEN greatest(1, least(600, CAST(l_quantity AS BIGINT) * 20 - 100)) ELSE 30 END AS asked,
         'body of ' || l_orderkey AS body,
         {NOW_SEC} AS now,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE {NOW_SEC} + (l_orderkey % 5) * 60 - 30 END AS retry_deadline,
         l_orderkey % 19 = 0 AS sync
  FROM lineitem
)"""


def app_of() -> Column:
    """An app of which one has a third of all events."""
    return F.when(F.col("event_id") % 3 == 0, "main").otherwise(F.concat(F.lit("app-"), F.col("user_id") % 8))


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and purchases as thrown exceptions whose messages carry ids and numbers."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 4
    message = (
        F.when(kind == 0, F.concat(F.lit("User "), "user_id", F.lit(" not found")))
        .when(kind == 1, F.concat(F.lit("Timeout after "), k, F.lit(" ms\n on 0xBEEF"), "user_id"))
        .when(kind == 2, F.concat(F.lit("Job 01234567-89ab-cdef-0123-"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit("  failed")))
    )
    return events(spark, sf_dir).where("event_type IN ('error', 'purchase')").select(
        app_of().alias("app"), F.col("event_id").alias("seq"), "ts",
        F.concat(F.lit("App\\Fault"), F.col("user_id") % 3).alias("class"), message.alias("message"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("app/Service.php:"), F.col("user_id") % 5)).alias("frame"),
    )


def deploys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some signups as deploys; every fourth failed."""
    return events(spark, sf_dir).where("event_type = 'signup' AND event_id % 25 < 3").select(
        app_of().alias("app"), "ts", F.col("event_id").alias("version"), (F.col("event_id") % 4 != 0).alias("success")
    )


OCCURRENCES_SQL = r"""
faults AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'main' ELSE 'app-' || (user_id % 8) END AS app, event_id AS seq, ts,
         'App\Fault' || (user_id % 3) AS class,
         CASE event_id % 4 WHEN 0 THEN 'User ' || user_id || ' not found'
              WHEN 1 THEN 'Timeout after ' || json_extract_string(props, '$.k') || ' ms' || chr(10) || ' on 0xBEEF' || user_id
              WHEN 2 THEN 'Job 01234567-89ab-cdef-0123-' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '  failed' END AS message,
         CASE WHEN user_id % 5 <> 0 THEN 'app/Service.php:' || (user_id % 5) END AS frame
  FROM events WHERE event_type IN ('error', 'purchase')
), shaped AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(message, ''),
      '[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}', '#', 'g'), '0[xX][0-9A-Fa-f]+', '#', 'g'), '[0-9]+', '#', 'g'), '[ \t\r\n]+', ' ', 'g')) AS template
  FROM faults
), occurrences AS (SELECT *, sha256(coalesce(class, '') || chr(10) || template || chr(10) || coalesce(frame, '')) AS fingerprint FROM shaped
), deploys AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'main' ELSE 'app-' || (user_id % 8) END AS app, ts, event_id AS version
  FROM events WHERE event_type = 'signup' AND event_id % 25 < 3 AND event_id % 4 <> 0
)"""


def beats(e: DataFrame) -> DataFrame:
    """Events as heartbeats of their apps."""
    return e.select(app_of().alias("app"), "ts")
