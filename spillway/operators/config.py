"""Effective settings per app: remote over local over default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spillway.constants import CONFIG_DEFAULTS, MIN_REMOTE_BATCH
from spillway.operators.ordering import Scan, scan, stage

_NUMERIC = r"\A[ \t\n\r\x0B\f]*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?[ \t\n\r\x0B\f]*\z"

# Remote key -> column, for the keys that override even when null.
PASS_THROUGH = {
    "heartbeatIntervalSeconds": "heartbeat_interval_seconds",
    "captureQueries": "capture_queries",
    "captureJobs": "capture_jobs",
    "captureMails": "capture_mails",
    "captureScheduled": "capture_scheduled",
    "slowQueryThresholdMs": "slow_query_ms",
    "enabled": "enabled",
}


def _number(value: Column) -> Column:
    """A numeric setting, given as a number or as numeric text, else NULL."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(text.rlike(_NUMERIC), F.trim(text).try_cast("double"))


def clamp_seconds(value: Column, low: int, high: int) -> Column:
    """Whole seconds within bounds; the clamp comes first, as a number may be too large to cast."""
    n = _number(value)
    return F.when(n.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), n)).cast("bigint"))


def remote_batch_size(value: Column) -> Column:
    """A positive size, raised to the remote minimum; otherwise NULL (keep the local one)."""
    n = _number(value)
    return F.when(n > 0, F.greatest(F.lit(MIN_REMOTE_BATCH), F.least(n, F.lit(float(1 << 53))).cast("bigint")).cast("bigint"))


def effective_config(apps: DataFrame) -> DataFrame:
    """One settings row per app.

    Reads ``app``, ``remote`` (JSON text or NULL) and any local setting columns.
    Settings that pass through override with whatever the remote sent, null
    included; clamped ones ignore null and unusable values.
    """
    parsed = apps.withColumn("_r", F.from_json("remote", "map<string,variant>"))
    r = F.col("_r")

    def local(name: str) -> Column:
        default = F.lit(CONFIG_DEFAULTS.get(name))
        return F.coalesce(F.col(name), default) if name in apps.columns else default

    def sent(key: str) -> Column:
        return F.try_element_at(r, F.lit(key))

    def as_text(key: str) -> Column:
        return F.try_variant_get(sent(key), "$", "string")

    through = [
        F.when(F.coalesce(F.map_contains_key(r, key), F.lit(False)), as_text(key))
        .otherwise(local(name).cast("string"))
        .alias(name)
        for key, name in PASS_THROUGH.items()
    ]
    is_text = F.schema_of_variant(sent("minLevel")) == "STRING"
    array = lambda key: F.when(F.startswith(F.schema_of_variant(sent(key)), F.lit("ARRAY")), F.to_json(sent(key)))
    return parsed.select(
        *[c for c in apps.columns if c != "remote" and c not in CONFIG_DEFAULTS],
        *through,
        F.coalesce(clamp_seconds(sent("httpTimeoutSeconds"), 1, 20) * 1000, local("timeout_ms")).alias("timeout_ms"),
        F.coalesce(clamp_seconds(sent("flushIntervalSeconds"), 1, 60), local("flush_interval_sec")).alias(
            "flush_interval_sec"
        ),
        F.coalesce(remote_batch_size(sent("batchSize")), local("batch_size")).alias("batch_size"),
        F.when(is_text, as_text("minLevel")).alias("min_level"),
        as_text("sampleRate").alias("sample_rate"),
        array("contextTypeWhitelist").alias("context_type_whitelist"),
        array("redactionPatterns").alias("redaction_patterns"),
    )


def etag_changes(beats: DataFrame, app: Sequence[str], order: Sequence[str], etag: str = "etag") -> DataFrame:
    """Heartbeats that announce a configuration other than the last one seen."""
    seen = scan(stage(beats, app, order), app, {"_cached": Scan("last", F.col(etag), before=True)})
    changed = F.col(etag).isNotNull() & ~F.col(etag).eqNullSafe(F.col("_cached"))
    return seen.select(*beats.columns, F.col("_cached").alias("cached_etag"), changed.alias("refresh"))
