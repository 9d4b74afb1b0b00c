"""Raw records to batches ready for delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spillway.constants import MAX_BYTES, MAX_ENTRIES, SENSITIVE_KEYS
from spillway.functions.redact import Masks
from spillway.operators import filters, packing
from spillway.operators.normalize import to_entries, with_wire_text
from spillway.session import materialise


def wanted(records: DataFrame, config: DataFrame, **own_failure) -> DataFrame:
    """Records that are shipped at all. ``own_failure``: ``job``, ``failed``, ``gave_up`` of ``is_own_failure``.

    Reads settings ``url, token, enabled, channel_level, min_level`` per app.
    """
    own = F.lit(False)
    if "exc" in records.columns:
        job = F.col("exc.job") if "job" in records.schema["exc"].dataType.names else F.lit(None).cast("string")
        own = filters.is_own_failure(F.col("exc.class"), job, F.col("exc.message"), **own_failure)
    settings = config.select("app", "url", "token", "enabled", "channel_level", "min_level")
    kept = filters.with_config(records.filter(~own), settings).filter(
        filters.configured(F.col("url"), F.col("token"))
        & filters.switched_on(F.col("enabled"))
        & filters.passes_channel(F.col("level_name"), F.col("channel_level"))
        & filters.passes_min_level(F.col("level_name"), F.col("min_level"))
    )
    return kept.select(*[kept[c] for c in records.columns])


def normalise_logs(
    records: DataFrame,
    config: DataFrame,
    *,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
    flush_interval: int | None = 10,
    unit: Sequence[str] = (),
    redact_message: bool = True,
    keys: Sequence[str] = SENSITIVE_KEYS,
    extra_patterns: Masks = (),
    own_failure: dict | None = None,
    per_app: bool = False,
) -> DataFrame:
    """Filter, normalise, mask and pack; one row per entry with its batch.

    Masked entries are written once to the shared folder: packing then reads
    only keys and sizes from it, and nothing is masked twice. With ``per_app`` each
    app's own ``batch_size`` and ``flush_interval_sec`` (see ``effective_config``) apply.
    """
    domain = ["app", "proc", *unit]
    entries = with_wire_text(
        to_entries(
            wanted(records, config, **(own_failure or {})),
            redact_message=redact_message,
            keys=keys,
            extra_patterns=extra_patterns,
            carry=[*domain, "seq", "ts"],
        )
    )
    stored = materialise(entries, "entries")
    limited = stored
    if per_app:
        own = config.select("app", F.col("batch_size").alias("_batch"), F.col("flush_interval_sec").alias("_flush"))
        limited, batch_size, flush_interval = stored.join(own, "app", "left"), F.col("_batch"), F.col("_flush")
    plan = packing.pack(
        limited,
        domain,
        ["ts", "seq"],
        batch_size=batch_size,
        size=F.col("entry_bytes"),
        max_bytes=max_bytes,
        at=F.col("ts"),
        flush_interval=flush_interval,
    ).drop("size")
    return packing.attach(stored, plan, [*domain, "ts", "seq"])
