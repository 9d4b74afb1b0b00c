"""Which records are shipped at all.

Predicates read raw columns only, so Spark pushes them to the scan and nothing
is masked or rendered for a row that is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spillway.constants import DELIVERY_FAILED, DELIVERY_JOB, GAVE_UP, LEVEL_RANK
from spillway.functions.text import is_set, is_switched_off, level_rank


def with_config(records: DataFrame, config: DataFrame) -> DataFrame:
    """Overlay each app's settings on its records.

    No broadcast hint: the table has one row per app, and Spark broadcasts it
    when its measured size allows, else joins by app with skew splitting.
    """
    return records.join(config, "app", "left")


def configured(url: Column, token: Column) -> Column:
    """The app knows where to deliver."""
    return is_set(url) & is_set(token)


def switched_on(enabled: Column) -> Column:
    return ~is_switched_off(enabled)


def passes_channel(level_name: Column, channel_level: Column) -> Column:
    """At or above the channel's own level; an unknown channel level means *warning*."""
    floor = F.coalesce(level_rank(channel_level), F.lit(LEVEL_RANK["warning"]))
    return level_rank(level_name) >= floor


def passes_min_level(level_name: Column, min_level: Column) -> Column:
    """At or above the remote minimum; an unknown or missing minimum filters nothing."""
    floor = level_rank(min_level)
    return F.coalesce(level_rank(level_name) >= floor, F.lit(True))


def class_is(name: Column, classes: Sequence[str]) -> Column:
    """A class of these names; names without a qualifier also match qualified ones."""
    bare = F.element_at(F.split(name, r"[\\\\.]"), -1)
    return name.isin(list(classes)) | bare.isin([c for c in classes if not set(c) & {"\\", "."}])


def is_own_failure(
    exc_class: Column, exc_job: Column, exc_message: Column, job: str = DELIVERY_JOB,
    failed: Sequence[str] = (DELIVERY_FAILED,), gave_up: Sequence[str] = tuple(GAVE_UP),
) -> Column:
    """The record reports that log delivery itself failed.

    ``job`` is the delivery job's name; ``failed`` are classes that only it raises (list subclasses as well),
    ``gave_up`` those that the queue raises for any job.
    """
    named = F.when(exc_job.isNotNull(), exc_job == job).otherwise(
        F.coalesce(F.startswith(exc_message, F.lit(f"{job} has ")), F.lit(False))
    )
    return F.coalesce(class_is(exc_class, failed) | (class_is(exc_class, gave_up) & named), F.lit(False))


def is_foreign_job(job_name: Column, job: str = DELIVERY_JOB) -> Column:
    """A failed job other than the delivery job."""
    return ~F.coalesce(job_name == job, F.lit(False))


def is_slow(duration_ms: Column, threshold_ms: Column | int = 1000) -> Column:
    return duration_ms >= threshold_ms


def is_captured(kind: Column, query: Column, job: Column, scheduled: Column, mail: Column) -> Column:
    """The app forwards events of this kind; queries are off unless asked for."""
    flag = F.when(kind == "query", F.coalesce(query, F.lit("false")))
    for name, col in [("job", job), ("scheduled", scheduled), ("mail", mail)]:
        flag = flag.when(kind == name, F.coalesce(col, F.lit("true")))
    return ~is_switched_off(flag)


def is_valid_request_id(rid: Column) -> Column:
    return F.coalesce(rid.rlike(r"\A[A-Za-z0-9._:-]{1,128}\z"), F.lit(False))


def request_id_or_new(rid: Column) -> Column:
    """The given id, or a fresh UUID v4 for an unusable one."""
    return F.when(is_valid_request_id(rid), rid).otherwise(F.expr("uuid()"))
