"""Remove the delivery job's records from the failed-job stores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from spillway.constants import DELIVERY_JOB
from spillway.functions.text import iso8601
from spillway.operators.ordering import same
from spillway.session import materialise
from spillway.sources.deadletter import dead_letter_line
from spillway.sources.jobs import is_own_failed, job_entries

ROW = ["store", "id"]


def classify(stores: DataFrame, job: str = DELIVERY_JOB) -> DataFrame:
    """``store, id`` with ``own``, ``uuid`` and ``readable`` of ``store, id, name, payload`` rows."""
    p = F.col("_p")
    parsed = stores.select(*ROW, "name", F.try_parse_json("payload").alias("_p"))
    uuid = F.coalesce(F.try_variant_get(p, "$.uuid", "string"), F.try_variant_get(p, "$.id", "string"), F.lit(""))
    return parsed.select(
        *ROW,
        is_own_failed(p, F.col("name"), job).alias("own"),
        uuid.alias("uuid"),
        F.try_variant_get(p, "$.data.entries", "array<variant>").isNotNull().alias("readable"),
    )


def first_copies(marks: DataFrame) -> DataFrame:
    """The first readable copy of each uuid; records without one all count.

    A minimum combines map-side, so a uuid shared by any number of rows never
    gathers them in one task.
    """
    readable = marks.filter("readable")
    keyed = readable.filter(F.col("uuid") != "")
    firsts = keyed.groupBy("uuid").agg(F.min(F.struct(*ROW)).alias("_first"))
    kept = firsts.select("uuid", *[F.col(f"_first.{c}").alias(c) for c in ROW])
    loose = readable.filter(F.col("uuid") == "").select("uuid", *ROW)
    return kept.unionByName(loose)


@dataclass
class Forgotten:
    exported: DataFrame
    actions: DataFrame
    remaining: DataFrame
    counts: DataFrame


def forget_failed(
    stores: DataFrame, *, export: bool = False, dry_run: bool = False, job: str = DELIVERY_JOB, now=None
) -> Forgotten:
    """Decide on every record of the union of the stores, scanned in (store, id) order.

    With ``export`` a record goes only once its entries are in the dead-letter
    table: one copy per uuid is exported, and an unreadable record stays unless
    a readable copy came before it. Payloads are decoded once, into a narrow
    table of marks on which all decisions are made.
    """
    marks = materialise(classify(stores, job), "failed-marks")
    own = marks.filter("own")
    firsts = first_copies(own)
    action = F.when(~F.col("own"), "foreign")
    decided = marks
    if export:
        seen = firsts.filter(F.col("uuid") != "").select(
            F.col("uuid").alias("_uuid"), F.struct(*ROW).alias("_first")
        )
        # Without a uuid nothing can match: those rows stay out of the join.
        unread, nameless = (own.filter(~F.col("readable") & test) for test in (F.col("uuid") != "", F.col("uuid") == ""))
        kept = (
            unread.join(seen, unread["uuid"] == seen["_uuid"], "left")
            .filter(F.col("_first").isNull() | (F.struct(*ROW) < F.col("_first")))
            .select(*ROW)
            .unionByName(nameless.select(*ROW))
            .withColumn("_kept", F.lit(True))
        )
        decided = marks.join(kept, ROW, "left")
        action = action.when(F.col("_kept"), "unreadable")
    actions = decided.select(*ROW, "uuid", "own", action.otherwise("delete").alias("action"))
    at = iso8601(now if now is not None else F.current_timestamp())
    exported = stores.join(firsts, ROW, "inner").select(
        *ROW,
        "uuid",
        dead_letter_line(
            at, F.concat(F.lit("failed job "), F.col("uuid")), job_entries(F.try_parse_json("payload"))
        ).alias("line"),
    )
    gone = actions.filter(F.col("action") == "delete").select(*ROW)
    remaining = stores if dry_run else delete_rows(stores, gone)
    return Forgotten(exported, actions, remaining, store_counts(actions, dry_run))


def store_counts(actions: DataFrame, dry_run: bool = False) -> DataFrame:
    gone = F.lit(0).cast("bigint") if dry_run else F.count_if(F.col("action") == "delete")
    return actions.groupBy("store").agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if("own").alias("matched"),
        gone.alias("deleted"),
        F.count_if(F.col("action") == "unreadable").alias("kept"),
    )


def delete_rows(stores: DataFrame, ids: DataFrame) -> DataFrame:
    """The stores without the given ids."""
    return stores.join(ids, same(stores, ids, ROW), "left_anti")
