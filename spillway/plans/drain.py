"""Send dead letters again and sort out what is refused."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from spillway.constants import MAX_BYTES, MAX_ENTRIES
from spillway.functions.text import text_json_bytes
from spillway.operators import packing
from spillway.operators.delivery import outcome_drain
from spillway.operators.ordering import number_rows, stage
from spillway.operators.rejection import resolve
from spillway.session import materialise
from spillway.sources import deadletter


def ranked_sources(*lines: DataFrame) -> DataFrame:
    """Line tables in the order they are drained: an unfinished snapshot before the live file."""
    ranked = [t.withColumn("source_rank", F.lit(i).cast("bigint")) for i, t in enumerate(lines)]
    out = ranked[0]
    for t in ranked[1:]:
        out = out.unionByName(t)
    return out


def decode(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Entries of readable lines and, without ``pos``, one row per malformed line; decoded once and stored."""
    bad = F.col("malformed")
    rows = deadletter.parse(lines).select(
        *keys, "malformed", F.when(bad, F.col("value")).alias("value"), F.posexplode_outer("entries").alias("pos", "entry")
    )
    return materialise(
        rows.filter(bad | F.col("pos").isNotNull()).withColumn("entry_bytes", text_json_bytes(F.col("entry"))), "dead-letters"
    )


def pack_dead_letters(
    decoded: DataFrame,
    run: list[str],
    order: list[str],
    *,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(entries, plan): entries of ``decode``, packed across lines of a run."""
    entries = decoded.filter(F.col("pos").isNotNull()).drop("malformed", "value")
    plan = packing.pack(
        entries, run, [*order, "pos"], batch_size=batch_size, size=F.col("entry_bytes"), max_bytes=max_bytes
    )
    return entries, plan


def number_batches(plan: DataFrame, run: list[str]) -> DataFrame:
    """Batches of a run with their position in it."""
    batches = plan.groupBy(*run, "batch_start").agg(
        F.count(F.lit(1)).alias("n_entries"), F.sum("size").alias("n_bytes")
    )
    return number_rows(stage(batches, run, ["batch_start"]), run, "batch_no").drop("_pos", "_part")


@dataclass
class Drained:
    sent: DataFrame
    again: DataFrame
    quarantine: DataFrame
    unsent: DataFrame
    report: DataFrame


def drain_dead_letters(
    lines: DataFrame,
    responses: DataFrame,
    run: list[str],
    order: list[str],
    *,
    limit: int = 0,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
) -> Drained:
    """One drain over observed ``responses`` (run columns, ``batch_no, status, body``).

    A batch without a final answer, and every batch after the first such one,
    is kept for the next run; so are batches beyond ``limit``. ``again`` holds
    the rows of refused batches that go out once more, smaller. ``run`` names at
    least one column.
    """
    decoded = decode(lines, [*run, *order])
    entries, plan = pack_dead_letters(decoded, run, order, batch_size=batch_size, max_bytes=max_bytes)
    plan = materialise(plan, "plan")
    batches = materialise(number_batches(plan, run), "batches")
    answered = batches.join(responses, [*run, "batch_no"], "left").withColumn(
        "outcome", F.when(F.col("status").isNull(), "none").otherwise(outcome_drain(F.col("status")))
    )
    final = F.col("outcome").isin("success", "reject")
    stuck = answered.filter(~final).groupBy(*run).agg(F.min("batch_no").alias("_stuck"))
    judged = answered.join(stuck, run, "left")
    within = F.lit(True) if limit <= 0 else F.col("batch_no") < limit
    judged = materialise(
        judged.withColumn(
            "handled", within & (F.col("_stuck").isNull() | (F.col("batch_no") < F.col("_stuck")))
        ).drop("_stuck"),
        "judged",
    )

    key = F.concat_ws("/", *[F.col(c).cast("string") for c in run], F.col("batch_start").cast("string"))
    placed = packing.attach(entries, plan.drop("size"), [*run, *order, "pos"]).withColumn("batch_id", key)
    named = judged.withColumn("batch_id", key)
    sent = named.filter(F.col("handled") & (F.col("outcome") == "success"))
    refused = named.filter(F.col("handled") & (F.col("outcome") == "reject"))
    rows = (
        placed.withColumn("_line_pos", F.col("pos"))
        .withColumn("pos", F.col("rn") - F.col("batch_start"))
    )
    fates = resolve(rows, refused.select("batch_id", "n_entries", "status", "body"))
    bad_rows = fates.filter(F.col("fate") == "quarantine").select(
        *run, F.array("entry").alias("entries"), "reason", F.lit(None).cast("string").alias("raw")
    )
    bad_lines = deadletter.malformed(decoded, run).select(
        *run, F.array().cast("array<string>").alias("entries"), "reason", "raw"
    )
    report = drain_report(named, fates, bad_lines, run)
    again = fates.filter(F.col("fate").isin("resend", "split"))
    return Drained(sent, again, bad_rows.unionByName(bad_lines), named.filter(~F.col("handled")), report)


def drain_report(batches: DataFrame, fates: DataFrame, bad_lines: DataFrame, run: list[str]) -> DataFrame:
    """Batches and entries sent, entries rejected, malformed lines and whether anything is left."""
    ok = F.col("handled") & (F.col("outcome") == "success")
    zero = F.lit(0).cast("bigint")
    parts = (
        batches.select(
            *run,
            ok.cast("bigint").alias("sent"),
            F.when(ok, F.col("n_entries")).otherwise(0).alias("sent_entries"),
            zero.alias("rejected"),
            zero.alias("malformed"),
            (~F.col("handled")).cast("bigint").alias("left"),
        )
        .unionByName(
            fates.filter(F.col("fate") == "quarantine").select(
                *run, zero.alias("sent"), zero.alias("sent_entries"), F.lit(1).cast("bigint").alias("rejected"),
                zero.alias("malformed"), zero.alias("left"),
            )
        )
        .unionByName(
            bad_lines.select(
                *run, zero.alias("sent"), zero.alias("sent_entries"), zero.alias("rejected"),
                F.lit(1).cast("bigint").alias("malformed"), zero.alias("left"),
            )
        )
    )
    return parts.groupBy(*run).agg(
        F.sum("sent").alias("batches_sent"),
        F.sum("sent_entries").alias("entries_sent"),
        F.sum("rejected").alias("rejected"),
        F.sum("malformed").alias("malformed"),
        (F.sum("left") > 0).alias("remainder"),
    )
