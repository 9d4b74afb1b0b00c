"""Exception groups, their resolution by deploys and their regressions; outages between heartbeats.

The delivery contract only names these; the definitions are ours.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spillway.operators.asof import next_match, with_next
from spillway.operators.blockfold import Blocks, block_fold
from spillway.operators.ordering import number_once

# What changes from one message to the next: UUIDs, hexadecimal numbers, digits.
_VARIABLE = [
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"0[xX][0-9A-Fa-f]+",
    r"[0-9]+",
]


def template(message: Column) -> Column:
    """A message without what varies: numbers and ids become ``#``, blanks one space; null is empty."""
    out = F.coalesce(message, F.lit(""))
    for pattern in _VARIABLE:
        out = F.regexp_replace(out, pattern, "#")
    return F.trim(F.regexp_replace(out, r"[ \t\r\n]+", " "))


def fingerprint(cls: Column, message_template: Column, frame: Column) -> Column:
    """Names a group by class, message template and top frame; null and empty are the same."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.sha2(F.concat(part(cls), F.lit("\n"), part(message_template), F.lit("\n"), part(frame)), 256)


def with_groups(occurrences: DataFrame) -> DataFrame:
    """Occurrences (class, message, frame, ...) with ``template`` and ``fingerprint``."""
    rows = occurrences.withColumn("template", template(F.col("message")))
    return rows.withColumn("fingerprint", fingerprint(F.col("class"), F.col("template"), F.col("frame")))


def group_exceptions(occurrences: DataFrame, by: Sequence[str] = ("app",)) -> DataFrame:
    """One row per ``by`` and fingerprint of occurrences (``by``, seq, ts, class, message, frame).

    Adds ``class``, ``template``, ``frame``, ``n`` occurrences, ``n_messages`` different messages, ``first`` and ``last``
    (ts, seq, message; by ts, then seq; rows without a time come before all). Two levels: rows with the same
    message are combined first, map-side, so that patterns run once per message and a hot group reaches the
    second level as its different messages; that level is combined map-side as well.
    """
    seen = F.struct("ts", "seq", "message")
    same = occurrences.groupBy(*by, "class", "message", "frame").agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("first"), F.max(seen).alias("last"))
    told = with_groups(same)
    return told.groupBy(*by, "fingerprint").agg(
        F.min(F.coalesce("class", F.lit(""))).alias("class"), F.min("template").alias("template"), F.min(F.coalesce("frame", F.lit(""))).alias("frame"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_messages"), F.min("first").alias("first"), F.max("last").alias("last"),
    )


def next_deploys(occurrences: DataFrame, deploys: DataFrame) -> DataFrame:
    """Occurrences (app, ts, ...) with ``deploy``: the next successful deploy of their app (app, ts, version), strictly later."""
    landed = deploys.where("success").select("app", "ts", "version")
    return next_match(occurrences, landed, ["app"], "ts", "ts", tie="version", name="deploy")


def resolved_groups(groups: DataFrame, deploys: DataFrame) -> DataFrame:
    """Groups (app, ``last``, ...) with ``state`` and ``deploy``: resolved once a successful deploy follows the last occurrence."""
    dated = groups.withColumn("last_ts", F.col("last.ts"))
    landed = deploys.where("success").select("app", "ts", "version")
    told = next_match(dated, landed, ["app"], "last_ts", "ts", tie="version", name="deploy").drop("last_ts")
    return told.withColumn("state", F.when(F.col("deploy").isNull(), "open").otherwise("resolved"))


# ---------------------------------------------------------------- lifecycle

NEW, OPEN, RESOLVED, REOPENED = range(4)
STATES = ["new", "open", "resolved", "reopened"]
RESOLUTION, OCCURRENCE = 0, 1
#: Next state by (symbol, state).
MOVES = {
    RESOLUTION: (NEW, RESOLVED, RESOLVED, RESOLVED),
    OCCURRENCE: (OPEN, OPEN, REOPENED, REOPENED),
}


@dataclass(frozen=True)
class _Lifecycle:
    """The state machine of a group; a block's function is the table of where each state leads."""

    start: int = NEW

    @staticmethod
    def _symbols(rows: pa.Table, end: int) -> list[int]:
        return rows.filter(pc.less(rows["_rn"], end))["kind"].to_pylist()

    def summarise(self, rows: pa.Table, end: int) -> tuple[int, ...]:
        out = tuple(range(len(STATES)))
        for symbol in self._symbols(rows, end):
            out = tuple(MOVES[symbol][s] for s in out)
        return out

    def evaluate(self, fn: tuple[int, ...], state: int) -> int:
        return fn[state]

    def compose(self, first: tuple[int, ...], then: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(then[s] for s in first)

    def replay(self, rows: pa.Table, end: int, state: int) -> pa.Table:
        rows = rows.filter(pc.less(rows["_rn"], end))
        before, after = [], []
        for symbol in rows["kind"].to_pylist():
            before.append(state)
            state = MOVES[symbol][state]
            after.append(state)
        return rows.append_column("before", pa.array(before, pa.int64())).append_column("after", pa.array(after, pa.int64()))


def lifecycle(signals: DataFrame, by: Sequence[str], blocks: Blocks = Blocks()) -> DataFrame:
    """State changes of groups: ``signals`` (``by``, ts, kind, id) that change a state, with ``before`` and ``after``.

    ``kind`` is ``OCCURRENCE`` or ``RESOLUTION``. Signals go by ts, then resolutions first, then id. The first
    occurrence opens a group, a resolution resolves it, an occurrence after that reopens it. Blocks of rows are
    summarised into transition tables, which compose, so a group of any size is replayed in parallel.
    """
    numbered = number_once(signals.select(*by, "ts", "kind", "id"), by, ["ts", "kind", "id"])
    added = [T.StructField("before", T.LongType()), T.StructField("after", T.LongType())]
    told = block_fold(numbered, by, _Lifecycle(), blocks, ["kind"], added)
    named = F.array(*[F.lit(s) for s in STATES])
    return told.where("before != after").select(
        *by, "ts", "kind", "id", F.get(named, F.col("before").cast("int")).alias("before"), F.get(named, F.col("after").cast("int")).alias("after")
    )


def regressions(occurrences: DataFrame, deploys: DataFrame, blocks: Blocks = Blocks()) -> DataFrame:
    """State changes (app, fingerprint, ts, kind, id, before, after) of exception groups that deploys resolve.

    Only the next deploy after some occurrence can change a group's state, so just those are united with the
    occurrences: at most one per occurrence, instead of every deploy with every group. A deploy at the
    instant of an occurrence counts as before it. ``id`` is an occurrence's seq or a deploy's version.
    """
    rows = with_groups(occurrences).select("app", "fingerprint", "ts", "seq")
    told = next_deploys(rows, deploys)
    fixes = told.where("deploy IS NOT NULL").groupBy("app", "fingerprint", F.col("deploy.ts").alias("ts"), F.col("deploy.version").cast("string").alias("id")).agg(F.lit(RESOLUTION).alias("kind"))
    seen = rows.select("app", "fingerprint", "ts", F.lit(OCCURRENCE).alias("kind"), F.col("seq").cast("string").alias("id"))
    return lifecycle(seen.unionByName(fixes), ["app", "fingerprint"], blocks)


# ---------------------------------------------------------------- heartbeats

MISSED = 3


def outages(beats: DataFrame, interval_sec: int, until: Column | None = None) -> DataFrame:
    """Outages (app, ``last``, ``offline_at``, ``back_at``) of heartbeats (app, ts): no beat for ``MISSED`` intervals.

    An app goes offline ``MISSED`` intervals after a beat that no other follows within them, and is back with its next beat; ``back_at`` is null
    if there is none. Such an open outage counts if its ``offline_at`` is not after ``until`` (default: the last
    beat of any app). Beats without a time are left out; beats at one instant are one.
    """
    limit = F.make_dt_interval(secs=F.lit(MISSED * interval_sec))
    told = with_next(beats.select("app", "ts"), ["app"], "ts", "back_at").withColumn("offline_at", F.col("ts") + limit)
    if until is None:
        until = F.lit(beats.agg(F.max("ts")).first()[0]).cast("timestamp")  # one value
    gone = F.when(F.col("back_at").isNull(), F.col("offline_at") <= until).otherwise(F.col("offline_at") <= F.col("back_at"))
    return told.where(gone).select("app", F.col("ts").alias("last"), "offline_at", "back_at")


def closed_sessions(beats: DataFrame, interval_sec: int) -> DataFrame:
    """Of a stream of heartbeats (app, ts): each time an app goes offline, as (app, ``since``, ``last``, ``offline_at``).

    A session window holds the beats that are less than ``MISSED`` intervals apart and ends that long after the last.
    It is emitted when the watermark passes its end, so an app's silence is told by the beats of
    others. State is one row per app that is online; beats are combined before they shuffle.
    """
    timed = beats.select("app", "ts").where("ts IS NOT NULL").withWatermark("ts", "0 seconds")
    window = F.session_window("ts", f"{MISSED * interval_sec} seconds")
    told = timed.groupBy("app", window.alias("w")).agg(F.min("ts").alias("since"), F.max("ts").alias("last"))
    return told.select("app", "since", "last", F.col("w.end").alias("offline_at"))
