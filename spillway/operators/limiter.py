"""Shared rate limit over tables of requests.

The limiter is GCRA: requests are ``interval`` ms apart, and a request may run
up to ``tolerance`` ms ahead of its slot. ``shape`` delays requests so that all
are served, ``police`` drops those that come too early.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spillway.operators.blockfold import Blocks, block_fold
from spillway.operators.ordering import Scan, number_once, number_rows, scan, stage


def interval_ms(per_minute: Column) -> Column:
    return F.when(per_minute > 0, F.floor((F.lit(60_000) + per_minute - 1) / per_minute).cast("bigint"))


def tolerance_ms(per_minute: Column) -> Column:
    return (F.floor((per_minute + 9) / 10).cast("bigint") - 1) * interval_ms(per_minute)


def limits(per_minute: int) -> tuple[int, int]:
    """(interval, tolerance) in ms of a limit known when the plan is built."""
    interval = -(-60_000 // per_minute)
    return interval, (-(-per_minute // 10) - 1) * interval


def _limit_columns(per_minute: int | str) -> tuple[Column, Column]:
    """(interval, tolerance) of a number or of a column that is constant per token; 0 where unlimited."""
    limit = F.col(per_minute) if isinstance(per_minute, str) else F.lit(per_minute)
    return tuple(F.coalesce(ms(limit), F.lit(0)).cast("bigint") for ms in (interval_ms, tolerance_ms))


def shape(
    df: DataFrame, token: Sequence[str], order: Sequence[str], at_ms: str, per_minute: int | str, *, clock: bool = False
) -> DataFrame:
    """Departure time of every request when all are served, first come first served.

    ``per_minute`` is a number or names a column, constant per token; 0, a negative or no limit means unlimited.
    ``clock`` adds ``clock_ms``, the limiter's clock after each request.

    Unrolling the recursion gives a running maximum, so one scan does it:
    the limiter's clock after request i is T*i + max over j <= i of (a_j - T*(j-1)).
    """
    interval, tolerance = _limit_columns(per_minute)
    staged = stage(df, token, order)
    numbered = number_rows(staged, token)
    # Clock before request i: T*i + max over j < i of (a_j - T*j), i counted from 0.
    ranked = scan(numbered, token, {"_lead": Scan("max", F.col(at_ms) - interval * F.col("_rn"), before=True)})
    clock_before = F.col("_lead") + interval * F.col("_rn")
    departs = F.greatest(F.col(at_ms), clock_before - tolerance)
    after = [(F.greatest(F.col(at_ms), clock_before) + interval).alias("clock_ms")] if clock else []
    return ranked.select(*df.columns, departs.alias("departs_ms"), (departs - F.col(at_ms)).alias("waits_ms"), *after)


def pace_inline(
    df: DataFrame,
    run: Sequence[str],
    order: Sequence[str],
    ready_ms: str,
    per_minute: int,
    *,
    deadline_ms: str | None = None,
    wait_sec: str | None = None,
    max_wait: int = 0,
) -> DataFrame:
    """Send slot of each request of a run: not before it is ready, nor closer than the pace allows.

    A run stops at the first slot at or past ``deadline_ms`` (a column, constant per run; null: none) and
    after the first request whose answer asked to wait (``wait_sec``) more than ``max_wait`` seconds. What
    is left unsent has a null ``slot_ms``.
    """
    interval = -(-60_000 // per_minute) if per_minute > 0 else 0
    numbered = number_rows(stage(df, run, order), run)
    scans = {"_lead": Scan("max", F.col(ready_ms) - interval * F.col("_rn"))}
    if wait_sec is not None:
        scans["_stop"] = Scan("max", (F.col(wait_sec) > max_wait).cast("int"), before=True)
    slot, sent = F.col("_lead") + interval * F.col("_rn"), F.lit(True)
    if wait_sec is not None:
        sent = sent & (F.coalesce("_stop", F.lit(0)) == 0)
    if deadline_ms is not None:
        # Slots never fall, so every later one is past it too.
        sent = sent & F.coalesce(slot < F.col(deadline_ms), F.lit(True))
    return scan(numbered, run, scans).select(*df.columns, F.when(sent, slot).alias("slot_ms"))


def pauses(df: DataFrame, token: Sequence[str], order: Sequence[str], at_ms: str, seconds: str) -> DataFrame:
    """End of the pause in force after each pause request; a pause is never shortened."""
    ends = F.when(F.col(seconds) > 0, F.col(at_ms) + F.col(seconds) * 1000)
    return scan(stage(df, token, order), token, {"paused_until_ms": Scan("max", F.coalesce(ends, F.lit(0)))}).select(
        *df.columns, "paused_until_ms"
    )


def requests_in_window(
    df: DataFrame, token: Sequence[str], order: Sequence[str], at_ms: str, window_ms: int = 60_000
) -> DataFrame:
    """Requests of the token in the ``window_ms`` up to and including each request's time.

    Time is cut into cells of one window length. What a window sees is what came so far in
    its own cell and what has not yet left of the cell before, so each cell's rows also go to
    the next one, at the time they leave: two running sums per (token, cell), linear
    in its rows, where a sliding frame adds up its whole window at every row. A
    token busy enough to fill one cell is first merged to one row per
    millisecond, which bounds a cell by its length, not by its traffic.
    """
    per_ms = df.groupBy(*token, at_ms).agg(F.count(F.lit(1)).alias("_n"))
    cell, none = F.floor(F.col(at_ms) / window_ms).cast("bigint"), F.lit(0).cast("bigint")
    at = F.col(at_ms)
    comes = F.struct(cell.alias("cell"), at.alias("at"), F.col("_n").alias("come"), none.alias("gone"))
    goes = F.struct((cell + 1).alias("cell"), (at + window_ms).alias("at"), none.alias("come"), F.col("_n").alias("gone"))
    moves = per_ms.select(*token, F.explode(F.array(comes, goes)).alias("_m")).select(
        *token, *[F.col(f"_m.{c}").alias(f"_{c}") for c in ("cell", "at", "come", "gone")]
    )
    whole = Window.partitionBy(*token, "_cell")
    so_far = whole.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    counted = moves.withColumn("in_window", F.sum(F.col("_come") - F.col("_gone")).over(so_far) + F.sum("_gone").over(whole))
    return counted.filter(F.col("_come") > 0).select(*token, F.col("_at").alias(at_ms), F.col("_come").alias("requests"), "in_window")


# ------------------------------------------------------------------- policing

@dataclass
class _Police:
    """Dropping limiter as a block rule; the state is the limiter's clock.

    A clock at or before a block's first request acts like one right there, and
    no clock runs further ahead than tolerance + interval. So a block's state
    function is a table over that many milliseconds: all clocks are replayed
    together, each jumping from grant to grant. A column ``_clock``, constant per
    token, is a clock carried in: no clock lies before it.
    """

    at: str
    start: int = 0
    tell: bool = False

    @staticmethod
    def _limits(rows: pa.Table) -> tuple[int, int]:
        """One block belongs to one token, so its first row has the limits of all."""
        return rows["_interval"][0].as_py(), rows["_tolerance"][0].as_py()

    @staticmethod
    def _carried(rows: pa.Table) -> int:
        return rows["_clock"][0].as_py() if "_clock" in rows.column_names else 0

    def summarise(self, rows: pa.Table, end: int):
        times = _open_times(rows, self.at)
        if not len(times):
            return None
        interval, tolerance = self._limits(rows)
        origin, count = int(times[0]), len(times)
        clock = np.maximum(origin + np.arange(tolerance + interval + 1, dtype=np.int64), self._carried(rows))
        result = clock.copy()
        # Distinct (clock, next request) pairs, and which of them each entry clock follows.
        follows = np.arange(len(clock))
        passed = np.zeros(len(clock), dtype=np.int64)
        entries = np.arange(len(clock))
        rounds = 0
        while True:
            at = np.maximum(passed, np.searchsorted(times, clock - tolerance, side="left"))
            live = at < count
            if not live.all():
                done = ~live[follows]
                result[entries[done]] = clock[follows[done]]
                if not live.any():
                    break
                entries = entries[~done]
                follows = (np.cumsum(live) - 1)[follows[~done]]
                clock, at = clock[live], at[live]
            clock = np.maximum(clock, times[at]) + interval
            passed = at + 1
            rounds += 1
            if rounds % 8 == 1 and len(clock) > 1:
                pair = (clock - clock.min()) * (count + 1) + passed
                _, first, merged = np.unique(pair, return_index=True, return_inverse=True)
                clock, passed = clock[first], passed[first]
                follows = merged.reshape(-1)[follows]
        return origin, result

    def evaluate(self, fn, state: int) -> int:
        if fn is None:
            return state
        origin, result = fn
        return int(result[min(max(state - origin, 0), len(result) - 1)])

    def compose(self, first, then):
        if first is None or then is None:
            return then if first is None else first
        origin, result = then
        return first[0], result[np.clip(first[1] - origin, 0, len(result) - 1)]

    def replay(self, rows: pa.Table, end: int, state: int) -> pa.Table:
        interval, tolerance = self._limits(rows)
        still = np.nonzero(~_closed(rows, self.at))[0]
        times = _ints(rows[self.at])[still].tolist()
        # From grant to grant; what lies between is refused.
        t = max(state, self._carried(rows))
        at, hits, clocks = bisect_left(times, t - tolerance), [], [t]
        while at < len(times):
            hits.append(at)
            t = max(t, times[at]) + interval
            clocks.append(t)
            at = bisect_left(times, t - tolerance, at + 1)
        granted = np.zeros(rows.num_rows, bool)
        granted[still[hits]] = True
        if self.tell:
            rows = rows.append_column("clock_ms", pa.array(np.array(clocks, np.int64)[np.cumsum(granted)], pa.int64()))
        return rows.append_column("granted", pa.array(granted, pa.bool_()))


def _ints(column: pa.ChunkedArray) -> np.ndarray:
    return pc.cast(column, pa.int64()).to_numpy()


def _closed(rows: pa.Table, at: str) -> np.ndarray:
    """Requests made while all sending is paused."""
    if "_paused" not in rows.column_names:
        return np.zeros(rows.num_rows, bool)
    return _ints(rows["_paused"]) > _ints(rows[at])


def _open_times(rows: pa.Table, at: str) -> np.ndarray:
    return _ints(rows[at])[~_closed(rows, at)]


def police(
    df: DataFrame,
    token: Sequence[str],
    order: Sequence[str],
    at_ms: str,
    per_minute: int | str,
    *,
    paused_until_ms: str | None = None,
    carried_ms: str | None = None,
    block_rows: int = Blocks.rows,
) -> DataFrame:
    """Which requests fit the budget when refused ones are dropped.

    ``order`` must begin with ``at_ms``; ``per_minute`` as in ``shape``. ``paused_until_ms`` optionally gives the
    end of the pause known at each request (see ``pauses``), ``carried_ms`` names the clock,
    constant per token, that earlier requests have left; then ``clock_ms`` is the clock after
    each request. Exact for a token of any size: see ``blockfold``.
    """
    interval, tolerance = _limit_columns(per_minute)
    rows = df.withColumns({"_interval": interval, "_tolerance": tolerance})
    paused = F.coalesce(F.col(paused_until_ms), F.lit(0)) if paused_until_ms is not None else F.lit(0)
    carried = carried_ms is not None
    if carried:
        rows = rows.withColumn("_clock", F.coalesce(F.col(carried_ms), F.lit(0)).cast("bigint"))
        # Requests may come late, far behind that clock: they are refused and don't move it.
        paused = F.greatest(paused, F.col("_clock") - F.col("_tolerance"))
    closing = carried or paused_until_ms is not None
    if closing:
        rows = rows.withColumn("_paused", paused)
    rule = _Police(at_ms, tell=carried)
    out = block_fold(
        number_once(rows, token, order),
        token,
        rule,
        Blocks(block_rows),
        needs=[at_ms, "_interval", "_tolerance", *(["_paused"] if closing else []), *(["_clock"] if carried else [])],
        added=[*([T.StructField("clock_ms", T.LongType())] if carried else []), T.StructField("granted", T.BooleanType())],
    )
    return out.select(*df.columns, "granted", *(["clock_ms"] if carried else []))
