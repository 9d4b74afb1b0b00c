"""Packing entries into batches.

Every function plans on narrow columns (keys, size, time) and returns one row
per entry with ``batch_start``: the position inside its domain of the first
entry of its batch, which together with the domain names the batch. ``attach``
brings the plan back to the payload with one equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spillway.constants import MAX_BYTES, MAX_ENTRIES, MIN_BYTES, UNBUFFERED_COMMANDS
from spillway.operators.blockfold import Blocks, block_fold, fold_whole
from spillway.operators.ordering import number_once, number_rows, same, stage


def entry_limit(batch_size: int) -> int:
    return max(1, min(MAX_ENTRIES, batch_size))


def byte_limit(max_bytes: int) -> int:
    return max(MIN_BYTES, max_bytes)


def pack_by_count(df: DataFrame, domain: Sequence[str], order: Sequence[str], batch_size: int = MAX_ENTRIES) -> DataFrame:
    """Batches of ``batch_size`` entries, first in first out."""
    n = entry_limit(batch_size)
    numbered = number_rows(stage(df.select(*domain, *order), domain, order), domain)
    start = (F.col("_rn") - F.col("_rn") % n).alias("batch_start")
    return numbered.select(*domain, *order, F.col("_rn").alias("rn"), start)


@dataclass
class _Greedy:
    """Greedy packing by count, bytes and age as a block rule.

    The state is the global row number at which the next batch opens. Where a
    batch opened at row *i* ends depends on *i* alone, so the state function of
    a block is a table over its first ``n`` rows. Columns ``_n`` and ``_age``,
    constant per domain, stand in for the limits of the same name.
    """

    n: int
    max_bytes: int | None
    age: int | None
    tick: bool
    start: int = 0

    def _limit(self, rows: pa.Table, name: str) -> int | None:
        return rows[f"_{name}"][0].as_py() if f"_{name}" in rows.column_names else getattr(self, name)

    def _next(self, rows: pa.Table) -> np.ndarray:
        """Local index of the batch start following a start at each row."""
        count = rows.num_rows
        here = np.arange(count)
        nxt = here + self._limit(rows, "n")
        age = self._limit(rows, "age")
        if self.max_bytes is not None:
            size = _ints(rows["_size"])
            ends = np.cumsum(size)
            # First row whose end lies beyond the budget of a batch opened here.
            over = np.searchsorted(ends, ends - size + self.max_bytes, side="right")
            nxt = np.minimum(nxt, np.maximum(over, here + 1))
        if age is not None:
            sec = _ints(rows["_sec"])
            # Times may fall once, behind what an earlier trigger left open; none of that is old.
            cut = int(np.argmax(np.diff(sec) < 0)) + 1 if (np.diff(sec) < 0).any() else 0
            old = cut + np.searchsorted(sec[cut:], sec + age, side="left")
            if self.tick:
                nxt = np.minimum(nxt, np.maximum(old, here + 1))
            else:
                # The row that finds the batch too old still joins it.
                nxt = np.minimum(nxt, np.maximum(old, here) + 1)
        return nxt

    def summarise(self, rows: pa.Table, end: int):
        first = rows["_rn"][0].as_py()
        count, size, n = rows.num_rows, end - first, self._limit(rows, "n")
        # Rows at or past the end are where the walk stops; starts in the last
        # rows may point past everything shown, never past end + n.
        jump = np.concatenate([self._next(rows), np.arange(count, count + n)])
        stop = np.arange(len(jump))
        jump = np.where(stop < size, jump, stop)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        return first, (first + jump[: min(n, size)]).astype(np.int64)

    def evaluate(self, fn, state: int) -> int:
        first, exits = fn
        return int(exits[state - first])

    def compose(self, first, then):
        return first[0], then[1][first[1] - then[0]]

    def replay(self, rows: pa.Table, end: int, state: int) -> pa.Table:
        rn = _ints(rows["_rn"])
        base = int(rn[0])
        nxt = self._next(rows).tolist()
        starts = []
        at, stop = max(0, state - base), min(end - base, rows.num_rows)
        begin = at
        while at < stop:
            starts.append(at)
            at = nxt[at]
        at = min(at, rows.num_rows)
        covered = rows.slice(begin, max(0, at - begin))
        lengths = np.diff(np.array([*starts, at], dtype=np.int64)) if starts else np.array([], dtype=np.int64)
        first = np.repeat(np.array(starts, dtype=np.int64) + base, lengths)
        return covered.append_column("batch_start", pa.array(first, pa.int64()))


def _ints(column: pa.ChunkedArray) -> np.ndarray:
    return pc.cast(column, pa.int64()).to_numpy()


def pack(
    df: DataFrame,
    domain: Sequence[str],
    order: Sequence[str],
    *,
    batch_size: int | Column = MAX_ENTRIES,
    size: Column | None = None,
    max_bytes: int = MAX_BYTES,
    at: Column | None = None,
    flush_interval: int | Column | None = None,
    tick: bool = False,
    block_rows: int = Blocks.rows,
    bounded: bool = False,
) -> DataFrame:
    """Greedy first-in-first-out packing by count and, when given, bytes and age.

    ``size`` is an entry's bytes in a request body; a batch that would exceed
    ``max_bytes`` closes first, and an oversized entry travels alone. ``at`` is
    the arrival time, which must not decrease along ``order`` (but once, behind rows of one
    time that fit a batch: see ``streaming.triggers``); a batch older
    than ``flush_interval`` whole seconds closes with the entry that finds it
    so, or (``tick``) before that entry.

    (domain, order) must identify a row. Domains may be of any size; where a contract bounds
    them (``bounded``), each is packed by one task, without numbering all rows first. ``batch_size``
    and ``flush_interval`` may be columns, constant per domain; a null one is no limit
    of its own (100 entries, any age).
    """
    domain, order = list(domain), list(order)
    by_age = flush_interval is not None
    own = {}
    if isinstance(batch_size, Column):
        own["_n"] = F.greatest(F.lit(1), F.least(F.lit(MAX_ENTRIES), batch_size))
        batch_size = MAX_ENTRIES
    if isinstance(flush_interval, Column):
        own["_age"] = F.greatest(F.lit(0), F.coalesce(flush_interval, F.lit(1 << 40)))
        flush_interval = None
    narrow = df.select(
        *domain,
        *order,
        *([size.cast("bigint").alias("_size")] if size is not None else []),
        *([F.unix_seconds(at).alias("_sec")] if by_age else []),
        *[value.cast("bigint").alias(name) for name, value in own.items()],
    )
    rule = _Greedy(
        n=entry_limit(batch_size),
        max_bytes=byte_limit(max_bytes) if size is not None else None,
        age=max(0, flush_interval) if flush_interval is not None else None,
        tick=tick,
    )
    added = [T.StructField("batch_start", T.LongType())]
    if bounded:
        packed = fold_whole(narrow, domain, order, rule, added)
    else:
        needs = [c for c in ("_size", "_sec", "_n", "_age") if c in narrow.columns]
        packed = block_fold(number_once(narrow, domain, order), domain, rule, Blocks(block_rows, rule.n), needs, added)
    return packed.withColumnRenamed("_rn", "rn").drop("_sec", "_n", "_age").withColumnRenamed("_size", "size")


def unbuffered_key(command: Column, seq: Column, commands: Sequence[str] = UNBUFFERED_COMMANDS) -> Column:
    """Unit of work for records of commands that never buffer: each its own batch."""
    return F.when(command.isin(list(commands)), seq)


def attach(entries: DataFrame, plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Payload rows with the batch columns of ``plan``; the payload moves once."""
    extra = [c for c in plan.columns if c not in keys]
    return entries.join(plan, same(entries, plan, keys), "inner").select(
        *[entries[c] for c in entries.columns], *[plan[c] for c in extra if c not in entries.columns]
    )


def summarise_batches(packed: DataFrame, domain: Sequence[str], at: str = "ts") -> DataFrame:
    """Size and time span of each batch; map-side combined."""
    return packed.groupBy(*domain, "batch_start").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.sum("size").alias("n_bytes"),
        F.min(at).alias("first_ts"),
        F.max(at).alias("last_ts"),
    )


def assemble(packed: DataFrame, domain: Sequence[str], entry: str = "entry") -> DataFrame:
    """One row per batch with its entries in order; a batch holds at most 100."""
    return packed.groupBy(*domain, "batch_start").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("rn"), F.col(entry).alias("entry")))), lambda e: e["entry"]
        ).alias("entries"),
    )


def halve(entries: DataFrame, pos: str, n: str, limit: int) -> DataFrame:
    """Add ``piece`` (its first position) and ``size`` when every piece above ``limit`` is halved.

    A batch holds at most 100 entries, so seven rounds always suffice; each is
    a projection, nothing is shuffled.
    """
    out = entries.withColumn("piece", F.lit(0).cast("bigint")).withColumn("size", F.col(n))
    for _ in range(7):
        half = F.floor((F.col("size") + 1) / 2).cast("bigint")
        out = out.withColumn("_half", F.when(F.col("size") > limit, half)).withColumn(
            "_right", F.coalesce(F.col(pos) - F.col("piece") >= F.col("_half"), F.lit(False))
        )
        out = out.withColumns(
            {
                "piece": F.when(F.col("_right"), F.col("piece") + F.col("_half")).otherwise(F.col("piece")),
                "size": F.when(F.col("_right"), F.col("size") - F.col("_half")).otherwise(
                    F.coalesce("_half", "size")
                ),
            }
        ).drop("_half", "_right")
    return out
