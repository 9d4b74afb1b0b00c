"""Batches and rate limits over streams, with state per key.

All rows that a key has in a trigger go through one task here; ``triggers`` has the same
rules for keys of any size. What only this module can do is close batches by a timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spillway.constants import MAX_BYTES, MAX_ENTRIES
from spillway.operators.limiter import limits
from spillway.operators.packing import byte_limit, entry_limit

BATCH_SCHEMA = "app string, proc string, batch_first long, n_entries int, n_bytes long, first_ms long, seqs array<long>"


class MicroBatcher(StatefulProcessor):
    """Closes a batch by count, bytes or age of its first entry.

    Without ``tick`` the entry that finds the batch too old joins it, as when
    only arrivals close batches. With ``tick`` a processing-time timer closes
    the batch once it is old enough, and so does the next entry.
    """

    def __init__(self, n: int, max_bytes: int, age_sec: int, tick: bool):
        self.n = n
        self.max_bytes = max_bytes
        self.age = age_sec
        self.tick = tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Open batch: its totals, and its entries apart so that totals stay cheap to read.
        self.open = handle.getValueState("open", "n int, bytes long, first_ms long")
        self.entries = handle.getListState("entries", "seq long")

    def _load(self):
        if not self.open.exists():
            return [0, 0, 0], []
        n, size, first = self.open.get()
        return [n, size, first], [row[0] for row in self.entries.get()]

    def _close(self, key, total, seqs) -> dict:
        return {
            "app": key[0], "proc": key[1], "batch_first": seqs[0], "n_entries": total[0],
            "n_bytes": total[1], "first_ms": total[2], "seqs": list(seqs),
        }

    def _old(self, total, ms: int) -> bool:
        return ms // 1000 - total[2] // 1000 >= self.age

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, seqs = self._load()
        carried = bool(seqs)
        done = []
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["ms", "seq"])
        for seq, ms, size in zip(arrived["seq"], arrived["ms"], arrived["entry_bytes"]):
            seq, ms, size = int(seq), int(ms), int(size)
            if seqs and (total[1] + size > self.max_bytes or (self.tick and self._old(total, ms))):
                done.append(self._close(key, total, seqs))
                total, seqs = [0, 0, 0], []
            if not seqs:
                total[2] = ms
            seqs.append(seq)
            total[0] += 1
            total[1] += size
            if total[0] >= self.n or (not self.tick and self._old(total, ms)):
                done.append(self._close(key, total, seqs))
                total, seqs = [0, 0, 0], []
        self._save(total, seqs)
        if self.tick and not (carried and not done):
            # The timer belongs to the first entry of the open batch.
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if seqs:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.age * 1000)
        if done:
            yield pd.DataFrame(done)

    def _save(self, total, seqs) -> None:
        self.entries.clear()
        if not seqs:
            self.open.clear()
            return
        self.open.update((total[0], total[1], total[2]))
        self.entries.put([(s,) for s in seqs])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, seqs = self._load()
        self.open.clear()
        self.entries.clear()
        if seqs:
            yield pd.DataFrame([self._close(key, total, seqs)])

    def close(self) -> None:
        pass


def micro_batches(
    entries: DataFrame,
    *,
    batch_size: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
    flush_interval: int = 10,
    tick: bool = False,
) -> DataFrame:
    """Batches of a stream of ``app, proc, seq, ts, entry_bytes``.

    With ``tick`` run the query on a processing-time trigger: timers only fire
    while it keeps running.
    """
    keyed = entries.select(
        F.col("app").cast("string").alias("app"),
        F.col("proc").cast("string").alias("proc"),
        "seq",
        F.unix_millis("ts").alias("ms"),
        "entry_bytes",
    )
    return keyed.groupBy("app", "proc").transformWithStateInPandas(
        MicroBatcher(entry_limit(batch_size), byte_limit(max_bytes), max(0, flush_interval), tick),
        outputStructType=BATCH_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if tick else "None",
    )


class Policer(StatefulProcessor):
    """Rate limit per token: a request is granted or refused as it arrives."""

    def __init__(self, interval: int, tolerance: int):
        self.interval = interval
        self.tolerance = tolerance

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The clock is in the past once idle, so forgetting it changes nothing.
        self.state = handle.getValueState("clock", "tat long, paused long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tat, paused = self.state.get() if self.state.exists() else (0, 0)
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["at_ms", "seq"])
        granted = []
        for at, pause in zip(arrived["at_ms"], arrived["pause_sec"]):
            at = int(at)
            ok = max(tat, at) - self.tolerance <= at and paused <= at
            granted.append(ok)
            if ok:
                tat = max(tat, at) + self.interval
            if pause > 0:
                paused = max(paused, at + int(pause) * 1000)
        self.state.update((int(tat), int(paused)))
        yield pd.DataFrame(
            {"token": key[0], "seq": arrived["seq"], "at_ms": arrived["at_ms"], "granted": granted}
        )

    def close(self) -> None:
        pass


def police_stream(requests: DataFrame, per_minute: int) -> DataFrame:
    """Grant or refuse each request of a stream of ``token, seq, at_ms, pause_sec``; a limit of 0 grants all.

    ``pause_sec`` is what the answer to the request asked all senders to wait
    (0: nothing); later requests of the token honour it.
    """
    keyed = requests.select(F.col("token").cast("string").alias("token"), "seq", "at_ms", "pause_sec")
    if per_minute <= 0:
        return keyed.select("token", "seq", "at_ms", F.lit(True).alias("granted"))
    return keyed.groupBy("token").transformWithStateInPandas(
        Policer(*limits(per_minute)),
        outputStructType="token string, seq long, at_ms long, granted boolean",
        outputMode="Append",
        timeMode="None",
    )

