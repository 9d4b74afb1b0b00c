"""State of streams: timers, expiry, deletion of old epochs, limits per token."""

import os
import random

from pyspark.sql import functions as F

from spillway.operators import limiter
from spillway.streaming import triggers
from test_triggers import files


def epochs(path):
    return sorted(int(x) for x in os.listdir(path) if x.isdigit())


def test_timers_close_batches_without_input(spark, tmp_path):
    rnd, chunks, n, t = random.Random(2), [], 0, 1_000_000
    for k in range(4):
        rows = []
        for _ in range(120):
            t += rnd.choice([0, 10, 900, 1500])
            # In the last two triggers only one key has input.
            rows.append(("a" if k > 1 else rnd.choice(["a"] * 6 + ["b", "c", None]), "p", n, t, rnd.randint(100, 900)))
            n += 1
        chunks.append(rows)
    want, held, now = [], {}, 0
    for rows in chunks:
        for k, _, i, ms, size in rows:
            b = held.get(k, [])
            if b and (sum(x[2] for x in b) + size > 4096 or ms // 1000 - b[0][1] // 1000 >= 6):
                want.append((k, b[0][1], tuple(x[0] for x in b)))
                b = []
            b = [*b, (i, ms, size)]
            if len(b) >= 10:
                want.append((k, b[0][1], tuple(x[0] for x in b)))
                b = []
            held[k], now = b, ms
        for k, b in held.items():
            if b and now // 1000 - b[0][1] // 1000 >= 6:
                want.append((k, b[0][1], tuple(x[0] for x in b)))
                held[k] = []
    stream = files(spark, tmp_path, chunks, "app string, proc string, seq long, ms long, entry_bytes int").withColumn("ts", F.timestamp_millis("ms"))
    path, step = str(tmp_path / "state"), triggers.batching(10, 4096, 6, tick=True, block_rows=32)
    triggers.start_triggers(stream, step, path, str(tmp_path / "checkpoint"), compact=2).awaitTermination()
    got = triggers.read_triggers(spark, step, path).collect()
    assert sorted(((r.app, r.first_ms, tuple(r.seqs)) for r in got), key=repr) == sorted(want, key=repr)
    quiet = [r for r in spark.read.parquet(f"{path}/out/*/timers").collect() if r.app != "a"]
    assert quiet and all(len(r.seqs) == r.n_entries for r in quiet)


def test_old_tokens_go_and_no_grant_changes(spark, tmp_path):
    rnd, t, chunks, n = random.Random(9), 1_000_000, [], 0
    for k in range(6):
        rows = []
        for _ in range(80):
            t += rnd.choice([0, 1, 100, 400, 1200])
            # Each trigger has a token of its own, and one that all share.
            rows.append((rnd.choice(["all", f"only-{k}", None]), n, t, rnd.choice([0] * 30 + [3]), 50))
            n += 1
        chunks.append(rows)
        t += 200_000
    interval, tolerance = limiter.limits(50)
    want, clocks = {}, {}
    for rows in chunks:
        for k, i, a, pause, _ in rows:
            tat, paused = clocks.get(k, (0, 0))
            want[i] = max(tat, a) - tolerance <= a and paused <= a
            clocks[k] = max(tat, a) + interval if want[i] else tat, max(paused, a + pause * 1000 if pause else 0)
    stream = files(spark, tmp_path, chunks, "token string, seq long, at_ms long, pause_sec int, per_minute int")
    path, step = str(tmp_path / "state"), triggers.policing("per_minute", block_rows=64)
    triggers.start_triggers(stream, step, path, str(tmp_path / "checkpoint"), compact=2).awaitTermination()
    got = {r.seq: r.granted for r in triggers.read_triggers(spark, step, path).collect()}
    assert got == want and len(set(want.values())) == 2
    kept, now, since = triggers.state_before(spark, step, path, 6)
    assert now == chunks[-1][-1][2] and since >= 4
    tokens = {r.token for r in kept.collect()}
    assert "only-5" in tokens and not {"only-0", "only-1", "only-2"} & tokens
    assert min(epochs(f"{path}/state")) >= 2 and min(epochs(f"{path}/meta")) >= 4 and epochs(f"{path}/out") == list(range(6))


def test_limits_of_tokens_in_streams(spark, tmp_path):
    rnd, chunks, n, t = random.Random(4), [], 0, 1_000_000
    limits = {"a": 50, "b": 7, "free": 0, "none": None}
    for _ in range(2):
        rows = []
        for _ in range(200):
            t += rnd.choice([0, 200, 900])
            k = rnd.choice(list(limits))
            rows.append((k, n, t, 0, limits[k]))
            n += 1
        chunks.append(rows)
    granted, departs, police, shape = {}, {}, {}, {}
    for k, i, a, _, limit in (x for rows in chunks for x in rows):
        if not limit:
            granted[i], departs[i] = True, a
            continue
        interval, tolerance = limiter.limits(limit)
        tat = police.get(k, 0)
        granted[i] = max(tat, a) - tolerance <= a
        police[k] = max(tat, a) + interval if granted[i] else tat
        before = shape.get(k, a)
        departs[i] = max(a, before - tolerance)
        shape[k] = max(before, a) + interval
    stream = files(spark, tmp_path, chunks, "token string, seq long, at_ms long, pause_sec int, per_minute int")
    assert {r.seq: r.granted for r in triggers.run_triggers(stream, triggers.policing("per_minute"), "police").collect()} == granted
    assert {r.seq: r.departs_ms for r in triggers.run_triggers(stream, triggers.shaping("per_minute"), "shape").collect()} == departs
