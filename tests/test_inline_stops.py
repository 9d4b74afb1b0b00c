import random

from spillway.operators import limiter as L


def test_a_run_stops_at_its_deadline_and_after_a_long_wait(spark):
    rnd, rows = random.Random(3), []
    for run, deadline, waits in (("a", 200_000, []), ("b", None, [120, 130]), ("c", 60_000, [5]), ("d", None, [])):
        t = 0
        for i in range(200):
            t += rnd.choice([0, 200, 3000])
            rows.append((run, i, t, 601 if i in waits else rnd.choice([None, 0, 600]), deadline))
    want, last, stopped = {}, {}, set()
    for run, i, t, wait, deadline in rows:
        slot = max(t, last[run] + 1200) if run in last else t
        last[run] = slot
        if deadline is not None and slot >= deadline:
            stopped.add(run)
        want[run, i] = None if run in stopped else slot
        if (wait or 0) > 600:
            stopped.add(run)
    df = spark.createDataFrame(rows, "run string, i long, t long, wait int, deadline long")
    got = L.pace_inline(df, ["run"], ["t", "i"], "t", 50, deadline_ms="deadline", wait_sec="wait", max_wait=600).collect()
    assert {(r.run, r.i): r.slot_ms for r in got} == want and stopped == {"a", "b", "c"}
    plain = L.pace_inline(df, ["run"], ["t", "i"], "t", 50).collect()
    assert all(r.slot_ms is not None for r in plain)
