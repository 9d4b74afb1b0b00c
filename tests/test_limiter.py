import random

import pytest
from pyspark.sql import functions as F

from spillway.operators import limiter as L


def traffic(per_minute, seed):
    """One token holds nearly everything; saturated stretches and idle gaps alternate."""
    rnd = random.Random(seed)
    interval, _ = L.limits(per_minute)
    rows, t = [], 1_000_000
    for i in range(1500):
        t += rnd.choice([0, 1, 5, 100, interval // 3, interval, 8 * interval if rnd.random() < 0.05 else 1])
        rows.append((0, t, i))
    return rows + [(1, 1_000_000 + i * 7, i) for i in range(100)]


def sequential(rows, per_minute, closed=lambda k, a: False):
    interval, tolerance = L.limits(per_minute)
    granted, departs = {}, {}
    for k in {r[0] for r in rows}:
        clock = shaped = 0
        for _, a, i in sorted(r for r in rows if r[0] == k):
            ok = max(clock, a) - tolerance <= a and not closed(k, a)
            granted[(k, i)] = ok
            if ok:
                clock = max(clock, a) + interval
            departs[(k, i)] = max(a, shaped - tolerance)
            shaped = max(shaped, a) + interval
    return granted, departs


@pytest.mark.parametrize("per_minute", [1, 11, 50, 600])
def test_equal_to_the_recursion(spark, per_minute):
    rows = traffic(per_minute, per_minute)
    df = spark.createDataFrame(rows, "k int, at long, i long")
    granted, departs = sequential(rows, per_minute)
    got = {(r.k, r.i): r.granted for r in L.police(df, ["k"], ["at", "i"], "at", per_minute, block_rows=200).collect()}
    assert got == granted
    shaped = {(r.k, r.i): r.departs_ms for r in L.shape(df, ["k"], ["at", "i"], "at", per_minute).collect()}
    assert shaped == departs


def test_pauses_close_whole_blocks(spark):
    rows = [(0, 1_000_000 + i * 500, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, at long, i long").withColumn(
        "until", F.when(F.col("i") > 100, F.lit(1_150_000)).otherwise(0)
    )
    want, _ = sequential(rows, 50, lambda k, a: 1_050_000 < a < 1_150_000)
    out = L.police(df, ["k"], ["at", "i"], "at", 50, paused_until_ms="until", block_rows=50)
    assert {(r.k, r.i): r.granted for r in out.collect()} == want


def test_shape_golden(spark):
    df = spark.createDataFrame([(0, 0, i) for i in range(8)], "k int, at long, i long")
    got = [r.departs_ms for r in L.shape(df, ["k"], ["at", "i"], "at", 50).orderBy("i").collect()]
    assert got == [0, 0, 0, 0, 0, 1200, 2400, 3600]
    slow = L.shape(df.filter("i < 2"), ["k"], ["at", "i"], "at", 6).orderBy("i").collect()
    assert [r.departs_ms for r in slow] == [0, 10_000]


def test_saturating_demand_stays_in_the_window_bound(spark):
    df = spark.range(6000).select(F.lit(0).alias("k"), (F.col("id") * 100).alias("at"), F.col("id").alias("i"))
    granted = L.police(df, ["k"], ["at", "i"], "at", 50, block_rows=500).filter("granted")
    assert 494 <= granted.count() <= 506
    assert L.requests_in_window(granted, ["k"], ["at"], "at").agg(F.max("in_window")).first()[0] <= 55


def test_pause_is_never_shortened(spark):
    df = spark.createDataFrame([(0, 0, 1, 30), (0, 1000, 2, 5)], "k int, at long, i long, ask int")
    assert [r.paused_until_ms for r in L.pauses(df, ["k"], ["at", "i"], "at", "ask").orderBy("i").collect()] == [30_000, 30_000]


def test_windows_are_counted_without_a_sliding_frame(spark):
    """Beside a count of every pair: several requests of a millisecond, ends of cells, times below zero and none."""
    rnd = random.Random(5)
    rows = [(k, rnd.choice([rnd.randrange(-300, 300), 100 * rnd.randrange(-3, 4) + rnd.choice([-1, 0, 1])])) for k in (0, 1) for _ in range(400)]
    df = spark.createDataFrame([*rows, (1, None), (1, None)], "k int, at long")
    out = L.requests_in_window(df, ["k"], ["at"], "at", 100)
    assert out.columns == ["k", "at", "requests", "in_window"]
    want = {(k, t): (rows.count((k, t)), sum(t - 100 < u <= t for j, u in rows if j == k)) for k, t in rows} | {(1, None): (2, 2)}
    got = out.collect()
    assert len(got) == len(want) and {(r.k, r.at): (r.requests, r.in_window) for r in got} == want
    # A frame that starts behind its row is added up anew at every row.
    assert "specifiedwindowframe(RangeFrame, -" not in out._jdf.queryExecution().executedPlan().toString()
