import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spillway.operators import packing as P


def brute(rows, n, max_bytes, age, tick):
    """(domain, i) -> position of the first row of its batch; rows are (domain, i, size, sec)."""
    out, by = {}, {}
    for d, i, size, sec in rows:
        by.setdefault(d, []).append((sec, i, size))
    for d, items in by.items():
        count = used = start = 0
        oldest = None
        for k, (sec, i, size) in enumerate(sorted(items)):
            if count and tick and age is not None and sec - oldest >= age:
                count = used = 0
            if count and max_bytes is not None and used + size > max_bytes:
                count = used = 0
            if count == 0:
                start, oldest = k, sec
            out[(d, i)] = start
            count, used = count + 1, used + size
            if count >= n or (age is not None and not tick and sec - oldest >= age):
                count = used = 0
    return out


@pytest.fixture(scope="module")
def traffic(spark):
    """One domain holds most rows, one a third, the rest are tiny."""
    rnd = random.Random(3)
    rows, sec = [], 0
    for i in range(1500):
        sec += rnd.choice([0, 0, 1, 2, 9])
        rows.append((0, i, rnd.choice([10, 200, 900, 1500]), sec))
    rows += [(1, i, 1, i) for i in range(250)]
    for d in range(2, 8):
        rows += [(d, i, rnd.randint(1, 3000), i * d) for i in range(rnd.randint(1, 25))]
    df = spark.createDataFrame(rows, "d int, i long, size_ long, sec long").withColumn("ts", F.timestamp_seconds("sec"))
    return rows, df.cache()


@pytest.mark.parametrize(
    "n,max_bytes,age,tick,block",
    [(100, 4096, None, False, 128), (10, 5000, 20, False, 64), (20, 4000, 15, True, 64), (100, 4096, 30, False, 65536)],
)
def test_blocks_equal_the_sequential_fold(traffic, n, max_bytes, age, tick, block):
    rows, df = traffic
    got = P.pack(
        df, ["d"], ["ts", "i"], batch_size=n, size=F.col("size_"), max_bytes=max_bytes,
        at=F.col("ts"), flush_interval=age, tick=tick, block_rows=block,
    )
    found = [(r.d, r.i, r.batch_start) for r in got.collect()]
    assert len(found) == len(rows)
    assert {(d, i): s for d, i, s in found} == brute(rows, n, max_bytes, age, tick)


def sizes(packed):
    starts = Counter((r.batch_start) for r in packed.collect())
    return [starts[k] for k in sorted(starts)]


def log(spark, n, seconds=lambda i: 0, size=1):
    rows = [(i, seconds(i), size) for i in range(n)]
    return spark.createDataFrame(rows, "i long, sec long, size_ long").withColumn("ts", F.timestamp_seconds("sec")).withColumn("p", F.lit(0))


@pytest.mark.parametrize("n,size,want", [(250, 100, [100, 100, 50]), (25, 10, [10, 10, 5]), (150, 500, [100, 50])])
def test_count_limits(spark, n, size, want):
    assert sizes(P.pack_by_count(log(spark, n), ["p"], ["i"], size)) == want
    assert sizes(P.pack(log(spark, n), ["p"], ["i"], batch_size=size)) == want


def test_oversized_entry_travels_alone(spark):
    rows = spark.createDataFrame([(0, 0, 10), (0, 1, 9000), (0, 2, 10), (0, 3, 10)], "p int, i long, s long")
    assert sizes(P.pack(rows, ["p"], ["i"], size=F.col("s"), max_bytes=0)) == [1, 1, 2]


def test_age_golden(spark):
    two = log(spark, 2, lambda i: 30 * i)
    assert sizes(P.pack(two, ["p"], ["ts", "i"], at=F.col("ts"), flush_interval=10)) == [2]
    four = log(spark, 4, lambda i: 0 if i < 3 else 9)
    assert sizes(P.pack(four, ["p"], ["ts", "i"], batch_size=2, at=F.col("ts"), flush_interval=10)) == [2, 2]
    assert sizes(P.pack(four, ["p"], ["ts", "i"], at=F.col("ts"), flush_interval=0)) == [1, 1, 1, 1]


def test_batches_keep_order_and_limits(traffic):
    rows, df = traffic
    packed = P.pack(df, ["d"], ["ts", "i"], batch_size=10, size=F.col("size_"), max_bytes=4096, block_rows=64)
    found = P.attach(df.select("d", "i", "ts", "size_"), packed.drop("size"), ["d", "ts", "i"]).collect()
    assert len(found) == len(rows)
    batches = {}
    for r in sorted(found, key=lambda r: (r.d, r.rn)):
        batches.setdefault((r.d, r.batch_start), []).append(r)
    for (d, start), batch in batches.items():
        assert [r.rn for r in batch] == list(range(start, start + len(batch)))
        assert len(batch) <= 10 and (len(batch) == 1 or sum(r.size_ for r in batch) <= 4096)
        after = batches.get((d, start + len(batch)))
        if after:  # two neighbours could not have been one batch
            assert len(batch) == 10 or sum(r.size_ for r in batch) + after[0].size_ > 4096


def test_halving(spark):
    rows = log(spark, 100).withColumn("n", F.lit(100).cast("bigint"))
    got = Counter((r.piece, r["size"]) for r in P.halve(rows, "i", "n", 30).collect())
    assert got == {(0, 25): 25, (25, 25): 25, (50, 25): 25, (75, 25): 25}
