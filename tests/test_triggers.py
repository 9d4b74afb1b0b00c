"""Rules over several triggers against a plain loop; one key holds nearly everything and some rows come late."""

import random

import pytest
from pyspark.sql import functions as F

from spillway.operators import limiter
from spillway.streaming import triggers


def files(spark, tmp_path, chunks, schema):
    """One file per trigger, in order."""
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def requests(seed):
    rnd, t, chunks, n = random.Random(seed), 1_000_000, [], 0
    for _ in range(3):
        rows = []
        for _ in range(400):
            t += rnd.choice([0, 1, 100, 400, 1200, 5000])
            rows.append((rnd.choice(["a"] * 20 + ["b", None]), n, t, rnd.choice([0] * 60 + [3])))
            n += 1
        chunks.append(rows)
        t -= 30_000
    return chunks


def test_limits(spark, tmp_path):
    chunks = requests(5)
    interval, tolerance = limiter.limits(50)
    granted, departs, police, shape = {}, {}, {}, {}
    for rows in chunks:
        for k, i, a, pause in sorted(rows, key=lambda r: (r[2], r[1])):
            tat, paused = police.get(k, (0, 0))
            granted[i] = max(tat, a) - tolerance <= a and paused <= a
            police[k] = max(tat, a) + interval if granted[i] else tat, max(paused, a + pause * 1000 if pause else 0)
            before = shape.get(k, a)
            departs[i] = max(a, before - tolerance)
            shape[k] = max(before, a) + interval
    stream = files(spark, tmp_path, chunks, "token string, seq long, at_ms long, pause_sec int")
    got = triggers.run_triggers(stream, triggers.policing(50, block_rows=64), "police").collect()
    assert {r.seq: r.granted for r in got} == granted and len(set(granted.values())) == 2
    got = triggers.run_triggers(stream, triggers.shaping(50), "shape").collect()
    assert {r.seq: r.departs_ms for r in got} == departs


def test_batches(spark, tmp_path):
    rnd, chunks, n, t = random.Random(7), [], 0, 1_000_000
    for _ in range(4):
        rows = []
        for _ in range(150):
            t += rnd.choice([0, 10, 900, 2500])
            rows.append((rnd.choice(["a"] * 15 + ["b", None]), "p", n, t, rnd.randint(100, 1500)))
            n += 1
        chunks.append(rows)
        t -= 40_000
    want, held = [], {}
    for rows in chunks:
        for k, _, i, ms, size in sorted(rows, key=lambda r: (r[3], r[2])):
            b = held.get(k, [])
            if b and sum(x[2] for x in b) + size > 4096:
                want.append((k, b[0][1], tuple(x[0] for x in b)))
                b = []
            b = [*b, (i, ms, size)]
            if len(b) >= 10 or ms // 1000 - b[0][1] // 1000 >= 6:
                want.append((k, b[0][1], tuple(x[0] for x in b)))
                b = []
            held[k] = b
    stream = files(spark, tmp_path, chunks, "app string, proc string, seq long, ms long, entry_bytes int")
    rows = stream.withColumn("ts", F.timestamp_millis("ms"))
    got = triggers.run_triggers(rows, triggers.batching(10, 4096, 6, block_rows=32), "batches").collect()
    assert sorted(((r.app, r.first_ms, tuple(r.seqs)) for r in got), key=repr) == sorted(want, key=repr)


@pytest.fixture
def apart(spark):
    """Small partitions are left as they are."""
    own = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_key_is_spread_over_tasks(spark, tmp_path, apart):
    """The tasks that write the rows of one token share them."""
    spark.range(40_000).select(F.lit("a").alias("token"), F.col("id").alias("seq"), (F.col("id") * 7).alias("at_ms")).coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    step = triggers.shaping(50)

    def run(batch, state):
        out, after = step.run(batch, state)
        seen.append(max(r["count"] for r in out.groupBy(F.input_file_name()).count().collect()))
        return out, after

    stream = spark.readStream.schema("token string, seq long, at_ms long").parquet(str(tmp_path / "in"))
    triggers.run_triggers(stream, triggers.Step(run, step.state, step.out), "shape")
    assert max(seen) < 30_000
