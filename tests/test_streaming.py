import json
import time

import pytest
from pyspark.sql import functions as F

from spillway.operators import limiter, packing
from spillway.operators.normalize import to_entries, with_wire_text
from spillway.plans import adapters as A
from spillway.plans.normalise_logs import wanted
from spillway.streaming import drain as D, stateful, stateless

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def small_state(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def slices(df, path, key, n):
    """Parquet files that arrive one after the other, in order of ``key``."""
    high = df.agg(F.max(key)).first()[0] + 1
    for i in range(n):
        part = df.filter((F.col(key) >= high * i // n) & (F.col(key) < high * (i + 1) // n))
        part.coalesce(1).write.mode("append").parquet(path)


def run(df, path, checkpoint):
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert query.exception() is None


def test_entries_equal_batch(spark, tmp_path):
    raw, config = A.raw_log(spark, SF), A.app_config(spark, SF)
    slices(raw, str(tmp_path / "in"), "seq", 3)
    stream = stateless.read_records(spark, str(tmp_path / "in"), raw.schema, max_files=1)
    query = stateless.write_entries(stateless.normalised(stream, config), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(240)
    got = {r.seq: r.entry for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.seq: r.entry for r in with_wire_text(to_entries(wanted(raw, config))).collect()}
    assert got == want


def test_micro_batches_equal_packing(spark, tmp_path):
    rows = A.raw_log(spark, SF).select("app", "proc", "seq", "ts", (F.lit(200) + F.col("seq") * 37 % 900).alias("entry_bytes"))
    slices(rows, str(tmp_path / "in"), "seq", 2)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = stateful.micro_batches(stream, batch_size=10, max_bytes=4096, flush_interval=36_000)
    run(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r.seqs) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    packed = packing.pack(
        rows, ["app", "proc"], ["ts", "seq"], batch_size=10, size=F.col("entry_bytes"), max_bytes=4096,
        at=F.col("ts"), flush_interval=36_000,
    )
    batches = {}
    for r in packed.orderBy("app", "rn").collect():
        batches.setdefault((r.app, r.proc, r.batch_start), []).append(r.seq)
    want = {tuple(b) for b in batches.values()}
    assert got <= want
    assert len(want - got) <= 8  # what is still open, one batch per process


def test_a_timer_closes_an_old_batch(spark, tmp_path):
    rows = spark.range(5).select(
        F.lit("a").alias("app"), F.lit("p").alias("proc"), F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(0)).alias("ts"), F.lit(100).alias("entry_bytes"),
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        stateful.micro_batches(stream, flush_interval=2, tick=True).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="1 second").start()
    )
    found = []
    for _ in range(60):
        time.sleep(1)
        if query.exception() is not None:
            break
        if (tmp_path / "out" / "_spark_metadata").exists():
            found = spark.read.schema(stateful.BATCH_SCHEMA).parquet(str(tmp_path / "out")).collect()
        if found:
            break
    query.stop()
    assert [list(r.seqs) for r in found] == [[0, 1, 2, 3, 4]]


def test_policing_equals_batch(spark, tmp_path):
    rows = A.events(spark, SF).select(
        (F.col("user_id") % 4).cast("string").alias("token"), F.col("event_id").alias("seq"),
        F.floor(F.col("ms") / 2000).alias("at_ms"), F.lit(0).alias("pause_sec"),
    )
    slices(rows, str(tmp_path / "in"), "seq", 2)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(stateful.police_stream(stream, 11), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.seq: r.granted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.seq: r.granted for r in limiter.police(rows, ["token"], ["at_ms", "seq"], "at_ms", 11).collect()}
    assert got == want and not all(got.values())


def test_drain_resumes_after_a_crash(spark, tmp_path):
    folder = tmp_path / "dead"
    folder.mkdir()
    for f in range(2):
        lines = [json.dumps({"entries": [{"m": f * 100 + i * 10 + k} for k in range(10)]}) for i in range(5)]
        (folder / f"{f}.log").write_text("\n".join(lines) + "\n" + ("broken\n" if f else ""))
    sent, bad, fail = {}, [], [True]

    def send(batches, epoch):
        rows = batches.collect()
        if epoch == 1 and fail:
            fail.clear()
            raise RuntimeError("crash")
        sent.update({r.batch_id: [json.loads(e)["m"] for e in r.entries] for r in rows})

    def start():
        return D.drain(
            spark, str(folder), str(tmp_path / "cp"), send,
            lambda rows, epoch: bad.extend(r.raw for r in rows.collect()), max_files=1, batch_size=20,
        )

    try:
        start().awaitTermination(240)
    except Exception:
        pass
    assert len(sent) == 3
    start().awaitTermination(240)
    assert sorted(len(v) for v in sent.values()) == [10, 10, 20, 20, 20, 20]
    assert sorted(m for v in sent.values() for m in v) == list(range(50)) + list(range(100, 150))
    assert set(bad) == {"broken"}
