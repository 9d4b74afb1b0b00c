import json
import os

from pyspark.sql import functions as F

from spillway.constants import DELIVERY_JOB
from spillway.plans.forget import forget_failed
from spillway.plans.rebatch import rebatch_backlog
from spillway.sources import deadletter as S
from spillway.sources.ingest import parse_metadata


def line(*messages):
    return json.dumps({"failed_at": "t", "reason": "r", "entries": [{"message": m} for m in messages]})


def write(path, text):
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_files_with_torn_and_malformed_lines(spark, tmp_path):
    write(tmp_path / "a.log", line("a1", "a2") + "\n\nnot json\r\n" + line("a3") + '\n{"entries":[{"mess')
    write(tmp_path / "b.log", line("b1"))  # unterminated but readable
    write(tmp_path / "c.log", line("c1") + "\n{broken\n")
    write(tmp_path / "d.log", b'{"entries":[]}\nbad \xb1 bytes')
    lines = S.read_lines(spark, str(tmp_path))
    rows = S.unnest(S.parse(lines), S.LINE_ID).orderBy(*S.LINE_ID, "pos").collect()
    assert sorted(json.loads(r.entry)["message"] for r in rows) == ["a1", "a2", "a3", "b1", "c1"]
    bad = {(os.path.basename(r.file), r.reason): r.raw for r in S.quarantine(lines).collect()}
    assert bad[("a.log", "malformed line")] == "not json"
    assert bad[("a.log", "incomplete line (torn write)")] == '{"entries":[{"mess'
    assert bad[("c.log", "malformed line")] == "{broken"
    assert ("d.log", "incomplete line (torn write)") in bad
    assert len(bad) == 4


def test_large_files_are_split_without_losing_order(spark, tmp_path):
    write(tmp_path / "big.log", "".join(line(i) + "\n" for i in range(2000)) + "torn")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = S.read_lines(spark, str(tmp_path / "big.log"))
        assert lines.select("block").distinct().count() > 3
        rows = S.unnest(S.parse(lines), S.LINE_ID).orderBy(*S.LINE_ID).collect()
        assert [json.loads(r.entry)["message"] for r in rows] == list(range(2000))
        assert [r.reason for r in S.quarantine(lines).collect()] == ["incomplete line (torn write)"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quarantine_and_dead_letters_round_trip(spark, tmp_path):
    bad = spark.createDataFrame([("malformed line", "x")], "reason string, raw string")
    S.write_quarantine(bad, str(tmp_path / "rejected"))
    S.write_quarantine(bad, str(tmp_path / "rejected"))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "rejected")).collect()] == [
        {"entries": [], "reason": "malformed line", "raw": "x"}
    ] * 2
    row = spark.range(1).select(
        S.dead_letter_line(F.lit("t"), F.lit('say "hi"'), F.array(F.lit('{"a":1}'), F.lit("[2]")), F.lit("raw/é")).alias("line")
    )
    S.append(row, str(tmp_path / "dead"))
    assert json.loads(spark.read.text(str(tmp_path / "dead")).first().value) == {
        "failed_at": "t", "reason": 'say "hi"', "entries": [{"a": 1}, [2]], "raw": "raw/é",
    }


def test_metadata_pairs(spark):
    df = spark.createDataFrame([(["a=1", "=x", "novalue", "b=c=d", "a=2", "e="],), (["junk"],), ([],)], "p array<string>")
    got = [r.m for r in df.select(parse_metadata(F.col("p")).alias("m")).collect()]
    assert got == [{"b": "c=d", "a": "2", "e": ""}, None, None]


def payload(own, entries=None, **more):
    job = DELIVERY_JOB if own else "App\\Jobs\\Other"
    data = {"commandName": job, **({} if entries is None else {"entries": entries})}
    return json.dumps({"displayName": job, "data": data, **more})


def test_rebatch_golden(spark):
    rows = [("logs", i, payload(True, [{"message": f"m-{i}"}])) for i in range(250)] + [("logs", 250, payload(False))]
    jobs = spark.createDataFrame(rows, "queue string, seq long, payload string")
    waiting = spark.createDataFrame([("logs", 0, None)], "queue string, waiting long, last_due double")
    out = rebatch_backlog(jobs, waiting, F.lit(1000).cast("bigint"), rate=45)
    batches = out.batches.orderBy("batch_no").collect()
    assert [(b.n_entries, b.due_in, b.retry_deadline) for b in batches] == [(100, 0, 4600), (100, 1, 4601), (50, 2, 4602)]
    assert [(r.seq, r.new_seq) for r in out.backlog.collect()] == [(250, 251)]
    total = out.totals.filter("chunk IS NULL").first()
    assert (total.jobs, total.entries, total.batches, total.returned) == (251, 250, 3, 1)


def test_forget_golden(spark):
    rows = [("database", i, None, payload(True, [{}], uuid=f"u{i}")) for i in range(1500)]
    rows += [("database", 1500 + i, None, payload(False)) for i in range(3)]
    rows += [("database", 1503, None, payload(False, note=DELIVERY_JOB))]
    stores = spark.createDataFrame(rows, "store string, id long, name string, payload string")
    out = forget_failed(stores)
    row = out.counts.first()
    assert (row.scanned, row.matched, row.deleted) == (1504, 1500, 1500)
    assert out.remaining.count() == 4
    assert forget_failed(stores, dry_run=True).counts.first().deleted == 0


def test_export_keeps_one_copy_and_the_unreadable(spark):
    rows = [
        ("database", 1, None, payload(True, [{"m": 1}], uuid="a")), ("database", 2, None, payload(True, [{"m": 2}], uuid="b")),
        ("listing", 1, None, payload(True, [{"m": 3}], uuid="a")), ("listing", 2, DELIVERY_JOB, payload(False, [{"m": 4}], uuid="c")),
        ("listing", 3, None, payload(True, uuid="d")), ("listing", 4, None, payload(True, [{"m": 5}], uuid="b")),
        ("listing", 5, DELIVERY_JOB, "{broken"),
    ]
    stores = spark.createDataFrame(rows, "store string, id long, name string, payload string")
    out = forget_failed(stores, export=True)
    lines = [json.loads(r.line) for r in out.exported.orderBy("store", "id").collect()]
    assert [(x["reason"], x["entries"]) for x in lines] == [
        ("failed job a", [{"m": 1}]), ("failed job b", [{"m": 2}]), ("failed job c", [{"m": 4}]),
    ]
    assert sorted((r.store, r.id) for r in out.remaining.collect()) == [("listing", 3), ("listing", 5)]
