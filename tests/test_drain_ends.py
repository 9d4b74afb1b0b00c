"""Ends of files whatever their codec, commits of a drain's sink, rows of a batch in order, clipped messages."""

import bz2
import gzip

import zstandard
from pyspark.sql import functions as F

from spillway.operators import normalize as N, rejection as R
from spillway.sources import deadletter as S
from spillway.streaming.drain import epoch_sink, read_epochs

WHOLE, TORN = b'{"entries":[{"m":1}]}\n' * 3000, b'{"entries":[{"m":1}]}\n' * 3000 + b'{"entries":[{"m"'


def test_ends_of_packed_files(spark, tmp_path):
    pack = {"gz": gzip.compress, "bz2": bz2.compress, "zst": zstandard.compress}
    want = {}
    for kind, f in pack.items():
        for name, data in (("whole", f(WHOLE)), ("torn", f(TORN)), ("cut", f(TORN)[:-9]), ("two", f(WHOLE) + f(b"x\n")), ("open", f(WHOLE) + f(b"x")), ("none", f(b"")), ("empty", b"")):
            (tmp_path / f"{name}.{kind}").write_bytes(data)
            if data:  # Spark reads no empty file
                want[f"{name}.{kind}"] = name in ("torn", "cut", "open")
    (tmp_path / "plain.txt").write_bytes(TORN)
    got = {r.file.rsplit("/", 1)[-1]: r.torn for r in S.compressed_ends(spark, str(tmp_path)).collect()}
    assert got == want


def test_torn_lines_of_packed_and_plain_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(TORN)
    (tmp_path / "b.log.gz").write_bytes(gzip.compress(TORN))
    (tmp_path / "c.log.gz").write_bytes(gzip.compress(WHOLE + b"broken\n"))
    (tmp_path / "d.log.gz").write_bytes(gzip.compress(b""))
    lines = S.read_lines(spark, str(tmp_path))
    got = {(r.file.rsplit("/", 1)[-1], r.reason) for r in S.quarantine(lines, S.compressed_ends(spark, str(tmp_path))).collect()}
    torn = "incomplete line (torn write)"
    assert got == {("a.log", torn), ("b.log.gz", torn), ("c.log.gz", "malformed line")}


def test_only_committed_epochs_count(spark, tmp_path):
    path, rows = str(tmp_path / "out"), spark.createDataFrame([("0/0", ["a"])], "batch_id string, entries array<string>")
    assert read_epochs(spark, path, rows.schema).count() == 0
    send = epoch_sink(path)
    send(rows, 0)
    send(rows, 1)
    send(rows, 1)  # repeated
    send(rows, 2)
    (tmp_path / "out" / "2" / "_SUCCESS").unlink()  # broke off
    assert read_epochs(spark, path, rows.schema).count() == 2


def test_refused_rows_in_order(spark):
    rows = [("a", 17, "x"), ("a", 3, "y"), ("a", 100, "z"), ("b", 0, "w")]
    got = {r.batch_id: [x.pos for x in r.refused] for r in R.refused_in_order(spark.createDataFrame(rows, "batch_id string, pos long, reason string")).collect()}
    assert got == {"a": [3, 17, 100], "b": [0]}


def test_messages_are_cut_after_masking(spark):
    rows = spark.createDataFrame([("é" * 10,), ("ab a@example.com " + "x" * 50,), (None,), ("short",)], "message string")
    rows = rows.select(F.lit("a").alias("app"), F.lit("error").alias("level_name"), F.lit(0).cast("timestamp").alias("ts"), "message", F.lit("h").alias("host"), F.lit("{}").alias("context"))
    got = [r.message for r in N.to_entries(rows, carry=["app"], max_message_bytes=15).collect()]
    assert got == ["é" * 7, "ab [EMAIL] xxxx", None, "short"]
    assert N.to_entries(rows, carry=["app"]).first().message == "é" * 10
