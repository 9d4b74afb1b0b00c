"""A drain that isn't over, or a sink that lacks one of its triggers, is an error and not a shorter result."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from spillway.plans.catalog import QUERIES, backlog
from spillway.streaming.drain import drain, epoch_sink, read_epochs

SCHEMA = "batch_id string, entries array<string>"


def events(spark, path, kinds):
    rows = spark.createDataFrame([(i, "2024-01-01 00:00:00", k) for i, k in enumerate(kinds)], "event_id long, ts string, event_type string")
    rows.selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "event_type").coalesce(1).write.parquet(f"{path}/events.parquet")


def fill(folder, files):
    folder.mkdir()
    for f in range(files):
        (folder / f"{f}.log").write_text("".join(json.dumps({"entries": [{"m": f * 10 + i}]}) + "\n" for i in range(5)))


def run(spark, path, send):
    drain(spark, str(path / "in"), str(path / "cp"), send, lambda rows, epoch: None, max_files=1, batch_size=10).awaitTermination(240)


def found(spark, path, *checkpoint):
    rows = read_epochs(spark, str(path / "out"), SCHEMA, *checkpoint)
    return sorted(json.loads(e)["m"] for r in rows.collect() for e in r.entries)


def failing(path, at):
    keep = epoch_sink(path)

    def send(rows, epoch):
        if epoch == at:
            raise RuntimeError("no space left")
        keep(rows, epoch)

    return send


@pytest.mark.parametrize("at", [0, 1, 2])
def test_no_failure_but_the_meant_one_is_passed_over(spark, tmp_path, monkeypatch, at):
    events(spark, tmp_path, ["error"] * 60)

    monkeypatch.setattr(backlog, "epoch_sink", lambda path: failing(path, at))
    with pytest.raises(StreamingQueryException, match="no space left"):
        QUERIES["drain_resumed"](spark, str(tmp_path)).collect()


@pytest.mark.parametrize("kinds", [["error"] * 60, ["error", "view"], ["view"] * 3, []])
def test_every_entry_of_the_resumed_drain(spark, tmp_path, kinds):
    events(spark, tmp_path, kinds)
    got = sorted(tuple(r) for r in QUERIES["drain_resumed"](spark, str(tmp_path)).collect())
    assert got == [(i, h, 10) for i, k in enumerate(kinds) if k == "error" for h in (0, 10)]


def test_a_drain_that_broke_off_is_no_result(spark, tmp_path):
    cp = str(tmp_path / "cp")
    fill(tmp_path / "in", 3)
    with pytest.raises(RuntimeError, match="no drain"):
        found(spark, tmp_path, cp)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, failing(str(tmp_path / "out"), 0))
    with pytest.raises(RuntimeError, match="broke off in trigger 0"):
        found(spark, tmp_path, cp)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, failing(str(tmp_path / "out"), 2))
    with pytest.raises(RuntimeError, match="broke off in trigger 2"):
        found(spark, tmp_path, cp)
    assert len(found(spark, tmp_path)) == 10  # what is there so far
    run(spark, tmp_path, epoch_sink(str(tmp_path / "out")))
    assert found(spark, tmp_path, cp) == [f * 10 + i for f in range(3) for i in range(5)]


@pytest.mark.parametrize("lost", [0, 1, 2])
def test_a_sink_that_lost_a_trigger_is_no_result(spark, tmp_path, lost):
    cp = str(tmp_path / "cp")
    fill(tmp_path / "in", 3)
    run(spark, tmp_path, epoch_sink(str(tmp_path / "out")))
    assert len(found(spark, tmp_path, cp)) == len(found(spark, tmp_path)) == 15
    (tmp_path / "out" / str(lost) / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match=rf"lacks triggers \[{lost}\]"):
        found(spark, tmp_path, cp)
    if lost == 2:  # by the sink alone, the last one may still be under way
        assert len(found(spark, tmp_path)) == 10
        return
    with pytest.raises(RuntimeError, match=rf"lacks triggers \[{lost}\]"):  # later ones have come, so it is not
        found(spark, tmp_path)


def test_a_sink_whose_first_folder_is_gone_is_no_result(spark, tmp_path):
    send = epoch_sink(str(tmp_path / "out"))
    send(spark.createDataFrame([("1/0", ["{}"])], SCHEMA), 1)
    with pytest.raises(RuntimeError, match=r"lacks triggers \[0\]"):
        found(spark, tmp_path)


def test_triggers_of_another_drain_are_no_result(spark, tmp_path):
    fill(tmp_path / "in", 1)
    run(spark, tmp_path, epoch_sink(str(tmp_path / "out")))
    epoch_sink(str(tmp_path / "out"))(spark.createDataFrame([("1/0", ["{}"])], SCHEMA), 1)
    with pytest.raises(RuntimeError, match=r"holds triggers \[1\]"):
        found(spark, tmp_path, str(tmp_path / "cp"))


def test_a_drain_of_no_files_is_empty(spark, tmp_path):
    fill(tmp_path / "in", 0)
    run(spark, tmp_path, epoch_sink(str(tmp_path / "out")))
    assert found(spark, tmp_path, str(tmp_path / "cp")) == []
