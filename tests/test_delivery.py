import datetime

import pytest
from pyspark.sql import functions as F

from spillway.functions.text import clip_bytes, retry_after_seconds
from spillway.operators import delivery as D, filters, pacing, rejection as R
from spillway.plans.adapters import NOW_SEC


def test_retry_after(spark):
    printed = lambda seconds, form: datetime.datetime.fromtimestamp(NOW_SEC + seconds, datetime.timezone.utc).strftime(form)
    fixdate = "%a, %d %b %Y %H:%M:%S GMT"
    cases = {str(n): min(max(n, 1), 600) for n in (-10**25, -3, 0, 1, 9, 599, 601, 10**25)}
    cases |= {f"\t{n} ": n for n in (2, 45)} | {printed(n, fixdate): min(max(n, 1), 600) for n in (-90, 1, 75, 9000)}
    good = printed(75, fixdate)
    other_day = good.replace(good[:3], "Sun" if good[:3] != "Sun" else "Sat")
    spoilt = [other_day, good.lower(), good[:-4], good[5:], good.replace("GMT", "CET"), good.replace(printed(75, "%d"), "00"), printed(75, "%Y/%m/%d %H:%M:%S"), "45.0", "4e1", "45 s", "0x2d", "later", " ", None]
    cases |= dict.fromkeys(spoilt, 30)
    df = spark.createDataFrame(list(cases.items()), "h string, want long")
    rows = df.withColumn("got", retry_after_seconds(F.col("h"), F.lit(NOW_SEC))).collect()
    assert [(r.h, r.got) for r in rows] == [(r.h, r.want) for r in rows]


ATTEMPT = "status int, retry_after string, body string, attempt int, now long, retry_deadline long, sync boolean"


@pytest.mark.parametrize(
    "row,action,delay,words",
    [
        ((503, None, "", 1, NOW_SEC, NOW_SEC + 9999, False), "release", 10, "HTTP 503"),
        ((500, None, "", 3, NOW_SEC, NOW_SEC + 9999, False), "release", 120, "HTTP 500"),
        ((408, None, "", 2, NOW_SEC, NOW_SEC + 9999, False), "release", 30, "HTTP 408"),
        ((502, None, "", 9, NOW_SEC, NOW_SEC + 9999, False), "release", 300, "HTTP 502"),
        ((None, None, "reset", 1, NOW_SEC, NOW_SEC + 9999, False), "release", 10, "unreachable: reset"),
        ((429, "17", "", 50, NOW_SEC, NOW_SEC + 9999, False), "release", 17, "HTTP 429"),
        ((401, None, "no", 1, NOW_SEC, NOW_SEC + 9999, False), "park", None, "HTTP 401 no"),
        ((503, None, "", 3, NOW_SEC, NOW_SEC + 140, False), "park", None, "retry window exhausted"),
        ((429, "120", "", 1, NOW_SEC, NOW_SEC + 100, False), "park", None, "retry window exhausted"),
        ((200, None, "", 1, NOW_SEC, NOW_SEC - 1, False), "park", None, "exhausted while waiting"),
        ((503, None, "", 1, NOW_SEC, NOW_SEC + 9999, True), "park", None, "sync queue"),
        ((503, None, "", 1, NOW_SEC, None, False), "park", None, "without a deadline"),
        ((429, None, "", 1, NOW_SEC, None, False), "park", None, "without a deadline"),
        ((200, None, "", 1, NOW_SEC, NOW_SEC + 9999, False), "done", None, None),
    ],
)
def test_next_action(spark, row, action, delay, words):
    got = D.next_action(spark.createDataFrame([row], ATTEMPT)).first()
    assert (got.action, got.delay) == (action, delay)
    assert got.reason is None if words is None else words in got.reason


def test_drain_backoff(spark):
    statuses = [503, 503, 429, 503, 200, 503, None, 422, 500, 500, 500, 500, 500, 200]
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate(statuses)], "run string, i int, status int")
    rows = D.drain_backoff(df, ["run"], ["i"]).orderBy("i").collect()
    assert [r.wait_sec for r in rows] == [2, 4, None, 8, None, 2, 4, None, 2, 4, 8, 16, None, None]
    assert [r.stops for r in rows].index(True) == 12
    assert [r.after_stop for r in rows] == [False] * 13 + [True]


def test_own_failures(spark):
    from spillway.constants import DELIVERY_JOB as job

    rows = [
        ("DeliveryFailed", None, "x", True), ("MaxAttemptsExceeded", None, f"{job} has been attempted", True),
        ("MaxAttemptsExceeded", None, "Other has been attempted", False), ("RuntimeError", None, f"{job} has failed", False),
        ("TimeoutExceeded", job, "x", True), ("TimeoutExceeded", "Other", f"{job} has timed out", False), (None, None, None, False),
    ]
    df = spark.createDataFrame(rows, "c string, j string, m string, want boolean")
    got = df.withColumn("got", filters.is_own_failure(F.col("c"), F.col("j"), F.col("m"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_pacing_goldens(spark):
    six = spark.range(6).withColumn("start", F.lit(0).cast("bigint"))
    due = [r.d for r in six.select(pacing.due_delay(F.col("id"), pacing.default_rate(50), F.col("start")).alias("d")).collect()]
    assert due == [0, 1, 2, 4, 5, 6]
    start = spark.range(1).select(
        pacing.schedule_start(F.lit(3), F.lit(NOW_SEC + 120), F.lit(NOW_SEC), 6).alias("a"),
        pacing.schedule_start(F.lit(0), F.lit(None).cast("double"), F.lit(NOW_SEC), 6).alias("b"),
        pacing.schedule_start(F.lit(9), F.lit(NOW_SEC), F.lit(NOW_SEC), 6, 5).alias("c"),
        pacing.schedule_start(F.lit(9), F.lit(NOW_SEC), F.lit(NOW_SEC), 0).alias("d"),
    ).first()
    assert tuple(start) == (130, 0, 5, 0)
    assert [pacing.default_rate(x) for x in (0, 1, 50)] == [0, 1, 45]
    chunks = spark.createDataFrame([("q", c, 1, 0) for c in range(10)], "q string, chunk long, n_batches long, start long")
    kept = pacing.claimed_chunks(chunks, ["q"], "chunk", 2, "start", max_ahead_min=2).filter("claimed").orderBy("chunk")
    assert [r.due_in for r in kept.collect()] == [0, 30, 60, 90, 120]


def entries(spark, n, batch="b"):
    return spark.range(n).select(F.lit(batch).alias("batch_id"), F.col("id").alias("pos"))


def test_named_rows_are_quarantined_and_the_rest_resent(spark):
    body = '{"errors":{"logs.71.message":["too long"],"logs.3.level":"bad","logs.300.x":["out"],"summary":["no"]}}'
    answer = spark.createDataFrame([("b", 100, 422, body)], "batch_id string, n_entries int, status int, body string")
    out = R.resolve(entries(spark, 100), answer)
    bad = {r.pos: r.reason for r in out.filter("fate = 'quarantine'").collect()}
    assert bad == {3: "HTTP 422: logs.3.level: bad", 71: "HTTP 422: logs.71.message: too long"}
    again = R.remaining_entries(entries(spark, 100), R.invalid_rows(answer)).orderBy("new_pos").collect()
    assert [r.pos for r in again] == [p for p in range(100) if p not in (3, 71)]
    assert [r.new_pos for r in again] == list(range(98))


def test_unexplained_refusals(spark):
    answer = spark.createDataFrame([("b", 5, 413, "too large")], "batch_id string, n_entries int, status int, body string")
    halves = R.resolve(entries(spark, 5), answer).orderBy("pos").collect()
    assert [(r.fate, r.half) for r in halves] == [("split", 0)] * 3 + [("split", 1)] * 2
    one = spark.createDataFrame([("b", 1, 413, "too large")], "batch_id string, n_entries int, status int, body string")
    row = R.resolve(entries(spark, 1), one).first()
    assert (row.fate, row.reason) == ("quarantine", "HTTP 413: too large")


def test_bisecting_isolates_the_bad_rows(spark):
    out = R.bisect(entries(spark, 100), F.col("pos").isin(3, 71)).collect()
    assert sorted(r.pos for r in out if r.quarantined) == [3, 71]
    assert all(r["size"] == 1 for r in out if r.quarantined)


def test_clip_bytes(spark):
    df = spark.createDataFrame([("aé😀b",)], "t string")
    got = [df.select(clip_bytes(F.col("t"), n).alias("r")).first().r for n in range(9)]
    assert got == ["", "a", "a", "aé", "aé", "aé", "aé", "aé😀", "aé😀b"]
