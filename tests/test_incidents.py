"""Exception groups, deploys, regressions, outages, trails and the masking audit against plain loops and on edge cases."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spillway.operators import incidents as I
from spillway.operators.asof import next_match, with_next
from spillway.operators.audit import mask_and_audit
from spillway.operators.blockfold import Blocks
from spillway.operators.trail import request_trail
from spillway.streaming import run_available

T0 = dt.datetime(2026, 3, 1)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("strict", [True, False])
def test_next_match_with_ties_and_one_hot_key(spark, strict):
    r = random.Random(strict)
    left = [(r.choice(["hot"] * 8 + ["a", "b", None]), r.choice([None, *range(60)]), k) for k in range(600)]
    right = [(r.choice(["hot", "a", None]), r.choice([None, *range(70)]), k, f"v{k}") for k in range(40)]
    a = spark.createDataFrame([(k, at(t), n) for k, t, n in left], "app string, ts timestamp, seq long")
    b = spark.createDataFrame([(k, at(t), n, v) for k, t, n, v in right], "app string, ts timestamp, version long, name string")
    got = {r.seq: r.next and r.next.version for r in next_match(a, b, ["app"], "ts", "ts", "version", strict=strict).collect()}
    for app, t, seq in left:
        later = [(u, v) for k, u, v, _ in right if k is not None and k == app and t is not None and u is not None and (u > t or u == t and not strict)]
        assert got[seq] == (min(later)[1] if later else None), (app, t)
    assert len(got) == len(left)
    assert next_match(a.limit(0), b, ["app"], "ts", "ts", "version").count() == 0
    assert next_match(a, b.limit(0), ["app"], "ts", "ts", "version").where("next IS NOT NULL").count() == 0


def test_with_next_across_partitions(spark):
    r = random.Random(1)
    rows = [(r.choice(["x"] * 5 + ["y", None]), r.choice([None, *range(300)]), k) for k in range(500)]
    df = spark.createDataFrame([(k, at(t), n) for k, t, n in rows], "app string, ts timestamp, seq long")
    got = with_next(df, ["app"], "ts").collect()
    want = collections.Counter()
    for app in ("x", "y", None):
        times = sorted(t for k, t, _ in rows if k == app and t is not None)
        want.update((app, at(t), at(u)) for t, u in zip(times, [*times[1:], None]))
    assert collections.Counter((r.app, r.ts, r.next_at) for r in got) == want


def test_templates(spark):
    cases = {
        "User 1234 not found": "User # not found", "User 9876 not found": "User # not found", "  a\n\t b ": "a b", "": "", None: "",
        "job 01234567-89AB-cdef-0123-456789abcdef at 0xDEADbeef": "job # at #", "v1.2.3-é7": "v#.#.#-é#",
    }
    df = spark.createDataFrame([(k,) for k in cases], "message string").withColumn("t", I.template(F.col("message")))
    assert {r.message: r.t for r in df.collect()} == cases


def test_groups_with_nulls_and_repeats(spark):
    rows = [("a", 1, at(5), "E", "id 1", None), ("a", 2, at(4), "E", "id 22", ""), ("a", 3, None, "E", "id 3", None), ("a", 3, None, "E", "id 3", None), ("b", 4, at(1), None, None, None)]
    df = spark.createDataFrame(rows, "app string, seq long, ts timestamp, class string, message string, frame string").withColumn("n", F.lit(7))
    got = {r.app: r for r in I.group_exceptions(df).collect()}
    assert (got["a"].n, got["a"].n_messages, got["a"].template, got["a"].first.seq, got["a"].last.seq) == (4, 3, "id #", 3, 1)
    assert (got["b"]["class"], got["b"].frame, got["b"].n) == ("", "", 1)
    assert I.group_exceptions(df.limit(0)).count() == 0


def test_lifecycle_in_small_blocks(spark):
    r = random.Random(3)
    signals = [(r.choice(["hot"] * 9 + ["g", None]), t // 3, r.choice([I.OCCURRENCE] * 3 + [I.RESOLUTION]), str(t)) for t in range(900)]
    df = spark.createDataFrame([(g, at(t), k, n) for g, t, k, n in signals], "g string, ts timestamp, kind int, id string")
    want, state = [], {}
    for g, t, k, n in sorted(signals, key=lambda s: (s[1], s[2], s[3])):
        before = state.get(g, "new")
        if k == I.OCCURRENCE:
            after = {"new": "open", "resolved": "reopened"}.get(before, before)
        else:
            after = "new" if before == "new" else "resolved"
        state[g] = after
        if after != before:
            want.append((g, at(t), n, before, after))
    for rows in (7, 65_536):
        got = [(r.g, r.ts, r.id, r.before, r.after) for r in I.lifecycle(df, ["g"], Blocks(rows)).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(want) > 100


def test_deploys_resolve_and_reopen(spark):
    kind = "app string, seq long, ts timestamp, class string, message string, frame string"
    seen = spark.createDataFrame([("a", n, at(t), "E", f"id {n}", "f") for n, t in enumerate([0, 10, 10, 30, 50])], kind)
    landed = spark.createDataFrame([("a", at(10), 1, True), ("a", at(20), 2, False), ("a", at(40), 3, True), ("b", at(60), 4, True)], "app string, ts timestamp, version long, success boolean")
    changes = [(r.ts, r.id, r.before, r.after) for r in I.regressions(seen, landed).orderBy("ts", "kind").collect()]
    # The deploy at 10 comes before the occurrences at 10, the failed one resolves nothing.
    assert changes == [(at(0), "0", "new", "open"), (at(10), "1", "open", "resolved"), (at(10), "1", "resolved", "reopened"), (at(40), "3", "reopened", "resolved"), (at(50), "4", "resolved", "reopened")]
    state = I.resolved_groups(I.group_exceptions(seen), landed).first()
    assert state.state == "open" and state.deploy is None
    assert I.resolved_groups(I.group_exceptions(seen.where("seq < 4")), landed).first().deploy.version == 3


def test_outages(spark):
    rows = [("a", t) for t in (0, 60, 60, 100, 279, 459.5, 700)] + [("b", 0), ("c", 690), ("d", None), (None, 0)]
    df = spark.createDataFrame([(k, at(t)) for k, t in rows], "app string, ts timestamp")
    got = {(r.app, r.last, r.offline_at, r.back_at) for r in I.outages(df, 60).collect()}
    assert got == {("a", at(279), at(459), at(459.5)), ("a", at(459.5), at(639.5), at(700)), ("b", at(0), at(180), None), (None, at(0), at(180), None)}
    late = I.outages(df, 60, F.lit(at(880)).cast("timestamp")).collect()
    assert {r.app for r in late if r.back_at is None} == {"a", "b", "c", None}
    assert I.outages(df.limit(0), 60).count() == 0


def test_outages_over_a_stream(spark, tmp_path):
    r = random.Random(6)
    beats = [("hot", t) for t in range(0, 9000, 50) if not 2000 < t < 2400] + [(r.choice("abc"), r.randrange(9000)) for _ in range(150)]
    beats.sort(key=lambda b: b[1])
    for k in range(3):  # a trigger each, in order of time
        part = [(a, at(t)) for a, t in beats[k * len(beats) // 3 : (k + 1) * len(beats) // 3]]
        spark.createDataFrame(part, "app string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("app string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {(r.app, r.last, r.offline_at) for r in run_available(I.closed_sessions(stream, 60), "beats").collect()}
    whole = I.outages(spark.read.parquet(str(tmp_path / "in")), 60).collect()
    assert got == {(r.app, r.last, r.offline_at) for r in whole} and len(got) > 20
    assert ("hot", at(2000), at(2180)) in got


def test_trail_of_a_hot_request(spark):
    r = random.Random(5)
    rows = [(r.choice(["hot", "hot", None, *map(str, range(40))]) if k % 3 else "hot", r.randrange(50), k) for k in range(900)]
    rows += [("twice", 1, 5), ("twice", 1, 5)]
    df = spark.createDataFrame(rows, "id string, t int, seq long")
    pages = request_trail(df, "id", ["t", "seq"], F.struct("t", "seq"), page_rows=7).collect()
    want = collections.defaultdict(list)
    for k, t, n in sorted((x for x in rows if x[0] is not None), key=lambda x: x[1:]):
        want[k].append((t, n))
    got = collections.defaultdict(list)
    for p in sorted(pages, key=lambda p: p.page):
        assert p.first == p.page * 7 == len(got[p.id]) and p.n == len(p.entries) <= 7
        got[p.id] += [tuple(e) for e in p.entries]
    assert got == want
    assert request_trail(df.limit(0), "id", ["t"], F.col("t")).count() == 0
    with pytest.raises(ValueError):
        request_trail(df, "id", ["t"], F.col("t"), page_rows=0)


def test_masking_audit(spark):
    rows = [(1, "a", "x@example.com and [EMAIL], y@example.org"), (2, "a", None), (3, None, "Bearer abcdefghijk Bearer eyJa.b.c"), (4, "b", "4111 1111 1111 1111 tel 12345")]
    df = spark.createDataFrame(rows, "id long, source string, text string").withColumn("mask", F.lit("mine"))
    masked, audit = mask_and_audit(df, "text", "source", [("[0-9]{5}", "[NUMBER]")])
    assert masked.columns == df.columns
    assert {r.id: r.text for r in masked.collect()} == {1: "[EMAIL] and [EMAIL], [EMAIL]", 2: None, 3: "Bearer [REDACTED] Bearer [JWT]", 4: "[CARD] tel [NUMBER]"}
    got = {(r.source, r.total, r.mask): (r.inserted, r.texts) for r in audit.collect()}
    assert len(got) == 4 * 5
    assert {k: v for k, v in got.items() if v[0]} == {
        ("a", False, "[EMAIL]"): (2, 1), (None, False, "[JWT]"): (1, 1), (None, False, "Bearer [REDACTED]"): (1, 1), ("b", False, "[CARD]"): (1, 1), ("b", False, "[NUMBER]"): (1, 1),
        (None, True, "[EMAIL]"): (2, 1), (None, True, "[JWT]"): (1, 1), (None, True, "Bearer [REDACTED]"): (1, 1), (None, True, "[CARD]"): (1, 1), (None, True, "[NUMBER]"): (1, 1),
    }
    assert all(r.inserted == 0 and r.total for r in mask_and_audit(df.limit(0), "text", "source")[1].collect())
