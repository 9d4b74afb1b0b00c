"""Dead letters, job backlogs and failed-job stores."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from spillway.functions.text import iso8601
from spillway.operators import pacing, packing as P
from spillway.operators.ordering import stage
from spillway.plans import adapters as A
from spillway.plans.catalog.packing import DOMAIN, ORDER, pack_sql
from spillway.plans.catalog.registry import query
from spillway.plans.drain import drain_dead_letters, ranked_sources
from spillway.plans.forget import classify, delete_rows, first_copies, forget_failed
from spillway.plans.rebatch import acknowledged, chunk_jobs, job_entry_rows, pack_jobs, rebatch_backlog, return_foreign
from spillway.session import scratch
from spillway.sources import deadletter as S
from spillway.sources.jobs import split_backlog
from spillway.streaming.drain import drain, epoch_sink, read_epochs

# ----------------------------------------------------------------- dead letters


def _mixed_lines(spark, d):
    i = F.col("event_id")
    c = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    line = (
        F.when(i % 8 == 0, c('{"reason":"r","entries":[{"level":"ERROR","message":"m-', i, '"},"scalar",{"level":"INFO","message":"n-', i, '"}]}'))
        .when(i % 8 == 1, " \t ")
        .when(i % 8 == 2, c("not json ", i, "\r"))
        .when(i % 8 == 3, '{"reason":"no entries"}')
        .when(i % 8 == 4, '{"entries":5}')
        .when(i % 8 == 5, c('{"entries":{"b":{"x":', i, '},"a":7,"c":[1,2]}}'))
        .when(i % 8 == 6, '{"entries":[]}')
        .otherwise(c('{"entries":[[', i, '],{"z":null}]}'))
    )
    return A.events(spark, d).select(i.alias("line"), line.alias("value"))


@query("deadletter_parse", """
SELECT event_id AS line, CAST(pos AS BIGINT) AS pos, CASE
    WHEN event_id % 8 = 0 AND pos = 0 THEN '{"level":"ERROR","message":"m-' || event_id || '"}'
    WHEN event_id % 8 = 0 THEN '{"level":"INFO","message":"n-' || event_id || '"}'
    WHEN event_id % 8 = 5 AND pos = 0 THEN '{"x":' || event_id || '}' WHEN event_id % 8 = 5 THEN '[1,2]'
    WHEN pos = 0 THEN '[' || event_id || ']' ELSE '{"z":null}' END AS entry
FROM events, (VALUES (0), (1)) AS p(pos) WHERE event_id % 8 IN (0, 5, 7)
""")
def deadletter_parse(spark, d):
    out = S.unnest(S.parse(_mixed_lines(spark, d)), ["line"])
    return out.select("line", F.col("pos").cast("bigint").alias("pos"), "entry")


@query("deadletter_quarantine", """
SELECT event_id AS line, 'malformed line' AS reason,
       CASE event_id % 8 WHEN 2 THEN 'not json ' || event_id WHEN 3 THEN '{"reason":"no entries"}' ELSE '{"entries":5}' END AS raw
FROM events WHERE event_id % 8 IN (2, 3, 4)
""")
def deadletter_quarantine(spark, d):
    return S.malformed(S.parse(_mixed_lines(spark, d)), ["line"])


@query("deadletter_line", f"""
WITH {A.RAW_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY app, proc ORDER BY ts, seq) - 1 AS rn FROM raw)
SELECT app, proc, rn // 25 * 25 AS batch_start, '{{"failed_at":"' || strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || '+00:00","reason":"HTTP 503","entries":[' ||
  string_agg('{{"message":"' || message || '"}}', ',' ORDER BY rn) || ']}}' AS line
FROM n GROUP BY app, proc, rn // 25 * 25
""")
def deadletter_line(spark, d):
    rows = A.raw_log(spark, d).select(*DOMAIN, *ORDER, F.to_json(F.struct("message")).alias("entry"))
    packed = P.attach(rows, P.pack_by_count(rows, DOMAIN, ORDER, 25), [*DOMAIN, *ORDER])
    ends = P.assemble(packed, DOMAIN).join(
        packed.groupBy(*DOMAIN, "batch_start").agg(F.max("ts").alias("at")), [*DOMAIN, "batch_start"]
    )
    return ends.select(
        *DOMAIN, "batch_start", S.dead_letter_line(iso8601(F.col("at")), F.lit("HTTP 503"), F.col("entries")).alias("line")
    )


@query("source_union", """
SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS source_rank, event_id AS line,
       row_number() OVER (ORDER BY CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END, event_id) - 1 AS rn FROM events
""")
def source_union(spark, d):
    """An unfinished snapshot is drained before the live file."""
    from spillway.operators.ordering import number_rows

    rows = _mixed_lines(spark, d).select("line")
    both = ranked_sources(rows.filter(F.col("line") % 3 == 0), rows.filter(F.col("line") % 3 != 0))
    numbered = number_rows(stage(both, [], ["source_rank", "line"]), [])
    return numbered.select("source_rank", "line", F.col("_rn").alias("rn"))


RUN_BASE = """
entries AS (SELECT 'r' || (o_orderkey % 2) AS run, o_orderkey AS line, pos, 35 + length(CAST(o_orderkey AS VARCHAR)) AS sz
  FROM orders, (VALUES (0), (1), (2)) AS p(pos) WHERE o_orderkey % 10 > 1 AND pos <= o_orderkey % 3),
base AS (SELECT run, line, pos, sz, 0 AS sec, row_number() OVER (PARTITION BY run ORDER BY line, pos) - 1 AS rn FROM entries)"""
RUN_BATCHES = """,
batches AS (SELECT run, batch_start, count(*) AS n, CAST(sum(sz) AS BIGINT) AS n_bytes,
   row_number() OVER (PARTITION BY run ORDER BY batch_start) - 1 AS batch_no FROM packed GROUP BY run, batch_start)"""


def _run_lines(spark, d):
    key = F.col("o_orderkey")
    entry = lambda p: F.concat(F.lit('{"level":"ERROR","message":"m-'), key, F.lit(f"-{p}"), F.lit('"}'))
    body = F.concat(F.lit('{"entries":['), F.concat_ws(",", *[F.when(key % 3 >= p, entry(p)) for p in range(3)]), F.lit("]}"))
    return A.table(spark, d, "orders").select(
        F.concat(F.lit("r"), key % 2).alias("run"), key.alias("line"),
        F.when(key % 10 == 0, "torn {").when(key % 10 == 1, "").otherwise(body).alias("value"),
    )


def _run_responses(spark, d):
    """One answer per batch: most accepted, some refused with and without named rows, r1 stuck at batch 60."""
    key = F.col("o_orderkey")
    run, no = F.concat(F.lit("r"), key % 2), pacing.div(key, F.lit(2))
    status = (
        F.when((no == 60) & (run == "r1"), 503).when(no % 7 >= 5, 422).otherwise(200)
    )
    body = F.when(no % 7 == 5, '{"errors":{"logs.3.level":["bad"]}}').otherwise("no")
    return A.table(spark, d, "orders").select(run.alias("run"), no.alias("batch_no"), status.alias("status"), body.alias("body"))


def _drained(spark, d):
    return drain_dead_letters(
        _run_lines(spark, d), _run_responses(spark, d), ["run"], ["line"], batch_size=40, max_bytes=1500
    )


@query("drain_report", pack_sql(RUN_BASE, ["run"], 40, size=1500) + RUN_BATCHES + """,
h AS (SELECT *, NOT (run = 'r1' AND batch_no >= 60) AS handled FROM batches)
SELECT run, CAST(count(*) FILTER (WHERE handled AND batch_no % 7 < 5) AS BIGINT) AS batches_sent,
  CAST(coalesce(sum(n) FILTER (WHERE handled AND batch_no % 7 < 5), 0) AS BIGINT) AS entries_sent,
  CAST(count(*) FILTER (WHERE handled AND ((batch_no % 7 = 5 AND n > 3) OR (batch_no % 7 >= 5 AND n = 1))) AS BIGINT) AS rejected,
  (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0 AND 'r' || (o_orderkey % 2) = h.run) AS malformed,
  CAST(bool_or(NOT handled) AS BIGINT) AS remainder
FROM h GROUP BY run
""")
def drain_report(spark, d):
    report = _drained(spark, d).report
    return report.withColumn("remainder", F.col("remainder").cast("bigint"))


@query("drain_unsent", pack_sql(RUN_BASE, ["run"], 40, size=1500) + RUN_BATCHES + """
SELECT run, batch_no, n AS n_entries, n_bytes FROM batches WHERE run = 'r1' AND batch_no >= 60
""")
def drain_unsent(spark, d):
    return _drained(spark, d).unsent.select("run", "batch_no", "n_entries", "n_bytes")


# ----------------------------------------------------------------------- backlog

CHUNK = 500
CHUNKED_SQL = f"""{A.BACKLOG_SQL},
chunked AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY seq) - 1 AS job_no,
  (row_number() OVER (PARTITION BY queue ORDER BY seq) - 1) // {CHUNK} AS chunk FROM jobs)"""
CHUNK_BASE = f"""{CHUNKED_SQL},
entries AS (SELECT queue, chunk, job_no, seq, pos, 33 + length(CAST(seq AS VARCHAR)) AS sz FROM chunked, (VALUES (0), (1)) AS p(pos) WHERE pos < n_entries),
base AS (SELECT queue, chunk, job_no, seq, pos, sz, 0 AS sec, row_number() OVER (PARTITION BY queue, chunk ORDER BY job_no, pos) - 1 AS rn FROM entries)"""


@query("backlog_split", f"WITH {A.BACKLOG_SQL} SELECT queue, seq, CAST(own AS BIGINT) AS own, CAST(n_entries AS BIGINT) AS n_entries FROM jobs")
def backlog_split(spark, d):
    return split_backlog(A.backlog(spark, d)).select("queue", "seq", F.col("own").cast("bigint").alias("own"), "n_entries")


@query("pack_chunked", pack_sql(CHUNK_BASE, ["queue", "chunk"], 60, size=2000) + """
SELECT queue, chunk, job_no, CAST(pos AS BIGINT) AS pos, CAST(batch_start AS BIGINT) AS batch_start FROM packed
""")
def pack_chunked(spark, d):
    entries = job_entry_rows(chunk_jobs(split_backlog(A.backlog(spark, d)), CHUNK))
    packed = pack_jobs(entries, batch_size=60, max_bytes=2000)
    return packed.select("queue", "chunk", "job_no", F.col("pos").cast("bigint").alias("pos"), "batch_start")


@query("ack_prefix", f"""
WITH {CHUNKED_SQL},
q AS (SELECT queue, chunk, CAST(sum(n_entries) AS BIGINT) // 100 * 100 AS queued FROM chunked GROUP BY ALL),
c AS (SELECT c.*, sum(n_entries) OVER (PARTITION BY queue, chunk ORDER BY job_no) AS needs FROM chunked c)
SELECT c.queue, c.chunk, job_no, CAST(needs AS BIGINT) AS needs, CAST(needs <= queued AS BIGINT) AS done FROM c JOIN q USING (queue, chunk)
""")
def ack_prefix(spark, d):
    """Only the full batches of each chunk have been queued so far."""
    jobs = chunk_jobs(split_backlog(A.backlog(spark, d)), CHUNK).select("queue", "chunk", "job_no", "n_entries")
    queued = jobs.groupBy("queue", "chunk").agg((pacing.div(F.sum("n_entries"), F.lit(100)) * 100).alias("queued"))
    out = acknowledged(jobs, queued)
    return out.select("queue", "chunk", "job_no", "needs", F.col("done").cast("bigint").alias("done"))


@query("return_foreign", f"""
WITH {A.BACKLOG_SQL}, t AS (SELECT queue, max(seq) AS last FROM jobs GROUP BY queue)
SELECT queue, seq, last + row_number() OVER (PARTITION BY queue ORDER BY seq) AS new_seq FROM jobs JOIN t USING (queue) WHERE NOT own
""")
def foreign(spark, d):
    jobs = A.backlog(spark, d)
    rows = split_backlog(jobs).filter(~F.col("own")).select("queue", "seq")
    return return_foreign(jobs, rows)


def _repacked(spark, d):
    """Repack behind a target queue that holds one job per finished order."""
    o = A.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    target = o.select(
        F.concat(F.lit("backlog-"), F.col("o_custkey") % 2).alias("queue"),
        (F.lit(A.NOW_SEC) + F.col("o_orderkey") % 600).cast("bigint").alias("due_at"),
    )
    return rebatch_backlog(
        A.backlog(spark, d), pacing.queue_state(target), F.lit(A.NOW_SEC).cast("bigint"),
        chunk=CHUNK, rate=100, max_ahead_min=25, batch_size=60, max_bytes=2000,
    )


REPACK_SQL = pack_sql(CHUNK_BASE, ["queue", "chunk"], 60, size=2000) + f""",
batches AS (SELECT queue, chunk, batch_start, count(*) AS n_entries, CAST(sum(sz) AS BIGINT) AS n_bytes FROM packed GROUP BY ALL),
per AS (SELECT queue, chunk, count(*) AS jobs, CAST(sum(n_entries) AS BIGINT) AS entries, count(*) FILTER (WHERE NOT own) AS returned FROM chunked GROUP BY ALL),
target AS (SELECT 'backlog-' || (o_custkey % 2) AS queue, count(*) AS waiting, max({A.NOW_SEC} + o_orderkey % 600) AS last_due
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
start AS (SELECT queue, greatest(0, waiting * 60 // 100, last_due - {A.NOW_SEC} + 60 // 100) AS start_in FROM target),
placed AS (SELECT per.*, start_in, (SELECT count(*) FROM batches b WHERE b.queue = per.queue AND b.chunk = per.chunk) AS n_batches,
   (SELECT count(*) FROM batches b WHERE b.queue = per.queue AND b.chunk < per.chunk) AS first_batch FROM per JOIN start USING (queue)),
claimed AS (SELECT * FROM placed WHERE start_in + 60 * first_batch // 100 <= 1500)"""


@query("repack_schedule", REPACK_SQL + f""",
numbered AS (SELECT b.*, start_in, first_batch + row_number() OVER (PARTITION BY b.queue, b.chunk ORDER BY batch_start) - 1 AS batch_no
  FROM batches b JOIN claimed USING (queue, chunk))
SELECT queue, chunk, CAST(batch_start AS BIGINT) AS batch_start, batch_no, n_entries, n_bytes, start_in + 60 * batch_no // 100 AS due_in,
       {A.NOW_SEC} + start_in + 60 * batch_no // 100 + 3600 AS retry_deadline FROM numbered
""")
def repack_schedule(spark, d):
    return _repacked(spark, d).batches


@query("repack_totals", REPACK_SQL + """
SELECT queue, coalesce(CAST(chunk AS VARCHAR), 'all') AS chunk, CAST(sum(jobs) AS BIGINT) AS jobs, CAST(sum(entries) AS BIGINT) AS entries,
       CAST(sum(n_batches) AS BIGINT) AS batches, CAST(sum(returned) AS BIGINT) AS returned
FROM claimed GROUP BY GROUPING SETS ((queue, chunk), (queue))
""")
def repack_totals(spark, d):
    totals = _repacked(spark, d).totals
    return totals.withColumn("chunk", F.coalesce(F.col("chunk").cast("string"), F.lit("all")))


@query("repack_backlog", REPACK_SQL + """,
gone AS (SELECT c.*, k.chunk IS NOT NULL AS taken FROM chunked c LEFT JOIN claimed k USING (queue, chunk)),
t AS (SELECT queue, max(seq) AS last FROM jobs GROUP BY queue)
SELECT queue, seq, seq AS new_seq FROM gone WHERE NOT taken
UNION ALL SELECT queue, seq, last + row_number() OVER (PARTITION BY queue ORDER BY seq) FROM gone JOIN t USING (queue) WHERE taken AND NOT own
""")
def repack_backlog(spark, d):
    return _repacked(spark, d).backlog.select("queue", "seq", "new_seq")


def _chunk_table(spark, d):
    rows = chunk_jobs(split_backlog(A.backlog(spark, d)), CHUNK)
    return rows.groupBy("queue", "chunk").agg(pacing.div(F.sum("n_entries") + 99, F.lit(100)).alias("n_batches")).withColumn(
        "start_in", F.lit(0).cast("bigint")
    )


CHUNK_TABLE_SQL = f"""{CHUNKED_SQL},
c AS (SELECT queue, chunk, CAST(sum(n_entries) + 99 AS BIGINT) // 100 AS n_batches FROM chunked GROUP BY ALL),
f AS (SELECT *, CAST(coalesce(sum(n_batches) OVER (PARTITION BY queue ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_batch FROM c)"""


@query("max_ahead", f"""
WITH {CHUNK_TABLE_SQL}
SELECT queue, chunk, first_batch, 60 * first_batch // 2 AS due_in, CAST(60 * first_batch // 2 <= 120 AS BIGINT) AS claimed FROM f
""")
def max_ahead(spark, d):
    """At two batches a minute, chunks whose first batch is due within two minutes are taken."""
    out = pacing.claimed_chunks(_chunk_table(spark, d), ["queue"], "chunk", 2, "start_in", max_ahead_min=2)
    return out.select("queue", "chunk", "first_batch", "due_in", F.col("claimed").cast("bigint").alias("claimed"))


@query("chunk_limit", f"""
WITH {CHUNK_TABLE_SQL} SELECT queue, chunk, first_batch, CAST(chunk < 3 AS BIGINT) AS claimed FROM f
""")
def chunk_limit(spark, d):
    out = pacing.claimed_chunks(_chunk_table(spark, d), ["queue"], "chunk", 0, "start_in", max_chunks=3)
    return out.select("queue", "chunk", "first_batch", F.col("claimed").cast("bigint").alias("claimed"))


@query("schedule_start", f"""
WITH t AS (SELECT o_orderpriority AS queue, count(*) AS waiting, max(CASE WHEN o_orderpriority <> '5-LOW' THEN {A.NOW_SEC} + o_orderkey % 900 + 0.5 END) AS last_due
  FROM orders GROUP BY ALL)
SELECT queue, waiting, CAST(greatest(0, waiting * 60 // 45, coalesce(CAST(ceil(last_due) AS BIGINT) - {A.NOW_SEC} + 60 // 45, 0)) AS BIGINT) AS start_in FROM t
""")
def schedule_start(spark, d):
    due = F.when(F.col("o_orderpriority") != "5-LOW", F.lit(A.NOW_SEC) + F.col("o_orderkey") % 900 + F.lit(0.5))
    jobs = A.table(spark, d, "orders").select(F.col("o_orderpriority").alias("queue"), due.alias("due_at"))
    state = pacing.queue_state(jobs)
    start = pacing.schedule_start(F.col("waiting"), F.col("last_due"), F.lit(A.NOW_SEC), pacing.default_rate(50))
    return state.select("queue", "waiting", start.cast("bigint").alias("start_in"))


# ----------------------------------------------------------------- failed stores


@query("failed_match", f"WITH {A.FAILED_SQL} SELECT store, id, uuid, CAST(own AS BIGINT) AS own, CAST(own AND readable AS BIGINT) AS exportable FROM failed")
def failed_match(spark, d):
    rows = classify(A.failed_jobs(spark, d))
    return rows.select(
        "store", "id", "uuid", F.col("own").cast("bigint").alias("own"),
        (F.col("own") & F.col("readable")).cast("bigint").alias("exportable"),
    )


@query("failed_dedupe", f"""
WITH {A.FAILED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY store, id) AS k FROM failed WHERE own AND readable)
SELECT uuid, store, id FROM r WHERE k = 1
""")
def failed_dedupe(spark, d):
    return first_copies(classify(A.failed_jobs(spark, d)).filter("own"))


FORGET_SQL = f"""{A.FAILED_SQL},
firsts AS (SELECT uuid, min(store || '/' || lpad(CAST(id AS VARCHAR), 12, '0')) AS first FROM failed WHERE own AND readable GROUP BY uuid),
acts AS (SELECT f.*, CASE WHEN NOT own THEN 'foreign' WHEN NOT readable AND (first IS NULL OR store || '/' || lpad(CAST(id AS VARCHAR), 12, '0') < first)
  THEN 'unreadable' ELSE 'delete' END AS action FROM failed f LEFT JOIN firsts USING (uuid))"""


@query("failed_actions", f"WITH {FORGET_SQL} SELECT store, id, action FROM acts")
def failed_actions(spark, d):
    return forget_failed(A.failed_jobs(spark, d), export=True).actions.select("store", "id", "action")


@query("failed_counts", f"""
WITH {FORGET_SQL}
SELECT store, count(*) AS scanned, count(*) FILTER (WHERE own) AS matched, count(*) FILTER (WHERE action = 'delete') AS deleted,
       count(*) FILTER (WHERE action = 'unreadable') AS kept FROM acts GROUP BY store
""")
def failed_counts(spark, d):
    return forget_failed(A.failed_jobs(spark, d), export=True).counts


@query("failed_dry_run", f"""
WITH {A.FAILED_SQL}
SELECT store, count(*) AS scanned, count(*) FILTER (WHERE own) AS matched, CAST(0 AS BIGINT) AS deleted, CAST(0 AS BIGINT) AS kept FROM failed GROUP BY store
""")
def failed_dry_run(spark, d):
    return forget_failed(A.failed_jobs(spark, d), dry_run=True).counts


@query("failed_remaining", f"WITH {A.FAILED_SQL} SELECT store, id FROM failed WHERE NOT own")
def failed_remaining(spark, d):
    return forget_failed(A.failed_jobs(spark, d)).remaining.select("store", "id")


EXPORTED_AT = 1_791_201_600  # 2026-10-05 12:00:00 UTC


@query("failed_export", f"""
WITH {A.FAILED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY store, id) AS k FROM failed WHERE own AND readable)
SELECT store, id, '{{"failed_at":"2026-10-05T12:00:00+00:00","reason":"failed job ' || uuid || '","entries":[{{"message":"m-' || id || '"}}]}}' AS line
FROM r WHERE k = 1
""")
def failed_export(spark, d):
    # The instant of this export, as its SQL states it; the attempts' present (A.NOW_SEC) is another one.
    now = F.timestamp_seconds(F.lit(EXPORTED_AT))
    return forget_failed(A.failed_jobs(spark, d), export=True, now=now).exported.select("store", "id", "line")


@query("delete_matched", f"WITH {A.FAILED_SQL} SELECT store, id FROM failed WHERE NOT (own AND readable)")
def delete_matched(spark, d):
    gone = classify(A.failed_jobs(spark, d)).filter(F.col("own") & F.col("readable")).select("store", "id")
    return delete_rows(A.failed_jobs(spark, d), gone).select("store", "id")


@query("torn_lines", """
SELECT event_id AS id, packed, kind, 'incomplete line (torn write)' AS reason FROM events, (VALUES (false), (true)) AS p(packed), (VALUES ('torn')) AS k(kind) WHERE event_id % 997 = 0
UNION ALL
SELECT event_id, packed, 'whole', 'malformed line' FROM events, (VALUES (false), (true)) AS p(packed) WHERE event_id % 997 = 1
""")
def torn_lines(spark, d):
    """Files that end in the middle of a line and files that don't, plain and compressed.

    A row that is torn has a file of its own, as a file ends once; whole ones share files. All lie in one folder, which is
    listed once and not folder by folder.
    """
    i = F.col("event_id")
    text = F.concat(F.lit('{"entries":[{"m":'), i, F.lit('}]}\n{"entries":[{"kind":"'), F.when(i % 997 == 0, "torn").otherwise("whole"), F.lit('","id":'), i)
    writers = max(8, 2 * spark.sparkContext.defaultParallelism)
    told = []
    for packed in (False, True):
        path = scratch(spark, "torn")
        for rest, end, most in ((0, " ", 1), (1, "\n", 1000)):  # what the writer puts behind a text, texts of a file
            rows = A.events(spark, d).where(i % 997 == rest).select(text.alias("value")).repartition(writers)
            write = rows.write.mode("append").option("lineSep", end).option("maxRecordsPerFile", most)
            (write.option("compression", "gzip") if packed else write).text(path)
        ends = S.compressed_ends(spark, path) if packed else None
        told.append(S.quarantine(S.read_lines(spark, path), ends).withColumn("packed", F.lit(packed)))
    found = F.regexp_extract("raw", '"kind":"(.*?)","id":(-?[0-9]+)', 1).alias("kind")
    number = F.regexp_extract("raw", '"id":(-?[0-9]+)', 1).cast("bigint").alias("id")
    return told[0].unionByName(told[1]).select(number, "packed", found, "reason")


@query("drain_resumed", """
SELECT event_id AS m, CAST(10 * h AS BIGINT) AS first, CAST(10 AS BIGINT) AS n FROM events, (VALUES (0), (1)) AS p(h) WHERE event_type = 'error'
""")
def drain_resumed(spark, d):
    """A drain over several triggers that breaks off after one was sent, and goes on from its checkpoint."""
    i = F.col("event_id")
    entries = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.concat(F.lit('{"m":'), i.cast("string"), F.lit(',"i":'), k.cast("string"), F.lit("}")))
    lines = A.events(spark, d).where("event_type = 'error'").select(S.dead_letter_line(F.lit("2026-01-01"), F.lit("HTTP 503"), entries).alias("line"))
    folder, checkpoint, out = (scratch(spark, f"drain-{x}") for x in ("in", "checkpoint", "out"))
    S.append(lines.repartition(6), folder)
    keep, crash = epoch_sink(out), [1]

    def send(batches, epoch):
        keep(batches, epoch)
        if epoch in crash:
            crash.remove(epoch)
            raise RuntimeError("the sender broke off")

    def run():
        drain(spark, folder, checkpoint, send, lambda rows, epoch: None, max_files=2, batch_size=10).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        if crash:  # not the one that was meant
            raise
    run()  # none is meant here
    done = read_epochs(spark, out, "batch_id string, entries array<string>", checkpoint)
    number = lambda c: F.get_json_object(F.element_at("entries", 1), c).cast("bigint")
    return done.select(number("$.m").alias("m"), number("$.i").alias("first"), F.size("entries").cast("bigint").alias("n"))
