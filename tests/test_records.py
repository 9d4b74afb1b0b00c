import json

from pyspark.sql import functions as F

from spillway.operators.config import effective_config
from spillway.operators.normalize import flatten_exception, to_entries, with_wire_text
from spillway.plans import adapters as A
from spillway.plans.normalise_logs import wanted

SF = "/root/testdata/sf0.001"


def record(spark, context_sql, exc_sql=None, message="'hi a@b.cc'"):
    exc = f", {exc_sql} AS exc" if exc_sql else ""
    return spark.sql(
        f"""SELECT 1 AS app, 1 AS proc, 1 AS seq, timestamp'2026-01-02 03:04:05.678' AS ts, 'critical' AS level_name,
        {message} AS message, 'h' AS host, {context_sql} AS context{exc}"""
    )


def entry(df, **kw):
    return json.loads(with_wire_text(to_entries(df, **kw)).first().entry)


EXC = "named_struct('class','E','message','mail a@b.cc','file','f','line',3,'trace',repeat('#0 x\n', 40))"
SHAPES = {
    "struct": "named_struct('order_id','7','password','p','type','job','request_id','r-1','message','mine')",
    "map": "map('order_id','7','password','p','type','job','request_id','r-1','message','mine')",
    "json": """'{"order_id":"7","password":"p","type":"job","request_id":"r-1","message":"mine"}'""",
    "variant": """parse_json('{"order_id":"7","password":"p","type":"job","request_id":"r-1","message":"mine"}')""",
}


def test_every_context_shape_gives_the_same_entry(spark):
    for sql in SHAPES.values():
        got = entry(record(spark, sql))
        assert got == {
            "timestamp": "2026-01-02T03:04:05.678+00:00", "level": "ERROR", "message": "hi [EMAIL]", "host": "h",
            "requestId": "r-1", "contextType": "job",
            "context": {"order_id": "7", "password": "[REDACTED]", "type": "job", "message": "mine"},
        }
        thrown = entry(record(spark, sql, EXC))
        assert thrown["contextType"] == "exception"
        assert thrown["context"] == {
            "class": "E", "message": "mail [EMAIL]", "file": "f", "line": 3, "trace": ["#0 x"] * 30,
            "order_id": "7", "password": "[REDACTED]", "type": "job",
        }


def test_message_may_stay_raw(spark):
    assert entry(record(spark, "map('a','b')"), redact_message=False)["message"] == "hi a@b.cc"


def test_nulls_inside_a_context_survive_and_an_empty_one_goes(spark):
    assert entry(record(spark, "named_struct('a', cast(null as string))"))["context"] == {"a": None}
    assert "context" not in entry(record(spark, "cast(map() as map<string,string>)"))
    assert "context" not in entry(record(spark, "'{}'"))


def test_request_id_is_masked_before_it_is_promoted(spark):
    assert entry(record(spark, "map('request_id','1234567890123')"))["requestId"] == "[CARD]"
    assert entry(record(spark, "'{\"request_id\":5}'"))["context"] == {"request_id": 5}


def test_free_form_exception_merge(spark):
    df = spark.sql(f"SELECT from_json('{{\"message\":\"mine\",\"k\":1}}', 'map<string,variant>') AS c, {EXC} AS e")
    exc = F.struct(*[F.col(f"e.{k}").alias(k) for k in ("class", "message", "file", "line")], F.split("e.trace", "\n").alias("trace"))
    got = json.loads(df.select(F.to_json(flatten_exception(F.col("c"), exc)).alias("j")).first().j)
    assert got["message"] == "mail a@b.cc" and got["k"] == 1 and got["trace"][0] == "#0 x"


def test_filters_reach_the_scan(spark):
    plain = spark.read.parquet(f"{SF}/events.parquet")
    plan = plain.filter(F.col("value") >= 100).select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,100.0)" in plan
    kept = wanted(A.raw_log(spark, SF), A.app_config(spark, SF)).select("seq")
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "props" not in text


def test_remote_numbers(spark):
    cases = [(50, 50), ('"40"', 40), (1, 10), (0, 100), (-5, 100), ("null", 100), ('"many"', 100), ("true", 100), ('" 1e2 "', 100)]
    df = spark.createDataFrame([(i, f'{{"batchSize":{v}}}') for i, (v, _) in enumerate(cases)], "app int, remote string")
    assert [r.batch_size for r in effective_config(df).orderBy("app").collect()] == [w for _, w in cases]
