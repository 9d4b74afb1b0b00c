"""Redaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators.audit import mask_and_audit
from spillway.functions.redact import redact_json, register, redact_text, redact_value
from spillway.plans import adapters as A
from spillway.plans.catalog.registry import query

MASK_SQL = r"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace({0},
  '\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b', '[JWT]', 'g'),
  'Bearer\s+[A-Za-z0-9._~+/=-]{{10,}}', 'Bearer [REDACTED]', 'gi'),
  '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b', '[EMAIL]', 'g'),
  '\b\d(?:[ -]?\d){{12,18}}\b', '[CARD]', 'g')"""


def _seeded(text, key):
    """Secrets of every kind put behind some texts."""
    return F.concat(
        text,
        F.when(key % 5 == 0, " Bearer eyJabc.def.ghi and bearer abcdefghijkl")
        .when(key % 5 == 1, F.concat(F.lit(" mail é"), key, F.lit("@example.com")))
        .when(key % 5 == 2, " é4111 1111 1111 1111 expires 12/28")
        .otherwise(""),
    )


SEEDED_SQL = """({0} || CASE {1} % 5 WHEN 0 THEN ' Bearer eyJabc.def.ghi and bearer abcdefghijkl'
  WHEN 1 THEN ' mail é' || {1} || '@example.com' WHEN 2 THEN ' é4111 1111 1111 1111 expires 12/28' ELSE '' END)"""


@query("redact_text", f"SELECT doc_id, {MASK_SQL.format(SEEDED_SQL.format('text', 'doc_id'))} AS text FROM documents")
def redact_documents(spark, d):
    return A.table(spark, d, "documents").select(
        "doc_id", redact_text(_seeded(F.col("text"), F.col("doc_id"))).alias("text")
    )


@query("redact_conversations", f"SELECT conv_id, turn, {MASK_SQL.format('text')} AS text FROM conversations")
def redact_conversations(spark, d):
    return A.table(spark, d, "conversations").select("conv_id", "turn", redact_text(F.col("text")).alias("text"))


@query("redact_extra_patterns", f"""
SELECT doc_id, regexp_replace({MASK_SQL.format('text')}, '[0-9]{{4,}}', '[NUMBER]', 'g') AS text FROM documents
""")
def redact_extra(spark, d):
    return A.table(spark, d, "documents").select(
        "doc_id", redact_text(F.col("text"), [("[0-9]{4,}", "[NUMBER]")]).alias("text")
    )


@query("redact_keys", """
SELECT c_custkey, c_name AS name, '[REDACTED]' AS password, '[REDACTED]' AS UserToken, '[REDACTED]' AS footprint,
       CAST(c_nationkey AS BIGINT) AS nation FROM customer
""")
def redact_keys(spark, d):
    c = A.table(spark, d, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.col("c_name").alias("password"), F.col("c_custkey").alias("UserToken"),
            F.col("c_acctbal").alias("footprint"), F.col("c_nationkey").cast("bigint").alias("nation"),
        ).alias("row"),
    )
    return c.select("c_custkey", redact_value(F.col("row"), c.schema["row"].dataType).alias("row")).select("c_custkey", "row.*")


@query("redact_nested", """
SELECT c_custkey, '{"profile":{"name":"' || c_name || '","mails":["[EMAIL]","plain"],"keys":{"api_key":"[REDACTED]","ok":"value"}},' ||
  '"tags":{"segment":"' || c_mktsegment || '","Cookie":"[REDACTED]"},"cards":[{"no":"[CARD]","n":' || c_nationkey || '}]}' AS doc
FROM customer
""")
def redact_nested(spark, d):
    c = A.table(spark, d, "customer").select(
        "c_custkey",
        F.struct(
            F.struct(
                F.col("c_name").alias("name"),
                F.array(F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")), F.lit("plain")).alias("mails"),
                F.struct(F.lit("k-123").alias("api_key"), F.lit("value").alias("ok")).alias("keys"),
            ).alias("profile"),
            F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("Cookie"), F.lit("c")).alias("tags"),
            F.array(
                F.struct(F.lit("4111-1111-1111-1111").alias("no"), F.col("c_nationkey").cast("bigint").alias("n"))
            ).alias("cards"),
        ).alias("doc"),
    )
    return c.select("c_custkey", F.to_json(redact_value(F.col("doc"), c.schema["doc"].dataType)).alias("doc"))


@query("redact_map", """
SELECT event_id, '-' AS missing, json_extract_string(props, '$.k') AS k, '[REDACTED]' AS auth, '[EMAIL] ok' AS note FROM events
""")
def redact_map(spark, d):
    e = A.events(spark, d).select(
        "event_id",
        F.create_map(
            F.lit("k"), F.get_json_object("props", "$.k"), F.lit("X-Authorization"), F.lit("abc"),
            F.lit("note"), F.concat(F.lit("u"), "user_id", F.lit("@example.com ok")),
        ).alias("m"),
    )
    masked = e.select("event_id", redact_value(F.col("m"), e.schema["m"].dataType).alias("m"))
    return masked.select(
        "event_id", F.coalesce(F.try_element_at("m", F.lit("nothing")), F.lit("-")).alias("missing"),
        F.col("m")["k"].alias("k"), F.col("m")["X-Authorization"].alias("auth"), F.col("m")["note"].alias("note"),
    )


@query("redact_json", """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"secret_id":"[REDACTED]","list":["[EMAIL]",1,null,true],"inner":{"otp":"[REDACTED]","a":"b"}}' AS doc
FROM events
""")
def redact_free_form(spark, d):
    text = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"),
        F.lit(',"secret_id":{"deep":[1]},"list":["u'), F.col("user_id"),
        F.lit('@example.com",1,null,true],"inner":{"otp":7,"a":"b"}}'),
    )
    return A.events(spark, d).select("event_id", redact_json(text).alias("doc"))


@query("depth_bound", """
SELECT event_id, repeat('{"a":', 11) || CASE WHEN event_id % 2 = 0 THEN '"[MAX_DEPTH]"' ELSE '"[REDACTED]"' END || repeat('}', 11) AS doc
FROM events
""")
def depth_bound(spark, d):
    """A value below level 10 is cut off, unless its key alone already hides it."""
    leaf = F.when(F.col("event_id") % 2 == 0, F.lit('{"b":{"c":1}}')).otherwise(F.lit("0"))
    deep = F.concat(F.repeat(F.lit('{"a":'), 11), leaf, F.repeat(F.lit("}"), 11))
    hidden = F.regexp_replace(deep, r'"a":0', '"token":0')
    masked = redact_json(hidden)
    return A.events(spark, d).select("event_id", F.regexp_replace(masked, '"token"', '"a"').alias("doc"))


@query("masking_audit", r"""
WITH t0 AS (SELECT source, """ + SEEDED_SQL.format("text", "doc_id") + r""" AS t FROM documents),
t1 AS (SELECT source, len(regexp_extract_all(t, '\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b')) AS a,
  regexp_replace(t, '\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b', '[JWT]', 'g') AS t FROM t0),
t2 AS (SELECT source, a, len(regexp_extract_all(t, '(?i)Bearer\s+[A-Za-z0-9._~+/=-]{10,}')) AS b,
  regexp_replace(t, 'Bearer\s+[A-Za-z0-9._~+/=-]{10,}', 'Bearer [REDACTED]', 'gi') AS t FROM t1),
t3 AS (SELECT source, a, b, len(regexp_extract_all(t, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b')) AS c,
  regexp_replace(t, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b', '[EMAIL]', 'g') AS t FROM t2),
t4 AS (SELECT source, a, b, c, len(regexp_extract_all(t, '\b\d(?:[ -]?\d){12,18}\b')) AS d FROM t3),
m AS (SELECT source, unnest(['[JWT]', 'Bearer [REDACTED]', '[EMAIL]', '[CARD]']) AS mask, unnest([a, b, c, d]) AS n FROM t4)
SELECT source, grouping(source) = 1 AS total, mask, CAST(sum(n) AS BIGINT) AS inserted, count(*) FILTER (n > 0) AS texts
FROM m GROUP BY GROUPING SETS ((source, mask), (mask))
""")
def masking_audit(spark, d):
    docs = A.table(spark, d, "documents")
    rows = docs.select("doc_id", "source", _seeded(F.col("text"), F.col("doc_id")).alias("text"))
    return mask_and_audit(rows, "text", "source")[1].select("source", "total", "mask", "inserted", "texts")


@query("sql_functions", f"""
SELECT doc_id, {MASK_SQL.format(SEEDED_SQL.format('text', 'doc_id'))} AS text, '{{{{"id":' || doc_id || ',"my_token":"[REDACTED]","to":"[EMAIL]"}}}}' AS props FROM documents
""".replace("{{", "{").replace("}}", "}"))
def sql_functions(spark, d):
    """The masks as functions of ``spark.sql``."""
    docs = A.table(spark, d, "documents")
    register(spark)
    props = F.concat(F.lit('{"id":'), "doc_id", F.lit(',"my_token":"t","to":"a@example.com"}'))
    docs.select("doc_id", _seeded(F.col("text"), F.col("doc_id")).alias("text"), props.alias("props")).createOrReplaceTempView("spillway_texts")
    return spark.sql("SELECT doc_id, redact_text(text) AS text, redact_json(props) AS props FROM spillway_texts")
