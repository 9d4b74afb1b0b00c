"""Rows the ingest endpoint refuses inside an otherwise good batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spillway.functions.text import clip

BATCH = ["batch_id"]


def _is(value: Column, *kinds: str) -> Column:
    schema = F.schema_of_variant(value)
    test = F.startswith(schema, F.lit(kinds[0]))
    for kind in kinds[1:]:
        test = test | F.startswith(schema, F.lit(kind))
    return test


def _messages(value: Column) -> Column:
    """A message list as an array: a single message counts as a list of one."""
    return (
        F.when(_is(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
        .when(_is(value, "OBJECT"), F.map_values(F.try_variant_get(value, "$", "map<string,variant>")))
        .when(_is(value, "VOID"), F.array().cast("array<variant>"))
        .otherwise(F.array(value))
    )


def _message_text(value: Column) -> Column:
    flag = F.try_variant_get(value, "$", "boolean")
    return (
        F.when(_is(value, "ARRAY", "OBJECT", "VOID"), F.to_json(value))
        .when(_is(value, "BOOLEAN"), F.when(flag, "1").otherwise(""))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def invalid_rows(responses: DataFrame) -> DataFrame:
    """``(batch_id, pos, reason)`` named by validation responses.

    Reads ``batch_id, n_entries, status, body``. ``body.errors`` maps
    ``logs.<pos>.<field>`` to one or more messages; positions outside the batch
    and other keys are ignored.
    """
    errors = F.from_json("body", "errors map<string,variant>")["errors"]
    named = responses.select(
        *BATCH, "n_entries", "status", F.posexplode(errors).alias("_k", "_key", "_value")
    ).withColumn("pos", F.regexp_extract("_key", r"^logs\.(\d+)(?:\.|$)", 1).try_cast("bigint"))
    said = named.filter(F.col("pos") < F.col("n_entries")).select(
        *BATCH, "status", "pos", "_k", "_key", F.posexplode(_messages(F.col("_value"))).alias("_m", "_message")
    )
    line = F.concat(F.col("_key"), F.lit(": "), _message_text(F.col("_message")))
    # Messages of one row of one response: bounded by the size of that response.
    per_row = said.groupBy(*BATCH, "pos").agg(
        F.first("status").alias("_status"), F.array_sort(F.collect_list(F.struct("_k", "_m", line.alias("line")))).alias("_lines")
    )
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), "; ")
    return per_row.select(
        *BATCH, "pos", F.concat(F.lit("HTTP "), F.col("_status").cast("string"), F.lit(": "), clip(text)).alias("reason")
    )


def refused_in_order(invalid: DataFrame) -> DataFrame:
    """``(batch_id, n_refused, refused)``: the refused rows (pos, reason) of each batch by ascending position.

    A batch has 100 entries at most, and a response's rows were grouped by position before, so the list is bounded.
    """
    listed = F.array_sort(F.collect_list(F.struct("pos", "reason")))
    return invalid.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("n_refused"), listed.alias("refused"))


def rejected_entries(entries: DataFrame, invalid: DataFrame) -> DataFrame:
    """Entries a response names, with its reason."""
    return entries.join(invalid, [*BATCH, "pos"], "inner")


def remaining_entries(entries: DataFrame, invalid: DataFrame) -> DataFrame:
    """Entries no response names, renumbered inside their batch (at most 100 rows)."""
    left = entries.join(invalid.select(*BATCH, "pos"), [*BATCH, "pos"], "left_anti")
    w = Window.partitionBy(*BATCH).orderBy("pos")
    return left.withColumn("new_pos", (F.row_number().over(w) - 1).cast("bigint"))


def resolve(entries: DataFrame, responses: DataFrame) -> DataFrame:
    """Fate of each entry of a refused batch: quarantine, resend or split.

    Rows named by the response are quarantined one by one and the rest is sent
    again; a batch named as a whole, or of a single row, is quarantined; an
    unexplained refusal halves the batch.
    """
    invalid = invalid_rows(responses).withColumnRenamed("reason", "_named")
    said = clip(F.coalesce("body", F.lit(""))).alias("_said")  # cut before it goes to every row
    refused = entries.join(responses.select(*BATCH, "n_entries", "status", said), BATCH, "inner")
    marked = refused.join(invalid, [*BATCH, "pos"], "left")
    w = Window.partitionBy(*BATCH)
    k = F.count("_named").over(w)
    n = F.col("n_entries")
    whole = F.concat(F.lit("HTTP "), F.col("status").cast("string"), F.lit(": "), F.col("_said"))
    counted = marked.withColumn("_k", k)
    some = (F.col("_k") > 0) & (F.col("_k") < n)
    fate = (
        F.when(some & F.col("_named").isNotNull(), "quarantine")
        .when(some, "resend")
        .when((F.col("_k") == 0) & (n > 1), "split")
        .otherwise("quarantine")
    )
    half = F.when(fate == "split", (F.col("pos") >= F.floor((n + 1) / 2)).cast("bigint"))
    return counted.select(
        *entries.columns,
        fate.alias("fate"),
        F.when(fate == "quarantine", F.when(some, F.col("_named")).otherwise(whole)).alias("reason"),
        half.alias("half"),
    )


def bisect(entries: DataFrame, is_bad: Column) -> DataFrame:
    """Pieces a batch falls into when every refused piece is halved.

    A piece is refused while it holds a bad row; a refused single row is
    quarantined. All rounds reuse one partitioning by batch, and a batch holds
    at most 100 rows, so seven halvings always reach single rows.
    """
    w = Window.partitionBy(*BATCH)
    out = (
        entries.withColumn("_bad", is_bad.cast("int"))
        .withColumn("piece", F.lit(0).cast("bigint"))
        .withColumn("size", F.count(F.lit(1)).over(w))
    )
    for _ in range(7):
        piece = Window.partitionBy(*BATCH, "piece")
        half = F.floor((F.col("size") + 1) / 2).cast("bigint")
        right = F.col("pos") - F.col("piece") >= half
        out = (
            out.withColumn("_split", (F.max("_bad").over(piece) == 1) & (F.col("size") > 1))
            .withColumn("_right", F.col("_split") & right)
            .withColumn("_half", half)
            .withColumn("piece", F.when(F.col("_right"), F.col("piece") + F.col("_half")).otherwise(F.col("piece")))
            .withColumn(
                "size",
                F.when(~F.col("_split"), F.col("size"))
                .when(F.col("_right"), F.col("size") - F.col("_half"))
                .otherwise(F.col("_half")),
            )
            .drop("_split", "_right", "_half")
        )
    return out.withColumn("quarantined", F.col("_bad") == 1).drop("_bad")


