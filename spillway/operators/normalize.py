"""Raw records and application events to wire entries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from spillway.constants import CONTEXT_TYPES, LEVEL_RANK, SENSITIVE_KEYS, TRACE_LINES
from spillway.functions.redact import free_form, Masks, is_sensitive_name, redact_json, redact_text, redact_value, sanitised
from spillway.functions.text import clip_bytes, level_rank, rfc3339_ms, text_json_bytes, valid_utf8

EXC_KEYS = ["class", "message", "file", "line", "trace"]
# Keys a flattened exception replaces in its context.
REPLACED_KEYS = ["exception", *EXC_KEYS]
KEEP_NULLS = {"ignoreNullFields": "false"}
FREE_FORM = "map<string,variant>"


# ---------------------------------------------------------------- scalar parts

def fold_level(level_name: Column) -> Column:
    rank = level_rank(level_name)
    return (
        F.when(rank >= LEVEL_RANK["error"], "ERROR").when(rank >= LEVEL_RANK["warning"], "WARN").otherwise("INFO")
    )


def trace_lines(trace: Column) -> Column:
    return F.slice(F.split(trace, "\n"), 1, TRACE_LINES)


def context_type(kind: Column) -> Column:
    return F.when(kind.isin(CONTEXT_TYPES), kind)


def exception_fields(exc: Column) -> Column:
    """Structured, still unmasked exception payload."""
    return F.when(
        exc.isNotNull(),
        F.struct(
            exc["class"].alias("class"),
            exc["message"].alias("message"),
            exc["file"].alias("file"),
            exc["line"].cast("bigint").alias("line"),
            trace_lines(exc["trace"]).alias("trace"),
        ),
    )


EXC_TYPE = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("trace", T.ArrayType(T.StringType())),
    ]
)


def flatten_exception(context: Column, exc: Column) -> Column:
    """Merge an exception into a free-form context; its keys win over the context's."""
    payload = F.map_from_arrays(
        F.array(*[F.lit(k) for k in EXC_KEYS]),
        F.array(
            *[exc[k].cast("variant") for k in EXC_KEYS[:4]],
            F.to_variant_object(exc["trace"]),
        ),
    )
    rest = F.map_filter(F.coalesce(context, F.create_map().cast(FREE_FORM)), lambda k, _: ~k.isin(REPLACED_KEYS))
    return F.when(exc.isNull(), context).otherwise(F.map_concat(payload, rest))


# ------------------------------------------------------------ context by shape

@dataclass
class _Context:
    """A masked context and the few questions normalisation asks of it."""

    masked: Column
    dtype: T.DataType
    #: JSON text of a context that isn't an object, else NULL.
    other: Column | None = None

    def text(self, key: str) -> Column:
        """Value of ``key`` when it is a string, else NULL."""
        if isinstance(self.dtype, T.StructType):
            if key in self.dtype.names and isinstance(self.dtype[key].dataType, T.StringType):
                return self.masked.getField(key)
            return F.lit(None).cast("string")
        value = F.try_element_at(self.masked, F.lit(key))
        if isinstance(self.dtype.valueType, T.VariantType):
            return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
        return value

    def json(self, drop: Sequence[str] = ()) -> Column:
        """JSON object text without the named keys; nulls inside survive."""
        if isinstance(self.dtype, T.StructType):
            kept = [self.masked.getField(n).alias(n) for n in self.dtype.names if n not in drop]
            body = F.to_json(F.struct(*kept), KEEP_NULLS) if kept else F.lit("{}")
        else:
            kept = F.map_filter(self.masked, lambda k, _: ~k.isin(list(drop))) if drop else self.masked
            body = F.to_json(kept, KEEP_NULLS)
        body = F.when(self.masked.isNull(), F.lit("{}")).otherwise(body)
        return body if self.other is None else F.coalesce(self.other, body)

    def object(self, drop: Sequence[str] = ()) -> Column:
        """As ``json``, with a list under a key of its own."""
        body = self.json(drop)
        return body if self.other is None else F.when(F.startswith(body, F.lit("[")), F.concat(F.lit('{"context":'), body, F.lit("}"))).otherwise(body)


def _masked_context(df: DataFrame, keys: Sequence[str], extra: Masks) -> _Context:
    dtype = df.schema["context"].dataType
    col = F.col("context")
    if isinstance(dtype, T.StructType) or (
        isinstance(dtype, T.MapType) and isinstance(dtype.valueType, T.StringType)
    ):
        return _Context(redact_value(col, dtype, keys, extra), _masked_type(dtype, keys))
    # Free form: JSON text, VARIANT or a map of VARIANT.
    text = sanitised(col, dtype)
    text = text if isinstance(dtype, T.StringType) else F.to_json(text)
    json_text = redact_json(text, keys, extra)
    raw = F.to_json(F.struct(redact_text(text, extra).alias("raw")))
    other = F.when(json_text.isNull() & (F.trim(text) != ""), raw).when(F.startswith(json_text, F.lit("[")) & (json_text != "[]"), json_text)
    return _Context(F.from_json(json_text, FREE_FORM), T.MapType(T.StringType(), T.VariantType()), other)


def _masked_type(dtype: T.DataType, keys: Sequence[str]) -> T.DataType:
    """Top-level shape after masking: sensitive fields have become strings."""
    if not isinstance(dtype, T.StructType):
        return dtype
    return T.StructType(
        [
            # A masked sensitive field is the constant mark, never a usable text value.
            T.StructField(f.name, T.StringType() if is_sensitive_name(f.name, keys) else T.VariantType() if free_form(f.dataType) else f.dataType)
            for f in dtype.fields
        ]
    )


def _join_objects(first: Column, second: Column) -> Column:
    """JSON text of two objects with disjoint keys, merged."""
    return F.when(second == "{}", first).otherwise(
        F.concat(F.substring(first, F.lit(1), F.length(first) - 1), F.lit(","), F.substring(second, F.lit(2), F.length(second)))
    )


# ------------------------------------------------------------------ wire entry

def to_entries(
    records: DataFrame,
    *,
    redact_message: bool = True,
    keys: Sequence[str] = SENSITIVE_KEYS,
    extra_patterns: Masks = (),
    carry: Sequence[str] = ("app", "proc", "seq", "ts"),
    max_message_bytes: int | None = None,
) -> DataFrame:
    """Project raw records to wire entries; one narrow, shuffle-free stage.

    ``max_message_bytes`` cuts longer messages, after masking, to whole characters (the receiving service keeps ``MESSAGE_BYTES``).

    ``context`` may be a STRUCT, a MAP of strings, a MAP of VARIANT, a VARIANT
    or JSON text; the result's ``context`` is JSON text. ``exc`` is optional.
    """
    ctx = _masked_context(records, keys, extra_patterns)
    rid = ctx.text("request_id")
    if "exc" in records.columns:
        exc = exception_fields(F.col("exc"))
        exc_json = F.to_json(redact_value(exc, EXC_TYPE, keys, extra_patterns), KEEP_NULLS)
        with_exc = _join_objects(
            exc_json,
            F.when(rid.isNotNull(), ctx.object([*REPLACED_KEYS, "request_id"])).otherwise(ctx.object(REPLACED_KEYS)),
        )
        plain = F.when(rid.isNotNull(), ctx.json(["request_id"])).otherwise(ctx.json())
        context = F.when(F.col("exc").isNotNull(), with_exc).otherwise(plain)
        kind = F.when(F.col("exc").isNotNull(), F.lit("exception")).otherwise(context_type(ctx.text("type")))
    else:
        context = F.when(rid.isNotNull(), ctx.json(["request_id"])).otherwise(ctx.json())
        kind = context_type(ctx.text("type"))

    message = valid_utf8(F.col("message"))
    message = redact_text(message, extra_patterns) if redact_message else message
    if max_message_bytes is not None:
        message = clip_bytes(message, max_message_bytes)
    return records.select(
        *carry,
        rfc3339_ms(F.col("ts")).alias("timestamp"),
        fold_level(F.col("level_name")).alias("level"),
        message.alias("message"),
        valid_utf8(F.col("host")).alias("host"),
        rid.alias("requestId"),
        kind.alias("contextType"),
        F.nullif(context, F.lit("{}")).alias("context"),
    )


ENTRY_FIELDS = ["timestamp", "level", "message", "host", "requestId", "contextType"]


def entry_json() -> Column:
    """Wire text of an entry: absent fields are left out at the top level only."""
    head = F.to_json(F.struct(*ENTRY_FIELDS))
    return F.when(F.col("context").isNull(), head).otherwise(
        F.concat(
            F.substring(head, F.lit(1), F.length(head) - 1),
            F.lit(',"context":'),
            F.col("context"),
            F.lit("}"),
        )
    )


def with_wire_text(entries: DataFrame) -> DataFrame:
    """Add ``entry`` (JSON text) and ``entry_bytes`` (its size in a request body)."""
    return entries.withColumn("entry", entry_json()).withColumn("entry_bytes", text_json_bytes(F.col("entry")))


# ----------------------------------------------------------- event projections

def job_failed_records(events: DataFrame) -> DataFrame:
    """``job_class, connection, queue, attempts, exc`` and the carried columns to raw records."""
    return _record(
        events,
        F.lit("error"),
        F.lit("Queue job failed"),
        F.struct(
            F.lit("job").alias("type"),
            F.coalesce("job_class", F.lit("unknown")).alias("class"),
            "connection",
            "queue",
            "attempts",
        ),
        F.col("exc"),
    )


def mail_records(events: DataFrame) -> DataFrame:
    """``subject, to, from`` (arrays of STRUCT<address>), ``message_id, data`` to raw records."""
    return _record(
        events,
        F.lit("info"),
        F.lit("Mail sent"),
        F.struct(
            F.lit("mail").alias("type"),
            "subject",
            F.transform("to", lambda a: a["address"]).alias("to"),
            F.get(F.col("from"), F.lit(0))["address"].alias("from"),
            F.col("message_id").alias("messageId"),
            "data",
        ),
    )


def slow_query_records(events: DataFrame) -> DataFrame:
    """``sql, bindings, duration_ms, connection`` of slow queries to raw records."""
    return _record(
        events,
        F.lit("info"),
        F.lit("Slow query"),
        F.struct(
            F.lit("query").alias("type"),
            "sql",
            "bindings",
            F.col("duration_ms").alias("durationMs"),
            "connection",
        ),
    )


def scheduled_records(events: DataFrame) -> DataFrame:
    """``event_class, command, reason, exc`` of scheduled tasks to raw records.

    A task without an exception keeps the null ``exception`` key in its context.
    """
    failed = F.contains(F.lower("event_class"), F.lit("failed"))
    return _record(
        events,
        F.when(failed, "error").otherwise("warning"),
        F.when(failed, "Scheduled task failed").otherwise("Scheduled task skipped"),
        F.struct(
            F.lit("scheduled").alias("type"),
            F.coalesce("command", F.lit("unknown")).alias("command"),
            F.lit(None).cast("string").alias("exception"),
            "reason",
        ),
        F.col("exc"),
    )


def uncaught_records(events: DataFrame) -> DataFrame:
    """``exc, context`` of uncaught exceptions to raw records; an empty message becomes the class.

    An ``exception`` key the context brings along wins over the exception itself.
    """
    exc = F.col("exc")
    dtype = events.schema["context"].dataType
    if isinstance(dtype, T.MapType):
        own = F.coalesce(F.map_contains_key("context", "exception"), F.lit(False))
    else:
        own = F.lit(isinstance(dtype, T.StructType) and "exception" in dtype.names)
    return _record(
        events,
        F.lit("error"),
        F.coalesce(F.nullif(exc["message"], F.lit("")), exc["class"]),
        F.col("context"),
        F.when(~own, exc),
    )


def _record(events: DataFrame, level: Column, message: Column, context: Column, exc: Column | None = None) -> DataFrame:
    return events.select(
        "app",
        "proc",
        "seq",
        "ts",
        "host",
        level.alias("level_name"),
        message.alias("message"),
        context.alias("context"),
        *([exc.alias("exc")] if exc is not None else []),
    )
