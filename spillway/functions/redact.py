"""Masking of secrets and personal data.

``redact_value`` builds one expression from a column's *schema*, so typed
structs, maps and arrays are masked inside whole-stage codegen. ``redact_json``
covers free-form JSON text, the only case where the shape is unknown when the
plan is built; it is an Arrow-batched UDF.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from spillway.constants import MASKS, MAX_DEPTH, REDACTED, SENSITIVE_KEYS, TOO_DEEP
from spillway.functions.text import ascii_pattern, finite_or_zero, valid_utf8

Masks = Sequence[tuple[str, str]]


_WORD = "[A-Za-z0-9_]"
_DOMAIN = r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![A-Za-z0-9_])"
# The masks once more, phrased so that Java decides on one character at most
# positions and looks around only at likely starts. ``tests`` hold them equal
# to the plain patterns. An address may start after an ASCII word character
# (then with a dot or sign) or after any other character, which is put back.
_QUICK = {
    "[JWT]": (
        ascii_pattern(rf"eyJ(?<!{_WORD}eyJ)[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b"),
        "[JWT]",
    ),
    "[EMAIL]": (
        rf"[.%+-](?<={_WORD}.)[A-Za-z0-9._%+-]*+{_DOMAIN}"
        rf"|(^|[^A-Za-z0-9_]){_WORD}[A-Za-z0-9._%+-]*+{_DOMAIN}",
        "$1[EMAIL]",
    ),
    "[CARD]": (rf"\d(?<!{_WORD}\d)(?:[ -]?\d){{12,18}}(?!{_WORD})", "[CARD]"),
}
# Necessary condition of each mask, cheap to test.
_HINTS = {
    "[JWT]": lambda s: F.contains(s, F.lit("eyJ")),
    "Bearer [REDACTED]": lambda s: s.rlike("(?i)bearer"),
    "[EMAIL]": lambda s: F.contains(s, F.lit("@")),
    "[CARD]": lambda s: s.rlike("[0-9](?:[ -]?[0-9]){12}"),
}


def redact_text(col: Column, extra: Masks = ()) -> Column:
    """Apply the masks from first to last; later ones see earlier results.

    Text that meets no mask's necessary condition is passed on as it is.
    """
    masked, suspicious = col, F.lit(False)
    for pattern, mark in MASKS:
        masked = F.regexp_replace(masked, *_QUICK.get(mark, (ascii_pattern(pattern), mark)))
        suspicious = suspicious | _HINTS[mark](col)
    out = F.when(suspicious, masked).otherwise(col)
    for pattern, mark in extra:
        out = F.regexp_replace(out, ascii_pattern(pattern), mark)
    return out


def marks_in(col: Column, mark: str) -> Column:
    """How often a mask's mark stands in a text."""
    return F.floor((F.length(col) - F.length(F.replace(col, F.lit(mark)))) / len(mark)).cast("bigint")


def inserted_marks(before: Column, after: Column, extra: Masks = ()) -> Column:
    """How many marks masking has put in, as a struct with a field per mask, in their order; null texts count as 0.

    No mask takes another's mark away, so what is there more than before has been inserted.
    """
    marks = dict.fromkeys(mark for _, mark in [*MASKS, *extra])
    return F.struct(*[F.coalesce(marks_in(after, m) - marks_in(before, m), F.lit(0).cast("bigint")).alias(m) for m in marks])


def is_sensitive_name(name: str, keys: Sequence[str] = SENSITIVE_KEYS) -> bool:
    lowered = name.lower()
    return any(needle.lower() in lowered for needle in keys)


def is_sensitive_key(key: Column, keys: Sequence[str] = SENSITIVE_KEYS) -> Column:
    return F.lower(key).rlike("|".join(re.escape(k.lower()) for k in keys))


def free_form(dtype: T.DataType) -> bool:
    """The type holds a VARIANT, or a map by text whose values cannot hold the mark."""
    if isinstance(dtype, T.StructType):
        return any(free_form(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return free_form(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return free_form(dtype.valueType) or isinstance(dtype.keyType, T.StringType) and not isinstance(dtype.valueType, T.StringType)
    return isinstance(dtype, T.VariantType)


def sanitised(col: Column, dtype: T.DataType) -> Column:
    """``col`` with 0 for what isn't a finite number and U+FFFD for bytes that aren't UTF-8, at any depth.

    A VARIANT is covered where it is a number itself, not inside its own arrays and objects.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return finite_or_zero(col).cast(dtype)
    if isinstance(dtype, T.StringType):
        return valid_utf8(col)
    if isinstance(dtype, T.VariantType):
        number = F.when(F.schema_of_variant(col).isin("DOUBLE", "FLOAT"), F.try_variant_get(col, "$", "double"))
        odd = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
        return F.when(odd, F.parse_json(F.lit("0"))).otherwise(col)
    if isinstance(dtype, T.StructType) and dtype.fields:
        return F.when(col.isNotNull(), F.struct(*[sanitised(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: sanitised(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: sanitised(v, dtype.valueType))
    return col


def _as_variant(col: Column, dtype: T.DataType, keys: Sequence[str], extra: Masks, depth: int) -> Column:
    """A masked VARIANT; Python cannot run inside a transform, so whole arrays and maps come here."""
    return F.try_parse_json(redact_json_udf(keys, extra, depth)(F.to_json(sanitised(col, dtype))))


def redact_value(
    col: Column,
    dtype: T.DataType,
    keys: Sequence[str] = SENSITIVE_KEYS,
    extra: Masks = (),
    depth: int = 0,
) -> Column:
    """Masked and sanitised copy of ``col``. A sensitive field becomes a STRING field."""
    if depth > MAX_DEPTH:
        return F.lit(TOO_DEEP)
    if isinstance(dtype, T.StringType):
        return redact_text(valid_utf8(col), extra)
    if isinstance(dtype, T.VariantType) or isinstance(dtype, (T.ArrayType, T.MapType)) and free_form(dtype):
        return _as_variant(col, dtype, keys, extra, depth)
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return col
        fields = []
        for field in dtype.fields:
            if is_sensitive_name(field.name, keys):
                inner = F.lit(REDACTED)
            else:
                inner = redact_value(col.getField(field.name), field.dataType, keys, extra, depth + 1)
            fields.append(inner.alias(field.name))
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: redact_value(x, dtype.elementType, keys, extra, depth + 1))
    if isinstance(dtype, T.MapType):
        if not isinstance(dtype.keyType, T.StringType):
            return F.transform_values(col, lambda _, v: redact_value(v, dtype.valueType, keys, extra, depth + 1))
        if not isinstance(dtype.valueType, T.StringType):
            # Values of another type cannot hold the mark.
            return _as_variant(col, dtype, keys, extra, depth)
        return F.transform_values(
            col,
            lambda k, v: F.when(is_sensitive_key(k, keys), F.lit(REDACTED)).otherwise(
                redact_value(v, dtype.valueType, keys, extra, depth + 1)
            ),
        )
    return sanitised(col, dtype)


def _masker(keys: Sequence[str], masks: Masks):
    """Recursive masking of one decoded JSON value."""
    rules = [(re.compile(p, re.ASCII), mark.replace("\\", r"\\")) for p, mark in masks]
    needles = [k.lower() for k in keys]

    def walk(value, depth):
        if depth > MAX_DEPTH:
            return TOO_DEEP
        if isinstance(value, str):
            for rule, mark in rules:
                value = rule.sub(mark, value)
            return value
        if isinstance(value, list):
            return [walk(v, depth + 1) for v in value]
        if isinstance(value, dict):
            return {
                k: REDACTED if any(n in k.lower() for n in needles) else walk(v, depth + 1)
                for k, v in value.items()
            }
        return value

    return walk


def _flattened(text: str) -> str:
    """JSON text in which whatever lies deeper than the bound is the mark, so that it can be decoded."""
    out, depth, quoted, at = [], 0, False, 0
    for k, c in enumerate(text):
        if quoted:
            quoted = c != '"' or _escapes(text, k)
        elif c == '"':
            quoted = True
        elif c in "[{":
            depth += 1
            if depth == MAX_DEPTH + 2:
                out.append(text[at:k] + json.dumps(TOO_DEEP))
        elif c in "]}":
            if depth == MAX_DEPTH + 2:
                at = k + 1
            depth -= 1
    return "".join(out) + (text[at:] if depth == 0 else "")


def _escapes(text: str, at: int) -> bool:
    """An odd number of backslashes stands before this place."""
    n = at
    while text[n - 1] == "\\":
        n -= 1
    return (at - n) % 2 == 1


def redact_json_udf(keys: Sequence[str] = SENSITIVE_KEYS, extra: Masks = (), depth: int = 0):
    """UDF from JSON text to masked JSON text; undecodable text gives NULL.

    What lies too deep becomes the mark, half a surrogate pair U+FFFD, and a number that JSON doesn't have 0.
    """
    keys, masks = list(keys), [*MASKS, *extra]

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        walk = _masker(keys, masks)

        def one(text):
            if text is None:
                return None
            try:
                try:
                    value = json.loads(text, parse_constant=lambda _: 0)
                except RecursionError:
                    value = json.loads(_flattened(text), parse_constant=lambda _: 0)
            except ValueError:
                return None
            masked = json.dumps(walk(value, depth), ensure_ascii=False, separators=(",", ":"))
            return masked.encode("utf-16", "surrogatepass").decode("utf-16", "replace")

        for batch in batches:
            yield batch.map(one, na_action="ignore").astype(object)

    return masked


def redact_json(col: Column, keys: Sequence[str] = SENSITIVE_KEYS, extra: Masks = ()) -> Column:
    return redact_json_udf(keys, extra)(col)


def register(spark: SparkSession) -> None:
    """Offer ``redact_text`` and ``redact_json`` to SQL in this session.

    ``redact_text`` is a SQL macro over built-ins, so it is inlined by the
    optimiser; only ``redact_json`` crosses into Python.
    """
    body = "s"
    for pattern, mark in MASKS:
        java, put = _QUICK.get(mark, (ascii_pattern(pattern), mark))
        quoted = java.replace("\\", "\\\\").replace("'", "\\'")
        body = f"regexp_replace({body}, '{quoted}', '{put}')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION redact_text(s STRING) RETURNS STRING RETURN {body}")
    spark.udf.register("redact_json", redact_json_udf())
