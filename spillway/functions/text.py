"""Strings, timestamps and sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from spillway.constants import (
    FALSE_WORDS,
    LEVEL_RANK,
    REASON_CHARS,
    RETRY_AFTER_DEFAULT,
    RETRY_AFTER_MAX,
    RETRY_AFTER_MIN,
)

# Java's \b follows Unicode letters; the masks are defined on ASCII words.
_ASCII_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
# What a trim removes: space, tab, newline, return, NUL, vertical tab.
_BLANKS = " \t\n\r\x00\x0b"


def ascii_pattern(pattern: str) -> str:
    """Rewrite ``\\b`` so that it means an ASCII word edge on the JVM."""
    return pattern.replace(r"\b", _ASCII_EDGE)


def trim_blanks(col: Column) -> Column:
    return F.trim(col, F.lit(_BLANKS))


def level_rank(name: Column) -> Column:
    """Severity of a level name, NULL for an unknown one."""
    ranks = F.create_map(*[F.lit(x) for kv in LEVEL_RANK.items() for x in kv])
    return F.element_at(ranks, F.lower(name))


def is_switched_off(value: Column) -> Column:
    """True only for a value that spells *false*; unknown spellings and NULL are not."""
    return F.coalesce(F.lower(trim_blanks(value.cast("string"))).isin(FALSE_WORDS), F.lit(False))


def is_set(value: Column) -> Column:
    """True for a usable setting: not NULL, not empty, not ``0``."""
    return F.coalesce(~value.isin("", "0"), F.lit(False))


def rfc3339_ms(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def iso8601(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def clip(col: Column, chars: int = REASON_CHARS) -> Column:
    return F.substring(col, 1, chars)


def clip_bytes(col: Column, limit: int) -> Column:
    """Longest prefix of whole characters that fits in ``limit`` UTF-8 bytes."""
    raw = F.encode(col, "utf-8")
    cuts = [F.substring(raw, 1, limit - back).cast("string") for back in range(4)]
    fitting = F.coalesce(*[F.when(F.is_valid_utf8(c), c) for c in cuts])
    return F.when(F.octet_length(col) <= limit, col).otherwise(fitting)


def valid_utf8(col: Column) -> Column:
    return F.make_valid_utf8(col)


def finite_or_zero(col: Column) -> Column:
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(0.0)).otherwise(col)


def json_bytes(json: Column) -> Column:
    """Bytes an entry takes inside a request body, its comma included.

    ``json`` must be rendered with ``ascii_json``; slashes are escaped on the
    wire as well.
    """
    return (F.length(json) + F.length(json) - F.length(F.replace(json, F.lit("/"), F.lit(""))) + 1).cast("bigint")


def ascii_json(value: Column) -> Column:
    """Compact JSON with everything outside ASCII written as ``\\uXXXX``."""
    return F.to_json(value, {"writeNonAsciiCharacterAsCodePoint": "true"})


def text_json_bytes(json: Column) -> Column:
    """``json_bytes`` for JSON text that still holds raw non-ASCII characters.

    A character outside ASCII becomes ``\\uXXXX`` (6 bytes), one outside the
    basic plane a surrogate pair (12 bytes); a slash gains a backslash.
    """
    chars = F.length(json)
    slashes = chars - F.length(F.replace(json, F.lit("/"), F.lit("")))
    wide = F.regexp_count(json, F.lit(r"[^\x00-\x7F]"))
    astral = F.regexp_count(json, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    extra = F.when(F.octet_length(json) == chars, F.lit(0)).otherwise(wide * 5 + astral * 6)
    return (chars + extra + slashes + 1).cast("bigint")


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Seconds asked for by a ``Retry-After`` header at epoch second ``now``.

    Whole seconds or an IMF-fixdate; anything else means the default. A date is
    accepted only when printing it gives the header back, which refuses
    overflowing days and wrong weekdays.
    """
    h = trim_blanks(F.coalesce(header, F.lit("")))
    fixdate = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
    # Only text of the right shape is parsed: a failed parse is slow.
    shaped = F.when(h.rlike(r"\A[A-Z][a-z]{2}, \d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} GMT\z"), F.substring(h, 6, 64))
    at = F.try_to_timestamp(shaped, F.lit("dd MMM yyyy HH:mm:ss 'GMT'"))
    strict = F.when(F.date_format(at, fixdate) == h, F.unix_seconds(at))
    # Digits beyond 18 overflow to "far away" or "now"; the clamp decides anyway.
    digits = F.regexp_extract(h, r"^-?(\d+)$", 1)
    whole = F.when(
        h.rlike(r"\A-?\d+\z"),
        F.when(h.startswith("-"), F.lit(0))
        .otherwise(F.when(F.length(F.ltrim(digits, F.lit("0"))) > 18, F.lit(RETRY_AFTER_MAX)).otherwise(h.try_cast("bigint"))),
    )
    seconds = F.coalesce(whole, strict - now, F.lit(RETRY_AFTER_DEFAULT))
    return F.greatest(F.lit(RETRY_AFTER_MIN), F.least(F.lit(RETRY_AFTER_MAX), seconds)).cast("bigint")
