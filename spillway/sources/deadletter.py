"""Dead-letter files: JSON lines ``{failed_at, reason, entries[], raw?}``."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spillway.functions.text import trim_blanks
from spillway.operators.ordering import same

LINE_ID = ["file", "block", "line"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of dead-letter files with a position that follows file order.

    The text source splits large files, so a position is (file, split start,
    row of the split); ``\\n`` alone ends a line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("_metadata.file_size").alias("file_size"),
        "value",
    )


def _entries(value: Column) -> Column:
    """``entries`` as an array of VARIANT; NULL when absent or scalar. An object counts as its values."""
    parsed = F.try_parse_json(value)
    listed = F.try_variant_get(parsed, "$.entries", "array<variant>")
    # The schema of all entries is worked out only where they aren't an array; an object's members then follow.
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$.entries", "variant"))
    # from_json keeps the document order of an object's members, VARIANT sorts them.
    members = F.map_values(F.from_json(value, "entries map<string,variant>")["entries"])
    return F.coalesce(listed, F.when(F.startswith(kind, F.lit("OBJECT")), members))


def containers(values: Column) -> Column:
    """JSON text of the arrays and objects among VARIANT values; scalars are dropped."""
    texts = F.transform(values, lambda v: F.to_json(v))
    return F.filter(texts, lambda t: F.startswith(t, F.lit("{")) | F.startswith(t, F.lit("[")))


def parse(lines: DataFrame) -> DataFrame:
    """Add ``entries`` (JSON text, arrays and objects only) and ``malformed`` to non-blank lines."""
    kept = lines.filter(trim_blanks(F.col("value")) != "")
    found = kept.withColumn("_found", _entries(trim_blanks(F.col("value"))))
    return found.select(
        *lines.columns,
        containers(F.col("_found")).alias("entries"),
        F.col("_found").isNull().alias("malformed"),
    )


def unnest_entries(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entry, in order; rows without entries leave none.

    The outer explode keeps Spark from testing ``entries`` in a filter of its
    own below, which would decode every line a second time.
    """
    return rows.select(*keys, F.posexplode_outer("entries").alias("pos", "entry")).filter(F.col("pos").isNotNull())


def unnest(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entry of the readable lines, in line order."""
    return unnest_entries(parsed, keys)


def malformed(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quarantine rows of the lines that could not be read."""
    bad = parsed.filter(F.col("malformed"))
    return bad.select(
        *keys, F.lit("malformed line").alias("reason"), F.rtrim("value", F.lit("\r\n")).alias("raw")
    )


def file_ends(lines: DataFrame) -> DataFrame:
    """Per file: its last line, and whether that line lacks a terminator.

    A complete file has one terminator byte per line, so the lines add up to
    one byte more than the file exactly when the last one is unterminated. The size of a
    compressed file says nothing of that kind: see ``compressed_ends``.
    """
    last = F.max(F.struct("block", "line"))
    spare = F.sum(F.octet_length("value").cast("bigint") + 1) - F.max("file_size")
    plain = ~F.lower("file").rlike(_COMPRESSED)
    return lines.groupBy("file").agg(last.alias("_last"), (plain & (spare == 1)).alias("torn"))


_COMPRESSED = r"\.(gz|gzip|bz2|deflate|zst|zstd)$"


def _last_byte(name: str, content: bytes) -> int | None:
    """The last byte of what ``content`` unpacks to, a part at a time; null if that is nothing, -1 if it can't be read to the end."""
    import bz2
    import zlib

    kind = name.lower().rsplit(".", 1)[-1]
    last, rest = None, content
    try:
        while rest:
            if kind in ("zst", "zstd"):
                import zstandard

                tool = zstandard.ZstdDecompressor().decompressobj()
            else:
                tool = bz2.BZ2Decompressor() if kind == "bz2" else zlib.decompressobj(zlib.MAX_WBITS | 32)
            at = 0
            while at < len(rest) and not tool.eof:
                part = tool.decompress(rest[at : at + (1 << 16)])
                at += 1 << 16
                last = part[-1] if part else last
            if not tool.eof:
                return -1
            rest = tool.unused_data + rest[at:]  # a file may be several streams
    except Exception:  # noqa: BLE001 - whatever a codec says of damaged data
        return -1
    return last


def compressed_ends(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(``file``, ``torn``) of the compressed files (gzip, bzip2, deflate, zstandard) of a path, by the last byte they unpack to.

    Such a file is unpacked by one task when its lines are read, and so here, in parts of bounded size. A file that can't be unpacked to
    its end, as its writer was cut off, is torn; an empty one isn't.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "content").where(F.lower("path").rlike(_COMPRESSED))

    def run(batches):
        for b in batches:
            ends = [(n, _last_byte(n, c) not in (None, 10)) for n, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in ends], pa.string()), pa.array([t for _, t in ends], pa.bool_())], ["file", "torn"])

    return files.mapInArrow(run, "file string, torn boolean")


def quarantine(lines: DataFrame, packed: DataFrame | None = None) -> DataFrame:
    """Malformed lines of files, an unreadable unterminated last line named as torn.

    ``packed`` tells of compressed files whether their last line is unterminated (see ``compressed_ends``).
    """
    bad = malformed(parse(lines), LINE_ID)
    ends = file_ends(lines)
    if packed is not None:
        cut = packed.where("torn").select(F.col("file").alias("_file"))
        ends = ends.join(cut, F.col("file") == F.col("_file"), "left").withColumn("torn", F.col("torn") | F.col("_file").isNotNull())
    ends = ends.filter("torn").select("file", F.col("_last.block").alias("block"), F.col("_last.line").alias("line"), "torn")
    marked = bad.join(ends, same(bad, ends, LINE_ID), "left")
    torn = F.coalesce(ends["torn"], F.lit(False))
    return marked.select(
        *[bad[c] for c in LINE_ID],
        F.when(torn, "incomplete line (torn write)").otherwise(bad["reason"]).alias("reason"),
        bad["raw"],
    )


def dead_letter_line(failed_at: Column, reason: Column, entries: Column, raw: Column | None = None) -> Column:
    """JSON line of a parked batch; ``entries`` is an array of JSON objects as text."""
    head = F.to_json(F.struct(failed_at.alias("failed_at"), reason.alias("reason")))
    body = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"entries":['), F.array_join(entries, ","), F.lit("]")
    )
    if raw is None:
        return F.concat(body, F.lit("}"))
    tail = F.to_json(F.struct(raw.alias("raw")))
    return F.when(raw.isNull(), F.concat(body, F.lit("}"))).otherwise(
        F.concat(body, F.lit(","), F.substring(tail, F.lit(2), F.length(tail)))
    )


def append(lines: DataFrame, path: str, column: str = "line") -> None:
    """Append JSON lines to a dead-letter or quarantine folder."""
    lines.select(F.make_valid_utf8(F.col(column)).alias("value")).write.mode("append").text(path)


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Append ``{entries:[], reason, raw}`` lines."""
    rows.select(
        F.array().cast("array<string>").alias("entries"), "reason", F.make_valid_utf8("raw").alias("raw")
    ).write.mode("append").json(path)
