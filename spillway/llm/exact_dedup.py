"""Exact dedup by two-pass Bloom filtering.

Pass one learns which hashes may occur twice, pass two marks the rows that hold
such a hash. Only marked rows shuffle; the others are unique for certain and
pass straight through.

* Every row gets the SHA-256 of its normalised text; id and hash are stored once.
* The hash space is cut into shards of about ``SHARD`` rows. Every task sends the
  distinct hashes that it holds, packed, to their shards (a hash that it holds
  twice is flagged, so a hot text costs a task one entry). A shard inserts them
  into one Bloom filter and puts those it finds there already into a second.
  Its size is fixed by ``SHARD`` and ``BITS``, whatever the input.
* The second filters of a slice of the hash space (at most ``filter_mb``) are
  broadcast and mark that slice's rows. The number of slices follows the row
  count; each is read by a range of the sorted hash column.
"""

from __future__ import annotations

import hashlib
import math
import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from spillway.llm.common import arrow_map, utf8
from spillway.session import materialise

LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
SHARD = 1 << 20
BITS = 16
PROBES = 4
FLUSH = 1 << 19
SHA = T.StructField("sha", T.BinaryType())


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_mb: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row
    with the largest id stays (null is smallest); of rows that also share the id,
    one. A null text counts as empty. Further columns are not looked at. An empty
    table gives an empty result.
    """
    rows = materialise(hashed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), "hashes")
    parts = []
    for lo, hi, shards, first, bits in repeated_filters(rows, filter_mb):  # one slice's filters at a time
        parts.append(materialise(mark(rows, lo, hi, shards, first, bits), "marked"))
        bits.destroy()
    marked = reduce(DataFrame.unionByName, parts)
    alone = marked.where(~F.col("maybe")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
    maybe = marked.where("maybe")
    stays = maybe.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    # Stored, so that the join can split a text of many rows.
    grouped = maybe.join(materialise(stays, "stays"), "sha").select(
        F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_mb: int = 64) -> DataFrame:
    """``docs`` with one row of each group of equal texts, one with the largest id; columns as they came.

    Null texts count as empty; of rows that agree in id too, any one stays. An empty table stays empty.
    Hashes are stored alone, and whole rows once, as they are marked. Only where the hash space has several slices they
    are stored before as well, sorted by hash within each task, and every slice reads its own; rows that cannot have a copy do not shuffle.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashes = materialise(_with_hash(rows.select("text")).select("h"), "hashes")
    parts = []
    for lo, hi, shards, first, bits in repeated_filters(hashes, filter_mb):
        if not parts and hi < shards.first_hash(shards.count):
            rows = materialise(_with_hash(rows).sortWithinPartitions("h"), "rows")
        own = rows if "text" in rows.columns else rows.where((F.col("h") >= lo) & (F.col("h") < hi))
        parts.append(materialise(_mark_whole(own, shards, bits), "marked"))
        bits.destroy()
    marked = reduce(DataFrame.unionByName, parts)
    alone = marked.where(~F.col("maybe")).select("kept.*")
    grouped = marked.where("maybe").groupBy("sha").agg(F.max_by("kept", F.struct("id")).alias("kept")).select("kept.*")
    return alone.unionByName(grouped)


def _digests(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """SHA-256 of the normalised texts, and their first 56 bits."""
    digests = [hashlib.sha256((t or b"").translate(LOWER)).digest() for t in utf8(texts)]
    h = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64) >> np.uint64(8)
    return pa.array(digests, pa.binary()), h.view(np.int64)


def hashed(df: DataFrame) -> DataFrame:
    """``id``, ``row`` (unique), ``h`` (64 bits of the digest) and ``sha``, sorted by ``h`` within each task."""

    def run(batches):
        for b in batches:
            sha, _ = _digests(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), sha], ["id", "sha"])

    kind = df.schema["id"].dataType.simpleString()
    out = arrow_map(df, run, f"id {kind}, sha binary").withColumn("h", F.conv(F.hex(F.substring("sha", 1, 7)), 16, 10).cast("long"))
    return out.withColumn("row", F.monotonically_increasing_id()).sortWithinPartitions("h")


def _with_hash(rows: DataFrame) -> DataFrame:
    """``rows`` with digest and hash of the text in its place."""
    kept = [f for f in rows.schema if f.name != "text"]

    def run(batches):
        for b in batches:
            sha, h = _digests(b.column("text"))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), sha, pa.array(h)], [*(f.name for f in kept), "sha", "h"])

    return arrow_map(rows, run, T.StructType([*kept, SHA, T.StructField("h", T.LongType())]))


class Shards:
    """Where a 56-bit hash belongs, and its Bloom positions there."""

    def __init__(self, rows: int):
        self.count = max(1, math.ceil(rows / SHARD))
        self.bits = 1 << max(10, math.ceil(math.log2(max(1, rows) / self.count * BITS)))

    def of(self, h: np.ndarray) -> np.ndarray:
        return ((h >> 24) * self.count) >> 32

    def first_hash(self, shard: int) -> int:
        """The smallest hash of a shard."""
        return -(-(shard << 32) // self.count) << 24

    def positions(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
            return ((a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(self.bits - 1)).astype(np.int64)


def repeated_filters(rows: DataFrame, filter_mb: int) -> Iterator[tuple[int, int, Shards, int, Broadcast]]:
    """Pass one: for each slice of the hash space (first hash, end, shards, first shard, broadcast filters)."""
    shards = Shards(rows.count())

    def local(batches):
        held, n = [], 0
        for b in batches:
            held.append(b.column("h").to_numpy())
            n += len(held[-1])
            if n >= FLUSH:
                yield from sent(held)
                held, n = [], 0
        if n:
            yield from sent(held)

    def sent(held):
        h, times = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.r_[0, np.nonzero(np.diff(shards.of(h)))[0] + 1, len(h)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part, twice = h[lo:hi], times[lo:hi] > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shards.of(part[:1])[0])]), pa.array([part.tobytes()]), pa.array([part[twice].tobytes()])], ["shard", "once", "twice"]
            )

    def insert(group: pd.DataFrame) -> pd.DataFrame:
        seen, again = np.zeros(shards.bits, bool), np.zeros(shards.bits, bool)
        for once, twice in zip(group["once"], group["twice"]):
            at = shards.positions(np.frombuffer(once, np.int64))
            again[at[seen[at].all(axis=1)]] = True
            seen[at] = True
            again[shards.positions(np.frombuffer(twice, np.int64))] = True
        return pd.DataFrame({"shard": group["shard"][:1], "bits": [np.packbits(again).tobytes()]})

    packed = arrow_map(rows.select("h"), local, "shard long, once binary, twice binary")
    filters = materialise(packed.groupBy("shard").applyInPandas(insert, "shard long, bits binary"), "filters")
    at_once = max(1, (filter_mb << 20) * 8 // shards.bits)
    for lo in range(0, shards.count, at_once):
        hi = min(lo + at_once, shards.count)
        bits = {r.shard: bytes(r.bits) for r in filters.where(F.col("shard").between(lo, hi - 1)).collect()}
        yield shards.first_hash(lo), shards.first_hash(hi), shards, lo, rows.sparkSession.sparkContext.broadcast(bits)


def _test(h: np.ndarray, shards: Shards, bits: dict[int, bytes]) -> np.ndarray:
    own, out = shards.of(h), np.zeros(len(h), bool)
    for shard in np.unique(own):
        here = np.nonzero(own == shard)[0]
        if (packed := bits.get(int(shard))) is not None:
            table, at = np.frombuffer(packed, np.uint8), shards.positions(h[here])
            out[here] = ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
    return out


def mark(rows: DataFrame, lo: int, hi: int, shards: Shards, first: int, bits: Broadcast) -> DataFrame:
    """Pass two over the stored hashes of a slice: ``maybe`` is false only where no other row has the hash."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), b.column("sha"), pa.array(_test(b.column("h").to_numpy(), shards, bits.value))], ["id", "row", "sha", "maybe"])

    part = rows.where((F.col("h") >= lo) & (F.col("h") < hi))
    return arrow_map(part.select("id", "row", "sha", "h"), run, f"id {kind}, row long, sha binary, maybe boolean")


def _mark_whole(rows: DataFrame, shards: Shards, bits: Broadcast) -> DataFrame:
    """Pass two over whole rows: those of a slice with their hashes, or all with their texts."""

    def run(batches):
        for b in batches:
            sha, h = _digests(b.column("text")) if "text" in b.schema.names else (b.column("sha"), b.column("h").to_numpy())
            yield pa.RecordBatch.from_arrays([b.column("kept"), b.column("id"), sha, pa.array(_test(h, shards, bits.value))], ["kept", "id", "sha", "maybe"])

    return arrow_map(rows, run, T.StructType([rows.schema["kept"], rows.schema["id"], SHA, T.StructField("maybe", T.BooleanType())]))
