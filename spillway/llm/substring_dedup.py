"""Removal of long repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered most significant digit first and only through ``LENGTH``
bytes. After each pass a group of one is done (nothing repeats there) and a group
whose members agree through the full depth is done as well (all of it repeats);
only mixed groups go on, with one witness for members that agree. What is equal at the end are the repeated windows.

The first digit is taken at an *anchor* so that one row stands for many suffixes:
the anchor of a window is the place of the smallest of its ``GRAM``-byte hashes,
which depends on the window's bytes alone, so equal windows have the same anchor
at the same offset. The passes:

1. anchors, about one in 170 bytes; digit: the gram; depth: all windows of the anchor;
2. anchors of mixed groups, cut by offset into pieces of ``PIECE`` windows; digit: the bytes
   which all windows of a piece share; depth: the bytes of any of them;
3. pieces of mixed groups, window by window.

Digits are compared as 64-bit hashes of two independent kinds (gram and content).
Groups are counted before they are joined back, so no group meets in one task.
Texts move once, and only those of documents that are removed in part stay.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, merged, utf8
from spillway.session import materialise

LENGTH = 400
GRAM = 64
PIECE = 24
#: Bytes of a text that are hashed at once, besides their surroundings.
SEGMENT = 1 << 20
_POS = np.uint64(22)

_RANDOM = np.random.default_rng(400)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2 ** bits of each."""
    with np.errstate(over="ignore"):
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(1 << bits, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    return tuple(out)


def mix(*parts: np.ndarray) -> np.ndarray:
    """One well-mixed 64-bit value of several."""
    with np.errstate(over="ignore"):
        x = np.zeros(len(parts[0]), np.uint64)
        for p in parts:
            x = (x ^ p.astype(np.uint64)) * _MIX
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
    return x


class Slice:
    """Bytes [``lo``, ``hi``) of a text with hashes of any stretch."""

    def __init__(self, text: bytes, lo: int, hi: int):
        self.lo, self.size = lo, hi - lo
        x = np.frombuffer(text, np.uint8, hi - lo, lo)
        power, self.back = powers(max(12, int(hi - lo + 1).bit_length()))
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(_BYTE[x] * power[: len(x)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of [start, end), in positions of the text."""
        s, e = starts - self.lo, ends - self.lo
        with np.errstate(over="ignore"):
            return mix((self.sums[e] - self.sums[s]) * self.back[s], e - s)

    def grams(self) -> np.ndarray:
        n = self.size - GRAM + 1
        with np.errstate(over="ignore"):
            h = (self.sums[GRAM:] - self.sums[:n]) * self.back[:n] * _MIX
            return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def anchors(text: bytes, length: int = LENGTH):
    """Per segment: (slice, anchors, first and last window start of each)."""
    n, reach = len(text), length - GRAM + 1
    for a in range(0, n - length + 1, SEGMENT):
        b = min(a + SEGMENT, n - GRAM + 1) if a + SEGMENT <= n - length else n
        lo, hi = max(0, a - reach), min(n, b + length + reach)
        part = Slice(text, lo, hi)
        key = part.grams() >> _POS << _POS
        key |= np.arange(len(key), dtype=np.uint64)
        # Minimum over every run of ``reach`` grams: suffix minima of one block meet prefix minima of the next.
        rows = -(-len(key) // reach)
        square = np.full(rows * reach, np.iinfo(np.uint64).max, np.uint64)
        square[: len(key)] = key
        square = square.reshape(rows, reach)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = part.size - length + 1
        own = (np.minimum(behind[:windows], ahead[reach - 1 : reach - 1 + windows]) & ((np.uint64(1) << _POS) - np.uint64(1))).astype(np.int64)
        cut = np.r_[0, np.nonzero(np.diff(own))[0] + 1, windows]
        at = own[cut[:-1]] + lo
        mine = (at >= a) & (at < b)
        yield part, at[mine], cut[:-1][mine] + lo, cut[1:][mine] - 1 + lo


def first_rows(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, digit, depth) of a text."""
    out = [[np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2]
    for part, at, first, last in anchors(text, length):
        out.append([at, first, last, part.hashes(at, at + GRAM), mix(part.hashes(first, last + length), at - first, last - first)])
    return tuple(np.concatenate(c) for c in zip(*out))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def settle(rows: DataFrame, carried: list[str]) -> DataFrame:
    """One radix pass over rows (key, depth, *carried): those in groups of several, with ``whole`` and ``more``.

    ``whole``: another row has the same key and the same bytes through the full depth. ``more``: goes on to
    the next pass, as it isn't whole, or as the one witness there for whole rows that its group also holds.
    """
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("depth").alias("least"), F.max("depth").alias("most")).where("n > 1")
    # Stored, so that the join deals its rows out anew and can split a hot key.
    groups = materialise(groups, "groups")
    left = materialise(rows.join(groups, "key").select("key", "depth", *carried, (F.col("least") == F.col("most")).alias("same")), "radix")
    mixed = left.where("NOT same")
    row = F.struct(*carried)
    twice = mixed.groupBy("key", "depth").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("witness")).where("n > 1").drop("n")
    twice = materialise(twice, "twice")  # for the same reason
    told = mixed.join(twice, ["key", "depth"], "left").select(*carried, F.col("witness").isNotNull().alias("whole"), (F.col("witness").isNull() | (F.col("witness") == row)).alias("more"))
    return left.where("same").select(*carried, F.lit(True).alias("whole"), F.lit(False).alias("more")).unionByName(told)


def per_doc(rows: DataFrame, *values: str) -> DataFrame:
    """Rows of a document gathered, whole ones and those that go on; bounded by the document's length."""
    one = F.struct(*values)
    return rows.groupBy("id", "t").agg(F.collect_list(F.when(F.col("whole"), one)).alias("whole"), F.collect_list(F.when(F.col("more"), one)).alias("more"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` (start, end; null where all or nothing goes).

    A byte of the UTF-8 text is removed if a ``length``-byte string that covers it also
    starts anywhere else in the table, overlapping occurrences of the same text included;
    strings never cross texts and are judged on the input. Null counts as empty; texts shorter
    than ``length`` are left alone. Rows that repeat id and text are each other's copies.
    """
    own = docs.select(F.col(id_col).alias("given"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own, kind = own.withColumn("t", F.xxhash64("text")), "string"
    seen = materialise(scan(own, length), "anchors")
    flat = seen.where("size(at) > 0").select("id", "t", F.explode(F.arrays_zip("key", "depth", "at", "first", "last")).alias("a")).select("id", "t", "a.*")
    first = per_doc(settle(flat, ["id", "t", "at", "first", "last"]), "at", "first", "last")
    sizes = seen.select("id", "t", "n_bytes").distinct()
    known = materialise(covered(first.join(sizes, ["id", "t"]), kind, length), "first")

    texts = own.drop("given").join(known.where("NOT gone OR size(at) > 0").drop("n_bytes"), ["id", "t"])
    texts = materialise(texts.dropDuplicates(["id", "t"]), "texts")
    pieces = per_doc(settle(second_rows(texts, kind, length), ["id", "t", "at", "piece", "low", "high"]), "at", "piece", "low", "high")
    pieces = materialise(pieces, "pieces")
    open_ = texts.select("id", "t", "text", "starts", "ends", "gone").join(pieces, ["id", "t"], "left")
    last = third_rows(open_.where("size(more) > 0"), kind, length)
    again = materialise(last.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "groups")
    windows = last.join(again, "key").groupBy("id", "t").agg(F.collect_list("at").alias("windows"))
    done = cut(open_.where("NOT gone").select("id", "t", "text", "starts", "ends", F.col("whole").alias("pieces")).join(windows, ["id", "t"], "left"), kind, length)

    gone = known.where("gone").select("id", "t", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(b""), 256).alias("kept"), F.lit(None).cast(SPANS).alias("spans"))
    return seen.select("given", "id", "t", "n_bytes", "sha").join(gone.unionByName(done), ["id", "t"], "left").select(
        F.col("given").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"), "spans",
    )


SPANS = "array<struct<start: long, end: long>>"


def scan(own: DataFrame, length: int) -> DataFrame:
    """Size and digest of every text, and its anchors."""

    def run(batches):
        for b in batches:
            cols = [[] for _ in range(7)]
            for text in utf8(b.column("text")):
                at, first, last, key, depth = first_rows(text, length)
                for c, v in zip(cols, (len(text), hashlib.sha256(text).hexdigest(), at, first, last, signed(key), signed(depth))):
                    c.append(v)
            kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 5]
            yield pa.RecordBatch.from_arrays(
                [b.column("given"), b.column("id"), b.column("t"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["given", "id", "t", "n_bytes", "sha", "at", "first", "last", "key", "depth"]
            )

    longs = ", ".join(f"{c} array<long>" for c in ("at", "first", "last", "key", "depth"))
    given = own.schema["given"].dataType.simpleString()
    return arrow_map(own.select("given", "id", "t", "text"), run, f"given {given}, id string, t long, n_bytes long, sha string, {longs}")


def covered(rows: DataFrame, kind: str, length: int) -> DataFrame:
    """Bytes that whole anchors cover; ``gone`` if that is all of them."""

    def run(batches):
        for b in batches:
            out = []
            for whole, more, n in zip(b.column("whole").to_pylist(), b.column("more").to_pylist(), b.column("n_bytes").to_pylist()):
                s, e = merged(np.array([w["first"] for w in whole], np.int64), np.array([w["last"] + length for w in whole], np.int64))
                out.append((s.tolist(), e.tolist(), [m["at"] for m in more], [m["first"] for m in more], [m["last"] for m in more], n, len(s) == 1 and s[0] == 0 and e[0] == n))
            kinds = [*[pa.list_(pa.int64())] * 5, pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("t"), *(pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 7, kinds))], ["id", "t", "starts", "ends", "at", "first", "last", "n_bytes", "gone"])

    longs = ", ".join(f"{c} array<long>" for c in ("starts", "ends", "at", "first", "last"))
    return arrow_map(rows.select("id", "t", "whole", "more", "n_bytes"), run, f"id {kind}, t long, {longs}, n_bytes long, gone boolean")


def slices(text: bytes, starts: np.ndarray, ends: np.ndarray):
    """Indices of sorted stretches, with a slice of the text that holds them."""
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + SEGMENT)))
        yield slice(at, to), Slice(text, int(starts[at]), int(ends[at:to].max()))
        at = to


def second_rows(texts: DataFrame, kind: str, length: int) -> DataFrame:
    """Pieces of mixed anchors: by offset from the anchor, so that equal windows are in the same piece."""

    def run(batches):
        for b in batches:
            for i, text in enumerate(utf8(b.column("text"))):
                at, first, last = (np.array(b.column(c)[i].as_py(), np.int64) for c in ("at", "first", "last"))
                order = np.argsort(first)
                at, first, last = at[order], first[order], last[order]
                near, far = (at - last) // PIECE, (at - first) // PIECE
                n = far - near + 1
                own = np.repeat(np.arange(len(at)), n)
                piece = np.repeat(near, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                low = np.maximum(first[own], at[own] - piece * PIECE - PIECE + 1)
                high = np.minimum(last[own], at[own] - piece * PIECE)
                order = np.argsort(low)
                own, piece, low, high = own[order], piece[order], low[order], high[order]
                a = at[own]
                core = a - piece * PIECE
                for part, one in slices(text, low, high + length):
                    key = mix(one.hashes(core[part], core[part] - PIECE + 1 + length), piece[part], one.hashes(a[part], a[part] + GRAM))
                    depth = mix(one.hashes(low[part], high[part] + length), a[part] - low[part], high[part] - low[part])
                    yield long_rows(b, i, signed(key), signed(depth), a[part], piece[part], low[part], high[part], names=("key", "depth", "at", "piece", "low", "high"))

    return arrow_map(texts.where("size(at) > 0").select("id", "t", "text", "at", "first", "last"), run, f"id {kind}, t long, key long, depth long, at long, piece long, low long, high long")


def long_rows(b: pa.RecordBatch, i: int, *values: np.ndarray, names: tuple[str, ...]) -> pa.RecordBatch:
    n = len(values[0])
    return pa.RecordBatch.from_arrays([pa.repeat(b.column("id")[i], n), pa.repeat(b.column("t")[i], n), *map(pa.array, values)], ["id", "t", *names])


def third_rows(texts: DataFrame, kind: str, length: int) -> DataFrame:
    """Windows of mixed pieces."""

    def run(batches):
        for b in batches:
            for i, text in enumerate(utf8(b.column("text"))):
                pieces = sorted(b.column("more")[i].as_py(), key=lambda p: p["low"])
                a, low, high = (np.array([p[c] for p in pieces], np.int64) for c in ("at", "low", "high"))
                n = high - low + 1
                s = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                a = np.repeat(a, n)
                order = np.argsort(s)
                a, s = a[order], s[order]
                for part, one in slices(text, s, s + length):
                    key = mix(one.hashes(s[part], s[part] + length), a[part] - s[part])
                    yield long_rows(b, i, signed(key), s[part], names=("key", "at"))

    return arrow_map(texts.select("id", "t", "text", "more"), run, f"id {kind}, t long, key long, at long")


def cut(texts: DataFrame, kind: str, length: int) -> DataFrame:
    """Removes what the three passes have found."""

    def run(batches):
        for b in batches:
            out = []
            for i, text in enumerate(utf8(b.column("text"))):
                starts, ends, pieces, windows = (b.column(c)[i].as_py() or [] for c in ("starts", "ends", "pieces", "windows"))
                s, e = merged(
                    np.array([*starts, *(p["low"] for p in pieces), *windows], np.int64),
                    np.array([*ends, *(p["high"] + length for p in pieces), *(w + length for w in windows)], np.int64),
                )
                kept, at = hashlib.sha256(), 0
                for x, y in zip(s.tolist(), e.tolist()):
                    kept.update(text[at:x])
                    at = y
                kept.update(text[at:])
                out.append((int((e - s).sum()), len(s), kept.hexdigest(), [{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("t"), *(pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, kinds))], ["id", "t", "n_removed", "n_spans", "kept", "spans"])

    return arrow_map(texts.select("id", "t", "text", "starts", "ends", "pieces", "windows"), run, f"id {kind}, t long, n_removed long, n_spans long, kept string, spans {SPANS}")
