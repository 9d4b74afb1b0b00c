"""Benchmark decontamination: a prefix-filtered join of word windows.

Every distinct window of the benchmark (``WINDOW`` consecutive words of an item,
or a whole shorter item) is a set of shingles, its pairs of adjacent words. A
document contains the window only if it contains all of them, so the window's
rarest shingle is its necessary prefix: rarity is counted over all documents, and
only that shingle is looked up. Where a document has it, the shingle's position in
the window says where the window would begin; a start before the text or an end
after it is out of bounds, and what remains is compared word by word.

The benchmark is the query set: it is cut into blocks of bounded size by a hash of
the item, and each block is broadcast and run over all documents. Documents never
shuffle; what was found is narrow and is grouped by document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, merged, utf8
from spillway.session import materialise

WINDOW = 10
#: Text of the benchmark that one block holds, about.
BLOCK_BYTES = 8 << 20
#: Candidate places verified at once.
AT_ONCE = 1 << 18

# Words are runs of 0-9, a-z and bytes from 0x80 after lower-casing A-Z; anything else becomes a space.
_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Block:
    """Windows of some benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [i for i, _ in items]
        found: dict[tuple, int] = {}
        holders: list[set[int]] = []
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                n = found.setdefault(tuple(ids[at : at + window]), len(found))
                if n == len(holders):
                    holders.append(set())
                holders[n].add(k)
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.windows = np.full((len(found), window), -1, np.int64)
        for n, w in enumerate(found):
            self.windows[n, : len(w)] = w
        self.holder_of = np.array([k for x in holders for k in sorted(x)], np.int64)
        self.holder_at = np.cumsum([0, *map(len, holders)])
        # Shingles of each window with their positions; a single word is its own shingle.
        size = len(self.vocabulary)
        self.pair = size
        pairs = np.where(self.windows[:, 1:] >= 0, self.windows[:, :-1] * size + self.windows[:, 1:], -1)
        single = self.lengths == 1
        if pairs.shape[1]:
            pairs[single, 0] = size * size + self.windows[single, 0]
        self.shingles = pairs
        self.keys = np.unique(pairs[pairs >= 0])

    def of(self, text: bytes | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, -1) for w in words(text)], np.int64)

    def places(self, ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``ids`` where a shingle of ``keys`` begins, and which."""
        if not len(keys) or not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        known = np.nonzero(ids >= 0)[0]
        two = known[:-1][np.diff(known) == 1] if len(known) else known
        at = np.r_[two, known]
        key = np.r_[ids[two] * self.pair + ids[two + 1], self.pair * self.pair + ids[known]]
        slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[slot] == key
        return at[hit], slot[hit]

    def order_by(self, counts: np.ndarray) -> None:
        """Choose each window's rarest shingle; ``counts`` belong to ``keys``."""
        slot = np.searchsorted(self.keys, self.shingles)
        rarity = np.where(self.shingles >= 0, counts[np.minimum(slot, len(self.keys) - 1)] if len(self.keys) else 0, np.iinfo(np.int64).max)
        offset = rarity.argmin(axis=1) if rarity.size else np.empty(0, np.int64)
        prefix = self.shingles[np.arange(len(offset)), offset] if rarity.size else np.empty(0, np.int64)
        by = np.argsort(prefix, kind="stable")
        self.prefix, first = np.unique(prefix[by], return_index=True)
        self.prefix_at = np.r_[first, len(by)]
        self.prefix_window, self.prefix_offset = by, offset[by]

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every occurrence in a document."""
        at, slot = self.places(ids, self.prefix)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        many = self.prefix_at[slot + 1] - self.prefix_at[slot]
        cuts = np.searchsorted(np.cumsum(many), np.arange(AT_ONCE, many.sum() + AT_ONCE, AT_ONCE), "left") + 1 if len(many) else []
        lo = 0
        for hi in cuts:
            n = many[lo:hi]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(self.prefix_at[slot[lo:hi]], n) + within
            window = self.prefix_window[entry]
            start = np.repeat(at[lo:hi], n) - self.prefix_offset[entry]
            fits = (start >= 0) & (start + self.lengths[window] <= len(ids))
            window, start = window[fits], start[fits]
            for j in range(self.windows.shape[1]):
                want = self.windows[window, j]
                same = (want < 0) | (ids[np.minimum(start + j, len(ids) - 1)] == want)
                window, start = window[same], start[same]
            out.append((window, start))
            lo = hi
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def held_by(self, windows: np.ndarray) -> list[str]:
        own = np.unique(windows)
        return [self.items[k] for k in np.unique(np.concatenate([self.holder_of[self.holder_at[w] : self.holder_at[w + 1]] for w in own])).tolist()] if len(own) else []


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes | None]]]:
    """Yields the items block by block; one block at a time is on the driver."""
    own = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = math.ceil(total / block_bytes)
    if not n:
        return
    own = own.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    for k in sorted(r.block for r in own.select("block").distinct().collect()):  # the blocks that have items
        yield [(r.item, r.text.encode() if r.text is not None else None) for r in own.where(F.col("block") == k).toLocalIterator()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted as strings), ``spans`` (hit words, end exclusive).

    A null or empty text has no words and is hit by nothing; an item without words
    has no window. Items that share a window are all named; a null item_id is named
    by an empty string. Rows that agree in id and text get a row each, with the same
    figures. Further columns are not looked at. An empty benchmark hits nothing, an empty table gives an empty result.
    """
    spark, parts = docs.sparkSession, []
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    for block in chain(map(Block, blocks_of(benchmark, item_col, item_text_col, block_bytes)), [None]):
        if block is None and parts:
            break
        block = block or Block([])  # an empty benchmark: documents are only counted
        counts = np.zeros(len(block.keys), np.int64)
        if len(counts):
            shared = spark.sparkContext.broadcast(block)
            for r in occurrences_of(own, shared).collect():  # at most the shingles of one block
                counts[r.shingle] = r.n
            shared.destroy()
        block.order_by(counts)
        shared = spark.sparkContext.broadcast(block)
        # Stored, so that one block at a time is broadcast.
        parts.append(materialise(scan(own, shared, kind, first=not parts), "finds"))
        shared.destroy()
    found = reduce(DataFrame.unionByName, parts)
    together = found.groupBy("id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.collect_set("hits").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count_if("first").alias("rows"),
    )
    return summed(together, id_col, kind)


def occurrences_of(docs: DataFrame, block) -> DataFrame:
    """How often each shingle of the block occurs in all documents."""

    def run(batches):
        own = block.value
        counts = np.zeros(len(own.keys), np.int64)
        for b in batches:
            for text in utf8(b.column("text")):
                counts += np.bincount(own.places(own.of(text), own.keys)[1], minlength=len(counts))
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["shingle", "n"])

    return arrow_map(docs.select("text"), run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def scan(docs: DataFrame, block, kind: str, first: bool) -> DataFrame:
    """What one block finds; the first block's scan also gives a row for documents without a hit."""

    def run(batches):
        own = block.value
        for b in batches:
            rows = []
            for key, text in zip(b.column("id").to_pylist(), utf8(b.column("text"))):
                ids = own.of(text)
                window, start = own.occurrences(ids)
                if len(window) or first:
                    s, e = merged(start, start + own.lengths[window])
                    rows.append((key, xxhash.xxh3_64_intdigest(text or b"") - (1 << 63), len(ids), np.stack([s, e]).astype(np.int64).tobytes(), own.held_by(window), first))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (b.column("id").type, pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.bool_()))], ["id", "text_key", "n_words", "hits", "items", "first"])

    return arrow_map(docs, run, f"id {kind}, text_key long, n_words long, hits binary, items array<string>, first boolean")


def summed(found: DataFrame, id_col: str, kind: str) -> DataFrame:
    """Unites the hit words of all blocks; a row for each of the given ones."""

    def run(batches):
        for b in batches:
            counts, spans, digests = [], [], []
            for hits, items in zip(b.column("hits").to_pylist(), b.column("items").to_pylist()):
                both = [np.frombuffer(h, np.int64).reshape(2, -1) for h in hits]
                s, e = merged(*np.concatenate(both, axis=1))
                counts.append(int((e - s).sum()))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
                digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            kind_ = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("n_words"), pa.array(counts, pa.int64()), b.column("items"), pa.array(digests, pa.string()), pa.array(spans, kind_), b.column("rows")],
                ["id", "n_words", "n_hit", "items", "items_sha256", "spans", "rows"],
            )

    out = arrow_map(found.select("id", "n_words", "hits", "items", "rows"), run, f"id {kind}, n_words long, n_hit long, items array<string>, items_sha256 string, spans array<struct<start: long, end: long>>, rows long")
    each = out.withColumn("copy", F.explode(F.expr("sequence(1L, rows)")))
    return each.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "items_sha256", "spans", (F.col("n_hit") > 0).alias("contaminated"))
