"""Periodic runs of words, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``COPIES`` periods and ``LEAST`` words long, that no neighbouring
word extends. So each of its words occurs ``COPIES`` times in it at least:

1. a word that occurs too rarely within its segment (at first the text) to be in
   such a run splits the segment; this recurs within the parts until no part splits;
2. what survives is scanned lag by lag. A run of period q holds ``COPIES`` - 1 whole
   blocks of a grid of step q, all equal, so for lag q only n / q block hashes are compared
   (n log n in all, not n * n) and exact comparison extends what they find. Lags go
   up by doubling; what lies in a run of a smaller period has that period.

All texts of a piece of an Arrow batch go through each step together, in numpy.
Texts never cross rows, so Spark only deals rows out: there is no shuffle.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, utf8

COPIES, LEAST = 4, 6
#: Bytes of texts that are worked on together, and block hashes compared together.
TOGETHER, BLOCKS = 1 << 21, 1 << 20
RUNS = "array<struct<start: long, length: long, period: long>>"

_BASE = 0x9E3779B97F4A7C15


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def stable_segments(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments that no word splits any more; ``sizes``: words of each text."""
    at, segment = np.arange(len(ids)), np.repeat(np.arange(len(sizes)), sizes)
    many, starts, ends = int(ids.max(initial=0)) + 1, [], []
    while len(at):
        length = np.bincount(segment)
        _, back, times = np.unique(segment * many + ids[at], return_inverse=True, return_counts=True)
        times, own = times[back], length[segment]
        # Below two periods of two words only a run of one word fits.
        rare = (times < COPIES) | ((own < 2 * COPIES) & (times < max(LEAST, COPIES)))
        split = np.zeros(len(length), bool)
        split[segment[rare]] = True
        first = np.cumsum(length) - length
        whole = ~split & (length > 0)
        starts.append(at[first[whole]])
        ends.append(starts[-1] + length[whole])
        left = split[segment] & ~rare
        at, old = at[left], segment[left]
        segment = np.cumsum(np.r_[False, (np.diff(at) != 1) | (np.diff(old) != 0)][: len(at)])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(starts)
    return starts[order], ends[order]


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place within the row of ragged rows laid end to end."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Hashes:
    """Hashes of any stretch of numbers; equal stretches have equal ones."""

    def __init__(self, ids: np.ndarray):
        self.size = len(ids)
        self.power = np.full(len(ids) + 1, _BASE, np.uint64)
        self.power[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(self.power, out=self.power)
            x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            self.sums = np.r_[np.uint64(0), np.cumsum(x * self.power[:-1])]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[ends] - self.sums[starts]) * self.power[self.size - starts]


def equal_blocks(hashes: Hashes, starts: np.ndarray, ends: np.ndarray, low: int):
    """For lags ``low`` to 2 * ``low`` - 1: stretches (segment, lag, start, end) of ``COPIES`` - 1 or more equal blocks."""
    room = (ends - starts) // COPIES  # the largest lag of a segment
    some = np.nonzero(room >= low)[0]
    owner, k = ragged(np.minimum(room[some], 2 * low - 1) - low + 1)
    segment, lag = some[owner], low + k
    blocks = (ends - starts)[segment] // lag
    upto, at = np.cumsum(blocks), 0
    while at < len(lag):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCKS, "right")))
        pair, j = ragged(blocks[at:to])
        q = lag[at:to][pair]
        begin = starts[segment[at:to]][pair] + j * q
        h = hashes.of(begin, begin + q)
        like_next = np.r_[(h[1:] == h[:-1]) & (pair[1:] == pair[:-1]), False]
        # Stretches of blocks that are like the next one.
        step = np.diff(np.r_[0, like_next.astype(np.int8), 0])
        first, last = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
        keep = last - first >= COPIES - 2
        first, last = first[keep], last[keep]
        yield segment[at:to][pair[first]], q[first], begin[first], begin[last] + q[first]
        at = to


def runs_of(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, in places of ``ids``, by start, then period."""
    starts, ends = stable_segments(ids, sizes)
    found: list[tuple[int, int, int]] = []
    if len(starts):
        hashes, low, longest = Hashes(ids), 1, int((ends - starts).max())
        while low * COPIES <= longest:
            known = np.array(sorted(found), np.int64).reshape(-1, 3)
            reach = np.maximum.accumulate(known[:, 0] + known[:, 1]) if len(known) else known[:, 0]
            for segment, lag, a, c in equal_blocks(hashes, starts, ends, low):
                if len(known):
                    before = np.searchsorted(known[:, 0], a, "right") - 1
                    new = (before < 0) | (reach[before] < c)
                    segment, lag, a, c = segment[new], lag[new], a[new], c[new]
                for s, q, x, y in zip(segment.tolist(), lag.tolist(), a.tolist(), c.tolist()):
                    # Exactly, and up to a period further on both sides: beyond it a block would have been like its neighbour.
                    lo, hi = max(int(starts[s]), x - q), min(int(ends[s]), y + q)
                    step = np.diff(np.r_[0, (ids[lo : hi - q] == ids[lo + q : hi]).astype(np.int8), 0])
                    for u, v in zip(np.nonzero(step == 1)[0].tolist(), np.nonzero(step == -1)[0].tolist()):
                        if v - u + q >= max(LEAST, COPIES * q):
                            found.append((lo + u, v - u + q, q))
            low *= 2
    out = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def read_texts(texts: list[bytes | None]) -> list[tuple[int, list[dict], bytes]]:
    """Per text: how many words, its runs, and the words that stay, joined by spaces."""
    words = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    runs = runs_of(numbered(flat), sizes)
    gone = np.zeros(len(flat) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(gone) > 0
    first = np.cumsum(sizes) - sizes
    cuts = np.searchsorted(runs[:, 0], np.r_[first, len(flat)])
    out = []
    for k, ws in enumerate(words):
        own = [{"start": s - int(first[k]), "length": n, "period": q} for s, n, q in runs[cuts[k] : cuts[k + 1]].tolist()]
        if own:
            ws = [w for w, x in zip(ws, gone[first[k] : first[k] + len(ws)].tolist()) if not x]
        out.append((int(sizes[k]), own, b" ".join(ws)))
    return out


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what ASCII white space separates, numbered from 0. ``collapsed`` joins by one space the words
    that no run holds after its first period. A null text counts as empty: no words, no runs, an empty
    ``collapsed``. Rows are independent, repeated ones too; an empty table gives an empty one. Columns of
    those three names are replaced, all others kept. A text is read whole, in one task.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    own = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            texts, at = utf8(b.column("text")), 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to] or b"") <= TOGETHER):
                    size, to = size + len(texts[to] or b""), to + 1
                said = read_texts(texts[at:to])
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(at, to - at), pa.array([x[0] for x in said], pa.int64()), pa.array([x[1] for x in said], runs_type), pa.array([x[2] for x in said], pa.binary()).cast(pa.string())],
                    ["row", "n_words", "runs", "collapsed"],
                )
                at = to

    out = arrow_map(own, run, f"row {own.schema['row'].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string")
    return out.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(kept)], "n_words", "runs", "collapsed")
