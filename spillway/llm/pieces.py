"""SentencePiece encoding and decoding by Viterbi over batches of equally long words.

A text is cut where a space mark follows another character; no piece reaches
across such a cut. Words of more than ``LONG`` characters, as in scripts without spaces, are also cut
between neighbours that no piece holds side by side: nothing is merged across these. Distinct words of one length form a matrix and advance
together, position by position: the hashes of all their substrings that end there
probe the sorted keys of the pieces, the scores of what is found are added to the
best scores of the prefixes before, and a vectorised maximum stores a backpointer
for each word.

For a unigram model every known piece may follow every other. A merge (BPE) model
has one right segmentation, and a sequence of its pieces is the right one exactly
if every two neighbours are what merging their joint text gives. There the
transitions that fail this are left out of the maximum; which of them hold is
worked out from the pieces' merges and remembered.

Characters without a piece become their UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Collection, Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map

SPACE = "▁"
UNIGRAM, BPE = 1, 2  # fixed values of the model format
#: A character without a piece is state ``UNKNOWN`` + its code point.
UNKNOWN = 1 << 24
#: Slots for pairs of pieces; a power of two.
MEMO = 1 << 20
#: Encoded words that a worker keeps.
KEPT = 1 << 17
#: Characters of words that advance together.
TOGETHER = 1 << 17
#: Characters of a word that is not cut further.
LONG = 24
#: Bytes of texts whose words are encoded together.
GATHERED = 2 << 20
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
_BASE, _SOME, _TAIL = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 20), np.uint64(64 - 21)


def model_type(path: str) -> int:
    """Field 3 of the trainer's part (field 2) of a model file; absent means unigram."""

    def fields(raw: bytes):
        at = 0
        while at < len(raw):
            tag, at = varint(raw, at)
            if tag & 7 == 0:
                value, at = varint(raw, at)
            else:
                size, at = {1: (8, at), 5: (4, at)}.get(tag & 7) or varint(raw, at)
                value, at = raw[at : at + size], at + size
            yield tag >> 3, value

    def varint(raw: bytes, at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            out |= (raw[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if raw[at - 1] < 128:
                return out, at

    with open(path, "rb") as f:
        trainer = next((v for k, v in fields(f.read()) if k == 2), b"")
    return next((v for k, v in fields(trainer) if k == 3), UNIGRAM)


class Model:
    """Pieces of a model, the sorted hashes by which they are found, and the words that were encoded last."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], unknown: int, kind: int):
        self.pieces, self.byte_ids, self.unknown, self.kind = pieces, byte_ids, unknown, kind
        usable = [i for i, p in enumerate(pieces) if p and i not in byte_ids.values()]
        self.id_of = {pieces[i]: i for i in usable}
        self.score = np.array(scores)
        self.longest = max((len(p) for p in self.id_of), default=1)
        keys = np.array([self.hash_of(p) for p in self.id_of], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(self.id_of.values()), np.int64)[order]
        self.some = np.zeros(1 << (64 - int(_SOME)), bool)  # which keys there may be, asked before the search
        with np.errstate(over="ignore"):
            self.some[(self.keys * _BASE >> _SOME).astype(np.int64)] = True
        self.forget()
        self.tails: np.ndarray | None = None
        self.beside: np.ndarray | None = None  # characters side by side in a piece
        self.memo: np.ndarray | None = None

    def grow_tails(self) -> None:
        """A table of the hashes that ends of pieces have: text that no piece ends with is not looked at further to the left."""
        self.tails = np.zeros(1 << (64 - int(_TAIL)), bool)
        found = []
        for p in self.id_of:
            h, power = 0, 1
            for c in reversed(p):
                h = ((ord(c) + 1) * power + h) & (1 << 64) - 1
                power = power * int(_BASE) & (1 << 64) - 1
                found.append(h)
        with np.errstate(over="ignore"):
            self.tails[(np.array(found, np.uint64) * _BASE >> _TAIL).astype(np.int64)] = True

    def grow_trees(self) -> None:
        """What encoding takes besides the pieces, which a decoder doesn't need: what deciding about neighbours takes: how each piece was merged, and which pairs merge into what."""
        n = len(self.pieces)
        self.rank = np.full(n, -1.0)  # when a piece is formed; single characters are there from the start
        self.left, self.right, self.odd = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        good, pairs = [], {}
        for p, i in self.id_of.items():
            states, tree = self.merge(p)
            good.append(states == [i])
            self.odd[i] = any(c not in self.id_of for c in p)
            if good[-1] and tree and not self.odd[i]:
                self.rank[i], self.left[i], self.right[i] = -self.score[i], self.id_of[tree[0]], self.id_of[tree[1]]
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = -self.score[i]
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged_at = np.array([pairs[k] for k in self.pairs.tolist()])
        usable = np.zeros(n, bool)
        usable[list(self.id_of.values())] = good
        self.keys, self.ids = self.keys[usable[self.ids]], self.ids[usable[self.ids]]  # pieces that merging never gives can't be used
        self.memo, self.memo_good = np.full(MEMO, -1, np.int64), np.zeros(MEMO, bool)

    @staticmethod
    def hash_of(text: str) -> int:
        out = 0
        for c in text:
            out = (out * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
        return out

    def merge(self, text: str) -> tuple[list[int], tuple[str, str] | None]:
        """Merges of a short text, best score first, then leftmost; and the last merge's parts."""
        parts, tree = list(text), None
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best[0]):
                    best = self.score[i], k
            if best is None:
                return [self.id_of[p] if p in self.id_of else UNKNOWN + ord(p) for p in parts], tree
            k = best[1]
            tree = parts[k], parts[k + 1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def text_of(self, state: int) -> str:
        return chr(state - UNKNOWN) if state >= UNKNOWN else self.pieces[state]

    def follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which pairs of neighbours merging would give; remembered in a table of fixed size."""
        key = before << 32 | after
        with np.errstate(over="ignore"):
            slot = ((key.astype(np.uint64) * _BASE) >> np.uint64(64 - MEMO.bit_length() + 1)).astype(np.int64)
        good, new = self.memo_good[slot], np.nonzero(self.memo[slot] != key)[0]
        if len(new):
            good[new] = self.neighbours(before[new], after[new])
            self.memo[slot[new]], self.memo_good[slot[new]] = key[new], good[new]
            both = np.nonzero(self.memo[slot[new]] != key[new])[0]  # two new keys of one slot: the slot is emptied
            self.memo[slot[new[both]]] = -1
        return good

    def neighbours(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Walks back in time along the right edge of one piece and the left edge of the other.

        The two edges change whenever one of them was formed. If the parts that stand there at some time
        merge before the next change, the pieces wouldn't have stayed apart.
        """
        good = np.ones(len(before), bool)
        odd = (before >= UNKNOWN) | (after >= UNKNOWN)
        odd[~odd] = self.odd[before[~odd]] | self.odd[after[~odd]]
        for k in np.nonzero(odd)[0].tolist():
            a, b = int(before[k]), int(after[k])
            good[k] = self.merge(self.text_of(a) + self.text_of(b))[0] == [a, b]
        live = np.nonzero(~odd)[0]
        x, y, limit = before[live], after[live], np.full(len(live), np.inf)
        while len(live):
            pair = x << 32 | y
            slot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joins = (self.pairs[slot] == pair) & (self.merged_at[slot] < limit)
            good[live[joins]] = False
            first = self.rank[x] > self.rank[y]
            ended = joins | ((self.rank[x] < 0) & (self.rank[y] < 0))
            # Of equal scores the leftmost merges first, so a part on the right gives way to an equal one across the edge.
            limit = np.where(first, self.rank[x], self.rank[y] + 0.5)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
            live, x, y, limit = live[~ended], x[~ended], y[~ended], limit[~ended]
        return good

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length, advancing together: all in a row, and how many each has."""
        n, size = len(words), len(words[0])
        columns = np.ascontiguousarray(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size).T).astype(np.uint64)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        step = np.zeros((size + 1, n), np.int16)
        last = np.zeros((size + 1, n), np.int64)
        floor = (self.score.min() if len(self.score) else 0) - 10
        with np.errstate(over="ignore"):
            for end in range(1, size + 1):
                best_, step_, last_ = best[end], step[end], last[end]
                alive, h, power = np.arange(n), np.zeros(n, np.uint64), np.uint64(1)
                for length in range(1, min(self.longest, end) + 1):
                    h = (columns[end - length][alive] + np.uint64(1)) * power + h
                    power = power * _BASE
                    mixed = h * _BASE
                    maybe = np.nonzero(self.some[(mixed >> _SOME).astype(np.int64)])[0]
                    slot = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                    hit = self.keys[slot] == h[maybe]
                    who = alive[maybe[hit]]
                    longer = np.nonzero(self.tails[(mixed >> _TAIL).astype(np.int64)])[0]
                    alive, h = alive[longer], h[longer]
                    state = self.ids[slot[hit]]
                    gain = self.score[state]
                    if length == 1:  # a character without a piece stands for itself
                        unseen = np.ones(n, bool)
                        unseen[who] = False
                        none = np.nonzero(unseen)[0]
                        if len(none):
                            who = np.concatenate([who, none])
                            state = np.concatenate([state, columns[end - 1][none].astype(np.int64) + UNKNOWN])
                            gain = np.concatenate([gain, np.full(len(none), floor)])
                    start = end - length
                    total = best[start][who] + gain
                    ok = total > best_[who]
                    if self.kind == BPE and start:
                        ok &= np.isfinite(total)
                        ok[ok] = self.follow(last[start][who[ok]], state[ok])
                    who = who[ok]
                    best_[who], step_[who], last_[who] = total[ok], length, state[ok]
                    if not len(alive):
                        break
        who, at, steps = np.arange(n), np.full(n, size), []
        while len(who):
            place = at * n + who
            steps.append((who, last.ravel()[place]))
            at = at - step.ravel()[place]
            who, at = who[at > 0], at[at > 0]
        # Steps were taken from the right; grouped by word they read from the left.
        who, states = (np.concatenate(x) for x in zip(*reversed(steps)))
        order = np.argsort(who, kind="stable")
        who, states = who[order], states[order]
        return self.spelt(who, states, n)

    def spelt(self, who: np.ndarray, states: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of states by word; characters without a piece as bytes, or as unknown (a run of them once) if the model has none."""
        odd = np.nonzero(states >= UNKNOWN)[0]
        if not self.byte_ids:
            again = odd[np.isin(odd - 1, odd) & (who[odd] == who[odd - 1])]
            ids = states.copy()
            ids[odd] = self.unknown
            kept = np.ones(len(ids), bool)
            kept[again] = False
            return ids[kept].astype(np.int32), np.bincount(who[kept], minlength=n)
        spelling = [[self.byte_ids[x] for x in chr(c).encode()] for c in (states[odd] - UNKNOWN).tolist()]
        times = np.ones(len(states), np.int64)
        times[odd] = [len(x) for x in spelling]
        ids = np.repeat(states, times).astype(np.int32)
        for at, x in zip((np.cumsum(times) - times)[odd].tolist(), spelling):
            ids[at : at + len(x)] = x
        return ids, np.bincount(np.repeat(who, times), minlength=n)

    def words(self, text: str) -> list[str]:
        """The text with space marks, a leading one added, cut before each run of marks."""
        if not text:
            return []
        found = _WORD.findall(SPACE + text.replace(" ", SPACE))
        if max(map(len, found)) <= LONG or not self.byte_ids:  # without byte pieces unknown neighbours are one piece
            return found
        return [part for w in found for part in ([w] if len(w) <= LONG else self.parts(w))]

    def parts(self, word: str) -> list[str]:
        """A word cut between neighbours that no piece holds."""
        if self.beside is None:
            self.beside = np.array(sorted({ord(a) << 21 | ord(b) for p in self.id_of for a, b in zip(p, p[1:])}), np.int64)
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        pair = codes[:-1] << 21 | codes[1:]
        apart = self.beside[np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)] != pair if len(self.beside) else np.ones(len(pair), bool)
        cuts = [0, *(np.nonzero(apart)[0] + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.kind == BPE and self.memo is None:
            self.grow_trees()
        if self.tails is None:
            self.grow_tails()
        # Words are numbered as they come, so that an occurrence takes a number and no text.
        every: defaultdict[str, int] = defaultdict(count().__next__)
        split = []
        for t in texts:
            words = self.words(t)
            split.append(np.fromiter(map(every.__getitem__, words), np.int32, len(words)))
        if len(self.kept) > KEPT:
            self.forget(every.keys())
        by_size: dict[int, list[str]] = {}
        for w in every:
            if w not in self.kept:
                by_size.setdefault(len(w), []).append(w)
        found, sizes = [self.flat], [self.sizes]
        for size, words in by_size.items():
            some = max(1, TOGETHER // size)
            for at in range(0, len(words), some):
                part = words[at : at + some]
                for held, x in zip((found, sizes), self.viterbi(part)):
                    held.append(x)
                self.kept.update(zip(part, range(len(self.kept), len(self.kept) + len(part))))
        self.flat, self.sizes = np.concatenate(found), np.concatenate(sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        place = np.fromiter(map(self.kept.__getitem__, every), np.int64, len(every))
        return [self.gathered(place[words], starts) for words in split]

    def forget(self, but: Collection[str] = ()) -> None:
        """Only words of ``but`` are kept: their places, and the pieces of all of them in a row."""
        held = [w for w in but if w in self.kept] if but else []
        if not held:
            self.kept: dict[str, int] = {}
            self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)
            return
        own = np.fromiter(map(self.kept.__getitem__, held), np.int64, len(held))
        self.flat, self.sizes = self.gathered(own), self.sizes[own]
        self.kept = dict(zip(held, range(len(held))))

    def gathered(self, own: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
        """The pieces of the words at these places, in a row."""
        starts = np.cumsum(self.sizes) - self.sizes if starts is None else starts
        n = self.sizes[own]
        return self.flat[np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]

    def decode(self, ids: np.ndarray) -> str:
        """Joined pieces without the leading mark; runs of byte pieces are read as UTF-8, bad bytes as U+FFFD."""
        out = b"".join(map(self.raw.__getitem__, ids.tolist()))
        text = out.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text

    @property
    def raw(self) -> list[bytes]:
        if not hasattr(self, "_raw"):
            self._raw = [p.encode() for p in self.pieces]
            for value, i in self.byte_ids.items():
                self._raw[i] = bytes([value])
        return self._raw


@cache
def load(path: str) -> Model:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    control = [sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
    pieces = ["" if control[i] else sp.id_to_piece(i) for i in range(size)]
    byte_ids = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
    return Model(pieces, [sp.get_score(i) for i in range(size)], byte_ids, sp.unk_id(), model_type(path))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>): the pieces of the whole text, null for a null text, empty for an empty one.

    Identity normalisation, a leading space mark, no pieces for the ends of a text. A column of that name is replaced.
    A row per row, repeated ones too; an empty table gives an empty one.
    """
    return _mapped(docs, text_col, {ids_col: _IDS}, lambda texts: [load(model_path).encode(texts)], GATHERED)


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``: the text of ``ids_col``, null for null. A column of that name is replaced."""
    return _mapped(docs, ids_col, {text_col: _TEXT}, lambda rows: [_decoded(load(model_path), rows)])


def encode_and_decode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``decode`` of ``encode`` by one worker a task: the pieces and what they are read back as; neither goes through a second worker."""

    def both(texts: list[str]) -> list[list]:
        model = load(model_path)
        ids = model.encode(texts)
        return [ids, _decoded(model, ids)]

    return _mapped(docs, text_col, {ids_col: _IDS, decoded_col: _TEXT}, both, GATHERED)


_IDS, _TEXT = ("array<int>", pa.list_(pa.int32())), ("string", pa.string())


def _decoded(model: Model, rows: list[np.ndarray]) -> list[str]:
    return [model.decode(r) for r in rows]


def _mapped(docs: DataFrame, source: str, targets: dict[str, tuple[str, pa.DataType]], f, together: int = 0) -> DataFrame:
    """``docs`` with the columns that ``f`` makes of the non-null values of ``source``; null for null."""
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in targets or c == source])
    renamed = own.select(F.struct(*[F.col(f"`{c}`") for c in own.columns if c not in targets]).alias("row"), F.col(f"`{source}`").alias("value"))
    names = [f"value{k}" for k in range(len(targets))]

    def run(batches):
        for some in _gathered(batches, together):
            values = [v for b in some for v in _values(b.column("value"))]
            made = [iter(x) for x in f([v for v in values if v is not None])]
            out = [[None if v is None else next(there) for v in values] for there in made]
            at = 0
            for b in some:
                parts = [pa.array(x[at : at + len(b)], kind) for x, (_, kind) in zip(out, targets.values())]
                yield pa.RecordBatch.from_arrays([b.column("row"), *parts], ["row", *names])
                at += len(b)

    types = ", ".join(f"{n} {sql_type}" for n, (sql_type, _) in zip(names, targets.values()))
    done = arrow_map(renamed, run, f"row {renamed.schema['row'].dataType.simpleString()}, {types}")
    return done.select("row.*", *[F.col(n).alias(target) for n, target in zip(names, targets)])


def _gathered(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of so many bytes of values: the more texts at once, the more words advance together."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column("value").nbytes
        if size >= together:
            yield held
            held, size = [], 0
    if held:
        yield held


def _values(column: pa.Array) -> list:
    return _rows_of(column) if pa.types.is_list(column.type) else column.to_pylist()


def _rows_of(column: pa.ListArray) -> list[np.ndarray | None]:
    """The lists of a column as slices of its numbers."""
    numbers, ends = column.values.fill_null(0).to_numpy(), column.offsets.to_numpy()
    return [numbers[a:b] if there else None for a, b, there in zip(ends[:-1], ends[1:], column.is_valid().to_pylist())]
