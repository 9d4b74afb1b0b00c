"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the embedding of its hash (word input) and the mean of the
embeddings of its character trigrams and four-grams (character input). Windows of
``WINDOW`` words, ``STRIDE`` apart, are read in both directions; attention pools the
states, a logistic unit scores the pool. A text's score is that of its worst
window, so long texts are read whole. Training labels belong to texts: after the
first round a toxic text only vouches for the windows that the network itself
finds worst in it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, utf8

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 15
WORD_DIM, GRAM_DIM, HIDDEN, ATTEND = 8, 12, 12, 8
#: Windows scored together, and words that a worker remembers.
TOGETHER, KEPT = 4096, 1 << 17
#: Learning rate of the embeddings against that of the rest.
EMBEDDINGS = 10
THRESHOLD = 0.7

#: Bytes of a word at most, and what the pieces of a longer run have in common.
LONGEST, SHARED = 64, 16

# Words are runs of ASCII letters and of bytes from 0x80; anything else becomes a space.
_WORDS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words of a text; a run of more than ``LONGEST`` bytes, as in scripts without spaces, is several words."""
    found = (text or b"").translate(_WORDS).split()
    if max(map(len, found), default=0) <= LONGEST:
        return found
    return [piece for word in found for piece in pieces(word)]


def pieces(word: bytes) -> list[bytes]:
    """Pieces of at most ``LONGEST`` bytes, cut between characters; neighbours share ``SHARED`` bytes or a little more."""
    out, at = [], 0
    while len(word) - at > LONGEST:
        end = _edge(word, at + LONGEST)
        out.append(word[at:end])
        at = _edge(word, end - SHARED)
    return [*out, word[at:]]


def _edge(word: bytes, at: int) -> int:
    """The start of the character that holds this byte."""
    for back in range(4):
        if word[at - back] & 0xC0 != 0x80:
            return at - back
    return at


def features(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words, buckets of all their n-grams in a row, and how many each has."""
    grams: list[int] = []
    sizes = []
    for word in vocabulary:
        marked = b"<" + word + b">"
        before = len(grams)
        grams += [crc32(marked[k : k + n]) % GRAM_BUCKETS for n in (3, 4) for k in range(max(1, len(marked) - n + 1))]
        sizes.append(len(grams) - before)
    return np.array([crc32(w) % WORD_BUCKETS for w in vocabulary], np.int64), np.array(grams, np.int64), np.array(sizes, np.int64)


def some_of(found: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words_, grams, sizes = found
    ends, n = np.cumsum(sizes), sizes[rows]
    at = np.repeat(ends[rows] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return words_[rows], grams[at], n


def gathered(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` by row."""
    return np.stack([np.bincount(rows, values[:, k], size) for k in range(values.shape[1])], axis=1).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int) -> Network:
        r = np.random.default_rng(seed)
        n = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        d = WORD_DIM + GRAM_DIM
        p = {"word": n(WORD_BUCKETS, WORD_DIM, scale=0.02), "gram": n(GRAM_BUCKETS, GRAM_DIM, scale=0.05)}
        for way in "fb":
            p |= {f"W{way}": n(d, 3 * HIDDEN, scale=d**-0.5), f"U{way}": n(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), f"c{way}": n(3 * HIDDEN, scale=0.0)}
        p |= {"A": n(2 * HIDDEN, ATTEND, scale=(2 * HIDDEN) ** -0.5), "a": n(ATTEND, scale=0.0), "v": n(ATTEND, scale=ATTEND**-0.5), "w": n(2 * HIDDEN, scale=0.3), "o": np.zeros(1, np.float32)}
        return Network(p)

    def inputs(self, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Input vectors of words given by their features."""
        words_, grams, sizes = found
        if not len(words_):
            return np.empty((0, WORD_DIM + GRAM_DIM), np.float32)
        mean = np.add.reduceat(self.p["gram"][grams], np.cumsum(sizes) - sizes) / sizes[:, None]
        return np.concatenate([self.p["word"][words_], mean], axis=1).astype(np.float32)

    def direction(self, way: str, x: np.ndarray, there: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States (time, window, hidden) of one direction; ``x``: projected inputs (time, window, 3 * hidden)."""
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        h, out, u = np.zeros((x.shape[1], HIDDEN), np.float32), np.empty((*x.shape[:2], HIDDEN), np.float32), self.p[f"U{way}"]
        for t in steps:
            hu = h @ u
            zr = sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if kept is not None:
                kept.append((t, h, z, r, n, hu[:, 2 * HIDDEN :]))
            h = out[t] = h + there[t][:, None] * (new - h)
        return out

    def pooled(self, states: np.ndarray, there: np.ndarray):
        s = np.tanh(states @ self.p["A"] + self.p["a"])
        e = s @ self.p["v"] + (there - 1) * 1e4
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        return s, alpha, np.einsum("tb,tbh->bh", alpha, states)

    def logits(self, projected: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of windows; ``at``: rows of ``projected`` (both directions), (time, window), row 0 for no word."""
        there = (at > 0).astype(np.float32)
        x = projected[at]
        states = np.concatenate([self.direction("f", x[..., : 3 * HIDDEN], there), self.direction("b", x[..., 3 * HIDDEN :], there)], axis=2)
        return self.pooled(states, there)[2] @ self.p["w"] + self.p["o"]

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        return np.concatenate([inputs @ self.p["Wf"] + self.p["cf"], inputs @ self.p["Wb"] + self.p["cb"]], axis=1)

    def gradients(self, found: tuple, at: np.ndarray, labels: np.ndarray, known: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean cross-entropy, and the logits; ``at`` counts ``found`` from 1. ``known`` scales word embeddings."""
        p, there = self.p, (at > 0).astype(np.float32)
        x0 = np.concatenate([np.zeros((1, WORD_DIM + GRAM_DIM), np.float32), self.inputs(found)])
        x0[1:, :WORD_DIM] *= known[:, None]
        x = self.projected(x0)[at]
        kept = {"f": [], "b": []}
        states = np.concatenate([self.direction(w, x[..., k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN], there, kept[w]) for k, w in enumerate("fb")], axis=2)
        s, alpha, pool = self.pooled(states, there)
        logits = pool @ p["w"] + p["o"]
        d = ((sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        g = {"w": pool.T @ d, "o": d.sum(keepdims=True)}
        dpool = d[:, None] * p["w"]
        dalpha = np.einsum("bh,tbh->tb", dpool, states)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["v"] = np.einsum("tb,tba->a", de, s)
        ds = de[..., None] * p["v"] * (1 - s * s)
        g["A"], g["a"] = np.einsum("tbh,tba->ha", states, ds), ds.sum(axis=(0, 1))
        dstates = alpha[..., None] * dpool + ds @ p["A"].T
        dx0 = np.zeros_like(x0)
        for k, way in enumerate("fb"):
            u, dh = p[f"U{way}"], np.zeros((at.shape[1], HIDDEN), np.float32)
            gu, dx = np.zeros_like(u), np.zeros((*at.shape, 3 * HIDDEN), np.float32)
            for t, h, z, r, n, hun in reversed(kept[way]):
                dh = dh + dstates[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                m = there[t][:, None]
                dnew, dh = dh * m, dh * (1 - m)
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (h - n) * z * (1 - z)
                dr = dn * hun * r * (1 - r)
                dx[t] = np.concatenate([dz, dr, dn], axis=1)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                gu += h.T @ du
                dh = dh + dnew * z + du @ u.T
            flat, rows = dx.reshape(-1, 3 * HIDDEN), at.ravel()
            g[f"U{way}"] = gu
            sums = gathered(rows, flat, len(x0))
            sums[0] = 0
            g[f"W{way}"], g[f"c{way}"] = x0.T @ sums, sums.sum(axis=0)
            dx0 += sums @ p[f"W{way}"].T
        words_, grams, sizes = found
        g["word"] = gathered(words_, dx0[1:, :WORD_DIM] * known[:, None], WORD_BUCKETS)
        g["gram"] = gathered(grams, np.repeat(dx0[1:, WORD_DIM:] / sizes[:, None], sizes, axis=0), GRAM_BUCKETS)
        return g, logits


def windows_of(n: int) -> np.ndarray:
    """Rows of word positions of all overlapping windows of ``n`` words; -1 past the end."""
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n > WINDOW else np.zeros(1, int)
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < n, at, -1)


@dataclass
class Scorer:
    network: Network
    kept: dict[bytes, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def rows(self, text_words: list[list[bytes]]) -> list[np.ndarray]:
        """Rows of the table of projected inputs, per text; row 0 is no word."""
        every = {w for ws in text_words for w in ws}
        new = [w for w in every if w not in self.kept]
        if self.table is None or len(self.kept) + len(new) > KEPT:
            self.kept, new = {}, every
            self.table = np.zeros((1, 6 * HIDDEN), np.float32)
        if new:
            listed = sorted(new)
            parts = [self.table]
            for at in range(0, len(listed), 1 << 14):
                parts.append(self.network.projected(self.network.inputs(features(listed[at : at + (1 << 14)]))))
            self.kept.update(zip(listed, range(len(self.table), len(self.table) + len(listed))))
            self.table = np.concatenate(parts)
        get = self.kept.__getitem__
        return [np.fromiter(map(get, ws), np.int64, len(ws)) for ws in text_words]

    def score(self, texts: list[bytes | None]) -> list[float]:
        out: list[float] = []
        split = [words(t) for t in texts]
        at = 0
        while at < len(split):  # some texts at a time, so that the windows of a batch stay few
            to, n = at, 0
            while to < len(split) and (to == at or n + len(split[to]) < TOGETHER * STRIDE):
                n, to = n + len(split[to]), to + 1
            out += self._scores(split[at:to])
            at = to
        return out

    def _scores(self, split: list[list[bytes]]) -> list[float]:
        rows = self.rows(split)
        # Position -1 of a text is its own last place, which is no word.
        every = [np.r_[r, 0][windows_of(len(r))] for r in rows]
        sizes = np.array([len(x) for x in every])
        flat = np.concatenate(every)
        logits = np.concatenate([self.network.logits(self.table, np.ascontiguousarray(flat[k : k + TOGETHER].T)) for k in range(0, len(flat), TOGETHER)])
        return sigmoid(np.maximum.reduceat(logits.astype(np.float64), np.cumsum(sizes) - sizes)).tolist()


def fit(texts: list[bytes], labels: np.ndarray, rounds: int = 10, steps: int = 60, batch: int = 256, rate: float = 0.01, seed: int = 8) -> Network:
    """Trains for ``rounds`` of ``steps`` batches: Adam, and Adagrad for the embeddings.

    Before each round all windows are scored. Half of a batch are the worst windows of toxic texts; of the
    other half one part are those clean windows that look most toxic, the rest any clean ones.
    """
    network, order = Network.fresh(seed), np.random.default_rng(seed)
    if not len(texts) or labels.min() == labels.max():
        network.p["w"][:] = 0  # nothing to tell apart: the same score for all
        network.p["o"][:] = 4.0 if len(labels) and labels[0] else -4.0
        return network
    vocabulary: dict[bytes, int] = {}
    rows, owner = [], []
    for k, t in enumerate(texts):
        own = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(t)] + [0])
        rows.append(own[windows_of(len(own) - 1)])
        owner += [k] * len(rows[-1])
    rows, owner = np.concatenate(rows), np.array(owner)
    found, toxic = features(list(vocabulary)), labels[owner] == 1
    clean, chosen, hard = np.nonzero(~toxic)[0], np.nonzero(toxic)[0], np.nonzero(~toxic)[0]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    for step in range(rounds * steps):
        if step and step % steps == 0:
            x = network.projected(np.concatenate([np.zeros((1, WORD_DIM + GRAM_DIM), np.float32), network.inputs(found)]))
            now = np.concatenate([network.logits(x, np.ascontiguousarray(rows[k : k + TOGETHER].T)) for k in range(0, len(rows), TOGETHER)])
            worst = np.full(len(texts), -np.inf)
            np.maximum.at(worst, owner, now)
            chosen = np.nonzero(toxic & (now >= worst[owner] - 1))[0]
            hard = clean[np.argsort(-now[clean], kind="stable")[: max(batch, len(clean) // 50)]]
        some = np.r_[order.choice(chosen, batch // 2), order.choice(hard, batch // 4), order.choice(clean, batch // 4)]
        at, back = np.unique(rows[some], return_inverse=True)
        there = at > 0
        local = (np.cumsum(there) * there)[back].reshape(len(some), WINDOW)
        # Words lose their own embedding half of the time, so that their characters must tell.
        known = 2 * (order.random(int(there.sum())) < 0.5).astype(np.float32)
        g, _ = network.gradients(some_of(found, at[there] - 1), np.ascontiguousarray(local.T), toxic[some].astype(np.float32), known)
        size = rate * (1 - step / (rounds * steps))
        for k, v in network.p.items():
            m, s = moments[k]
            if k in ("word", "gram"):
                s += g[k] * g[k]
                v -= EMBEDDINGS * size * g[k] / (np.sqrt(s) + 1e-6)
            else:
                m += 0.1 * (g[k] - m)
                s += 0.005 * (g[k] * g[k] - s)
                v -= size * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(s / (1 - 0.995 ** (step + 1))) + 1e-7)
    return network


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, longest: int = 4000) -> Network:
    """A network from texts (id, text) and their labels (id, toxic).

    At most ``per_label`` texts of each label of at most ``longest`` bytes, those of the smallest id hashes,
    are learnt from. They are chosen by ids and sizes, so texts don't shuffle. Null texts are left out.
    """
    short = docs.where(F.octet_length("text") <= longest)
    rows = short.select("id").join(labels.where("toxic IN (0, 1)").select("id", "toxic"), "id")
    chosen = [r for label in (0, 1) for r in rows.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(per_label).select("id", "toxic").collect()]
    if not chosen:
        return fit([], np.empty(0, np.int64))
    ids = docs.sparkSession.createDataFrame([(r.id, r.toxic) for r in chosen], rows.select("id", "toxic").schema).distinct()
    # Twice per_label rows, besides rows that repeat an id.
    sample = short.select("id", "text").join(F.broadcast(ids), "id").limit(4 * per_label).collect()
    sample.sort(key=lambda r: (r.toxic, r.id, r.text))
    return fit([r.text.encode() for r in sample], np.array([r.toxic for r in sample], np.int64))


def score(docs: DataFrame, network: Network, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``: the chance that the text is toxic; a null text is scored as an empty one. A column of that name is replaced.

    Equal texts get equal scores wherever they stand; an empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c != name]
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def run(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(scorer.score(utf8(b.column("text"))), pa.float64())], ["row", "score"])

    out = arrow_map(own, run, f"row {own.schema['row'].dataType.simpleString()}, score double")
    return out.select("row.*", F.col("score").alias(name))
