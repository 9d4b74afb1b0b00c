"""Quality: a byte-level convolutional network over overlapping chunks, in numpy.

The UTF-8 bytes of a text are cut into chunks of ``CHUNK`` bytes, ``STEP`` apart, that
cover all of it. ``FILTERS`` learned filters of ``WIDTH`` byte embeddings slide over a
chunk, ``STRIDE`` bytes at a time; each filter's largest response in the chunk (max
pooling) describes the chunk. The mean and the maximum of a text's chunks go into one
logistic unit, so a text of any length is read whole and gives one probability.

Only the places of the largest responses get gradients, so a training step costs
little more than scoring.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map, utf8

CHUNK, STEP = 512, 384
WIDTH, STRIDE, FILTERS, DIM = 8, 4, 24, 8
#: Stands for what lies behind the end of a text.
PAD = 256
#: Chunks that are convolved together.
TOGETHER = 256
THRESHOLD = 0.7


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def chunks_of(text: bytes | None) -> np.ndarray:
    """(chunk, place) bytes of a text; an empty one has a single chunk of padding."""
    x = np.frombuffer(text or b"", np.uint8)
    n = max(1, -(-(len(x) - CHUNK) // STEP) + 1)
    whole = np.full((n - 1) * STEP + CHUNK, PAD, np.int16)
    whole[: len(x)] = x
    return np.lib.stride_tricks.sliding_window_view(whole, CHUNK)[::STEP]


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int) -> Network:
        r = np.random.default_rng(seed)
        n = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        return Network({
            "embed": n(PAD + 1, DIM, scale=0.5), "filters": n(WIDTH * DIM, FILTERS, scale=(WIDTH * DIM) ** -0.5), "bias": np.zeros(FILTERS, np.float32),
            "mean": n(FILTERS, scale=0.1), "max": n(FILTERS, scale=0.1), "o": np.zeros(1, np.float32),
        })

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """Embedded windows (chunk, place, WIDTH * DIM)."""
        x = self.p["embed"][chunks].reshape(len(chunks), -1)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * DIM, axis=1)[:, :: STRIDE * DIM]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each chunk, not below 0, and its place."""
        best, places = [], []
        for k in range(0, len(chunks), TOGETHER):
            w = self.windows(chunks[k : k + TOGETHER])
            r = (np.ascontiguousarray(w).reshape(-1, WIDTH * DIM) @ self.p["filters"]).reshape(*w.shape[:2], FILTERS)
            places.append(r.argmax(axis=1) if self.learning else np.empty(0, np.int64))
            best.append(np.maximum(r.max(axis=1) + self.p["bias"], 0))
        return np.concatenate(best), np.concatenate(places)

    learning = False

    def logits(self, best: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts with ``sizes`` chunks each; also means and maxima."""
        first = np.cumsum(sizes) - sizes
        mean = np.add.reduceat(best, first) / sizes[:, None].astype(np.float32)
        most = np.maximum.reduceat(best, first)
        return mean @ self.p["mean"] + most @ self.p["max"] + self.p["o"], mean, most

    def gradients(self, chunks: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy."""
        self.learning = True
        best, places = self.pooled(chunks)
        self.learning = False
        z, mean, most = self.logits(best, sizes)
        d = ((sigmoid(z) - labels) / len(labels)).astype(np.float32)
        g = {"mean": mean.T @ d, "max": most.T @ d, "o": d.sum(keepdims=True)}
        own = np.repeat(np.arange(len(sizes)), sizes)
        is_most = best == most[own]
        share = np.add.reduceat(is_most.astype(np.float32), np.cumsum(sizes) - sizes)[own]
        db = d[own, None] * (self.p["mean"] / sizes[own, None] + self.p["max"] * is_most / share) * (best > 0)
        db = db.astype(np.float32)
        g["bias"] = db.sum(axis=0)
        at = places[..., None] * STRIDE + np.arange(WIDTH)  # (chunk, filter, width)
        seen = np.take_along_axis(chunks[:, None, :], at, axis=2)
        x = self.p["embed"][seen].reshape(*seen.shape[:2], WIDTH * DIM)
        g["filters"] = np.einsum("cfk,cf->kf", x, db)
        back = (db[..., None] * self.p["filters"].T).reshape(-1, DIM)
        g["embed"] = np.stack([np.bincount(seen.ravel(), back[:, k], PAD + 1) for k in range(DIM)], axis=1).astype(np.float32)
        return g

    def score(self, texts: list[bytes | None]) -> list[float]:
        """Probabilities of label 1; chunks of many texts together, those of a long text some at a time."""
        out, held, n = [], [], 0
        for text in texts:
            held.append(chunks_of(text))
            n += len(held[-1])
            if n >= 4 * TOGETHER:
                out += self._scores(held)
                held, n = [], 0
        return out + (self._scores(held) if held else [])

    def _scores(self, held: list[np.ndarray]) -> list[float]:
        best, _ = self.pooled(np.concatenate(held) if len(held) > 1 else held[0])
        return sigmoid(self.logits(best, np.array([len(c) for c in held]))[0].astype(np.float64)).tolist()


def fit(texts: list[bytes], labels: np.ndarray, steps: int = 400, batch: int = 48, rate: float = 0.01, seed: int = 11) -> Network:
    """Adam over ``steps`` batches, half of each label. With one label or none the score is the same for all texts.

    A third of a batch are stretches of 15 to 240 bytes of their texts, so that short texts are known too.
    """
    network, order = Network.fresh(seed), np.random.default_rng(seed)
    if not len(texts) or labels.min() == labels.max():
        network.p["mean"][:] = network.p["max"][:] = 0
        network.p["o"][:] = 4.0 if len(labels) and labels[0] else -4.0
        return network
    cut = [chunks_of(t) for t in texts]
    by_label = [np.nonzero(labels == k)[0] for k in (0, 1)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    for step in range(steps):
        some = np.concatenate([order.choice(own, batch // 2) for own in by_label])
        shown = []
        for i in some:
            n, at = int(15 * 16 ** order.random()), order.random()
            short = order.random() < 1 / 3 and n < len(texts[i])
            shown.append(chunks_of(texts[i][int(at * (len(texts[i]) - n)) :][:n]) if short else cut[i])
        g = network.gradients(np.concatenate(shown), np.array([len(c) for c in shown]), labels[some].astype(np.float32))
        for k, v in network.p.items():
            m, s = moments[k]
            m += 0.1 * (g[k] - m)
            s += 0.005 * (g[k] * g[k] - s)
            v -= rate * (1 - step / steps) * ((m / (1 - 0.9 ** (step + 1))) / (np.sqrt(s / (1 - 0.995 ** (step + 1))) + 1e-7) + 0.002 * v)
    return network


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, longest: int = 8000) -> Network:
    """A network from texts (id, text) and their labels (id, quality).

    At most ``per_label`` texts of each label, of at most ``longest`` bytes, those of the smallest id hashes, are
    learnt from. They are chosen by ids and sizes, so no text shuffles. Labels other than 0 and 1 are left out.
    """
    sizes = docs.select("id", F.octet_length("text").alias("size")).where(F.col("size") <= longest)
    rows = sizes.join(labels.where("quality IN (0, 1)").select("id", "quality"), "id")
    chosen = [r for label in (0, 1) for r in rows.where(F.col("quality") == label).orderBy(F.xxhash64("id"), "id").limit(per_label).select("id", "quality").collect()]
    if not chosen:
        return fit([], np.empty(0, np.int64))
    ids = docs.sparkSession.createDataFrame([(r.id, r.quality) for r in chosen], rows.select("id", "quality").schema)
    # Twice per_label rows, besides rows that repeat an id.
    sample = docs.select("id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "id").limit(4 * per_label).collect()
    sample.sort(key=lambda r: (r.quality, r.id, r.text))
    return fit([r.text.encode() for r in sample], np.array([r.quality for r in sample], np.int64))


def score(docs: DataFrame, network: Network, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``: the chance that the text is of quality, from 0 to 1.

    A null text is scored as an empty one. Equal texts get equal scores wherever they stand; an empty table
    gives an empty one. A column called ``name`` is replaced, all others are kept.
    """
    kept = [c for c in docs.columns if c != name]
    own = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(shared.value.score(utf8(b.column("text"))), pa.float64())], ["row", "score"])

    out = arrow_map(own, run, f"row {own.schema['row'].dataType.simpleString()}, score double")
    return out.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(kept)], F.col("score").alias(name))
