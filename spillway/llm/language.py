"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three characters of the lower-cased text are hashed into
``DIM`` columns. Document frequencies come from all texts that may be learnt from;
the weights from a bounded sample per language (``per_language``), by the
follow-the-regularised-leader update with elastic-net penalties, so most weights
are exactly zero. A temperature fitted on a part of the sample that the weights
never saw calibrates the scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spillway.llm.common import arrow_map

BITS = 15
DIM = 1 << BITS
#: Characters hashed at once.
CHUNK = 1 << 19
UNDETERMINED = "und"
#: Parts in which the rows of a language are ranked, one after the other.
PARTS = (64, 8, 1)
_LETTER = re.compile(r"[^\W\d_]")
_TIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the n-grams of a text, with their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(DIM, np.int64)
    with np.errstate(over="ignore"):
        for at in range(0, len(codes), CHUNK):
            c = codes[at : at + CHUNK + 2]
            h = np.zeros(len(c), np.uint32)
            for k in range(3):
                n = min(len(c) - k, CHUNK)
                if n <= 0:
                    break
                h = (h[:n] ^ c[k : k + n]) * _TIMES[k]
                h ^= h >> np.uint32(15)
                counts += np.bincount((h * _TIMES[0]) >> np.uint32(32 - BITS), minlength=DIM)
    some = np.nonzero(counts)[0]
    return some.astype(np.int32), counts[some]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[at]
        return v / max(float(np.linalg.norm(v)), 1e-12)

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(at, counts) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(*grams(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(vectors: list, labels: np.ndarray, classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    """FTRL-proximal over (columns, values): weights and bias."""
    z, n = np.zeros((DIM, classes)), np.zeros((DIM, classes))
    bias = np.zeros(classes)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            at, v = vectors[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(v @ w + bias)
            p[labels[i]] -= 1
            g = v[:, None] * p
            more = ni + g * g
            z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[at] = more
            bias -= 0.01 * p
    return weights(z, n), bias


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least cross-entropy on held-back rows."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(5), 200))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all texts hold each column, and how many texts there are. ``DIM`` numbers reach the driver."""

    def run(batches):
        df, n = np.zeros(DIM + 1, np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                df[grams(t)[0]] += 1
                df[DIM] += 1
        at = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["at", "n"])

    out = np.zeros(DIM + 1, np.int64)
    for r in arrow_map(texts.select("text"), run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r.at] = r.n
    return out[:DIM], int(out[DIM])


def train(labelled: DataFrame, per_language: int = 500, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, held_back: float = 0.25, seed: int = 4) -> Model:
    """A model from rows (id, text, lang); rows without text or language are left out.

    At most ``per_language`` rows of each language, those of the smallest id hashes, fit the weights.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    df, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    ranked = rows.select("id", "lang", F.xxhash64("id").alias("by"))
    from pyspark.sql import Window

    # First within parts of a language, so that no task ranks one as a whole; what is left is bounded.
    for parts in PARTS:
        ranked = ranked.withColumn("part", F.pmod("by", F.lit(parts))).withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy("by", "id")))
        ranked = ranked.where(F.col("k") <= per_language).select("id", "lang", "by")
    chosen = ranked.select("id", "lang")

    def run(batches):
        for b in batches:
            found = [grams(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("lang"), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["id", "lang", "at", "counts"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    # The sample is bounded by the number of languages times per_language.
    sample = rows.select("id", "text").join(F.broadcast(chosen), "id").select("id", "text", "lang")
    sample = sorted(arrow_map(sample, run, f"id {kind}, lang string, at array<int>, counts array<long>").collect(), key=lambda r: (r.lang, str(r.id)))
    languages = sorted({r.lang for r in sample})
    model = Model(languages, idf, np.zeros((DIM, len(languages))), np.zeros(len(languages)))
    if not sample:
        return model
    labels = np.array([languages.index(r.lang) for r in sample])
    vectors = [(np.array(r.at, np.int64), model.vector(np.array(r.at, np.int64), np.array(r.counts))) for r in sample]
    back = np.random.default_rng(seed).random(len(sample)) < held_back
    fit = [v for v, out in zip(vectors, back) if not out]
    if fit:
        model.weights, model.bias = follow_the_leader(fit, labels[~back], len(languages), epochs, alpha, beta, l1, l2, seed)
    kept = [v @ model.weights[at] + model.bias for (at, v), out in zip(vectors, back) if out]
    if kept:
        model.temperature = fitted_temperature(np.array(kept), labels[back])
    return model


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings) -> Model:
    """A model that learns from rows whose id's crc32 modulo 4 isn't 2."""
    return train(docs.where(remainder(id_col, 4) != 2).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), **settings)


def identify(docs: DataFrame, model: Model, text_col: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability; columns of those names are replaced.

    A text that is null or has no letter gets ``und`` with score 0, as does any text if nothing was learnt.
    Texts are read whole and one by one, so equal ones get equal answers; an empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c not in (name, score)]
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages numbers

    def run(batches):
        for b in batches:
            said = [shared.value.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], ["row", "lang", "score"])

    out = arrow_map(own, run, f"row {own.schema['row'].dataType.simpleString()}, lang string, score double")
    return out.select("row.*", F.col("lang").alias(name), F.col("score").alias(score))
