"""Every stage against a plain version of it on the small table."""

import duckdb

import corpus_pipeline as pipeline
from spillway.llm.language import identify, train_on
from spillway.llm.pieces import load

from test_operators import linked

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    by = {}
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        out = stage(spark, kept, SF)
        if name != "pieces":
            assert out.columns == docs.columns
        after = {r.doc_id for r in out.select("doc_id").collect()}
        by[name] = before, after, out
        kept = out if name != "pieces" else kept
    before, after, _ = by["language"]
    said = {r.doc_id: r for r in identify(docs, train_on(docs)).collect()}
    assert after == {k for k in before if said[k].lang_pred != "und" and said[k].score >= pipeline.SURE}
    before, after, _ = by["exact"]
    groups = {}
    for k, t in before.items():
        groups.setdefault("".join(c.lower() if c.isascii() else c for c in t), []).append(k)
    assert after == {max(g) for g in groups.values()}
    before, after, _ = by["near"]
    assert after == {k for k, (_, c) in linked(before.items(), 5, 80).items() if c == k}
    before, after, _ = by["leaks"]
    split = lambda t: [w for w in "".join(c.lower() if c.isascii() and c.isalpha() else c if c.isdigit() and c.isascii() or ord(c) > 127 else " " for c in t or "").split(" ") if w]
    windows = set()
    for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall():
        w = split(t)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    hit = {k for k, t in before.items() if any(tuple(split(t)[i : i + n]) in windows for n in sizes for i in range(len(split(t)) - n + 1))}
    assert after == before.keys() - hit
    before, after, out = by["pieces"]
    model = load(f"{pipeline.TOKENIZERS}/piece_bpe_32k.model")
    assert after == before.keys()
    for r in out.collect():
        assert r.same and r.ids == model.encode([before[r.doc_id]])[0].tolist()
