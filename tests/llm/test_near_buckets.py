"""What moves for every band of every class is numbers."""

from spillway.llm import near_dedup as N
from test_operators import DOCS, linked


def test_bands_move_without_keys(spark, monkeypatch):
    kinds, plain = {}, N.materialise

    def noted(df, name):
        kinds.setdefault(name, {t for _, t in df.dtypes})
        return plain(df, name)

    monkeypatch.setattr(N, "materialise", noted)
    monkeypatch.setattr(N, "BLOCK", 4)  # buckets of more than this are families as they are
    docs = [(k, " ".join(f"w{i}" for i in range(60)) + f" e{k % 9}") for k in range(20)] + [(50, "a b c d"), (51, "x y z"), (52, None)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_dedup(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == linked(docs)
    assert kinds["buckets"] == kinds["members"] == {"bigint"}
