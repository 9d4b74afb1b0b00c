"""What is linked already costs no further rounds."""

from spillway.llm import near_dedup as N
from test_operators import DOCS, linked


def test_stars_take_one_pass(spark, monkeypatch):
    stored, plain = [], N.materialise
    monkeypatch.setattr(N, "materialise", lambda df, name: stored.append(name) or plain(df, name))
    stars = [(1, k) for k in range(2, 9)] + [(1, 5), (20, 21), (30, 30)]
    got = {r.node: r.component for r in N.components(spark.createDataFrame(stars, "low long, high long")).collect()}
    assert got == {**{k: 1 for k in range(1, 9)}, 20: 20, 21: 20}
    assert stored == ["least"]


def test_parts_of_blocks_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    calls, plain = [], N.components
    monkeypatch.setattr(N, "components", lambda links: calls.append(1) or plain(links))
    docs = [(k, " ".join(f"w{i}" for i in range(150)) + f" e{k}") for k in range(12)]  # one family of three blocks
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_dedup(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == linked(docs)
    assert len(calls) == 1  # the families alone


def test_a_chain_ends_in_a_star(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 12)], "low long, high long")
    assert {tuple(r) for r in N.components(links).collect()} == {(k, 1) for k in range(1, 13)}
