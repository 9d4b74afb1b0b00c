"""Families of several blocks, and their cost."""

import random

import pytest

from spillway.llm import near_dedup as N
from test_operators import DOCS, linked


@pytest.mark.parametrize("block,size", [(4, 1 << 25), (1024, 4000)])
def test_families_of_many_blocks(spark, monkeypatch, block, size):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "BYTES", size)
    r = random.Random(block)
    base = [[f"w{r.randrange(500)}" for _ in range(150)] for _ in range(4)]
    docs = []
    for k in range(110):
        w = list(r.choice(base))
        # Near the threshold: many are linked by way of others only, some with none.
        for _ in range(r.choice([1, 2, 4, 7])):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        docs.append((k, " ".join(w)))
    for step in range(40):  # a chain in which only neighbours are linked
        docs.append((200 + step, " ".join(f"c{i}" for i in range(step * 5, step * 5 + 150))))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_dedup(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == linked(docs)
