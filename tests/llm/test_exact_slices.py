"""Slices of the hash space, and blocks of the benchmark, are taken one at a time."""

import random

import pytest

from spillway.llm import exact_dedup as E
from spillway.llm.decontaminate import decontaminate

DOCS = "doc_id long, text string"


@pytest.fixture
def broadcasts(spark, monkeypatch):
    """How many broadcasts were alive whenever one was made, and those that still are."""
    alive, most = set(), []
    real = type(spark.sparkContext).broadcast

    def broadcast(sc, value):
        out = real(sc, value)
        alive.add(id(out))
        most.append(len(alive))
        gone = out.destroy
        out.destroy = lambda *a: (alive.discard(id(out)), gone(*a))
        return out

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    return alive, most


def test_ids_slice_by_slice(spark, monkeypatch, broadcasts):
    monkeypatch.setattr(E, "SHARD", 50)
    alive, most = broadcasts
    docs = spark.createDataFrame([(k, f"text {k % 300}") for k in range(700)], DOCS)
    got = E.dedup_exact(docs, filter_mb=0).collect()
    assert len(most) > 5 and max(most) == 1 and not alive
    for r in got:
        group = [k for k in range(700) if k % 300 == r.doc_id % 300]
        assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))


def test_whole_rows_slice_by_slice(spark, monkeypatch, broadcasts):
    monkeypatch.setattr(E, "SHARD", 50)
    alive, most = broadcasts
    rows = [(k, f"text {k % 300}", {"a": k}, "h") for k in range(700)] + [(None, "TEXT 7", None, None), (900, None, None, "x"), (901, "", {}, "y")]
    kept = E.drop_copies(spark.createDataFrame(rows, DOCS + ", `od.d name` map<string, int>, h string"), filter_mb=0)
    got = kept.collect()
    assert len(most) > 5 and max(most) == 1 and not alive
    assert kept.columns == ["doc_id", "text", "od.d name", "h"]
    want = {max(k for k in range(700) if k % 300 == g) for g in range(300)} | {901}
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert all(r[2] == ({"a": r.doc_id} if r.doc_id < 700 else {}) for r in got)


def test_benchmark_block_by_block(spark, broadcasts):
    alive, most = broadcasts
    r = random.Random(5)
    word = lambda: r.choice("abcde")
    items = [(k, " ".join(word() for _ in range(r.choice((1, 2, 5, 10, 12))))) for k in range(12)]
    docs = [(k, " ".join(word() for _ in range(40)) + " " + r.choice(items)[1]) for k in range(15)]
    docs += [docs[0], docs[0], (0, "other"), (None, docs[1][1]), (None, None), (None, None), (99, " ".join("abcde"[k % 5] for k in range(100_000)))]
    got = decontaminate(spark.createDataFrame([(*d, "i", 1) for d in docs], DOCS + ", item string, n_hit int"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=100)
    got = sorted((repr(x.doc_id), x.n_words, x.n_hit, x["items"]) for x in got.collect())
    assert len(most) > 8 and max(most) == 1 and not alive
    want = []
    for key, text in docs:
        w, hit, named = (text or "").split(), set(), set()
        for item, t in items:
            own = t.split()
            n = min(10, len(own))
            windows = {tuple(own[a : a + n]) for a in range(len(own) - n + 1)}
            at = [a for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in windows]
            hit |= {x for a in at for x in range(a, a + n)}
            named |= {str(item)} if at else set()
        want.append((repr(key), len(w), len(hit), sorted(named)))
    assert got == sorted(want)
