"""Periodic runs, conversation tries and the quality network: brute force, edge cases, held-out accuracy."""

import collections
import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from spillway.llm import quality, turn_trie
from spillway.llm.catalog import QUERIES
from spillway.llm.periodic import find_runs

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def naive_runs(words):
    """(start, length, period) lag by lag over all words."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    out = []
    for q in range(1, len(ids) // 4 + 1):
        step = np.diff(np.r_[0, (ids[q:] == ids[:-q]).astype(int), 0])
        for a, b in zip(np.nonzero(step == 1)[0].tolist(), np.nonzero(step == -1)[0].tolist()):
            part = ids[a : b + q]
            if len(part) >= max(6, 4 * q) and not any(q % d == 0 and (part[d:] == part[:-d]).all() for d in range(1, q)):
                out.append((a, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got, several = QUERIES["op13_periodic_runs"](spark, SF).collect(), 0
    assert len(got) == len(docs)
    for r in got:
        words = (docs[r.doc_id] or "").encode().split()
        h = crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        words = [w.decode() for w in words]
        runs = naive_runs(words)
        several += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == sha(collapsed(words, runs))
    assert several > 5


@pytest.mark.parametrize("seed", range(3))
def test_runs_in_dense_texts(spark, seed):
    r = random.Random(seed)
    docs = []
    for k in range(250):
        words = []
        for _ in range(r.randrange(6)):
            letters = "abcdefghij"[: r.choice([1, 2, 3, 10])]
            unit = [r.choice(letters) for _ in range(r.randrange(1, 9))]
            words += (unit * 40)[: r.randrange(40)] if r.random() < 0.6 else [r.choice(letters) for _ in range(r.randrange(15))]
        docs.append((k, r.choice([" ", "\n", " \t"]).join(words)))
    for row in find_runs(spark.createDataFrame(docs, DOCS)).collect():
        words = row.text.split()
        runs = naive_runs(words)
        assert [(x.start, x.length, x.period) for x in row.runs] == runs
        assert row.collapsed == collapsed(words, runs) and row.n_words == len(words)


def test_runs_edge_cases(spark):
    unit = " ".join(f"w{k}" for k in range(500))
    docs = [(1, None, 5), (2, "", 5), (None, "a " * 9, 5), (None, "a " * 9, 5), (3, "a a a a a", 5), (4, "é x " * 6, 5), (5, " ".join([unit] * 60), 5)]
    out = find_runs(spark.createDataFrame(docs, DOCS + ", runs int").withColumn("row", F.lit("mine")))
    assert out.columns == ["doc_id", "text", "row", "n_words", "runs", "collapsed"]
    got = out.collect()
    by = {r.doc_id: [tuple(x) for x in r.runs] for r in got}
    assert by == {1: [], 2: [], None: [(0, 9, 1)], 3: [], 4: [(0, 6, 1)], 5: [(0, 30000, 500)]}
    assert [r.collapsed for r in got] == ["", "", "a", "a", "a a a a a", "é x", unit] and {r.row for r in got} == {"mine"}
    assert find_runs(spark.createDataFrame([], DOCS)).count() == 0


def naive_trie(convs):
    """Nodes of {conv: [(turn id, words)]}."""
    members = collections.defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = collections.defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        parts = [below(x) for x in children[p]]
        return sum(x for x, _ in parts) or 1, sum(y for _, y in parts) + (len(members[p]) - 1) * (p[-1][1] if p else 0)

    out = set()
    for p, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(p))))
        out.add((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), *below(p), sha(ends)))
    return out


@pytest.mark.parametrize("limit", [1, 6, 4096])
def test_trie_of_any_container_size(spark, limit):
    r = random.Random(12)
    convs, turns = {}, []
    for c in range(150):
        path = [("t" + r.choice("ab" if d < 3 else "abcdef"), d) for d in range(r.choice([0, 1, 2, 4, 7, 12]))]
        convs[c * 7] = list(convs[r.choice(list(convs))]) if c > 20 and r.random() < 0.3 else path
    for c in (3, 4):  # equal long conversations that share nothing with others
        convs[c] = [(f"x{d}", 2) for d in range(40)]
    for c, path in convs.items():
        turns += [(c, d, bytearray(t.encode()), w) for d, (t, w) in enumerate(path)]
    got = turn_trie.prefix_trie(
        spark.createDataFrame([(c, len(p)) for c, p in convs.items()], "conv long, len long"), spark.createDataFrame(turns, "conv long, pos long, t binary, words long"), limit
    ).collect()
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {tuple(r) for r in got} == naive_trie(convs)


def test_trie_edge_cases(spark):
    kind = "conv_id long, turn long, role string, text string, words long, pos string"
    rows = [(20, 1, "user", "b c", 9, "p"), (20, None, None, None, 9, "p"), (20, 1, "user", "b c", 9, "p"), (None, 0, "user", "x", 9, "p"), (21, 0, "user", "  y", 9, "p"), (39, 5, "", "", 9, "p")]
    turns = turn_trie.numbered_turns(spark.createDataFrame(rows, kind))
    assert sorted((r.conv, r.pos, r.words) for r in turns.collect()) == [(20, 0, 0), (20, 1, 2), (20, 2, 2), (21, 0, 2), (39, 0, 0)]
    heads, again = turn_trie.reopened(turns)
    own, want = {c: sorted((r.pos, bytes(r.t), r.words) for r in turns.collect() if r.conv == c) for c in (20, 21, 39)}, {}
    for c in own:
        h = crc32(str(c).encode()) % 4
        want[c] = [x[1:] for x in own.get(c - c % 20, [])[:h] + own[c][h:]]
    got = {c: [(bytes(r.t), r.words) for r in sorted(again.collect(), key=lambda r: r.pos) if r.conv == c] for c in own}
    assert got == want and {r.conv: r.len for r in heads.collect()} == {c: len(p) for c, p in want.items()}
    assert {tuple(r) for r in turn_trie.prefix_trie(heads, again).collect()} == naive_trie(want)
    empty = turn_trie.numbered_turns(spark.createDataFrame([], kind))
    assert turn_trie.prefix_trie(*turn_trie.reopened(empty)).count() == 0


def test_ids_of_a_large_class(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "PIECE", 50)
    members = spark.range(1000).select(F.lit(0).cast("long").alias("cls"), F.col("id").alias("conv")).unionByName(spark.createDataFrame([(5, 5), (5, 9)], "cls long, conv long"))
    got = {r.cls: r.sha for r in turn_trie.member_digests(members).collect()}
    assert got == {0: sha(",".join(map(str, range(1000)))), 5: sha("5,9")}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op11_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.predicted for r in rows if r.quality == 1], [r.predicted for r in rows if r.quality == 0]
    assert len(good) > 50 and np.mean(good) >= 0.95 and np.mean(bad) <= 0.15


def test_quality_reads_whole_texts_and_edges(spark):
    r = random.Random(11)
    word = lambda s: "".join(r.choice(s) for _ in range(r.randrange(2, 8)))
    good, bad = ([" ".join(word(s) for _ in range(60)) for _ in range(80)] for s in ("abcdefgh", "ABCDEF!!"))
    network = quality.fit([t.encode() for t in good[:60] + bad[:60]], np.array([1] * 60 + [0] * 60), steps=120)
    assert np.mean(np.array(network.score([t.encode() for t in good[60:]])) >= 0.7) > 0.9
    assert np.mean(np.array(network.score([t.encode() for t in bad[60:]])) < 0.7) > 0.9
    text = bytes(range(250)) * 40
    cut = quality.chunks_of(text)
    read = np.concatenate([cut[:-1, : quality.STEP].ravel(), cut[-1]])
    assert (read[: len(text)] == np.frombuffer(text, np.uint8)).all() and (read[len(text) :] == quality.PAD).all()
    late = (" ".join(good) * 8).encode(), (" ".join(good) * 4 + " ".join(bad) * 4).encode()
    assert network.score([late[0]])[0] > network.score([late[1]])[0]
    docs = [(1, None, 2), (2, "", 2), (3, good[0], 2), (3, good[0], 2), (4, "é" * 70000, 2)]
    out = quality.score(spark.createDataFrame(docs, DOCS + ", score int").withColumn("row", F.lit(1)), network)
    assert out.columns == ["doc_id", "text", "row", "score"]
    some = [x.score for x in out.collect()]
    assert some[0] == some[1] and some[2] == some[3] and all(0 <= x <= 1 for x in some)
    assert quality.score(spark.createDataFrame([], DOCS), network).count() == 0
    none = quality.train(spark.createDataFrame([], "id long, text string"), spark.createDataFrame([(1, None), (2, 5)], "id long, quality int"))
    assert none.score([b"a"])[0] < 0.7
    one = quality.train(spark.createDataFrame([(1, "a"), (2, None)], "id long, text string"), spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "id long, quality int"))
    assert one.score([b"a"])[0] >= 0.7
