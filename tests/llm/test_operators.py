"""The training-data operators against SQL, libraries and brute force, and their edge cases."""

import collections
import hashlib
import random
import re
import string

import numpy as np
import pytest

import oracle
from spillway.llm import chat, pii, warc
from spillway.llm.catalog import ORACLES, QUERIES, TOKENIZERS
from spillway.llm.decontaminate import decontaminate
from spillway.llm.exact_dedup import dedup_exact, drop_copies
from spillway.llm.language import identify, train as train_language
from spillway.llm.near_dedup import components, near_dedup
from spillway.llm.pieces import decode, encode, load
from spillway.llm.substring_dedup import remove_repeats
from spillway.llm.toxicity import Scorer, fit

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    con = oracle.connect(SF)
    cols, _, got = oracle.spark_rows(QUERIES[name](spark, SF))
    want_cols, _, want = oracle.duck_rows(con, ORACLES[name])
    assert cols == want_cols and got == want


def noisy(seed, n=40):
    """Texts with copies, shared passages, repeats within one text, empty and null ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    passage = [" ".join(word() for _ in range(150)) for _ in range(4)]
    out = []
    for k in range(n):
        parts = [" ".join(word() for _ in range(r.randrange(0, 120))) for _ in range(3)]
        p = r.choice(passage)
        cut = r.randrange(0, 60)
        out.append((k, " ".join([parts[0], p[cut : len(p) - r.randrange(0, 60)], parts[1]] if r.random() < 0.5 else parts)))
    out += [(n, out[0][1]), (n + 1, None), (n + 2, ""), (n + 3, "ab" * 700), (n + 4, "x" * 401), (n + 5, "y" * 400), (n + 6, out[1][1].upper()), (n + 7, out[2][1][:-3] + "zzz")]
    return out


def removed(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for k, t in texts.items():
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[k] = (len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    docs = noisy(seed)
    got = rows(remove_repeats(spark.createDataFrame(docs, DOCS)))
    want = removed({k: (t or "").encode() for k, t in docs}, 400)
    assert {k: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for k, r in got.items()} == want


def test_repeats_of_nulls_and_rows(spark):
    docs = spark.createDataFrame([(None, "q" * 500), (1, "a" * 300), (1, "a" * 300)], DOCS)
    got = remove_repeats(docs).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(300, 0), (300, 0), (500, 500)]
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def linked(docs, size=3, threshold=85):
    sets = {}
    for k, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


@pytest.mark.parametrize("size,threshold", [(3, 85), (5, 80)])
def test_near_copies(spark, size, threshold):
    r = random.Random(3)
    base = [[f"w{r.randrange(500)}" for _ in range(150)] for _ in range(8)]
    docs = []
    for k in range(120):
        w = list(r.choice(base))
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        docs.append((k, " ".join(w)))
    docs += [(120, docs[5][1].upper()), (121, None), (122, ""), (123, "one two"), (124, "ONE  two"), (125, docs[7][1])]
    got = rows(near_dedup(spark.createDataFrame(docs, DOCS), size=size, threshold=threshold))
    assert {k: (v["n_shingles"], v["component_id"]) for k, v in got.items()} == linked(docs, size, threshold)
    assert all(v["kept"] == (v["component_id"] == k) for k, v in got.items())


def test_near_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (2, "a b c d"), (1, "a b c d"), (2, "a b c d")], DOCS).withColumn("class_id", __import__("pyspark").sql.functions.lit(9))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 1, False), (2, 1, False), (None, None, True)], key=str)
    assert near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101)], "low long, high long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got.pop(101) == 100 and got.pop(100, 100) == 100
    assert set(got.values()) == {1} and set(got) | {1} == set(range(1, 61))


def test_exact_copies(spark):
    docs = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (6, "é"), (None, "ab")]
    got = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup_exact(spark.createDataFrame(docs, DOCS)).collect())
    assert got == collections.Counter([(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 2, True), (6, 6, 2, False)])
    kept = drop_copies(spark.createDataFrame([(*d, 7) for d in docs], DOCS + ", sha int"))
    assert kept.columns == ["doc_id", "text", "sha"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert dedup_exact(spark.createDataFrame([], DOCS)).count() == 0


def test_decontamination_in_blocks(spark):
    docs = spark.createDataFrame([(1, "x y one two three z"), (2, None), (3, "One-TWO, three"), (4, "")], DOCS)
    items = spark.createDataFrame([(7, "one two three"), (11, "two"), (5, ""), (6, None), (11, "absent words here")], "item_id long, text string")
    for block_bytes in (1 << 20, 1):
        got = rows(decontaminate(docs, items, block_bytes=block_bytes))
        assert (got[1]["n_words"], got[1]["n_hit"], got[1]["items"]) == (6, 3, ["11", "7"])
        assert (got[3]["n_hit"], got[3]["contaminated"]) == (3, True)
        assert [(got[k]["n_words"], got[k]["n_items"]) for k in (2, 4)] == [(0, 0), (0, 0)]
    assert not decontaminate(docs, items.limit(0)).where("contaminated").count()
    assert decontaminate(docs.limit(0), items).count() == 0


def test_archives(spark):
    pages = spark.createDataFrame([(1, "http://a/\r\n", "p" * 2000), (2, "http://b/", "p" * 2000), (3, None, None), (4, "u", "small"), (5, "u", "small"), (None, "u", "é" * 700)], "page_id long, url string, html string")
    archives = warc.write_archives(warc.with_revisits(pages), archive_bytes=300)
    got = {r.record_id: r for r in warc.read_archives(archives).collect()}
    assert all(r.error is None for r in got.values()) and len(got) == 6
    assert got["<urn:page:1>"].record_type == "revisit" and got["<urn:page:1>"].refers_to == "<urn:page:2>"
    assert bytes(got["<urn:page:2>"].payload) == b"p" * 2000 and got["<urn:page:1>"].payload_bytes == 2000
    content = bytes(archives.orderBy("path").first().content)
    cut = [x[-1] for x in warc.records(content[:-5])]
    assert cut[-1].startswith("frame")
    assert list(warc.records(b"")) == [] and list(warc.records(b"rubbish!"))[0][-1]
    assert warc.parsed(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n")[-1].startswith("missing")
    good = warc.record(1, "u", hashlib.sha1(b"abc").hexdigest(), b"abc", None)
    assert warc.parsed(good)[-1] is None
    assert warc.parsed(good.replace(b"abc", b"abd"))[-1] == "payload digest" and warc.parsed(good[:-6] + good[-4:])[-1] == "block length"


@pytest.mark.parametrize("text", ["", "a\\b", "<|end|>", "\\<|im|>\\", "<\\|say|>", "\\\\", "<|<|"])
def test_escapes(text):
    assert chat.unescaped(chat.escaped(text)) == text and "<|" not in chat.escaped(text)


def test_masks_cover_the_answers(spark):
    turns = [(1, 0, "user", " a<|end|>"), (1, 1, "assistant", " b\\ <|say|>é🙂 "), (1, 2, "assistant", ""), (1, 3, None, None), (1, 4, "assistant", "x\n"), (None, 0, "assistant", "n"), (1, 4, "assistant", "x\n")]
    out = chat.format_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), f"{TOKENIZERS}/byte_bpe_50k.json")
    for r in out.collect():
        back, under = chat.read_back(r.formatted, np.array(r.starts), np.array(r.ends), np.array(r.loss))
        want = [(a or "", b or "") for c, _, a, b in turns if c == r.conv_id]
        assert sorted(back) == sorted(want)
        assert under == [b for a, b in back if a == "assistant" and b]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    own, library = load(path), sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(9)
    texts = ["".join(r.choice("abcdehilnorst ensé日🙂\n\t  .,12=") for _ in range(r.randrange(80))) for _ in range(400)]
    texts += ["", " ", "   ", "  lead", "=" * 70, "internationalization of representations", "▁x"]
    got = own.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [own.decode(x) for x in got] == library.decode(library.encode(texts))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "Hello  world")], DOCS)
    back = rows(decode(encode(docs, path), path))
    assert [back[k]["decoded"] for k in (1, 2, 3)] == [None, "", "Hello  world"]


def naive_spans(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_rules_for_personal_data():
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice(["a", "@", ".", "-", "+", "1", "22", "255", " ", "(", ")", "b.c", "1.2.3.4", "4111111111111111", "\n"]) for _ in range(r.randrange(30)))
        assert pii.base_spans(text) == naive_spans(text), text


def test_field_adds_spans_and_skips_exactly():
    field = pii.train(pii.labelled_table())
    sentence = "Plain words here, write: someone at place dot com. Then call 555-123-4567, or not"
    found = {sentence[s:e] for s, _, e in pii.field_spans(field, [sentence])[0]}
    assert "555-123-4567" in found and any("place dot com" in x for x in found)
    for words, _ in pii.labelled_table(rows=60, seed=77):
        e = field.emissions(words)
        assert not pii.viterbi(e[None], field.moves)[0][~field.open_words(e)].any()
    table = pii.labelled_table(rows=120, seed=78)
    right = sum((pii.viterbi(field.emissions(w)[None], field.moves)[0] == [pii.LABELS.index(x) for x in y]).mean() > 0.99 for w, y in table)
    assert right >= 0.8 * len(table)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_language_edge_cases(spark):
    empty = spark.createDataFrame([], "id long, text string, lang string")
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (3, "123 !!", 2.0), (4, "abc", 2.0)], DOCS + ", score double")
    got = identify(docs, train_language(empty))
    assert got.columns == ["doc_id", "text", "lang_pred", "score"] and {(r.lang_pred, r.score) for r in got.collect()} == {("und", 0.0)}
    one = train_language(spark.createDataFrame([(1, "abc", "xx"), (2, None, "yy"), (3, "q", None)], "id long, text string, lang string"))
    assert rows(identify(docs, one))[4]["lang_pred"] == "xx" and rows(identify(docs, one))[3]["lang_pred"] == "und"


def test_toxicity_learns_words_and_reads_whole_texts():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8)))
    clean = [" ".join(word() for _ in range(60)) for _ in range(150)]
    toxic = [c + f" {bad}{word()} " + " ".join(word() for _ in range(20)) for c, bad in zip(clean, ["zorgo", "vilmu"] * 75)]
    texts = [t.encode() for t in clean[:100] + toxic[:100]]
    scorer = Scorer(fit(texts, np.array([0] * 100 + [1] * 100), rounds=6, steps=40))
    held = [t.encode() for t in clean[100:]], [t.encode() for t in toxic[100:]]
    assert np.mean(np.array(scorer.score(held[0])) < 0.7) > 0.85 and np.mean(np.array(scorer.score(held[1])) >= 0.7) > 0.85
    long = (" ".join(word() for _ in range(3000)) + " zorgoabc zorgoeh ").encode()
    some = scorer.score([None, b"", b"123", long])
    assert some[0] == some[1] == some[2] and all(0 <= x <= 1 for x in some)
    assert Scorer(fit([], np.empty(0, int))).score([b"a"])[0] < 0.7
