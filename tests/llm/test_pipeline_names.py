"""Columns of any name, ids of any type, empty tables; texts without spaces."""

import random
import time

import pytest
import sentencepiece

import corpus_pipeline as pipeline
from spillway.llm.catalog import TOKENIZERS
from spillway.llm.pieces import load

SF = "/root/testdata/sf0.001"


def text(name, n=60, end=""):
    return " ".join(f"{name}{i}" for i in range(n)) + end


@pytest.mark.parametrize("ids", ["string", "long", "double"])
def test_stages_keep_columns_and_take_any_id(spark, ids):
    cast = {"string": lambda k: f"a{k}", "long": lambda k: -k, "double": float}[ids]
    rows = [(cast(k), t) for k, t in [(1, text("a")), (2, text("a", end=" x")), (3, text("b")), (4, None), (5, ""), (5, "")]] + [(None, text("b", end=" y"))]
    kind = f"doc_id {ids}, text string, lang string, source string, n_chars long, _row string, _lang string, _score string, key string, lang_pred string"
    docs = spark.createDataFrame([(i, t, "xx", "s", 1, "r", "l", "s", "k", "p") for i, t in rows], kind)
    for name in ("near", "leaks", "exact", "language"):
        out = dict(pipeline.STAGES)[name](spark, docs, SF)
        assert out.schema == docs.schema, name
        got = out.collect()
        assert got and all((r._row, r._lang, r._score, r.key, r.lang_pred) == ("r", "l", "s", "k", "p") for r in got)
        if name == "near":
            first = min(cast(1), cast(2))
            assert sorted((r.doc_id for r in got), key=repr) == sorted([first, cast(3), cast(4), cast(5), cast(5)], key=repr)
        assert dict(pipeline.STAGES)[name](spark, docs.limit(0), SF).count() == 0
    assert pipeline.pieces(spark, docs.limit(0), SF).count() == 0


def test_texts_without_spaces():
    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    own, library = load(path), sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(3)
    some = ["日本語の文章を書いています。今日は天気がいいですね", "中文没有空格所以一个词就是整个句子", "donaudampfschifffahrtsgesellschaft", "🙂🙃é̀ñ", "한국어 문장", "=====--------", "0123456789"]
    texts = ["".join(r.choice(some) for _ in range(r.randrange(1, 12))) for _ in range(150)] + ["x" * 400, "ab" * 300, "日" * 500]
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
    long = "".join(r.choice(some[:2]) for _ in range(14_000))
    assert len(long) > 280_000
    start = time.perf_counter()
    ids = own.encode([long])[0].tolist()
    assert time.perf_counter() - start < 15
    assert ids == library.encode(long)
