"""Encoding and reading back takes one Python worker a task."""

from pyspark.sql import functions as F

from spillway.llm.catalog import QUERIES, TOKENIZERS
from spillway.llm.pieces import decode, encode, encode_and_decode

SF = "/root/testdata/sf0.001"
MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def test_one_worker_a_task(spark):
    plan = QUERIES["op9_sentencepiece"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_same_as_one_after_the_other(spark):
    texts = [None, "", " ", "a", "two  words", "\u4f60\u597d \U0001f600\x00", "\u2581mark", "x" * 40, "  lead and trail  "]
    docs = spark.createDataFrame([(i, t, "gone") for i, t in enumerate(texts * 3)], "doc_id long, text string, ids string")
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit("gone").alias("ids")).limit(60)
    for given in (docs, known, docs.limit(0)):
        both, chained = encode_and_decode(given, MODEL), decode(encode(given, MODEL), MODEL)
        assert both.columns == chained.columns == ["doc_id", "text", "ids", "decoded"] and both.schema == chained.schema
        assert sorted(both.collect(), key=str) == sorted(chained.collect(), key=str)
