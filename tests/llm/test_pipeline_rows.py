"""Stages decide on rows, also where doc_id recurs or is missing."""

import corpus_pipeline as pipeline

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.001"


def text(name, n=60, end=""):
    return " ".join(f"{name}{i}" for i in range(n)) + end


def test_near_decides_on_rows(spark):
    docs = [(1, text("a")), (2, text("a", end=" x")), (2, text("b")), (None, text("c")), (None, text("a", end=" y")), (7, text("c", end=" x"))]
    got = pipeline.near(spark, spark.createDataFrame(docs, DOCS), SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([docs[0], docs[2], docs[5]], key=str)


def test_leaks_decide_on_rows(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    docs = [(1, item), (1, text("a")), (None, item), (None, text("b")), (3, None)]
    got = pipeline.leaks(spark, spark.createDataFrame(docs, DOCS), SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([docs[1], docs[3], docs[4]], key=str)
