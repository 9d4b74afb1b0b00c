"""Whole rows are stored once, and move only where they may be wanted."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from spillway.llm import common, exact_dedup as E, near_dedup as N

SF = "/root/testdata/sf0.001"


def table_of(spark, rows):
    """Rows in eight partitions; ``at`` is the one that holds a row."""
    return spark.sparkContext.parallelize([(*r, k * 8 // len(rows)) for k, r in enumerate(rows)], 8).toDF("doc_id long, text string, at int")


@pytest.mark.parametrize("most", [15, 26])
def test_a_sieve_loses_no_key(spark, monkeypatch, most):
    monkeypatch.setattr(common, "SIEVE_MOST", most)
    keys = spark.range(0, 40_000, 2).select(F.concat(F.lit("k"), "id").alias("key"))
    told = spark.range(40_000).select("id", common.sieve(keys, "key")(F.concat(F.lit("k"), "id")).alias("may"))
    n = {r.even: r.n for r in told.where("may").groupBy((F.col("id") % 2 == 0).alias("even")).agg(F.count("*").alias("n")).collect()}
    assert n[True] == 20_000
    assert 0 < n[False] < (800 if most == 26 else 12_000)


def test_a_sieve_of_nothing(spark):
    none = spark.createDataFrame([], "key long")
    assert not spark.range(100).where(common.sieve(none, "key")(F.col("id"))).count()
    null = spark.createDataFrame([(None,)], "key long")
    assert spark.range(1).where(common.sieve(null, "key")(F.lit(None).cast("long"))).count() == 1


def test_whole_rows_are_stored_once(spark, monkeypatch):
    stored, plain = [], E.materialise
    monkeypatch.setattr(E, "materialise", lambda df, name: stored.append((name, "kept" in df.columns)) or plain(df, name))
    docs = [(k, f"text {k % 30}") for k in range(70)]
    got = E.drop_copies(table_of(spark, docs))
    assert sorted(r.doc_id for r in got.collect()) == list(range(40, 70))
    assert [name for name, whole in stored if whole] == ["marked"]


def test_rows_that_stay_do_not_move(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    text = lambda k: " ".join(f"w{k}_{i}" for i in range(40))
    docs = [(k, text(k)) for k in range(200)] + [(k, text(k - 200) + " end") for k in range(200, 210)] + [(300, item)]
    for stage, gone in ((pipeline.near, range(200, 210)), (pipeline.leaks, [300])):
        got = stage(spark, table_of(spark, docs), SF).select("*", F.spark_partition_id().alias("now")).collect()
        assert sorted(r.doc_id for r in got) == sorted({k for k, _ in docs} - set(gone))
        assert sum(r.at == r.now for r in got) > 0.9 * len(got)


def test_only_what_may_be_linked_moves(spark, monkeypatch):
    tests = {}
    monkeypatch.setattr(N, "sieve", lambda keys, key: tests.setdefault(key, common.sieve(keys, key)))
    docs = table_of(spark, [(k, " ".join(f"w{k // 2 if k < 20 else k}_{i}" for i in range(40)) + f" {k}") for k in range(400)])
    got = N.near_dedup(docs).where("NOT kept").collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 20, 2))
    assert sorted(tests) == ["bucket", "class", "class_id", "set_key"]  # bands, signatures and texts
    assert 20 <= docs.where(tests["class_id"](F.col("doc_id"))).count() < 40
