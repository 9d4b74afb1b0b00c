"""Positions counted while rows are written, and domains packed whole."""

import random

from pyspark.sql import functions as F

from spillway.operators import ordering, packing as P


def test_positions_of_any_domain(spark):
    """A domain of a third of the rows, null and NaN domains, single rows; Arrow batches of a few rows."""
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", "a", "b", None]), rnd.choice([1.5, float("nan"), None]), i) for i in range(900)]
    rows += [("hot", 1.5, i) for i in range(900, 1500)] + [(f"one{i}", None, i) for i in range(40)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "d string, x double, i long")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = ordering.number_once(df, ["d", "x"], ["i"], partitions=13).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    want, by = {}, {}
    for d, x, i in rows:
        by.setdefault((d, str(x)), []).append(i)
    for key, ids in by.items():
        want |= {(*key, i): n for n, i in enumerate(sorted(ids))}
    assert len(got) == len(rows)
    assert {(r.d, str(r.x), r.i): r._rn for r in got} == want


def test_no_rows(spark):
    empty = spark.createDataFrame([], "d string, i long, s long")
    assert ordering.number_once(empty, ["d"], ["i"]).count() == 0
    for bounded in (False, True):
        assert P.pack(empty, ["d"], ["i"], size=F.col("s"), bounded=bounded).count() == 0


def test_bounded_domains_pack_alike(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, "a", "b", "c", "d"]), i, rnd.choice([10, 700, 1500, 5000])) for i in range(2000)]
    df = spark.createDataFrame(rows, "d string, i long, s long")
    plans = [P.pack(df, ["d"], ["i"], batch_size=9, size=F.col("s"), max_bytes=4096, bounded=b) for b in (False, True)]
    assert plans[0].columns == plans[1].columns
    one, two = (sorted(map(str, p.collect())) for p in plans)
    assert len(one) == 2000 and one == two


def test_partitions_follow_the_input(spark, tmp_path):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(100_000).selectExpr("id", "uuid() AS t").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    assert ordering.range_partitions(t) == least
    few = ordering.range_partitions(t, 50_000)
    assert few > least
    assert ordering.range_partitions(t.select("id"), 50_000) < few
    # A join's estimate is a product: what it reads bounds it.
    assert ordering.range_partitions(t.join(t.toDF("id", "u"), "id"), 50_000) <= 2 * few
