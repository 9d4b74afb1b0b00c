"""Every torn row of the torn-lines query has a file of its own."""

import duckdb

from spillway.plans.catalog import ORACLES, QUERIES


def test_repeated_and_missing_ids(spark, tmp_path):
    ids = [0, 0, 997, 1, 1, 1, 998, 5, -997, None]
    rows = spark.createDataFrame([(i, "2024-01-01 00:00:00") for i in ids], "event_id long, ts string")
    rows.selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(ORACLES["torn_lines"]).fetchall()
    got = [tuple(r) for r in QUERIES["torn_lines"](spark, str(tmp_path)).collect()]
    assert len(want) == 16 and sorted(got) == sorted(want)
