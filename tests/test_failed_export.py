"""The lines of the failed-job export carry the instant that their SQL states."""

import json

from pyspark.sql import functions as F

from spillway.plans.adapters import failed_jobs
from spillway.plans.catalog import QUERIES
from spillway.plans.forget import forget_failed

SF = "/root/testdata/sf0.001"


def test_export_states_its_own_instant(spark):
    lines = [json.loads(r.line) for r in QUERIES["failed_export"](spark, SF).select("line").collect()]
    assert lines and {line["failed_at"] for line in lines} == {"2026-10-05T12:00:00+00:00"}


def test_export_takes_any_instant(spark):
    now = F.timestamp_seconds(F.lit(86_400))
    lines = forget_failed(failed_jobs(spark, SF), export=True, now=now).exported.select("line").collect()
    assert lines and {json.loads(r.line)["failed_at"] for r in lines} == {"1970-01-02T00:00:00+00:00"}
