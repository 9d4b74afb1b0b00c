"""Values that JSON doesn't have, in every shape of context, through normalise_logs."""

import json

import pytest
from pyspark.sql import functions as F

from spillway.plans.normalise_logs import normalise_logs

BAD = "cast(unhex('61B162') AS string)"
CONTEXTS = {
    "struct": f"named_struct('n', double('NaN'), 'f', float('Infinity'), 'ok', float('1.5'), 'l', array(double('-Infinity'), 2D), 's', {BAD}, 'm', map('x', double('NaN')))",
    "array_in_map": f"map('n', array(double('NaN')), 's', array(1D))",
    "variant_map": f"map('n', double('NaN')::variant, 's', {BAD}::variant)",
    "text": "cast(concat(unhex(hex('{\"n\":NaN,\"s\":\"')), unhex('61B162'), unhex(hex('\"}'))) AS string)",
}


@pytest.mark.parametrize("shape", list(CONTEXTS))
def test_no_value_that_json_lacks_is_shipped(spark, shape):
    raw = spark.sql(
        f"""SELECT 1L AS app, 1L AS proc, 1L AS seq, timestamp'2026-01-01' AS ts, 'error' AS level_name, {BAD} AS message,
            {BAD} AS host, {CONTEXTS[shape]} AS context"""
    )
    config = spark.sql("SELECT 1L AS app, 'https://x' AS url, 't' AS token, 'true' AS enabled, 'debug' AS channel_level, cast(null AS string) AS min_level")
    row = normalise_logs(raw, config).select("entry", F.is_valid_utf8("message").alias("ok")).first()
    entry = json.loads(row.entry)
    context = entry["context"]
    assert row.ok and entry["message"] == entry["host"] == "a�b"
    if shape == "struct":
        assert context == {"n": 0, "f": 0, "ok": 1.5, "l": [0, 2], "s": "a�b", "m": {"x": 0}}
    elif shape == "array_in_map":
        assert context == {"n": [0], "s": [1]}
    else:
        assert context == {"n": 0, "s": "a�b"}
