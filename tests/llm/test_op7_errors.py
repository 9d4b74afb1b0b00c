"""A damaged record is not left out."""

import pytest

from spillway.llm.catalog import every_page


def test_a_damaged_record_ends_op7(spark):
    row = "'<urn:page:1>' AS record_id, 3L AS payload_bytes, 'd' AS payload_digest, 'response' AS record_type, cast(null AS string) AS refers_to"
    assert every_page(spark.sql(f"SELECT {row}, cast(null AS string) AS error")).count() == 1
    with pytest.raises(Exception, match="damaged record: bad frame"):
        every_page(spark.sql(f"SELECT {row}, 'bad frame' AS error")).collect()
