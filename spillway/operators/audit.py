"""Masking audit: how many marks each mask has inserted, counted in the pass that masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from spillway.constants import MASKS
from spillway.functions.redact import Masks, inserted_marks, redact_text
from spillway.session import materialise


def mask_and_audit(rows: DataFrame, text: str, by: str, extra: Masks = ()) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``text`` masked, audit): masked, counted and written in one pass.

    The audit has a row per ``by`` and mask: ``mask``, ``inserted`` marks, ``texts`` with any of them; and for each mask one
    row with ``total`` set, whose numbers were observed while the rows passed by. Rows by group come
    from the counters that were written beside the texts, combined map-side; texts are not read again.
    """
    marks = list(dict.fromkeys(mark for _, mark in [*MASKS, *extra]))
    masked = rows.withColumn("_masked", redact_text(F.col(text), extra))
    counted = masked.withColumn("_marks", inserted_marks(F.col(text), F.col("_masked"), extra))
    out = counted.select(*[F.col("_masked").alias(c) if c == text else F.col(f"`{c}`") for c in rows.columns], "_marks")
    seen = Observation()
    watched = out.observe(seen, *[x.alias(f"{kind}{k}") for k, m in enumerate(marks) for kind, x in zip("it", _sums(m))])
    stored = materialise(watched, "masked")
    groups = stored.groupBy(F.col(f"`{by}`").alias(by)).agg(*[x.alias(f"{kind}{k}") for k, m in enumerate(marks) for kind, x in zip("it", _sums(m))])
    listed = F.array(*[F.struct(F.lit(m).alias("mask"), F.col(f"i{k}").alias("inserted"), F.col(f"t{k}").alias("texts")) for k, m in enumerate(marks)])
    by_group = groups.select(by, F.lit(False).alias("total"), F.inline(listed))
    told = seen.get
    totals = [(None, True, m, told[f"i{k}"] or 0, told[f"t{k}"] or 0) for k, m in enumerate(marks)]
    schema = f"`{by}` {rows.schema[by].dataType.simpleString()}, total boolean, mask string, inserted bigint, texts bigint"
    return stored.drop("_marks"), by_group.unionByName(rows.sparkSession.createDataFrame(totals, schema))


def _sums(mark: str) -> tuple[Column, Column]:
    n = F.col("_marks").getField(mark)
    return F.sum(n), F.sum((n > 0).cast("bigint"))
