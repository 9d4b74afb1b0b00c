"""Request trails: all log lines of a request in order, on pages of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spillway.operators.ordering import number_rows, stage

PAGE = 100


def request_trail(lines: DataFrame, request: str, order: Sequence[str], entry: Column, page_rows: int = PAGE) -> DataFrame:
    """Pages (``request``, ``page``, ``first`` row number, ``n``, ``entries``) of the lines of each request.

    Lines go by ``order`` and are numbered from 0; page p holds lines p * ``page_rows`` on, at most ``page_rows``. Lines
    without a request id belong to no trail; lines that repeat each count. Numbering is done over range
    partitions and a page is a group of its own, so a request of any size is no single array or task.
    """
    if page_rows < 1:
        raise ValueError("a page holds a line at least")
    keys = [f"_o{n}" for n in range(len(order))]
    narrow = lines.where(F.col(f"`{request}`").isNotNull()).select(
        F.col(f"`{request}`").alias("_request"), *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)], entry.alias("_entry")
    )
    numbered = number_rows(stage(narrow, ["_request"], keys), ["_request"]).select("_request", "_rn", "_entry")
    pages = numbered.groupBy("_request", F.floor(F.col("_rn") / page_rows).cast("bigint").alias("page")).agg(
        F.min("_rn").alias("first"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("_rn", "_entry"))).alias("lines")
    )
    return pages.select(F.col("_request").alias(request), "page", "first", "n", F.col("lines._entry").alias("entries"))
