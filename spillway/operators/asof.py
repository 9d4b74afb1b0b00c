"""As-of matches that look ahead, over domains of any size.

Rows of both sides are staged together, latest first, and the last match seen is
carried along; so "the next deploy after this occurrence" is a running value over
range partitions. No domain is windowed as a whole and no pairs are made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spillway.operators.ordering import Scan, scan, stage


def _micros(at: str) -> Column:
    return F.unix_micros(F.col(f"`{at}`"))


def next_match(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, right_at: str, tie: str, name: str = "next", strict: bool = True) -> DataFrame:
    """``left`` with ``name``: a struct of the earliest row of ``right`` that comes after it, else null.

    Rows match when they agree on ``on`` (null agrees with nothing) and ``right_at`` lies after ``at``, or at the
    same instant where ``strict`` is off. Of right rows at one instant that with the smallest ``tie`` is taken.
    A row of either side without a time matches nothing. Repeated rows of ``left`` each stay.
    """
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in on])
    right = right.where(known & F.col(f"`{right_at}`").isNotNull())
    # Latest first, so that what has been seen lies ahead; at one instant the side that must not see the other comes first.
    sides = (0, 1) if strict else (1, 0)
    found = F.struct(*[F.col(f"`{c}`") for c in right.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    keys = [F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(on)]
    rows = left.select(*keys, (-_micros(at)).alias("_at"), F.lit(sides[0]).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), row.alias("_row"))
    marks = right.select(*keys, (-_micros(right_at)).alias("_at"), F.lit(sides[1]).alias("_side"), F.col(f"`{tie}`").alias("_tie"), found.alias("_found"))
    domain = [f"_k{n}" for n in range(len(on))]
    staged = stage(rows.unionByName(marks, allowMissingColumns=True), domain, ["_at", "_side", "_tie"])
    # Ties ascend, and the last one seen counts: of one instant only the first may be seen.
    first = Scan("last", F.when(F.col("_found").isNotNull(), F.struct("_at", "_tie")), before=True)
    marked = scan(staged, domain, {"_before": first})
    again = F.col("_found").isNotNull() & (F.col("_before._at") == F.col("_at"))
    firsts = marked.select(*staged.columns, F.when(~F.coalesce(again, F.lit(False)), F.col("_found")).alias("_new"))
    seen = scan(firsts, domain, {"_next": Scan("last", F.col("_new"))})
    taken = F.when(F.col("_row").isNotNull() & F.col("_at").isNotNull() & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in domain]), F.col("_next"))
    return seen.where(F.col("_row").isNotNull()).select(*[F.col(f"_row.`{c}`").alias(c) for c in left.columns], taken.alias(name))


def with_next(rows: DataFrame, domain: Sequence[str], at: str, name: str = "next_at", order: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``name``: the time of the next row of their domain (null: none), also across partition edges.

    Rows go by ``at``, then ``order``; rows without a time are left out. Of rows at one instant
    all but the last have that instant as their next.
    """
    keys = [F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(domain)]
    # Nothing but the direction of time matters for ties, so ``order`` may ascend.
    narrow = rows.where(F.col(f"`{at}`").isNotNull()).select(
        *keys, (-_micros(at)).alias("_at"), *[F.col(f"`{c}`").alias(f"_o{n}") for n, c in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    )
    by = [f"_k{n}" for n in range(len(domain))]
    staged = stage(narrow, by, ["_at", *[f"_o{n}" for n in range(len(order))]])
    seen = scan(staged, by, {"_next": Scan("last", F.col("_at"), before=True)})
    return seen.select(*[F.col(f"_row.`{c}`").alias(c) for c in rows.columns], F.timestamp_micros(-F.col("_next")).alias(name))
