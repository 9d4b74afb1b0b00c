"""Exact sequential folds, run block by block in parallel.

Some rules are inherently sequential: where the next batch starts depends on
where the previous one did. But what a block of rows does to the state coming
in is a *function of that state*, and functions compose. So:

1. each block that has a successor is summarised into its state function;
2. the functions are composed in groups of ``FAN``, level by level, until a
   domain's functions fit one group, then evaluated back down to each block;
3. each block is replayed once with its now known entry state.

Where every domain fits one block, only step 3 is left. Steps 1 and 3 carry all rows and are parallel over blocks of fixed size; step
2 handles one small record per block, and no task more than ``FAN`` of a domain.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spillway.operators.ordering import domain_starts, same
from spillway.session import materialise

FAN = 64


class Rule(Protocol):
    """A sequential rule over the rows of one domain."""

    start: int

    def summarise(self, rows: pa.Table, end: int) -> Any:
        """State function of the rows numbered below ``end``."""

    def evaluate(self, fn: Any, state: int) -> int:
        """State after ``fn``."""

    def compose(self, first: Any, then: Any) -> Any:
        """``then`` applied after ``first``."""

    def replay(self, rows: pa.Table, end: int, state: int) -> pa.Table:
        """Output rows of one block, given its entry state."""


@dataclass(frozen=True)
class Blocks:
    """Block geometry: ``rows`` per block, of which a block also sees ``ahead`` of the next."""

    rows: int = 65_536
    ahead: int = 0


def block_fold(
    numbered: DataFrame,
    domain: Sequence[str],
    rule: Rule,
    blocks: Blocks,
    needs: Sequence[str],
    added: Sequence[T.StructField],
) -> DataFrame:
    """Replay ``rule`` over every domain of ``numbered`` (which has ``_rn``; see ``number_once``).

    ``needs`` are the columns the rule reads; all columns of ``numbered`` pass
    through untouched as Arrow buffers, and ``added`` are appended.
    """
    domain = list(domain)
    if blocks.ahead > blocks.rows:
        raise ValueError("a block may look ahead at most one block")
    own = F.floor(F.col("_rn") / blocks.rows).cast("bigint")
    def placed_in(rows_: DataFrame) -> DataFrame:
        if not blocks.ahead:
            return rows_.withColumn("_blk", own)
        # The first rows of a block are shown to the block before it as well.
        early = (F.col("_rn") % blocks.rows < blocks.ahead) & (own > 0)
        return rows_.withColumn("_blk", F.explode(F.when(early, F.array(own, own - 1)).otherwise(F.array(own))))

    out_schema = T.StructType([*numbered.schema.fields, *added])
    keys = [*domain, "_blk"]
    rows = blocks.rows

    # Blocks with a successor, one small row each; there are none where every domain fits one block.
    followed = numbered.filter((F.col("_rn") % rows == 0) & (F.col("_rn") > 0)).select(*domain, (own - 1).alias("_blk"))
    most = followed.agg(F.max("_blk")).first()[0]
    placed = placed_in(numbered)
    work = placed.withColumn("_entry", F.lit(None).cast("bigint"))
    if most is not None:
        entries = _entry_states(placed, materialise(followed, "followed"), most, domain, rule, rows, needs)
        # A block's entry state comes as a row before its own, so one shuffle brings both.
        known = entries.select(*keys, F.lit(-1).cast("bigint").alias("_rn"), "_entry")
        work = work.unionByName(known, allowMissingColumns=True)
    work = work.repartition(*keys).sortWithinPartitions(*keys, "_rn")

    def replay(block: pa.Table) -> pa.Table:
        end = (block["_blk"][0].as_py() + 1) * rows
        state = rule.start
        if block["_rn"][0].as_py() < 0:
            state, block = block["_entry"][0].as_py(), block.slice(1)
        return rule.replay(block, end, state).select(out_schema.names)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks_ in _runs(batches, keys):
            yield from pa.concat_tables([replay(b) for b in blocks_]).combine_chunks().to_batches()

    return work.mapInArrow(over, out_schema)


def fold_whole(
    df: DataFrame, domain: Sequence[str], order: Sequence[str], rule: Rule, added: Sequence[T.StructField]
) -> DataFrame:
    """Replay ``rule`` over domains that a contract bounds: one shuffle, each domain whole in one task.

    Rows get their position ``_rn`` in ``order``, and ``added``, which the rule appends.
    """
    domain = list(domain)
    out_schema = T.StructType([*df.schema.fields, T.StructField("_rn", T.LongType()), *added])
    work = df.repartition(*domain).sortWithinPartitions(*domain, *order)

    def replay(rows: pa.Table) -> pa.Table:
        counted = rows.append_column("_rn", pa.array(np.arange(rows.num_rows), pa.int64()))
        return rule.replay(counted, rows.num_rows, rule.start).select(out_schema.names)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for domains in _runs(batches, domain):
            yield from pa.concat_tables([replay(d) for d in domains]).combine_chunks().to_batches()

    return work.mapInArrow(over, out_schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[list[pa.Table]]:
    """The blocks of rows sorted by ``keys``, as many at a time as a batch completes."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        cuts = [0, *np.nonzero(domain_starts(held, keys))[0].tolist()]
        if len(cuts) > 1:
            yield [held.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
        held = held.slice(cuts[-1])
    if held is not None:
        yield [held]


def _entry_states(placed, followed, most, domain, rule, rows, needs) -> DataFrame:
    """Entry state of every block but the first of its domain."""
    keys = [*domain, "_blk"]
    key_fields = [placed.schema[c] for c in domain]
    need = placed.select(*dict.fromkeys([*keys, "_rn", *needs]))
    summarised = need.join(followed, same(need, followed, keys), "left_semi")

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rn")
        end = (table["_blk"][0].as_py() + 1) * rows
        fn = pickle.dumps(rule.summarise(table, end))
        return table.slice(0, 1).select(keys).append_column("_fn", pa.array([fn], pa.binary()))

    fn_schema = T.StructType([*key_fields, T.StructField("_blk", T.LongType()), T.StructField("_fn", T.BinaryType())])
    levels = [materialise(summarised.groupBy(*keys).applyInArrow(summarise, fn_schema), "fns")]
    group = F.floor(F.col("_blk") / FAN).cast("bigint")

    def composed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        fn = None
        for blob in pdf["_fn"]:
            step = pickle.loads(blob)
            fn = step if fn is None else rule.compose(fn, step)
        out = pdf.head(1)[keys].copy()
        out["_blk"] = out["_blk"] // FAN
        out["_fn"] = [pickle.dumps(fn)]
        return out

    while most >= FAN:
        most //= FAN
        up = levels[-1].groupBy(*domain, group.alias("_grp")).applyInPandas(composed, fn_schema)
        levels.append(materialise(up, "fns"))

    def walk(leaf: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
        """States before each function, or after each block: what the next one starts from."""

        def states(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_blk")
            state = int(pdf["_state"].iloc[0])
            seen = []
            for blob in pdf["_fn"]:
                before, state = state, int(rule.evaluate(pickle.loads(blob), state))
                seen.append(state if leaf else before)
            out = pdf[keys].copy()
            out["_blk"] += int(leaf)
            out["_entry" if leaf else "_state"] = seen
            return out

        return states

    above = None
    for depth in reversed(range(len(levels))):
        fns = levels[depth].withColumn("_grp", group)
        if above is None:
            entering = fns.withColumn("_state", F.lit(rule.start).cast("bigint"))
        else:
            outer = above.withColumnRenamed("_blk", "_grp")
            entering = fns.join(outer, same(fns, outer, [*domain, "_grp"]), "inner").select(
                *[fns[c] for c in fns.columns], outer["_state"]
            )
        above = entering.groupBy(*domain, "_grp").applyInPandas(
            walk(depth == 0),
            T.StructType([*fn_schema.fields[:-1], T.StructField("_state" if depth else "_entry", T.LongType())]),
        )
    return above
