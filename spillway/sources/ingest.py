"""Documents sent to, or describing what was sent to, the ingest endpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def request_bodies(packed: DataFrame, domain: Sequence[str], entry: str = "entry") -> DataFrame:
    """``{"logs":[…]}`` of every batch; a batch holds at most 100 entries."""
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rn"), F.col(entry).alias("e")))), lambda x: x["e"]
    )
    return packed.groupBy(*domain, "batch_start").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.concat(F.lit('{"logs":['), F.array_join(ordered, ","), F.lit("]}")).alias("body"),
    )


def parse_metadata(pairs: Column) -> Column:
    """``key=value`` pairs as a map: split at the first ``=``, a later key wins, junk is ignored."""
    usable = F.filter(pairs, lambda p: F.instr(p, "=") > 1)
    entries = F.transform(
        usable, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.substr(p, F.instr(p, "=") + 1).alias("v"))
    )
    # Keep the last pair of each key.
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda o: o["k"] == e["k"]),
    )
    return F.when(F.size(last) > 0, F.map_from_entries(last))


def deploy_markers(deploys: DataFrame) -> DataFrame:
    """Marker document of each deploy; absent fields are left out.

    Reads ``version, commit_sha, success`` and ``pairs`` (array of ``key=value``).
    """
    return deploys.select(
        "*",
        F.to_json(
            F.struct(
                "version",
                F.col("commit_sha").alias("commitSha"),
                "success",
                parse_metadata(F.col("pairs")).alias("metadata"),
            )
        ).alias("marker"),
    )
