"""Ranks and running sums of groups that may be too large for one task.

A window ``partitionBy(group)`` puts a whole group into one task. Here the rows
are dealt by sampled ranges of (group, order), so a large group lies in several
neighbouring partitions, in order; each partition counts what it holds of a
group, the counts' running sums say what stands before it, and windows only
number the rows of one partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import materialize


def ranged(rows: DataFrame, group: Sequence[str], order: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """``rows`` dealt by ranges of ``group`` and ``order`` into ``num_partitions``
    (default: the session's shuffle partitions), written once to the shared
    folder, with the number of their range as ``_range``: every range's rows
    stand behind those of the ranges before it.

    The bounds are sampled, so they are part of the result and not computed
    again; equal rows share a range.
    """
    n = num_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *group, *order)
    return materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def ranked_in_groups(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    running: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    rank: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3... in each ``group`` by ``order``), for each of ``running`` the sum of its
    column up to and with the row, and for each of ``totals`` the sum over the whole group.

    The same as windows over ``partitionBy(group)``, with no task that holds
    more than a range of a group. ``order`` should be total: rows equal in it
    are numbered in any order.
    """
    running, totals = running or {}, totals or {}
    held = ranged(rows, group, order, num_partitions)
    here = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = held.groupBy("_range", *group).agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.sum(c).alias(f"_run_{k}") for k, c in running.items()),
        *(F.sum(c).alias(f"_all_{k}") for k, c in totals.items()),
    )
    # one row a range and group: a group has as many as ranges that it touches
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = parts.select(
        "_range",
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *(F.coalesce(F.sum(f"_run_{k}").over(before), F.lit(0)).alias(f"_run_{k}") for k in running),
        *(F.sum(f"_all_{k}").over(whole).alias(f"_all_{k}") for k in totals),
    )
    numbered = held.select(
        "*",
        F.row_number().over(here).alias("_at"),
        *(F.sum(c).over(here).alias(f"_here_{k}") for k, c in running.items()),
    )
    same = numbered["_range"] == offsets["_range"]
    for g in group:
        same = same & numbered[g].eqNullSafe(offsets[g])
    joined = numbered.join(offsets, same)
    return joined.select(
        *(numbered[c] for c in rows.columns),
        (F.col("_at") + F.col("_n")).alias(rank),
        *((F.col(f"_here_{k}") + F.col(f"_run_{k}")).alias(k) for k in running),
        *(F.col(f"_all_{k}").alias(k) for k in totals),
    )
