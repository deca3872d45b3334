"""``row_number`` per group that stays balanced when one group holds a large part of all rows.

A window sorts a whole group in one task. Groups of a key up to ``GROUP_LIMIT`` rows go that way. Larger ones
are sliced by range over (keys, order), ranked inside each slice, and shifted by the row counts of
the earlier slices of the same group. Both ways give the same ranks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinmart.operators.sizing import broadcast_if_small, stage_counted
from spinmart.operators.staging import stage

# Rows of one group that a single task may sort.
GROUP_LIMIT = 4_000_000
# Rows of a group at the limit that the size estimate looks at.
ESTIMATE_ROWS = 1_000


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[str | Column]) -> list[Column]:
    """Sort terms with NULL last, ties broken by every other column, so ranks are repeatable."""
    terms = [F.col(term).asc_nulls_last() if isinstance(term, str) else term for term in first]
    named = {*keys, *(term for term in first if isinstance(term, str))}
    return terms + [F.col(name).asc_nulls_last() for name in df.columns if name not in named]


def heavy_groups(frames: Sequence[DataFrame], keys: Sequence[str], limit: int = GROUP_LIMIT,
                 estimate: int = ESTIMATE_ROWS) -> DataFrame | None:
    """The groups with more than ``limit`` rows in any of the frames as a staged table, or None.

    Sizes are estimated on a sample that holds about ``estimate`` rows of a group at the limit;
    groups from half the limit on are listed to be sure. The list only chooses how a group is
    processed: both ways are exact and take every row. It is never collected, however long it is.
    """
    fraction = min(1.0, estimate / limit)
    least = limit if fraction == 1.0 else limit * fraction / 2
    samples = [
        df.select(F.lit(side).alias("_side"), *keys).sample(fraction, seed=0) for side, df in enumerate(frames)]
    sampled = reduce(DataFrame.unionByName, samples)
    rows = [F.count_if(F.col("_side") == side) for side in range(len(frames))]
    most = F.greatest(*rows) if len(rows) > 1 else rows[0]
    found, n = stage_counted(
        sampled.groupBy(*keys).agg(most.alias("_rows")).where(F.col("_rows") > least).select(*keys), "heavy")
    return found if n else None


def split_groups(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows outside the heavy groups, rows inside). NULL keys count as a group of their own."""
    listed = broadcast_if_small(heavy.select(*[F.col(k).alias(f"_h_{k}") for k in keys]), staged=False)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def rank_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def rank_by_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
                   limit: int = GROUP_LIMIT) -> DataFrame:
    """Rank groups of any size in slices of at most about ``limit`` rows.

    The slices are staged, because their bounds come from a sample and must be the same for the
    counts and for the rows.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(tasks, math.ceil(df.count() / limit))
    sliced = stage(
        df.repartitionByRange(pieces, *keys, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    # Slices follow each other in key order: at most (groups + pieces) rows.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_slice").alias("_s_slice"), "_before")
    )
    same = reduce(
        Column.__and__,
        [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys],
        F.col("_slice") == F.col("_s_slice"),
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(broadcast_if_small(shift), same)
        .select(*df.columns, (F.col("_inside") + F.col("_before")).cast("long").alias(name))
    )


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn",
                limit: int = GROUP_LIMIT) -> DataFrame:
    """Add ``name``: the 1-based position of each row in its group.

    No keys means one group, which is always ranked by slices.
    """
    terms = total_order(df, keys, order)
    if not keys:
        return rank_by_slices(df, keys, terms, name, limit)
    heavy = heavy_groups([df], keys, limit)
    if heavy is None:
        return rank_by_window(df, keys, terms, name)
    rest, large = split_groups(df, heavy, keys)
    return rank_by_window(rest, keys, terms, name).unionByName(rank_by_slices(large, keys, terms, name, limit))
