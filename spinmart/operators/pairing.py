"""Full outer pairing of two streams: by rank within a group, or by a shared code."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.operators.ranking import (
    GROUP_LIMIT,
    heavy_groups,
    rank_by_slices,
    rank_by_window,
    rank_within,
    split_groups,
    total_order,
)
from spinmart.operators.sizing import broadcast_if_small, stage_counted
from spinmart.operators.staging import stage

# Parts into which the pairs of a code beyond the limit are cut, per time the limit is reached.
SALTS = 16
# Rows of a code at the square root of the limit that the size estimate looks at.
ESTIMATE_ROWS = 50

Defaults = Mapping[str, object]


def _mark(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    return left.withColumn("_has_left", F.lit(True)), right.withColumn("_has_right", F.lit(True))


def _fill(joined: DataFrame, left_defaults: Defaults | None, right_defaults: Defaults | None) -> DataFrame:
    filled = {}
    for marker, defaults in (("_has_left", left_defaults), ("_has_right", right_defaults)):
        for name, value in (defaults or {}).items():
            filled[name] = F.when(F.col(marker).isNull(), F.lit(value)).otherwise(F.col(name))
    return joined.withColumns(filled).drop("_has_left", "_has_right")


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str],
              left_defaults: Defaults | None = None, right_defaults: Defaults | None = None) -> DataFrame:
    """Full outer join; key columns are taken from whichever side is there.

    With defaults, columns of a *missing* side show the default in place of NULL. A NULL inside a
    matched row stays NULL, which a plain ``coalesce`` would lose.
    """
    left, right = _mark(left, right)
    return _fill(left.join(right, list(on), "full"), left_defaults, right_defaults)


def _join_ranked(left: DataFrame, right: DataFrame, keys: Sequence[str], rank: str,
                 left_defaults: Defaults | None, right_defaults: Defaults | None) -> DataFrame:
    # The left side's own rank is kept, so right-only rows have none.
    left = left.withColumn(rank, F.col("_nth"))
    return full_join(left, right, [*keys, "_nth"], left_defaults, right_defaults).drop("_nth")


def pair_nth(left: DataFrame, right: DataFrame, keys: Sequence[str],
             left_order: Sequence[str | Column], right_order: Sequence[str | Column],
             rank: str = "rn", left_rank_keys: Sequence[str] | None = None, limit: int = GROUP_LIMIT,
             left_defaults: Defaults | None = None, right_defaults: Defaults | None = None) -> DataFrame:
    """Pair the n-th left row with the n-th right row of each group; rows without a partner stay.

    ``rank`` is the left row's position. Both sides are ranked and joined on the same keys, so a
    session with ``requireAllClusterKeysForCoPartition=false`` shuffles each side once. Groups above
    ``limit`` on either side are ranked by slices and joined on (keys, rank), which spreads them.
    ``left_rank_keys`` ranks the left side by other columns than it is paired on.
    """
    fill = (left_defaults, right_defaults)
    if left_rank_keys is not None:
        # Many left rows of a key can have the same rank, so the pairs are checked, not the ranked groups.
        ranked = stage(rank_within(left, left_rank_keys, left_order, "_nth", limit).withColumn(rank, F.col("_nth")), "ranked")
        others = stage(rank_within(right, keys, right_order, "_nth", limit), "ranked")
        ranked, others = _mark(ranked, others)
        return _fill(_full_join_split(ranked, others, [*keys, "_nth"], limit), *fill).drop("_nth")

    left_terms, right_terms = total_order(left, keys, left_order), total_order(right, keys, right_order)
    heavy = heavy_groups([left, right], keys, limit)
    if heavy is None:
        return _join_ranked(rank_by_window(left, keys, left_terms, "_nth"),
                            rank_by_window(right, keys, right_terms, "_nth"), keys, rank, *fill)
    left_rest, left_large = split_groups(left, heavy, keys)
    right_rest, right_large = split_groups(right, heavy, keys)
    rest = _join_ranked(rank_by_window(left_rest, keys, left_terms, "_nth"),
                        rank_by_window(right_rest, keys, right_terms, "_nth"), keys, rank, *fill)
    large = _join_ranked(rank_by_slices(left_large, keys, left_terms, "_nth", limit),
                         rank_by_slices(right_large, keys, right_terms, "_nth", limit), keys, rank, *fill)
    return rest.unionByName(large)


def pair_by_key(left: DataFrame, right: DataFrame, key: str, limit: int = GROUP_LIMIT,
                left_defaults: Defaults | None = None, right_defaults: Defaults | None = None) -> DataFrame:
    """Full outer join on one code column; repeated codes match many to many.

    Rows without a code match nothing; a second join column spreads them over the tasks. Codes with more than
    ``limit`` pairs or rows skip the full join and are cut into parts (``_full_join_split``).
    """
    left, right = _mark(left, right)
    return _fill(_full_join_split(left, right, [key], limit), left_defaults, right_defaults)


def heavy_pairs(left: DataFrame, right: DataFrame, on: Sequence[str], limit: int) -> DataFrame | None:
    """Keys whose rows or pairs of rows are more than ``limit``, with ``_salts``, the parts to cut them into; or None.

    One side of such a key has at least the square root of ``limit`` rows. Keys near that size are found on a sample and
    counted exactly. The list only chooses how a key is joined.
    """
    found = heavy_groups([left, right], on, max(1, math.isqrt(limit)), ESTIMATE_ROWS)
    if found is None:
        return None
    counts = []
    for side, name in ((left, "_l"), (right, "_r")):
        _, those = split_groups(side.select(*on), found, on)
        counts.append(those.groupBy(*on).agg(F.count(F.lit(1)).alias(name)))
    # The keys hold no NULL here.
    both = counts[0].join(counts[1], list(on), "full").select(
        *on, F.greatest(F.coalesce("_l", F.lit(0)).cast("double") * F.coalesce("_r", F.lit(0)), F.coalesce("_l", F.lit(0)),
                        F.coalesce("_r", F.lit(0))).alias("_pairs"))
    heavy, n = stage_counted(both.where(F.col("_pairs") > limit).select(
        *on, (SALTS * F.ceil(F.col("_pairs") / limit)).cast("int").alias("_salts")), "heavy")
    return heavy if n else None


def _full_join_split(left: DataFrame, right: DataFrame, on: Sequence[str], limit: int) -> DataFrame:
    """Full join; the pairs of a heavy key are cut into parts by salting the left rows and repeating the right ones."""
    present = F.lit(True)
    for name in on:
        present = present & F.col(name).isNotNull()
    heavy = heavy_pairs(left.where(present), right.where(present), on, limit)
    if heavy is None:
        return _full_join_spread(left, right, on)
    keys = heavy.select(*on)
    left_rest, left_large = split_groups(left, keys, on)
    right_rest, right_large = split_groups(right, keys, on)
    out = _full_join_spread(left_rest, right_rest, on)
    salts = broadcast_if_small(heavy, staged=False)
    salted = left_large.join(salts, list(on)).withColumn(
        "_salt", F.pmod(F.xxhash64(*left_large.columns), F.col("_salts")).cast("int")).drop("_salts")
    repeated = right_large.join(salts, list(on)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    out = out.unionByName(salted.join(repeated, [*on, "_salt"], "inner").drop("_salt"))
    for mine, other in ((left_large, right_large), (right_large, left_large)):
        held = broadcast_if_small(other.select(*on).distinct())
        out = out.unionByName(mine.join(held, list(on), "left_anti"), allowMissingColumns=True)
    return out


def _full_join_spread(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full join whose rows with a NULL key, which match nothing, are spread over the tasks."""
    unknown = F.lit(False)
    for name in on:
        unknown = unknown | F.col(name).isNull()

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("_spread", F.when(unknown, F.xxhash64(*df.columns)).otherwise(F.lit(0)))

    return spread(left).join(spread(right), [*on, "_spread"], "full").drop("_spread")
