"""Latest row per key, and the upsert built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinmart.operators.sizing import BROADCAST_BYTES, measured_bytes
from spinmart.operators.staging import stage


def latest_per_key(df: DataFrame, key: str, stamp: Sequence[str]) -> DataFrame:
    """One row per key: the highest stamp, NULL lowest, ties settled by the other columns.

    Spark limits the window to the first row before the shuffle too, so a key with very many
    versions sends one row per map task.
    """
    rest = [name for name in df.columns if name not in stamp and name != key]
    order = [F.col(c).desc_nulls_last() for c in [*stamp, *rest]]
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_n", first).where("_n = 1").drop("_n")


def upsert_latest(target: DataFrame, staged: DataFrame, key: str, stamp: Sequence[str],
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """``target`` with the staged rows put in by key: the last stamp wins, a tie goes to staged.

    ``target`` holds one row per key, as every earlier upsert left it; rows without a key are one key. The keys and stamps of
    an increment are broadcast up to ``limit`` bytes, so the large target is scanned but not shuffled.
    """
    newest = stage(latest_per_key(staged, key, stamp), "newest")
    versions = newest.select(F.col(key).alias("_key"), F.struct(*stamp).alias("_version"))
    if measured_bytes(versions) <= limit:
        versions = F.broadcast(versions)
    same, mine = F.col(key).eqNullSafe(F.col("_key")), F.struct(*stamp)
    kept = target.join(versions, same & (F.col("_version") >= mine), "left_anti")
    stale = (
        target.select(key, *[c for c in stamp if c != key])
        .join(versions, same & (F.col("_version") < mine), "left_semi")
        .select(F.col(key).alias("_stale"))
    )
    return kept.unionByName(newest.join(stale, F.col(key).eqNullSafe(F.col("_stale")), "left_anti"))
