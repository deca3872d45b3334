"""Incremental load: extract changed rows, stage them as parquet, upsert them into the target."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinmart.operators.latest import upsert_latest
from spinmart.operators.sizing import broadcast_if_small
from spinmart.operators.staging import stage
from spinmart.sinks.tables import write_stage
from spinmart.sources.changes import LoadConfig, choose_tables, extract_changes


def incremental_load(spark: SparkSession, source: DataFrame, config: LoadConfig, lo: datetime,
                     hi: datetime, stage_path: str, target_path: str, new_target_path: str) -> DataFrame:
    """Load the rows changed in ``[lo, hi)`` and return the new target.

    The target being read is never overwritten: the merged rows go to ``new_target_path``. Loading
    the same interval again gives the same target.
    """
    write_stage(extract_changes(source, config, lo, hi), stage_path)
    target = spark.read.parquet(target_path)
    staged = spark.read.schema(target.schema).parquet(stage_path)
    merged = upsert_latest(target, staged, config.upsert_key, config.timestamp_columns)
    merged.write.parquet(new_target_path)
    return spark.read.schema(target.schema).parquet(new_target_path)


def incremental_load_partitioned(spark: SparkSession, source: DataFrame, config: LoadConfig,
                                 lo: datetime, hi: datetime, stage_path: str, target_path: str,
                                 partition: str) -> DataFrame:
    """As ``incremental_load`` for a target laid out by ``partition``; rewrites only what changed.

    For a partition value that never changes for a key, such as its creation day; a staged key that the target
    holds under another value is refused. Only the touched partitions are read, merged, staged in full,
    and then replaced from the staged copy, which stays until the replacement is done: after a stop half way, loading the
    same interval again gives the same target.
    """
    write_stage(extract_changes(source, config, lo, hi), stage_path)
    target = spark.read.parquet(target_path)
    staged = spark.read.parquet(stage_path).select(*target.columns)
    key = config.upsert_key
    places = broadcast_if_small(staged.select(F.col(key).alias("_key"), F.col(partition).alias("_place")).distinct())
    moved = target.select(key, partition).join(
        places, F.col(key).eqNullSafe(F.col("_key")) & ~F.col(partition).eqNullSafe(F.col("_place")), "left_semi")
    if not moved.isEmpty():
        raise ValueError(f"{partition} changed for rows of the target, such as {moved.first()[0]!r}")
    current = touched_rows(target, staged, partition)
    merged = stage(upsert_latest(current, staged, config.upsert_key, config.timestamp_columns), "merged")
    # Rebalancing gathers each partition's rows into few files, and splits a large partition.
    (
        merged.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target_path)
    )
    return spark.read.schema(target.schema).parquet(target_path)


def touched_rows(target: DataFrame, staged: DataFrame, partition: str) -> DataFrame:
    """Rows of the target's partitions that ``staged`` has values of; other partitions are not read.

    The values are a broadcast list of measured size. Its bounds are stated as a filter, which makes Spark
    prune the partitions by the list at run time.
    """
    values = staged.select(F.col(partition).alias("_value")).distinct()
    lo, hi, n, n_known = values.agg(F.min("_value"), F.max("_value"), F.count(F.lit(1)), F.count("_value")).first()
    listed = broadcast_if_small(values.where(F.col("_value").isNotNull()))
    listed = listed.where(F.col("_value").between(F.lit(lo), F.lit(hi)))
    rows = target.join(listed, F.col(partition) == F.col("_value"), "left_semi")
    return rows.unionByName(target.where(F.col(partition).isNull())) if n > n_known else rows


def load_all(spark: SparkSession, read: Callable[[str], DataFrame], source_type: str, database: str,
             available: Iterable[str], chosen: Iterable[str], mode: str, lo: datetime, hi: datetime,
             stage_root: str, target_root: str, version: str, new_version: str) -> dict[str, DataFrame]:
    """One load per chosen table; targets live in ``<target_root>/<table>/<version>``."""
    loaded = {}
    for table in choose_tables(available, chosen, mode):
        config = LoadConfig.for_source(source_type, database, table)
        loaded[table] = incremental_load(
            spark, read(table), config, lo, hi, f"{stage_root}/{table}",
            f"{target_root}/{table}/{version}", f"{target_root}/{table}/{new_version}")
    return loaded
