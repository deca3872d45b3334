"""Broadcasts of measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.operators.staging import stage

# Measured size up to which a table may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def _total_bytes(df: DataFrame) -> Column:
    """Size of the rows in memory, near enough: 16 bytes per value and the length of texts."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0)).alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """Size of a table, taken in one pass that keeps nothing."""
    seen = Observation()
    df.observe(seen, _total_bytes(df)).write.format("noop").mode("overwrite").save()
    return seen.get["bytes"]


def stage_measured(df: DataFrame, label: str = "lookup") -> tuple[DataFrame, int]:
    """The staged table and its size, which is taken while it is written."""
    seen = Observation()
    table = stage(df.observe(seen, _total_bytes(df)), label)
    return table, seen.get["bytes"]


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The staged table and its number of rows, which are counted while they are written."""
    seen = Observation()
    table = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return table, seen.get["rows"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, staged: bool = True) -> DataFrame:
    """Hint a broadcast if the measured size of a list or dimension is within bounds.

    The table is staged once, as lists and dimensions are mostly results; ``staged=False`` only measures a plain
    scan. Beyond the bound there is no hint, and Spark joins by shuffle.
    """
    table, size = stage_measured(df) if staged else (df, measured_bytes(df))
    return F.broadcast(table) if size <= limit else table
