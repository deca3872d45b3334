"""Joins to lists and dimensions that must not multiply, lose or bunch rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.functions.timerules import CampaignWindow, check_disjoint
from spinmart.operators.membership import can_filter, listed_filter
from spinmart.operators.ranking import GROUP_LIMIT, heavy_groups
from spinmart.operators.sizing import BROADCAST_BYTES, broadcast_if_small, measured_bytes, stage_measured
from spinmart.operators.staging import stage

# Windows under one set of key names that a row may be tested with one by one.
WINDOWS_TESTED = 1000


def exclude_ids(df: DataFrame, excluded: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Drop the rows whose ``column`` is listed. A NULL in the list excludes nothing.

    A list of up to ``limit`` bytes is broadcast. Of a longer one a filter of bits is (``membership.py``, at most 32 MB):
    rows that it tells not to be listed pass without a shuffle, and only the others meet the list. ``df`` is then read
    twice, so it should be a scan or staged. Lists too long for such a filter, and ids of other types than those of the
    list, are joined by shuffle.
    """
    (listed,) = excluded.columns
    ids = excluded.where(F.col(listed).isNotNull()).select(F.col(listed).alias("_listed"))
    ids, size = stage_measured(ids)
    same = F.col(column) == F.col("_listed")
    if size <= limit:
        return df.join(F.broadcast(ids), same, "left_anti")
    rows = ids.count()
    if not can_filter(ids, rows, df.select(column).schema[0].dataType):
        return df.join(ids, same, "left_anti")
    possible = F.coalesce(listed_filter(ids, rows)(F.col(column)), F.lit(False))
    return df.where(~possible).union(df.where(possible).join(ids, same, "left_anti"))


def left_join_present(left: DataFrame, right: DataFrame, key: str, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Left join on a key that matches nothing where it is NULL or an empty text.

    Left rows without a key would all meet in one task. They get a negative filler as second join
    column, while real keys carry their length, so a filler matches nothing.

    A key above ``limit`` rows on the right cannot be split in an outer join. Then the rows go
    through an inner join, which can, and those whose key the right side lacks are added. ``limit=None`` says
    that the right side has no such key and spares the look for one.
    """
    text = F.col(key).cast("string")
    present = F.coalesce(text, F.lit("")) != ""
    right = right.where(present)
    if limit is None or heavy_groups([right], [key], limit) is None:
        filler = -1 - F.pmod(F.xxhash64(*left.columns), F.lit(1 << 30)).cast("int")
        spread = left.withColumn("_spread", F.when(present, F.length(text)).otherwise(filler))
        return spread.join(right.withColumn("_spread", F.length(text)), [key, "_spread"], "left").drop("_spread")
    keyed = left.where(present)
    alone = keyed.join(right.select(key).distinct(), key, "left_anti").unionByName(left.where(~present))
    return keyed.join(right, key).unionByName(alone, allowMissingColumns=True)


def windows_table(spark, windows: Sequence[CampaignWindow], keys: T.StructType) -> DataFrame:
    """Campaign windows as a table; refuses overlaps under the same keys, which would repeat joined rows.

    A key that a window does not name is NULL and stands for any value.
    """
    check_disjoint(windows)
    schema = T.StructType([
        *[T.StructField(f"_w_{k.name}", k.dataType) for k in keys],
        T.StructField("_lo", T.TimestampNTZType()),
        T.StructField("_hi", T.TimestampNTZType()),
        T.StructField("_flag", T.IntegerType()),
        T.StructField("_place", T.IntegerType()),
    ])
    moment = datetime.fromisoformat
    rows = [
        (*[w.keys.get(k.name) for k in keys], moment(w.lo) if w.lo else None, moment(w.hi) if w.hi else None, w.flag, i)
        for i, w in enumerate(windows)
    ]
    return spark.createDataFrame(rows, schema)


def flag_by_window_table(df: DataFrame, windows: DataFrame, keys: Sequence[str], time: str,
                         default: int, name: str, limit: int = BROADCAST_BYTES, most: int = WINDOWS_TESTED) -> DataFrame:
    """Add the flag of the first window that holds ``time`` (``lo < t <= hi``), else ``default``.

    Windows that name the same keys are joined on these keys, with the time range as a residual
    condition, so that every join is a hash join; windows without keys meet on a constant. This is for tables of up to
    ``limit`` bytes, which are broadcast, with at most ``most`` windows under the same key names that do not overlap
    under one key. Others go through bins of time (``flag_by_bins``), where no row meets all windows.
    """
    size = measured_bytes(windows)
    named = [F.col(f"_w_{k}").isNotNull().alias(f"_{i}") for i, k in enumerate(keys)]
    patterns = windows.groupBy(*named).count().where("count > 0").collect()
    if size > limit or any(p["count"] > most for p in patterns):
        return flag_by_bins(df, windows, keys, time, default, name)
    out, found = df, []
    for i, given in enumerate(sorted(tuple(p)[:-1] for p in patterns)):
        columns = {c: f"_{i}{c}" for c in windows.columns}
        those = windows.where(_names_keys(keys, given)).withColumnsRenamed(columns)
        held = (F.col(f"_{i}_lo").isNull() | (F.col(time) > F.col(f"_{i}_lo"))) & (
            F.col(f"_{i}_hi").isNull() | (F.col(time) <= F.col(f"_{i}_hi")))
        for key in (k for k, has in zip(keys, given) if has):
            held = held & (F.col(key) == F.col(f"_{i}_w_{key}"))
        if not any(given):
            # Both sides are always 0, but not constants, which Spark would drop from the condition.
            those = those.withColumn(f"_{i}met", F.explode(F.array(F.lit(0))))
            held = held & (F.pmod(F.xxhash64(time), F.lit(1)).cast("int") == F.col(f"_{i}met"))
        out = out.join(F.broadcast(those), held, "left")
        found.append(F.when(F.col(f"_{i}_place").isNotNull(), F.struct(
            F.col(f"_{i}_place").alias("place"), F.col(f"_{i}_flag").alias("flag"))))
    first = F.array_min(F.array_compact(F.array(*found)))["flag"] if found else F.lit(None).cast("int")
    return out.withColumn(name, F.coalesce(first, F.lit(default))).select(*df.columns, name)


def _names_keys(keys: Sequence[str], given: Sequence[bool]) -> Column:
    """Windows that name exactly these keys."""
    return F.expr(" AND ".join(["true", *(f"`_w_{k}` IS {'NOT ' if has else ''}NULL" for k, has in zip(keys, given))]))


def _seconds(time: Column, kind: T.DataType) -> Column:
    """Whole seconds, in the order of the times: of the wall clock for those without a zone."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_seconds(time.cast("timestamp"))
    day = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def _bin(seconds: Column, level: Column) -> Column:
    return F.call_function("shiftright", seconds, level)


def bin_windows(windows: DataFrame, kind: T.DataType) -> DataFrame:
    """Windows with ``_level`` and ``_bin``, listed once for each bin of time they touch, which are two at most.

    Bins of level n are 2**n seconds wide, and a window has the level of the first that are wider than it. A window
    without a beginning or an end is in bin 0 of level 0; one that holds nothing is in none. Of windows of four seconds
    or more that do not overlap, six at most touch one bin.
    """
    lo, hi = _seconds(F.col("_lo"), kind), _seconds(F.col("_hi"), kind)
    level = F.length(F.bin(hi - lo + 1)).cast("int")
    ended = F.col("_lo").isNotNull() & F.col("_hi").isNotNull()
    touched = F.sequence(_bin(lo, F.col("_level")), _bin(hi, F.col("_level")))
    return (windows.where(~ended | (F.col("_lo") < F.col("_hi")))
            .withColumn("_level", F.when(ended, level).otherwise(0))
            .withColumn("_bin", F.explode(F.when(ended, touched).otherwise(F.array(F.lit(0).cast("long"))))))


def flag_by_bins(df: DataFrame, windows: DataFrame, keys: Sequence[str], time: str, default: int, name: str) -> DataFrame:
    """``flag_by_window_table`` for any number of windows, which may overlap: the first that holds decides.

    Each distinct (keys, time) asks one bin of every level that has windows (``bin_windows``); equality on bin and
    keys, the exact test after. So a row meets the windows near its time, not all; windows without an end, which share
    a bin, should be few. The answers are joined back by keys and time.
    """
    kind = df.select(time).schema[0].dataType
    binned = stage(bin_windows(windows, kind), "bins")
    levels = [r[0] for r in binned.select("_level").distinct().collect()] or [0]  # 64 at most
    mine = {k: f"_k{i}" for i, k in enumerate(keys)}
    level = F.col("_level")
    asked = (df.select(*[F.col(k).alias(c) for k, c in mine.items()], F.col(time).alias("_t")).distinct()
             .withColumn("_level", F.explode(F.array(*[F.lit(n).cast("int") for n in sorted(levels)])))
             .withColumn("_bin", F.when(level == 0, F.lit(0).cast("long")).otherwise(_bin(_seconds(F.col("_t"), kind), level)))
             .withColumnsRenamed({"_level": "_asked_level", "_bin": "_asked_bin"}))
    patterns = binned.select(*[F.col(f"_w_{k}").isNotNull().alias(c) for k, c in mine.items()], F.lit(True)).distinct().collect()
    parts = []
    for given in sorted(tuple(p)[:-1] for p in patterns):
        held = (F.col("_asked_level") == level) & (F.col("_asked_bin") == F.col("_bin")) & (
            F.col("_lo").isNull() | (F.col("_t") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_t") <= F.col("_hi")))
        for key in (k for k, has in zip(keys, given) if has):
            held = held & (F.col(mine[key]) == F.col(f"_w_{key}"))
        parts.append(asked.join(binned.where(_names_keys(keys, given)), held).select(
            *mine.values(), "_t", F.struct("_place", "_flag").alias("_found")))
    if not parts:
        return df.withColumn(name, F.lit(default))
    best = reduce(DataFrame.union, parts).groupBy(*mine.values(), "_t").agg(F.min("_found")["_flag"].alias("_first"))
    same = F.col(time).eqNullSafe(F.col("_t"))
    for key, column in mine.items():
        same = same & F.col(key).eqNullSafe(F.col(column))
    return df.join(best, same, "left").withColumn(name, F.coalesce("_first", F.lit(default))).select(*df.columns, name)


def left_join_derived(df: DataFrame, key: Column, dim: DataFrame, dim_key: str) -> DataFrame:
    """Left join to a dimension on a key computed from a row; a NULL key matches nothing."""
    return (
        df.withColumn("_derived", key)
        .join(dim.withColumnRenamed(dim_key, "_dim_key"), F.col("_derived") == F.col("_dim_key"), "left")
        .drop("_derived", "_dim_key")
    )
