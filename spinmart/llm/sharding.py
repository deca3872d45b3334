"""Put documents into shards of near equal bytes: minimax contiguous partition of ordered atomic groups.

Equal texts form one atomic group. Groups are ordered by a 16-bit hash of their text, and groups with the same
hash stay together, so the ordered sizes are at most 65,536 numbers whatever the table's size. Over these, the
smallest capacity for which a greedy pass needs no more shards than allowed is found by binary
search. The cuts are then placed under that capacity as near to equal shares as the rest allows, so
that one very large group fills a shard of its own and leaves the others even.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinmart.operators.staging import stage

SHARDS = 16
UNITS = 1 << 16
# Rows of a unit that one task numbers; larger units are numbered in several cells.
CELL_ROWS = 1_000


def _struct(**values: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in values.items()])


def smallest_capacity(sizes: Column, shards: int) -> Column:
    """The least capacity for which at most ``shards`` contiguous parts of ``sizes`` stay within it."""
    zero = F.lit(0).cast("long")
    total = F.aggregate(sizes, zero, lambda s, x: s + x)
    largest = F.array_max(sizes)
    least = F.greatest(largest, F.ceil(total / shards).cast("long"))

    def parts(capacity: Column) -> Column:
        return F.aggregate(
            sizes, _struct(held=zero, parts=F.lit(1)),
            lambda s, x: F.when(s["held"] + x > capacity, _struct(held=x, parts=s["parts"] + 1))
            .otherwise(_struct(held=s["held"] + x, parts=s["parts"])),
            lambda s: s["parts"])

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("long")
        return (F.when(s["lo"] >= s["hi"], s)
                .when(parts(middle) <= shards, _struct(lo=s["lo"], hi=middle))
                .otherwise(_struct(lo=middle + 1, hi=s["hi"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), _struct(lo=least, hi=least + largest), halve, lambda s: s["lo"])


def last_cuts(sizes: Column, capacity: int) -> Column:
    """Where a greedy pass from the end cuts; the parts that units from i on need are one more than the cuts after i."""
    n = F.size(sizes)
    return F.aggregate(
        F.reverse(sizes), _struct(held=F.lit(0).cast("long"), i=n, cuts=F.array().cast("array<int>")),
        lambda s, x: F.when(s["held"] + x > capacity, _struct(held=x, i=s["i"] - 1, cuts=F.array_append(s["cuts"], s["i"])))
        .otherwise(_struct(held=s["held"] + x, i=s["i"] - 1, cuts=s["cuts"])),
        lambda s: s["cuts"])


def even_cuts(sizes: Column, capacity: int, total: int, later: list[int], shards: int) -> Column:
    """First unit of each shard after the first."""
    needed = F.lit(1)
    listed = F.array(*[F.lit(c) for c in later]).cast("array<int>")

    def step(s: Column, x: Column) -> Column:
        left = shards - F.size(s["cuts"])  # shards from the open one on
        needed = F.size(F.filter(listed, lambda c: c > s["i"])) + 1
        full = s["held"] + x > capacity
        even = (s["held"] > 0) & ((s["held"] + x / 2) * left > s["rest"]) & (needed <= left - 1)
        return F.when(full | even, _struct(
            held=x, i=s["i"] + 1, rest=s["rest"] - s["held"], cuts=F.array_append(s["cuts"], s["i"]),
        )).otherwise(_struct(held=s["held"] + x, i=s["i"] + 1, rest=s["rest"], cuts=s["cuts"]))

    start = _struct(held=F.lit(0).cast("long"), i=F.lit(0), rest=F.lit(total).cast("long"),
                    cuts=F.array().cast("array<int>"))
    return F.aggregate(sizes, start, step, lambda s: s["cuts"])


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, units: int = UNITS) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot``, ``grown_shard`` (NULL).

    ``size`` is the UTF-8 length of the text plus one; a NULL text counts as empty. Equal texts share a shard.
    ``slot`` numbers the rows of a shard from 0 without gaps. Repeated rows and equal or NULL ids
    get slots of their own. Other columns are not used. An empty table gives an empty table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(units)).cast("int").alias("_unit"),
        F.monotonically_increasing_id().alias("_row"),
    ), "sharding-rows")
    by_unit = stage(rows.groupBy("_unit").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")),
                    "sharding-units")

    # At most ``units`` sizes, in one row.
    ordered = by_unit.agg(F.array_sort(F.collect_list(F.struct("_unit", "_bytes"))).alias("units"))
    ordered = ordered.select(F.col("units._unit").alias("names"), F.col("units._bytes").alias("sizes"))
    names, cuts = [], []
    found = ordered.where(F.size("sizes") > 0).select(
        smallest_capacity(F.col("sizes"), shards), F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).first()
    if found:
        capacity, total = found
        later = ordered.select(last_cuts(F.col("sizes"), capacity)).first()[0]
        placed = even_cuts(F.col("sizes"), capacity, total, later, shards)
        cuts = ordered.select(F.col("names"), placed.alias("cuts")).select(
            F.transform("cuts", lambda c: F.get("names", c))).first()[0]
    shard = F.lit(0)
    for first in cuts:
        shard = shard + F.when(F.col("_unit") >= first, 1).otherwise(0)

    # Slots: rows before the cell, then the place in the cell. At most ``units`` plus one cell per CELL_ROWS rows,
    # and no more than twice ``units``, so the tables joined here have a proven bound.
    n_rows = by_unit.agg(F.sum("_rows")).first()[0] or 0
    cell_rows = max(CELL_ROWS, math.ceil(n_rows / units))
    cells = by_unit.select("_unit", F.ceil(F.col("_rows") / cell_rows).cast("int").alias("_cells"))
    split = rows.join(F.broadcast(cells.where("_cells > 1")), "_unit", "left").withColumn(
        "_cell", F.pmod(F.xxhash64("_row"), F.coalesce("_cells", F.lit(1))).cast("int")).drop("_cells")
    before = Window.partitionBy("shard").orderBy("_unit", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (split.groupBy("_unit", "_cell").agg(F.count(F.lit(1)).alias("_n")).withColumn("shard", shard.cast("int"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    place = F.row_number().over(Window.partitionBy("_unit", "_cell").orderBy("_row"))
    return (
        split.withColumn("_place", place).join(F.broadcast(starts), ["_unit", "_cell"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("_start") + F.col("_place") - 1).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards."""
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
