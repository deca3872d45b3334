"""A mart of two streams paired by rank, kept up to date by increments.

A new row's rank is the number of rows its group had before plus its place in the increment, so the ranks of history stay and
history is not read. Stored are, by bucket of the group: ``paired`` rows, which have both sides and are only added to;
``open`` rows, which wait for the other side; and ``state``, one row per group with its counts and the last row of each side.
A load reads the open rows and the state of the buckets that new rows fall into. A row that belongs before the last one of its
group is late: its whole group is read and ranked again, and only then are paired rows read and rewritten, those of its bucket.
All of it is one target with versions, so a reader sees an increment whole or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.operators.ranking import GROUP_LIMIT, rank_within
from spinmart.operators.sizing import BROADCAST_BYTES, stage_measured
from spinmart.operators.staging import stage, staged_for
from spinmart.sinks.versions import VersionedTable, gaps, no_rows

# Buckets of groups. A load rewrites the open rows and the state of the buckets it touches.
BUCKETS = 64
# Folders of a bucket's paired rows from which on ``compact`` makes them one.
MANY_FOLDERS = 16
SIDES = ("left", "right")


class PairedMart:
    """The n-th left row beside the n-th right row of each group, as ``pair_nth`` gives it over all rows loaded so far.

    Rows with a NULL in their key are ranked as a group of their own and pair with nothing; equal rows are rows of their own.
    The rank follows the order columns, then all others, NULL last. Keys have one type on both sides, and other columns have
    different names.
    """

    def __init__(self, spark: SparkSession, root: str, left: T.StructType, right: T.StructType, keys: Sequence[str],
                 left_order: Sequence[str], right_order: Sequence[str], buckets: int = BUCKETS,
                 limit: int = GROUP_LIMIT) -> None:
        self.spark, self.keys, self.buckets, self.limit = spark, list(keys), buckets, limit
        self.order = {"left": list(left_order), "right": list(right_order)}
        self.columns = {side: [f.name for f in schema if f.name not in self.keys]
                        for side, schema in (("left", left), ("right", right))}
        self.table = VersionedTable(spark, root, "_kind")
        self._empty = self._layout(no_rows(spark, left), no_rows(spark, right))

    # ------------------------------------------------------------ expressions

    def _layout(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of both sides in one frame: the keys, and the other columns as ``left`` or ``right``."""
        def side(df, name):
            return df.select(*self.keys, F.struct(*self.columns[name]).alias(name))
        return side(left, "left").unionByName(side(right, "right"), allowMissingColumns=True)

    def _place(self, side: str) -> Column:
        """What a row is ordered by, NULL last; NULL for rows of the other side."""
        order = self.order[side] + [c for c in self.columns[side] if c not in self.order[side]]
        fields = [F.col(side)[c] for c in order]
        terms = [t.alias(f"{kind}{i}") for i, c in enumerate(fields) for kind, t in (("n", c.isNull()), ("v", c))]
        return F.when(F.col(side).isNotNull(), F.struct(*terms))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))

    def _kind(self, kind: str | Column) -> Column:
        return F.concat(F.lit(kind) if isinstance(kind, str) else kind, F.lit("-"), self._bucket().cast("string"))

    def _unpairable(self) -> Column:
        return reduce(Column.__or__, [F.col(k).isNull() for k in self.keys])

    def _with(self, rows: DataFrame, groups: DataFrame, how: str, small: bool) -> DataFrame:
        """``rows`` joined with ``groups`` on the keys, NULL equal to NULL; ``small`` groups may be broadcast."""
        renamed = groups.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)],
                                *[c for c in groups.columns if c not in self.keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
        return rows.join(F.broadcast(renamed) if small else renamed, same, how).drop(*[f"_k{i}" for i in range(len(self.keys))])

    def _parts(self, groups: DataFrame, kinds: Sequence[str]) -> DataFrame:
        """The partitions of the kinds that hold the groups, as the manifest names them."""
        kind = F.explode(F.array(*[F.lit(k) for k in kinds]))
        return groups.select(*self.keys, kind.alias("_k")).select(
            F.hex(self._kind(F.col("_k"))).alias("part")).distinct()

    def _rows(self, version: int, kind: str, groups: DataFrame) -> DataFrame:
        """All rows of a kind in the buckets of the groups."""
        return self.table.read(version, self._parts(groups, [kind]))

    # ------------------------------------------------------------ reading

    def read(self, version: int | None = None) -> DataFrame:
        """The mart: keys, the left row's columns and ``rn``, its rank, and the right row's columns."""
        stored = self.table.places(version).select("part").where(
            ~F.unhex("part").cast("string").startswith("state-")).distinct()
        return self.table.read(version, stored).select(
            *self.keys, *[F.col(f"left.{c}").alias(c) for c in self.columns["left"]],
            F.when(F.col("left").isNotNull(), F.col("nth")).alias("rn"),
            *[F.col(f"right.{c}").alias(c) for c in self.columns["right"]])

    # ------------------------------------------------------------ loading

    def load(self, left: DataFrame, right: DataFrame, lo: datetime, hi: datetime, holes: bool = False) -> int:
        """Add the rows of ``[lo, hi)`` and return the new version.

        An interval that overlaps one loaded before is refused, as its rows are there already, and one that would leave a gap
        unless ``holes``. Intervals may come in any order: rows that belong before others are late rows.
        """
        if not self.table.versions():
            self.table.create(self._stored(self._empty))
        version = self.table.versions()[-1]
        known = self.table.intervals(version)
        if not lo < hi or any(a < hi and lo < b for a, b in known):
            raise ValueError(f"{lo} to {hi} is empty or was loaded before")
        if not holes and len(gaps([*known, (lo, hi)])) > len(gaps(known)):
            raise ValueError(f"{lo} to {hi} leaves a gap beside {known[0][0]} to {known[-1][1]}")
        with staged_for(self.spark, "increment"):
            return self._load(version, stage(self._layout(left, right), "new-rows"), (lo, hi))

    def _load(self, version: int, new: DataFrame, interval: tuple[datetime, datetime]) -> int:
        groups, small = self._groups(version, new)
        late = groups.where("_late").select(*self.keys)
        any_late = bool(late.head(1))
        waiting = self._rows(version, "open", groups)
        opened = stage(self._with(waiting, groups.select(*self.keys, "_late"), "left", small), "open-rows")
        again = opened.where("_late").select(*self.keys, *SIDES)
        rest = []
        if any_late:
            paired = self._rows(version, "paired", late).select(*self.keys, "nth", *SIDES)
            again = stage(again.unionByName(self._with(paired, late, "left_semi", small).drop("nth")), "late-rows")
            rest = [self._stored(self._with(paired, late, "left_anti", small), self._kind("paired"))]
        sides = [self._ranked(side, new.unionByName(again) if any_late else new, groups, small).unionByName(
            opened.where(f"NOT _late AND {side} IS NOT NULL").select(*self.keys, "nth", side)) for side in SIDES]
        pairs = sides[0].join(sides[1], [*self.keys, "nth"], "full")
        done = self._unpairable() | (F.col("left").isNotNull() & F.col("right").isNotNull())
        rows = [
            self._stored(pairs, self._kind(F.when(done, "paired").otherwise("open"))),
            self._stored(opened.where("_late IS NULL").drop("_late"), self._kind("open")),
            self._stored(self._with(self._rows(version, "state", groups), groups.select(*self.keys), "left_anti", small),
                         self._kind("state")),
            self._stored(groups.drop("_late", "before_left", "before_right"), self._kind("state")), *rest]
        emptied = self._parts(groups, ["open", "state"])
        if any_late:
            emptied = emptied.unionByName(self._parts(late, ["paired"]))
        return self.table.change(version, reduce(DataFrame.unionByName, rows), emptied, interval)

    def _groups(self, version: int, new: DataFrame) -> tuple[DataFrame, bool]:
        """The groups of the new rows, staged: counts before and after, the last row of each side, and whether a row is late;
        and whether their measured size is within the bound of a broadcast, which grows with the increment."""
        came, size = stage_measured(new.groupBy(*self.keys).agg(*[
            c for side in SIDES for c in (
                F.count(side).alias(f"came_{side}"), F.min(self._place(side)).alias(f"first_{side}"),
                F.max(self._place(side)).alias(f"newest_{side}"))]), "came")
        small = size <= BROADCAST_BYTES
        state = self._rows(version, "state", came).select(*self.keys, *[f"{c}_{side}" for side in SIDES for c in ("n", "last")])
        both = self._with(came, self._with(state, came.select(*self.keys), "left_semi", small), "left", small)
        late = reduce(Column.__or__, [
            F.coalesce(F.col(f"first_{side}") < F.col(f"last_{side}"), F.lit(False)) for side in SIDES])
        columns = []
        for side in SIDES:
            before, last, newest = F.coalesce(f"n_{side}", F.lit(0)), F.col(f"last_{side}"), F.col(f"newest_{side}")
            columns += [F.when(late, 0).otherwise(before).cast("long").alias(f"before_{side}"),
                        (before + F.col(f"came_{side}")).cast("long").alias(f"n_{side}"),
                        F.when(last.isNull() | (newest > last), newest).otherwise(last).alias(f"last_{side}")]
        return stage(both.select(*self.keys, late.alias("_late"), *columns), "groups"), small

    def _ranked(self, side: str, rows: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
        """The rows of a side with their rank in the whole group."""
        flat = rows.where(F.col(side).isNotNull()).select(*self.keys, f"{side}.*")
        # The place within the increment. What is ranked is a scan of staged tables, which may be read several times.
        placed = rank_within(flat, self.keys, self.order[side], "_nth", self.limit)
        return self._with(placed, groups.select(*self.keys, F.col(f"before_{side}").alias("_before")), "inner", small).select(
            *self.keys, (F.col("_nth") + F.col("_before")).alias("nth"), F.struct(*self.columns[side]).alias(side))

    def _stored(self, rows: DataFrame, kind: Column | None = None) -> DataFrame:
        """Rows in the columns of the table."""
        out = rows if kind is None else rows.withColumn("_kind", kind)
        empty = self._empty.select("*", F.lit("").alias("_kind"), F.lit(None).cast("long").alias("nth"), *[
            c for side in SIDES for c in (F.lit(None).cast("long").alias(f"n_{side}"),
                                          self._place(side).alias(f"last_{side}"))])
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name not in out.columns]
        return out.select("*", *missing).select(*empty.columns)

    def compact(self, many: int = MANY_FOLDERS) -> int:
        """Write buckets of ``many`` folders or more into one folder each; the version it makes, or the current one."""
        version = self.table.versions()[-1]
        folders = self.table.places(version).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        parts = folders.where(F.col("n") >= many).select("part")
        if not parts.head(1):
            return version
        known = self.table.intervals(version)
        return self.table.change(version, self.table.read(version, parts), parts, known[0])
