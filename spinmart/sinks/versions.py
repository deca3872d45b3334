"""A target with versions: a load writes aside, and one rename of its manifest makes it the current version.

``<root>/data/<load>`` holds the partitions that a load wrote, ``<root>/manifests/<n>`` the partitions of version n, each
with its folder, and the time intervals loaded so far. A reader takes the manifest it finds and keeps it, so it sees one
version whole, whatever is written meanwhile; a load that stops before the rename leaves no trace in any version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from spinmart.operators.latest import upsert_latest
from spinmart.operators.staging import stage
from spinmart.sources.changes import LoadConfig, extract_changes

Interval = tuple[datetime, datetime]
PLACES = "part string, path string"
INTERVALS = T.StructType([T.StructField("lo", T.TimestampNTZType()), T.StructField("hi", T.TimestampNTZType())])


def merged(intervals: Iterable[Interval]) -> list[Interval]:
    """The same times as disjoint intervals in order; neighbours that touch are one, empty ones go."""
    out: list[Interval] = []
    for lo, hi in sorted(i for i in intervals if i[0] < i[1]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def gaps(intervals: Iterable[Interval]) -> list[Interval]:
    """The times between the first and the last interval that none covers."""
    known = merged(intervals)
    return [(a[1], b[0]) for a, b in zip(known, known[1:])]


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def few_rows(spark: SparkSession, form: str | T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """A few rows of a manifest, without a Python worker for each core."""
    schema = T.StructType.fromDDL(form) if isinstance(form, str) else form
    if not rows:
        return no_rows(spark, schema)
    columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), schema)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


class VersionedTable:
    """Rows laid out by a partition column that never changes for a key, such as the creation day."""

    def __init__(self, spark: SparkSession, root: str, partition: str) -> None:
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = path
        self._files = path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifests

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def places(self, version: int | None = None) -> DataFrame:
        """(part, path) of a version, the newest unless named; ``part`` is the value as hexadecimal text, NULL for NULL."""
        return self.spark.read.schema(PLACES).parquet(f"{self._manifest(version)}/places")

    def intervals(self, version: int | None = None) -> list[Interval]:
        """What was loaded, as disjoint intervals: one, and one more for each gap."""
        if not self.versions():
            return []
        rows = self.spark.read.schema(INTERVALS).parquet(f"{self._manifest(version)}/intervals").collect()
        return merged((r.lo, r.hi) for r in rows)

    def _manifest(self, version: int | None) -> str:
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError(f"no version {'' if version is None else version} in {self.root}")
        return f"{self.root}/manifests/{known[-1] if version is None else version}"

    def _switch(self, aside: str, version: int) -> None:
        """Make the manifest that lies aside the one of ``version``; refused if another load has made it first."""
        place = self._path(f"{self.root}/manifests/{version}")
        self._files.mkdirs(place.getParent())
        if self._files.exists(place) or not self._files.rename(self._path(aside), place):
            raise RuntimeError(f"version {version} of {self.root} was made by another load")

    # ------------------------------------------------------------ reading

    def read(self, version: int | None = None, parts: DataFrame | None = None) -> DataFrame:
        """The rows of a version; with ``parts`` (column ``part``) only those partitions are listed and read."""
        places = self.places(version)
        if parts is not None:
            places = places.join(parts, places["part"].eqNullSafe(parts["part"]), "left_semi")
        # As many paths as partitions, which any reader of a partitioned table lists on the driver.
        paths = [f"{self.root}/{r.path}" for r in places.select("path").distinct().collect()]
        schema = self._schema()
        return self.spark.read.schema(schema).parquet(*paths) if paths else no_rows(self.spark, schema)

    def _schema(self) -> T.StructType:
        """Of the table, as the first version has it: columns are not changed by loads."""
        first = self.spark.read.schema(PLACES).parquet(f"{self._manifest(self.versions()[0])}/schema")
        return T.StructType.fromJson(json.loads(first.first().path))

    def _part(self):
        return F.hex(F.col(self.partition).cast("string"))

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """(folder of the load, its places)."""
        load = f"data/{uuid.uuid4().hex}"
        # A folder's name is hexadecimal, so any value can name one; the column itself stays in the files.
        named = rows.withColumn("_part", F.coalesce(self._part(), F.lit("NULL"))).hint("rebalance", "_part")
        named.write.partitionBy("_part").parquet(f"{self.root}/{load}")
        folders = [s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.root}/{load}")) if s.isDirectory()]
        names = [(f.split("=", 1)[1], f"{load}/{f}") for f in folders if f.startswith("_part=")]
        return load, few_rows(self.spark, PLACES, [(None if p == "NULL" else p, path) for p, path in names])

    def _publish(self, version: int, places: DataFrame, intervals: Iterable[Interval], schema: T.StructType) -> None:
        aside = f"{self.root}/aside-{uuid.uuid4().hex}"
        places.coalesce(1).write.parquet(f"{aside}/places")
        few_rows(self.spark, INTERVALS, merged(intervals)).coalesce(1).write.parquet(f"{aside}/intervals")
        few_rows(self.spark, PLACES, [(None, schema.json())]).coalesce(1).write.parquet(f"{aside}/schema")
        self._switch(aside, version)

    def create(self, rows: DataFrame, covered: Sequence[Interval] = ()) -> int:
        """Version 1, of all ``rows``, which hold the changes of the ``covered`` intervals."""
        _, places = self._write(rows)
        self._publish(1, places, covered, rows.schema)
        return 1

    def next_interval(self, until: datetime) -> Interval | None:
        """What to load next: the first gap, else the time since the last load; None if all is loaded."""
        known = self.intervals()
        if not known:
            raise ValueError("nothing was loaded yet, so the first interval must be named")
        return next(iter(gaps(known)), None) or ((known[-1][1], until) if known[-1][1] < until else None)

    def load(self, source: DataFrame, config: LoadConfig, lo: datetime, hi: datetime, holes: bool = False) -> int:
        """Upsert the rows of ``source`` changed in ``[lo, hi)`` and return the new version.

        Only partitions with changed rows are read and written; the others keep the folders they have. An interval that would
        leave a gap before or after it is refused unless ``holes``. Loading an interval again changes no row.
        """
        version = self.versions()[-1]
        known = self.intervals(version)
        if not holes and len(gaps([*known, (lo, hi)])) > len(gaps(known)):
            raise ValueError(f"{lo} to {hi} leaves a gap beside {known[0][0]} to {known[-1][1]}")
        schema = self._schema()
        staged = stage(extract_changes(source, config, lo, hi).select(*schema.names), "extract")
        parts = staged.select(self._part().alias("part")).distinct()
        rows = upsert_latest(self.read(version, parts), staged, config.upsert_key, config.timestamp_columns)
        return self.change(version, rows, parts, (lo, hi))

    def change(self, version: int, rows: DataFrame, emptied: DataFrame, loaded: Interval) -> int:
        """The version after ``version``: partitions in ``emptied`` (column ``part``) go, ``rows`` are added beside the others."""
        _, places = self._write(rows)
        old = self.places(version)
        kept = old.join(emptied, old["part"].eqNullSafe(emptied["part"]), "left_anti")
        self._publish(version + 1, kept.unionByName(places), [*self.intervals(version), loaded], self._schema())
        return version + 1
