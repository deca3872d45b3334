"""Readers. Types come from the schema given or the catalog; none are inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spinmart.sinks.tables import SHEET_OPTIONS


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table (``db.table``) or, with a schema, a parquet folder."""
    return spark.table(name) if schema is None else spark.read.schema(schema).parquet(name)


def query_options(url: str, query: str, partition_column: str | None = None,
                  bounds: tuple[int, int] | None = None, partitions: int = 1,
                  fetch_rows: int = 10_000, **connection: str) -> dict[str, str]:
    """Options of a JDBC read. With a partition column the query is read in parallel ranges."""
    options = {"url": url, "fetchsize": str(fetch_rows), **connection}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None:
        raise ValueError("a partitioned read needs bounds")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, url: str, query: str, **settings) -> DataFrame:
    """Result of a query on a remote database. Stays a DataFrame."""
    return spark.read.format("jdbc").options(**query_options(url, query, **settings)).load()


def read_sheet(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A worksheet exported as CSV, one folder per sheet: columns by the names in its header row.

    The header decides where a column is; a cell that is no value of the column's type is NULL.
    """
    cells = spark.read.options(**SHEET_OPTIONS).csv(folder)

    def text(name: str):
        return F.when(F.col(name).startswith("\\"), F.substring(name, 2, 2_147_483_647)).otherwise(F.col(name))

    return cells.select(*[text(field.name).try_cast(field.dataType).alias(field.name) for field in schema])
