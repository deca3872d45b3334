"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How sheets are written and read: nothing is trimmed, quotes are doubled, cells may hold line breaks, and a NULL
# is told from an empty text. A text that begins like the mark for NULL gets one more backslash.
SHEET_OPTIONS = {
    "header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"',
    "escape": '"', "multiLine": "true", "nullValue": "\\N", "emptyValue": "",
}


def append_to_mart(df: DataFrame, table: str, mode: str = "append") -> None:
    """Write to an existing mart table, columns matched by position.

    The target decides: as many columns, in its order. ``mode="replace"`` overwrites, so that a
    re-run of the same load does not repeat rows.
    """
    target = df.sparkSession.table(table).columns
    if len(target) != len(df.columns):
        raise ValueError(f"{table} has {len(target)} columns, the result has {len(df.columns)}")
    df.write.insertInto(table, overwrite={"append": False, "replace": True}[mode])


def write_stage(df: DataFrame, path: str) -> None:
    """Stage an extract as parquet, replacing an earlier one."""
    df.write.mode("overwrite").parquet(path)


def write_export(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Replace an export: CSV parts with a header; read in part order they follow ``order``.

    Every value comes back as it was with ``read_sheet``.
    """
    out = df.orderBy(*order) if order else df
    texts = {f.name: F.when(F.col(f.name).startswith("\\"), F.concat(F.lit("\\"), F.col(f.name))).otherwise(F.col(f.name))
             for f in df.schema if isinstance(f.dataType, T.StringType)}
    out.withColumns(texts).write.mode("overwrite").options(**SHEET_OPTIONS | {"emptyValue": '""'}).csv(path)


def write_outbox(messages: DataFrame, path: str) -> None:
    """Replace a message table; a delivery service outside Spark reads it."""
    messages.write.mode("overwrite").parquet(path)
