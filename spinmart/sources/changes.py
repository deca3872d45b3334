"""Incremental extract of changed rows, and the choice of tables to load."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.functions.timerules import ntz

# Change-stamp columns by kind of source, and how they are stored.
CHANGE_STAMPS = {
    "postgres": (("updated_at", "created_at"), "timestamp"),
    "mariadb": (("updated", "created"), "integer"),
}


@dataclass(frozen=True)
class LoadConfig:
    """What to load: source and target table, change stamps, upsert key."""

    database: str
    source_table: str
    target_table: str
    timestamp_columns: tuple[str, ...]
    timestamp_column_type: str
    upsert_key: str = "id"

    @classmethod
    def for_source(cls, source_type: str, database: str, table: str) -> LoadConfig:
        columns, kind = CHANGE_STAMPS[source_type]
        return cls(database, table, table, columns, kind)


def choose_tables(available: Iterable[str], chosen: Iterable[str], mode: str) -> list[str]:
    """Partial: the chosen tables. Full: all tables but the chosen ones."""
    if mode == "partial":
        return sorted(set(chosen))
    if mode == "full":
        return sorted(set(available) - set(chosen))
    raise ValueError(f"mode is 'full' or 'partial', not {mode!r}")


def changed_between(columns: Iterable[str], kind: str, lo: datetime, hi: datetime) -> Column:
    """Predicate: any change stamp lies in ``[lo, hi)``.

    The bounds are converted, never the columns, so the whole test is pushed to the source.
    """
    if kind == "timestamp":
        start, end = ntz(lo), ntz(hi)
    elif kind == "integer":
        start, end = (F.lit(int((t if t.tzinfo else t.replace(tzinfo=UTC)).timestamp())) for t in (lo, hi))
    else:
        raise ValueError(f"stamp columns are 'timestamp' or 'integer', not {kind!r}")
    return reduce(Column.__or__, [(F.col(c) >= start) & (F.col(c) < end) for c in columns])


def extract_changes(df: DataFrame, config: LoadConfig, lo: datetime, hi: datetime) -> DataFrame:
    return df.where(changed_between(config.timestamp_columns, config.timestamp_column_type, lo, hi))
