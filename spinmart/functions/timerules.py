"""Time rules. Stored times are UTC wall clock (``timestamp_ntz``); people read local wall clock.

Nothing here reads the clock: the run time comes in as ``as_of``, so a re-run gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Ho_Chi_Minh"


def ntz(moment: datetime | str) -> Column:
    """``timestamp_ntz`` literal, so that a comparison never casts the column and stays pushable."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")


def local_time(stored: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock of a stored UTC time. Independent of the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), stored)


def hour_start(local: Column) -> Column:
    """Start of the hour of a wall-clock time, by subtraction, so no time zone takes part."""
    return local - F.make_dt_interval(mins=F.minute(local), secs=F.extract(F.lit("SECOND"), local))


def hour_lag_cutoff(as_of: datetime, lag_hours: int = 1, zone: str = LOCAL_ZONE) -> datetime:
    """UTC time up to which rows count: start of the local hour of ``as_of``, less the lag."""
    utc = as_of.astimezone(UTC) if as_of.tzinfo else as_of.replace(tzinfo=UTC)
    hour = utc.astimezone(ZoneInfo(zone)).replace(minute=0, second=0, microsecond=0)
    return (hour.astimezone(UTC) - timedelta(hours=lag_hours)).replace(tzinfo=None)


def settled(stored: Column, as_of: datetime, lag_hours: int = 1, zone: str = LOCAL_ZONE) -> Column:
    """Predicate: the row is old enough to count. Compares the bare column, so parquet can skip."""
    return stored <= ntz(hour_lag_cutoff(as_of, lag_hours, zone))


@dataclass(frozen=True)
class CampaignWindow:
    """Half-open window ``lo < t <= hi`` in local time. A bound left out is open.

    ``keys`` maps column names to the values the window applies to; none means every row.
    """

    flag: int
    lo: str | None = None
    hi: str | None = None
    keys: dict = field(default_factory=dict)

    def holds(self, local: Column) -> Column:
        test = F.lit(True)
        for name, value in self.keys.items():
            test = test & (F.col(name) == F.lit(value))
        if self.lo is not None:
            test = test & (local > ntz(self.lo))
        if self.hi is not None:
            test = test & (local <= ntz(self.hi))
        return test


def window_flag(local: Column, windows: Sequence[CampaignWindow], default: int | Column) -> Column:
    """Flag of the first window that holds, else ``default``; for a short list kept in code."""
    default = F.lit(default) if isinstance(default, int) else default
    if not windows:
        return default
    chain = F.when(windows[0].holds(local), F.lit(windows[0].flag))
    for window in windows[1:]:
        chain = chain.when(window.holds(local), F.lit(window.flag))
    return chain.otherwise(default)


def check_disjoint(windows: Iterable[CampaignWindow]) -> None:
    """Raise if two windows of the same key overlap: a join on them would repeat rows."""
    by_key: dict = {}
    for window in windows:
        by_key.setdefault(tuple(sorted(window.keys.items())), []).append(window)
    for key, group in by_key.items():
        group.sort(key=lambda w: datetime.fromisoformat(w.lo) if w.lo else datetime.min)
        for before, after in zip(group, group[1:]):
            if before.hi is None or after.lo is None or (
                    datetime.fromisoformat(after.lo) < datetime.fromisoformat(before.hi)):
                raise ValueError(f"campaign windows overlap for {dict(key)}")
