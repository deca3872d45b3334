"""Columns of a caller's table that are named like those an operator uses inside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def step_aside(df: DataFrame, inner: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with free names for the columns named like one of ``inner``, whatever the case; and free name to own name.

    ``withColumnsRenamed`` with the second gives the columns their names back.
    """
    used = {name.lower() for name in inner}
    taken, own = used | {name.lower() for name in df.columns}, {}
    for name in df.columns:
        if name.lower() in used:
            free = f"_own_{name}"
            while free.lower() in taken:
                free = f"_{free}"
            taken.add(free.lower())
            own[free] = name
    return df.withColumnsRenamed({name: free for free, name in own.items()}), own
