"""Full-row and key-based duplicate removal, safe for hot groups of copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, provenance: Sequence[str] = ()) -> DataFrame:
    """One of each distinct row.

    Columns that only say where a copy came from do not make it different; the
    smallest value is kept.  Copies collapse inside each task before the shuffle,
    so a group with a third of all rows sends one row per task.
    """
    carried = [c for c in provenance if c in df.columns]
    if not carried:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in carried]
    kept = df.groupBy(*keys).agg(*(F.min(c).alias(c) for c in carried))
    return kept.select(*df.columns)


def best_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[Column | str], latest: bool = True) -> DataFrame:
    """One whole row per key: the latest (or earliest) by ``first``, then by all other columns.

    This is a maximum over a struct, not a sorted window: every task reduces each
    key to one candidate before the shuffle, so one hot key cannot fill a task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in first]
    rank = F.struct(*(c.alias(f"_o{i}") for i, c in enumerate(order)), *rest)
    pick = F.max if latest else F.min
    return (
        df.groupBy(*keys)
        .agg(pick(rank).alias("_best"))
        .select(*(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns))
    )
