"""Row classes of a batch: on time or late, clean or corrupt.  Every row gets exactly one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.contracts import Contract
from tidewater.functions.moments import timestamp

REASON = "_reason"


def is_late(event_time: str, cutoff: Column | dt.datetime | None) -> Column:
    """Before the cutoff.  No cutoff, or no event time, is never late."""
    if cutoff is None:
        return F.lit(False)
    limit = cutoff if isinstance(cutoff, Column) else timestamp(cutoff)
    return F.coalesce(F.col(event_time) < limit, F.lit(False))


def corruption_reason(contract: Contract, event_time: str | None = None) -> Column:
    """Why a row is corrupt, NULL for a clean row.  The first reason found counts."""
    event_time = event_time or contract.event_time_column
    reason = F.when(F.col(contract.rescued_column).isNotNull(), F.lit("rescued"))
    reason = reason.when(F.col(event_time).isNull(), F.lit("null_event_time"))
    for name in contract.required:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing:{name}"))
    return reason


def is_corrupt(contract: Contract) -> Column:
    return corruption_reason(contract).isNotNull()


def split_late(df: DataFrame, event_time: str, cutoff: Column | dt.datetime | None) -> tuple[DataFrame, DataFrame]:
    """(on time, late); a row without event time stays with the first."""
    late = is_late(event_time, cutoff)
    return df.filter(~late), df.filter(late)


def split_valid(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(clean, corrupt), the latter with its reason.  Filter one persisted frame, not a fresh plan, twice."""
    return (
        df.filter(~is_corrupt(contract)),
        df.withColumn(REASON, corruption_reason(contract)).filter(F.col(REASON).isNotNull()),
    )
