"""Lineage columns."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.contracts import Contract
from tidewater.functions.expressions import contract_column
from tidewater.functions.moments import timestamp
from tidewater.sources.rescue import SOURCE_FILE

# An expression that reads no column has one value per batch.
READS_ROW = re.compile(r"\b(col|expr)\s*\(")


def _columns(contract: Contract, batch_id: int, ingest_time: dt.datetime, constant: bool) -> dict[str, Column]:
    columns = {}
    for meta in contract.metadata:
        if constant != bool(READS_ROW.search(meta.expression)):
            column = contract_column(meta.expression, batch_id, ingest_time)
            columns[meta.name] = column.cast(meta.datatype) if meta.datatype else column
    return columns


def batch_constants(
    contract: Contract, batch_id: int, ingest_time: dt.datetime, landed: Sequence[str] = ()
) -> dict[str, Column]:
    """The metadata columns that are the same in every row of a batch.

    The three columns every table needs are among them, unless the contract or
    the landed columns have them.
    """
    declared = {m.name for m in contract.metadata} | set(landed)
    defaults = {
        "_batch_id": F.lit(batch_id).cast("bigint"),
        "_ingest_timestamp": timestamp(ingest_time),
        "_schema_version_id": F.lit(contract.version),
    }
    constants = _columns(contract, batch_id, ingest_time, constant=True)
    return constants | {name: column for name, column in defaults.items() if name not in declared}


def inject_row_metadata(df: DataFrame, contract: Contract, batch_id: int, ingest_time: dt.datetime) -> DataFrame:
    """Add the metadata columns that depend on the row.  One named like a landed column replaces it."""
    return df.withColumns(_columns(contract, batch_id, ingest_time, constant=False)).drop(SOURCE_FILE)


def inject_metadata(df: DataFrame, contract: Contract, batch_id: int, ingest_time: dt.datetime) -> DataFrame:
    """Add all metadata columns of the contract."""
    rows = inject_row_metadata(df, contract, batch_id, ingest_time)
    return rows.withColumns(batch_constants(contract, batch_id, ingest_time, df.columns))


def derive_event_date(df: DataFrame, timestamp: str, date: str) -> DataFrame:
    """The date of the event time, in place of the landed date."""
    return df.withColumn(date, F.to_date(timestamp))
