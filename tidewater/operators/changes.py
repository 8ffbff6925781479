"""Which days of a merged table have changed since the facts were last brought up to date.

Every merge notes the days of the rows it brings and of the versions they replace, before it stores them; a run that dies has noted
too many days, never too few.  What has been worked off is dropped as a whole, by the merges it came from, so a merge that comes meanwhile is not lost.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.tables import create_table, drop_partitions, partition_values

SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("run", T.StringType())])


class ChangedDays:
    """The ledger of one dataset."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def note(self, days: Iterable[dt.date | None]) -> None:
        """Add days; rows without a day are in no fact table."""
        create_table(self.spark, self.name, SCHEMA, ["run"], "Days that changed since the last daily run")
        run = uuid.uuid4().hex[:12]
        lines = [(day, run) for day in sorted({d for d in days if d is not None})]
        if lines:
            self.spark.createDataFrame(lines, SCHEMA).coalesce(1).write.mode("append").insertInto(self.name)

    def pending(self) -> list[str]:
        """The merges that have noted days, as of now."""
        if not self.spark.catalog.tableExists(self.name):
            return []
        self.spark.catalog.refreshTable(self.name)
        return sorted(r["spec"]["run"] for r in partition_values(self.spark, self.name).collect())

    def days(self, runs: list[str]) -> list[dt.date]:
        rows = self.spark.table(self.name).filter(F.col("run").isin(runs)).select("day").distinct() if runs else None
        return sorted(r["day"] for r in rows.collect()) if rows else []

    def settle(self, runs: list[str], later: Iterable[dt.date]) -> None:
        """These merges are worked off but for the days in ``later``, which are noted once more first."""
        self.note(later)
        if runs:
            drop_partitions(self.spark, self.name, [{"run": run} for run in runs])
