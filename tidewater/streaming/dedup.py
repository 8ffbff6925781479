"""Duplicate removal across the batches of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dayfilters import DayFilters
from tidewater.operators.tables import append_batch
from tidewater.operators.upsert import has_keys, source_winners
from tidewater.session import written


def within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Spark's own state-store variant, for streams whose keys are evenly spread."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


class FirstSeen:
    """A ``foreachBatch`` sink that stores the first row of each key.

    A row repeats an earlier one if a stored row of an earlier batch has its key and is not older than ``horizon_days`` before the row's own day.
    A row without event time lies within every horizon, and every row within its: it repeats any stored row of its key, and any later row of its key
    repeats it.  In a batch the earliest row of a key is kept, one without time only if there is no other.  Rows with a NULL key are all kept.

    Copies within a batch collapse inside the tasks before the shuffle, so a key
    with a third of a batch cannot fill one task.  Days that may hold a key of the batch come from the stored Bloom filters of each day, in
    the table ``<table>_filters``; other days are not read, however long the horizon is.  A batch of many keys reads all days within its horizon.  The stored rows themselves decide.
    """

    def __init__(
        self, table: str, keys: Sequence[str], event_time: str, date: str, horizon_days: int, grain: str = "day", blocks: int = 64
    ):
        self.table, self.keys = table, list(keys)
        self.event_time, self.date, self.horizon_days, self.grain, self.blocks = event_time, date, horizon_days, grain, blocks

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(self.date, F.to_date(F.date_trunc(self.grain, self.event_time))).withColumn(
            "_batch_id", F.lit(batch_id).cast("bigint")
        )
        # The earliest is the least, and NULL is less than any time: rows without time are put behind the others.
        rows = rows.withColumn("_timeless", F.col(self.event_time).isNull())
        winners = source_winners(rows, self.keys, "_timeless", latest=False, then=[self.event_time]).drop("_timeless")
        fresh = written(winners, "firsts")
        if fresh.isEmpty():
            return
        filters = DayFilters(spark, f"{self.table}_filters", self.keys, self.date, self.blocks)
        unseen = fresh
        if spark.catalog.tableExists(self.table):
            days = filters.possible(fresh.filter(has_keys(self.keys)).select(*self.keys, self.date), self.horizon_days)
            # A batch that is run again must not meet its own rows.
            stored = spark.table(self.table).filter(filters.listed(days) & (F.col("_batch_id") < batch_id))
            seen = stored.select(*self.keys, F.col(self.date).alias("_seen")).alias("s")
            same = [F.col(f"f.{k}") == F.col(f"s.{k}") for k in self.keys]
            near = F.col("_seen").isNull() | F.col(f"f.{self.date}").isNull() | (F.col("_seen") >= F.date_sub(F.col(f"f.{self.date}"), self.horizon_days))
            # Needed twice, by the filters and by the table.
            unseen = written(fresh.alias("f").join(seen, [*same, near], "left_anti"), "unseen")
        filters.add(unseen.filter(has_keys(self.keys)).select(*self.keys, self.date))
        append_batch(unseen, self.table, [self.date])
