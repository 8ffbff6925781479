"""Counts and watermarks per batch.

Everything here is one partial-then-final aggregation: each task reduces its own
rows to one line per batch before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.contracts import WatermarkSpec
from tidewater.functions.scalars import minutes_before
from tidewater.session import written

BATCHES_PER_BLOCK = 1024


def watermark_columns(max_event_time: Column, spec: WatermarkSpec) -> dict[str, Column]:
    """Watermark and cutoff that follow from a batch's latest event time."""
    watermark = minutes_before(max_event_time, spec.delayed_threshold_minutes)
    return {"watermark": watermark, "cutoff": minutes_before(watermark, spec.allowed_lateness_minutes)}


def batch_watermarks(
    df: DataFrame, spec: WatermarkSpec, batch: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """One row per batch: latest event time, watermark, cutoff."""
    latest = df.groupBy(*batch).agg(F.max(spec.event_time_column).alias("max_event_time"))
    return latest.withColumns(watermark_columns(F.col("max_event_time"), spec))


def with_cutoff(df: DataFrame, spec: WatermarkSpec, batch: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Each row with the cutoff of its batch.

    The cutoffs are stored first, one row per batch.  Their true size is then
    known: a small table is broadcast and the rows stay where they are; a large
    one is joined by shuffle.
    """
    cutoffs = written(batch_watermarks(df, spec, batch).select(*batch, "cutoff"), "cutoffs")
    return df.join(cutoffs, list(batch))


def batch_counts(df: DataFrame, corrupt: Column, late: Column, batch: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per batch: all rows, late rows, and the error rate of the rows on time."""
    counted = df.groupBy(*batch).agg(
        F.count("*").alias("total"),
        F.count_if(late).alias("late"),
        F.count_if(~late).alias("on_time"),
        F.count_if(~late & corrupt).alias("corrupt"),
    )
    return counted.withColumn("error_pct", error_rate(F.col("corrupt"), F.col("on_time")))


def error_rate(corrupt: Column, total: Column) -> Column:
    """Corrupt rows in percent; NULL for an empty batch."""
    return F.try_divide(corrupt, total) * 100


def monotone_watermark(batches: DataFrame, keys: Sequence[str] = ("domain",), value: str = "watermark") -> DataFrame:
    """The watermark that never goes back: its running maximum in batch order.

    The history of a dataset has no bound, so it is handled in blocks of
    consecutive batches: a running maximum within each block, joined with the
    maximum of the blocks before, which is a table ``BATCHES_PER_BLOCK`` times smaller.
    """
    keys = list(keys)
    block = F.floor(F.col("batch_id") / BATCHES_PER_BLOCK).alias("_block")
    blocked = batches.select("*", block)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        blocked.groupBy(*keys, "_block")
        .agg(F.max(value).alias("_max"))
        .select(*keys, "_block", F.max("_max").over(earlier).alias("_before"))
    )
    within = Window.partitionBy(*keys, "_block").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(before, [*keys, "_block"])
        .withColumn("monotone_watermark", F.greatest(F.max(value).over(within), "_before"))
        .drop("_block", "_before")
    )
