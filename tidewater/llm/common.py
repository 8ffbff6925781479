"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side with at most so many rows of a few numbers each (about 64 MB) may be broadcast.
BROADCAST_ROWS = 2_000_000


def bounded(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``side`` for broadcast if a count proves it small; else the planner shuffles both sides.

    ``side`` is counted, so pass a written table of narrow rows.
    """
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, for a Python function over Arrow batches: they hold 1,000 rows and about 16 MB from now on in this session, unless it has set its own sizes.

    By default a batch is 10,000 rows, which long texts would make too large for a worker.
    """
    conf = df.sparkSession.conf
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(rows) == "10000":
        conf.set(rows, "1000")
    if conf.get(size, None) == "67108864b":
        conf.set(size, str(16 << 20))
    return df


def word_list(text: Column) -> Column:
    """The words of a text: runs of characters other than blank, tab, line feed, VT, FF and CR."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
