"""Greedy chains over ordered events, without a sequential pass over a group.

Both the circuit breaker and alert masking repeat one step: from the current
event, jump to the first later event that meets a condition.  ``first_after``
finds every jump at once and ``mark_chain`` marks the events that the chain from
each group's first event really visits.  No task holds a whole group: look-ups
are split by buckets of the ordering, and the chain is followed by doubling the
length of the jumps, so it takes as many rounds as the logarithm of its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.session import written


def first_after(
    queries: DataFrame, points: DataFrame, keys: Sequence[str], position: str, bucket: str, result: str
) -> DataFrame:
    """For each query row, the smallest point position strictly after the query's own, in its group.

    Both frames carry ``keys``, ``position`` (any orderable type) and ``bucket``,
    an integer that grows with the position.  Within a bucket the answer comes
    from a running window; if the bucket has no later point, from the first point
    of the next bucket that has one.
    """
    keys = list(keys)
    payload = [c for c in queries.columns if c not in (*keys, position, bucket)]
    base = [*keys, F.col(position), F.col(bucket)]
    asked = queries.select(*base, F.lit(True).alias("_query"), F.struct(F.lit(0).alias("_"), *payload).alias("_row"))
    known = points.select(*base, F.lit(False).alias("_query"), F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    both = asked.unionByName(known)
    point = F.when(~F.col("_query"), F.col(position))

    # Descending, queries first among equals: the last point seen is the next one.
    back = (
        Window.partitionBy(*keys, bucket)
        .orderBy(F.desc(position), F.desc("_query"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    within = both.withColumn("_in_bucket", F.last(point, ignorenulls=True).over(back)).filter("_query")

    later = Window.partitionBy(*keys).orderBy(F.desc(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    buckets = both.groupBy(*keys, bucket).agg(F.min(point).alias("_first"))
    beyond = buckets.select(*keys, bucket, F.last("_first", ignorenulls=True).over(later).alias("_beyond"))

    return within.join(beyond, [*keys, bucket]).select(
        *keys,
        position,
        bucket,
        *(F.col(f"_row.{c}").alias(c) for c in payload),
        F.coalesce("_in_bucket", "_beyond").alias(result),
    )


def mark_chain(nodes: DataFrame, keys: Sequence[str], position: str, following: str) -> DataFrame:
    """The positions visited when each group is followed from its first node along ``following``.

    ``nodes`` has one row per (keys, position).
    """
    keys = list(keys)
    nodes = written(nodes.select(*keys, F.col(position).alias("_at"), F.col(following).alias("_to")), "nodes")
    jumps = nodes.filter("_to IS NOT NULL")
    visited = nodes.groupBy(*keys).agg(F.min("_at").alias("_at"))
    while not jumps.isEmpty():
        reached = visited.join(jumps, [*keys, "_at"]).select(*keys, F.col("_to").alias("_at"))
        visited = written(visited.unionByName(reached), "visited")
        onward = jumps.select(*keys, F.col("_at").alias("_to"), F.col("_to").alias("_end"))
        jumps = written(
            jumps.join(onward, [*keys, "_to"]).select(*keys, "_at", F.col("_end").alias("_to")), "jumps"
        )
    return visited.withColumnRenamed("_at", position)
