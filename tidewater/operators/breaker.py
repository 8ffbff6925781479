"""Circuit breaker over the error rates of a dataset's batches.

Rules: a batch is bad if its error rate is strictly above the threshold.
CLOSED + bad -> OPEN until the batch's time plus the degradation time.
OPEN + good at or after that time -> HALF_OPEN, if the policy recovers by itself.
HALF_OPEN + good -> CLOSED.  Everything else, and an empty batch, changes nothing.
The state is updated before the batch is routed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewater.contracts import BreakerPolicy
from tidewater.operators.sequences import first_after, mark_chain
from tidewater.session import written

CLOSED, OPEN, HALF_OPEN = "CLOSED", "OPEN", "HALF_OPEN"

BUCKET_MICROS = 86_400_000_000
POSITION = T.StructType([T.StructField("clock", T.LongType()), T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class BreakerState:
    """The breaker after a batch."""

    state: str = CLOSED
    open_until: dt.datetime | None = None


def next_state(
    before: BreakerState, error_pct: float | None, batch_time: dt.datetime, policy: BreakerPolicy
) -> BreakerState:
    """One step, for the batch a stream has just counted."""
    if error_pct is None:
        return before
    if error_pct > policy.max_error_percentage:
        if before.state == CLOSED:
            return BreakerState(OPEN, batch_time + dt.timedelta(minutes=policy.degradation_minutes))
        return before
    if before.state == OPEN and policy.auto_recover and batch_time >= before.open_until:
        return BreakerState(HALF_OPEN)
    if before.state == HALF_OPEN:
        return BreakerState(CLOSED)
    return before


def breaker_states(batches: DataFrame, policy: BreakerPolicy) -> DataFrame:
    """The state after every batch of a history, from CLOSED on.

    ``batches`` has one row per (domain, batch_id) with ``batch_time`` and
    ``error_pct``; times must not go back in batch order.

    Each bad batch, were it to open the breaker, fixes when the breaker is half
    open, closed, and opened next.  Those three look-ups are made for all bad
    batches at once; following the jumps marks the batches that really opened it,
    and each batch takes its state from the last opening before it.
    """
    # One row per batch from here on; the rows they were counted from are read once.
    batches = written(batches, "batches")
    position = F.struct(F.unix_micros("batch_time").alias("clock"), F.col("batch_id").cast("long").alias("batch_id"))
    facts = batches.filter("error_pct IS NOT NULL").select(
        "domain", position.cast(POSITION).alias("pos"), (F.col("error_pct") > policy.max_error_percentage).alias("bad")
    )
    keyed = facts.withColumn("bucket", _bucket("pos"))
    bad, good = keyed.filter("bad").drop("bad"), keyed.filter("NOT bad").drop("bad")

    def after(df: DataFrame, start: str, points: DataFrame, result: str) -> DataFrame:
        """Add the first of ``points`` after column ``start``; rows without a start keep NULL."""
        others = [c for c in df.columns if c not in ("domain", "bucket")]
        asked = df.filter(F.col(start).isNotNull()).select(
            "domain", F.col(start).alias("pos"), _bucket(start).alias("bucket"), F.struct(*others).alias("_was")
        )
        found = first_after(asked, points, ["domain"], "pos", "bucket", result)
        answered = found.select("domain", *(F.col(f"_was.{c}").alias(c) for c in others), result)
        missing = df.filter(F.col(start).isNull()).select("domain", *others, F.lit(None).cast(POSITION).alias(result))
        return written(answered.unionByName(missing), "trips")

    degraded = policy.degradation_minutes * 60_000_000
    # Just before any batch at the end of the degradation time; -1 sorts before every batch id.
    expiry = F.struct((F.col("opened.clock") + degraded).alias("clock"), F.lit(-1).cast("long").alias("batch_id"))
    if not policy.auto_recover:
        expiry = F.lit(None)
    trips = bad.select("domain", F.col("pos").alias("opened"), expiry.cast(POSITION).alias("expiry"))
    trips = after(trips, "expiry", good, "half_open")
    trips = after(trips, "half_open", good, "closed")
    trips = after(trips, "closed", bad, "reopened")
    openings = trips.join(mark_chain(trips, ["domain"], "opened", "reopened"), ["domain", "opened"])

    return _as_of(batches, position, openings)


def _bucket(position: str) -> Column:
    return F.floor(F.col(f"{position}.clock") / BUCKET_MICROS)


def _as_of(batches: DataFrame, position: Column, openings: DataFrame) -> DataFrame:
    """Each batch with the state its last opening implies.

    Batches and openings are merged in one ordering, split by bucket; a bucket's
    first rows take the last opening of the buckets before.
    """
    trip = F.struct("opened", "half_open", "closed")
    empty = F.lit(None).cast(
        T.StructType([T.StructField(n, POSITION) for n in ("opened", "half_open", "closed")])
    )
    # An empty batch changes nothing but still shows the state in force.
    rows = batches.select("domain", position.cast(POSITION).alias("pos"), empty.alias("trip"), F.struct(*batches.columns).alias("row"))
    marks = openings.select(
        "domain", F.col("opened").alias("pos"), trip.alias("trip"), F.lit(None).cast(rows.schema["row"].dataType).alias("row")
    )
    merged = rows.unionByName(marks).withColumn("bucket", _bucket("pos"))
    forward = (
        Window.partitionBy("domain", "bucket")
        .orderBy("pos", F.col("row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy("domain").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        merged.groupBy("domain", "bucket")
        .agg(F.max("trip").alias("trip"))
        .select("domain", "bucket", F.last("trip", ignorenulls=True).over(earlier).alias("carried"))
    )
    placed = (
        merged.withColumn("here", F.last("trip", ignorenulls=True).over(forward))
        .filter("row IS NOT NULL")
        .join(carried, ["domain", "bucket"])
        .withColumn("last_trip", F.coalesce("here", "carried"))
    )
    state = (
        F.when(F.col("last_trip").isNull(), CLOSED)
        .when(F.col("last_trip.half_open").isNull() | (F.col("pos") < F.col("last_trip.half_open")), OPEN)
        .when(F.col("last_trip.closed").isNull() | (F.col("pos") < F.col("last_trip.closed")), HALF_OPEN)
        .otherwise(CLOSED)
    )
    return placed.select("row.*", state.alias("breaker_state"))


def breaker_actions(states: DataFrame, policy: BreakerPolicy, max_retries: int) -> DataFrame:
    """What a batch's state means for its writes.

    Attempts of the quarantine write: all retries while CLOSED, one while OPEN,
    two while HALF_OPEN.  Under ``degrade_mode`` write errors are tolerated unless
    CLOSED; ``fail_fast`` refuses a batch that finds the breaker not CLOSED;
    ``alert_only`` never tolerates nor refuses but raises an alert.
    """
    degraded = F.col("breaker_state") != CLOSED
    attempts = (
        F.when(F.col("breaker_state") == CLOSED, max_retries + 1).when(F.col("breaker_state") == OPEN, 1).otherwise(2)
    )
    return states.withColumns(
        {
            "quarantine_attempts": attempts,
            "tolerate_errors": degraded & F.lit(policy.action == "degrade_mode"),
            "refuse_batch": degraded & F.lit(policy.action == "fail_fast"),
            "raise_alert": degraded & F.lit(policy.action == "alert_only"),
        }
    )


def quarantine_attempts(state: str, max_retries: int) -> int:
    """The same attempt count, for the batch at hand."""
    return {CLOSED: max_retries + 1, OPEN: 1, HALF_OPEN: 2}[state]
