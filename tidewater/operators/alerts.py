"""Alert masking: one row per kind of error, and silence after each notification.

An occurrence notifies if it is the first of its fingerprint or later than the
end of the silence set by the last notification; it then sets a new silence.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import MaskingPolicy
from tidewater.functions.scalars import error_fingerprint, short_message
from tidewater.operators.sequences import first_after, mark_chain
from tidewater.operators.tables import Layers, create_table, overwrite_partitions, switch_partitions
from tidewater.session import written

# Look-ups are split by minute: no task sorts more than one minute of one fingerprint.
BUCKET_MICROS = 60_000_000
#: Parts of the stored state of all kinds of errors.
ALERT_BUCKETS = 16


def record_alert(
    spark: SparkSession, layers: Layers, domain: str, batch_id: int, step: str, error: Exception, at: dt.datetime
) -> str:
    """Add one occurrence to the alert history; a batch that runs again replaces its own."""
    row = (type(error).__name__, str(error), at, domain, step, batch_id)
    line = spark.createDataFrame(
        [row], "error_type string, error_message string, occurred_at timestamp, domain string, step string, _batch_id long"
    )
    name, partitions = layers.table("system", "alert_occurrences"), ["domain", "step", "_batch_id"]
    create_table(spark, name, line.schema, partitions, "One row per failed step of a batch")
    overwrite_partitions(line, name, partitions)
    return name


def note_alert(
    spark: SparkSession, layers: Layers, policy: MaskingPolicy, domain: str, batch_id: int, step: str, error: Exception, at: dt.datetime
) -> bool:
    """Add one occurrence, and say whether it notifies or is silent; the kinds of errors that are known are kept in ``system.alert_state``.

    A batch that runs again meets its own occurrence: that is no new one, and notifies if it did.
    """
    name = layers.table("system", "alert_state")
    record_alert(spark, layers, domain, batch_id, step, error, at)
    row = (type(error).__name__, str(error), at, domain, batch_id)
    line = spark.createDataFrame([row], "error_type string, error_message string, occurred_at timestamp, domain string, batch_id long")
    return advance_stored(spark, name, line, policy).filter("notifies").count() > 0


def advance_stored(spark: SparkSession, name: str, occurrences: DataFrame, policy: MaskingPolicy) -> DataFrame:
    """Take new occurrences into the stored state of all kinds of errors; gives their decisions.

    Only the buckets of the kinds that occurred are read and written.
    """
    bucket = F.pmod(F.xxhash64("error_fingerprint"), F.lit(ALERT_BUCKETS)).cast("int")
    known = None
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
        own = occurrences.select(error_fingerprint(F.col("error_type"), F.col("error_message")).alias("error_fingerprint"))
        touched = [r[0] for r in own.select(bucket).distinct().collect()]  # all buckets at most
        known = written(spark.table(name).filter(F.col("_bucket").isin(touched)).drop("_bucket"), "alerts")
    log, decisions = advance_alerts(known, occurrences, policy)
    if known is not None:
        log = log.unionByName(known.join(log.select("error_fingerprint"), "error_fingerprint", "left_anti"))
    log = written(log.withColumn("_bucket", bucket), "alerts")
    create_table(spark, name, log.schema, ["_bucket"], "One row per error fingerprint")
    switch_partitions(log, name, ["_bucket"])
    return decisions


def advance_alerts(known: DataFrame | None, occurrences: DataFrame, policy: MaskingPolicy) -> tuple[DataFrame, DataFrame]:
    """(log, decisions): the log rows of the kinds that occurred, and (error_fingerprint, at, notifies) for every new moment.

    ``known`` is the log so far, None for an empty one.  The end of silence that it carries is where each kind's chain goes on, so no older occurrence is read.
    Batches come in the order of time; an occurrence that lies before what is known is silent, and only moves the first occurrence back.
    """
    times = _moments(occurrences)
    silence = F.make_dt_interval(hours=F.lit(policy.silence_hours))
    open_ = times.select("error_fingerprint", "at")
    if known is not None:
        until = known.select("error_fingerprint", F.unix_micros("silenced_until").alias("until"))
        open_ = open_.join(until, "error_fingerprint", "left").filter("until IS NULL OR at > until").drop("until")
    notified = written(notifications(open_, policy), "notified")
    fresh = _log(times, notified, silence, "left")
    decisions = times.select("error_fingerprint", "at").join(notified.withColumn("notifies", F.lit(True)), ["error_fingerprint", "at"], "left")
    decisions = decisions.select("error_fingerprint", F.timestamp_micros("at").alias("at"), F.coalesce("notifies", F.lit(False)).alias("notifies"))
    if known is None:
        return written(fresh, "alerts"), decisions
    old = known.select("error_fingerprint", F.struct(*known.columns).alias("old"))
    both = fresh.select("error_fingerprint", F.struct(*fresh.columns).alias("new")).join(old, "error_fingerprint", "left")
    earlier = F.col("old").isNotNull() & (F.col("old.first_occurrence") <= F.col("new.first_occurrence"))
    merged = {c: F.when(earlier, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")) for c in fresh.columns}
    merged["last_occurrence"] = F.greatest("old.last_occurrence", "new.last_occurrence")
    merged["occurrence_count"] = F.coalesce("old.occurrence_count", F.lit(0)) + F.col("new.occurrence_count")
    merged["silenced_until"] = F.greatest("old.silenced_until", "new.silenced_until")
    return written(both.select(*(v.alias(c) for c, v in merged.items())), "alerts"), decisions


def alert_log(spark: SparkSession, layers: Layers, policy: MaskingPolicy) -> DataFrame:
    """The masked log of all recorded occurrences."""
    history = spark.table(layers.table("system", "alert_occurrences"))
    return mask_alerts(history.withColumnRenamed("_batch_id", "batch_id"), policy)


def refresh_alert_log(spark: SparkSession, layers: Layers, policy: MaskingPolicy) -> str:
    """Write the masked log anew from the recorded occurrences."""
    name, log = layers.table("system", "alert_logs"), alert_log(spark, layers, policy)
    create_table(spark, name, log.schema, comment="One row per error fingerprint")
    log.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    return name


def notifications(times: DataFrame, policy: MaskingPolicy, keys: tuple[str, ...] = ("error_fingerprint",)) -> DataFrame:
    """The times of each fingerprint that notify.  ``times`` has one row per (keys, ``at``), in microseconds."""
    bucket = F.floor(F.col("at") / BUCKET_MICROS).alias("bucket")
    silence = policy.silence_hours * 3_600_000_000
    points = times.select(*keys, "at", bucket)
    ends = times.select(*keys, F.col("at").alias("start"), (F.col("at") + silence).alias("at")).select("*", bucket)
    jumps = first_after(ends, points, keys, "at", "bucket", "next_at").select(
        *keys, F.col("start").alias("at"), "next_at"
    )
    return mark_chain(jumps, keys, "at", "next_at")


def mask_alerts(occurrences: DataFrame, policy: MaskingPolicy) -> DataFrame:
    """The alert log after all occurrences.

    ``occurrences`` needs error_type, error_message, domain, batch_id and
    occurred_at.  ``occurrence_count`` counts notifications, as each of them
    updates the log; silent occurrences only move ``last_occurrence``.
    """
    times = _moments(occurrences)
    return _log(times, notifications(times, policy), F.make_dt_interval(hours=F.lit(policy.silence_hours)), "inner")


def _moments(occurrences: DataFrame) -> DataFrame:
    """Occurrences of one kind and one moment as one row; all later steps read this smaller table."""
    first = F.min(
        F.struct(
            F.col("batch_id").cast("string").alias("batch_id"),
            "domain",
            "error_type",
            short_message(F.col("error_message")).alias("error_message"),
        )
    )
    return written(
        occurrences.groupBy(
            error_fingerprint(F.col("error_type"), F.col("error_message")).alias("error_fingerprint"),
            F.unix_micros("occurred_at").alias("at"),
        ).agg(first.alias("details")),
        "alerts",
    )


def _log(times: DataFrame, notified: DataFrame, silence: Column, how: str) -> DataFrame:
    log = times.groupBy("error_fingerprint").agg(
        F.min(F.struct("at", "details")).alias("first"), F.max("at").alias("last_at")
    )
    told = notified.groupBy("error_fingerprint").agg(F.count("*").alias("occurrence_count"), F.max("at").alias("last_notified"))
    return log.join(told, "error_fingerprint", how).select(
        F.col("error_fingerprint").alias("alert_id"),
        "first.details.error_type",
        "first.details.error_message",
        "error_fingerprint",
        F.timestamp_micros("first.at").alias("first_occurrence"),
        F.timestamp_micros("last_at").alias("last_occurrence"),
        F.coalesce("occurrence_count", F.lit(0)).alias("occurrence_count"),
        (F.timestamp_micros("last_notified") + silence).alias("silenced_until"),
        "first.details.domain",
        "first.details.batch_id",
    )
