"""Retention: roll expiring days up, then purge them, and log both."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import Contract
from tidewater.operators.rollup import merged_rollup, partial_rollup
from tidewater.operators.tables import (
    SEGMENT,
    Layers,
    create_table,
    drop_partitions,
    overwrite_partitions,
    partition_columns,
    partition_values,
)
from tidewater.session import written

# Columns of the audit table.
AUDIT_SCHEMA = (
    "audit_id string, operation_type string, table_name string, rows_affected long, execution_time_ms long, "
    "status string, message string, execution_timestamp timestamp, batch_id string"
)


def date_column(contract: Contract) -> str:
    """The one date among the partition columns of the clean table."""
    kinds = {f.name: f.type for f in contract.fields}
    dates = [c for c in contract.sink.partition_by if kinds.get(c) == "DateType"]
    if len(dates) != 1:
        raise ValueError(f"{contract.domain}: retention needs one date among the partition columns, found {dates}")
    return dates[0]


def within_ttl(df: DataFrame, date: str, as_of: dt.date, ttl_days: int) -> DataFrame:
    """Rows that are kept: not older than ``ttl_days``."""
    return df.filter(F.col(date) >= F.lit(as_of - dt.timedelta(days=ttl_days)))


def expiring(df: DataFrame, date: str, as_of: dt.date, ttl_days: int, days_before: int = 1) -> DataFrame:
    """Rows of days that must be rolled up now, ``days_before`` the purge would take them."""
    return df.filter(F.col(date) <= F.lit(as_of - dt.timedelta(days=ttl_days - days_before)))


def purge_table(spark: SparkSession, name: str, date: str, as_of: dt.date, ttl_days: int) -> int:
    """Drop the partitions of days past their time to live; gives the number of rows dropped.

    The table is partitioned by ``date``: rows are counted from file footers, and
    none is read or rewritten.
    """
    oldest = as_of - dt.timedelta(days=ttl_days)
    rows = spark.table(name).filter(F.col(date) < F.lit(oldest)).count()
    # ISO dates order as text.
    specs = partition_values(spark, name).filter(F.col("spec")[date] < oldest.isoformat())
    drop_partitions(spark, name, [dict(r["spec"]) for r in specs.collect()])
    left = spark.table(name).filter(F.col(date) < F.lit(oldest)).count()
    if left:
        raise RuntimeError(f"{name}: {left} rows of expired days are still stored")
    return rows


def purge_late(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date) -> int:
    """Drop late rows stored longer than the contract keeps them; gives the number of segments.

    How long a batch has been stored is in its state row.
    """
    name = layers.table("bronze", contract.late_table)
    if not spark.catalog.tableExists(name):
        return 0
    oldest = dt.datetime.combine(as_of, dt.time(), dt.timezone.utc) - dt.timedelta(days=contract.late_data.storage_days)
    batches = spark.table(layers.table("system", f"{contract.domain}_batches"))
    expired = batches.filter(F.col("batch_time") < F.lit(oldest)).select(F.col("_batch_id").cast("string").alias("batch"))
    # Batches come in the order of time: a segment is as old as its last batch.
    stored = partition_values(spark, name).select(F.col("spec")[SEGMENT].alias("segment"))
    stored = stored.withColumn("batch", F.substring_index("segment", "-", -1))
    gone = [r["segment"] for r in stored.join(expired, "batch", "left_semi").collect()]
    drop_partitions(spark, name, [{SEGMENT: segment} for segment in gone])
    return len(gone)


def roll_up_expiring(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date) -> str:
    """Roll the expiring days of a clean table up into gold.

    Gold is merged from stored parts of each day.  A day is one part as long as its rows are in the
    clean table, so repeating the run is safe.  Rows that come after the day was purged are a part of their
    own: they add to the day's gold rows and do not replace them.
    """
    finish_purges(spark, layers, contract)
    return _roll_up(spark, layers, contract, as_of, _stored_places(spark, layers, contract))


def _roll_up(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date, places: DataFrame) -> str:
    """Roll up the rows of ``places``, partitions of the clean table that were listed before: what arrives meanwhile is not of this run."""
    life, silver = contract.lifecycle, layers.table("silver", contract.domain)
    date = date_column(contract)
    if {m.frequency for m in life.rollups} != {"daily"}:
        raise ValueError(f"{contract.domain}: retention rolls up by day")
    gold, keys = layers.table("gold", life.output_table or f"{contract.domain}_daily"), list(life.rollup_keys)
    due = _rows_in(expiring(spark.table(silver), date, as_of, life.ttl_days, life.rollup_days_before_ttl), places)
    fresh = written(partial_rollup(due, keys, contract.event_time_column, life.rollups), "rollup")
    parts = _parts_table(layers, contract)
    create_table(spark, parts, fresh.withColumn("part", F.lit(0)).schema, ["date", "part"], "Rollups of parts of a day")

    purged = spark.table(_purges_table(layers, contract)).groupBy("date").agg(F.max("part").alias("gone"))
    # The part after the purged ones; the rows of a part stay in the clean table until its purge is in the ledger.
    days = fresh.select("date").distinct().join(purged, "date", "left")
    days = written(days.select("date", F.coalesce(F.col("gone") + 1, F.lit(0)).cast("int").alias("part")), "days")
    overwrite_partitions(fresh.join(days, "date"), parts, ["date", "part"])

    daily = merged_rollup(spark.table(parts).join(days.select("date"), "date", "left_semi"), keys, life.rollups)
    daily = daily.withColumnsRenamed(dict(life.rollup_names))
    create_table(spark, gold, daily.schema, ["date"], "Daily rollup of expired days")
    overwrite_partitions(daily, gold, ["date"])
    return gold


def _parts_table(layers: Layers, contract: Contract) -> str:
    return layers.table("system", f"{contract.domain}_rollup_parts")


def _purges_table(layers: Layers, contract: Contract) -> str:
    return layers.table("system", f"{contract.domain}_rollup_purges")


def _stored_places(spark: SparkSession, layers: Layers, contract: Contract) -> DataFrame:
    """Partitions of the clean table as of now, with the types of its columns; read from the catalog alone."""
    name = layers.table("silver", contract.domain)
    kinds = {f.name: f.dataType for f in spark.table(name).schema.fields}
    columns = partition_columns(spark, name)
    return partition_values(spark, name).select(*(F.col("spec")[c].cast(kinds[c]).alias(c) for c in columns))


def _rows_in(rows: DataFrame, places: DataFrame) -> DataFrame:
    same = reduce(lambda a, b: a & b, (rows[c].eqNullSafe(places[c]) for c in places.columns))
    return rows.join(places, same, "left_semi")


def _place(places: DataFrame) -> Column:
    """A partition as text: its values by column."""
    return F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in places.columns)), {"ignoreNullFields": "false"})


def intend_purge(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date, places: DataFrame) -> None:
    """Note which partitions are about to be dropped, and the part of their day that holds their rows in gold.

    From now on these partitions count as purged, whatever becomes of this run: what is found in others is new.
    """
    date = date_column(contract)
    oldest = as_of - dt.timedelta(days=contract.lifecycle.ttl_days)
    gone = places.filter(F.col(date) < F.lit(oldest)).select(F.col(date).alias("date"), _place(places).alias("place"))
    last = spark.table(_parts_table(layers, contract)).groupBy("date").agg(F.max("part").alias("part"))
    noted = gone.join(last, "date", "left").select("place", F.lit(False).alias("done"), "date", F.coalesce("part", F.lit(0)).alias("part"))
    overwrite_partitions(written(noted, "purges"), _purges_table(layers, contract), ["date", "part"])


def finish_purges(spark: SparkSession, layers: Layers, contract: Contract) -> None:
    """Drop what the ledger says is purged and is still, or again, stored; then note that it is done.

    This ends a purge that a lost run began.  A partition that comes back is the batch that filled it run once more: its rows are in gold.
    """
    ledger = _purges_table(layers, contract)
    schema = T.StructType.fromDDL("place string, done boolean, date date, part int")
    create_table(spark, ledger, schema, ["date", "part"], "Partitions that were rolled up and purged, or are about to be")
    name = layers.table("silver", contract.domain)
    if not spark.catalog.tableExists(name):
        return
    stored = _stored_places(spark, layers, contract)
    back = stored.select(_place(stored).alias("place")).join(spark.table(ledger).select("place"), "place", "left_semi").distinct()
    drop_partitions(spark, name, [json.loads(r["place"]) for r in back.collect()])
    open_days = spark.table(ledger).filter("not done").select("date", "part").distinct()
    settled = spark.table(ledger).join(open_days, ["date", "part"], "left_semi").withColumn("done", F.lit(True))
    settled = written(settled, "purges")
    if not settled.isEmpty():
        overwrite_partitions(settled, ledger, ["date", "part"])


def rollup_then_purge(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date) -> tuple[str, int]:
    """Roll up, and only then purge: a day leaves the clean table after its rollup is stored.

    Three steps that may each be the last of a lost run: the rollup (repeated, it replaces itself), the note of intent, the drop (the next
    run finishes it).  Gives the gold table and the number of rows purged.
    """
    finish_purges(spark, layers, contract)
    places = _stored_places(spark, layers, contract)
    gold = _roll_up(spark, layers, contract, as_of, places)
    oldest = as_of - dt.timedelta(days=contract.lifecycle.ttl_days)
    date = date_column(contract)
    expired = spark.table(layers.table("silver", contract.domain)).filter(F.col(date) < F.lit(oldest))
    rows = _rows_in(expired, places).count()
    intend_purge(spark, layers, contract, as_of, places)
    finish_purges(spark, layers, contract)
    return gold, rows


def audited(
    spark: SparkSession,
    layers: Layers,
    operation: str,
    table: str,
    batch_id: int,
    at: dt.datetime,
    action: Callable[[], int],
) -> int:
    """Run one maintenance step and add its audit row, also when it fails."""
    started, status, message, rows = time.monotonic(), "SUCCESS", None, 0
    try:
        rows = action()
        return rows
    except Exception as error:
        status, message = "FAILED", str(error)[:500]
        raise
    finally:
        elapsed = int((time.monotonic() - started) * 1000)
        row = (uuid.uuid4().hex, operation, table, rows, elapsed, status, message, at, str(batch_id))
        line = spark.createDataFrame([row], AUDIT_SCHEMA).withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        log = layers.table("system", "lifecycle_audit")
        create_table(spark, log, line.schema, ["_batch_id", "operation_type", "table_name"], "One row per maintenance operation")
        overwrite_partitions(line, log, ["_batch_id", "operation_type", "table_name"])
