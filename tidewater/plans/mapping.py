"""The four datasets expressed over the given tables.

Every dataset reads its whole source table.  Faults that the queries look for are
planted into the values of rows, never by leaving rows out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The parameters all registered queries share.
EPOCH_DAY = dt.date(2024, 1, 1)
AS_OF = dt.date(2024, 1, 31)
INGEST_TIME = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the customer of their order.

    Line and order share the order key; the optimizer picks the join by size and
    splits a key that holds too many lines at run time.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    at = F.col("l_shipdate").cast("timestamp")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.lit("EUR").alias("currency"),
        at.alias("transaction_timestamp"),
        F.to_date(at).alias("transaction_date"),
        F.col("l_returnflag").alias("flag"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("l_shipdate").cast("timestamp")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("warehouse_id"),
        F.col("l_quantity").cast("int").alias("quantity_available"),
        F.col("l_linenumber").alias("quantity_reserved"),
        F.to_date(at).alias("last_updated"),
        at.alias("last_updated_timestamp"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("operation_id"),
        F.col("l_returnflag").alias("flag"),
    )


def iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("SENSOR-"), F.lpad(F.col("user_id").cast("string"), 10, "0")).alias("sensor_id"),
        F.concat(F.lit("LOC-"), "event_type").alias("location_id"),
        F.col("value").alias("temperature"),
        _k().alias("humidity"),
        (F.col("value") / 50).alias("ph"),
        (_k() / 2).alias("soil_moisture"),
        at.alias("reading_timestamp"),
        F.to_date(at).alias("reading_date"),
        batch_day(F.col("ts")).alias("batch_id"),
        "event_id",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("city"),
        F.col("value").alias("temperature"),
        _k().alias("humidity"),
        at.alias("forecast_timestamp"),
        F.to_date(at).alias("forecast_date"),
        batch_day(F.col("ts")).alias("batch_id"),
        "event_id",
    )


def batch_day(ts: Column) -> Column:
    """Batch of an event: days since the first day."""
    return F.datediff(F.to_date(ts), F.lit(EPOCH_DAY)).cast("long")


# The same datasets in DuckDB SQL, for the oracles.
SALES_SQL = """SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice AS amount, CAST(l_quantity AS INTEGER) AS quantity,
  'EUR' AS currency, l_shipdate AS transaction_timestamp, CAST(l_shipdate AS DATE) AS transaction_date,
  l_returnflag AS flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

INVENTORY_SQL = """SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS warehouse_id,
  CAST(l_quantity AS INTEGER) AS quantity_available, l_linenumber AS quantity_reserved,
  CAST(l_shipdate AS DATE) AS last_updated, l_shipdate AS last_updated_timestamp,
  l_orderkey || '-' || l_linenumber AS operation_id, l_returnflag AS flag
FROM lineitem"""

IOT_SQL = """SELECT 'SENSOR-' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS sensor_id, 'LOC-' || event_type AS location_id,
  value AS temperature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity, value / 50 AS ph,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) / 2 AS soil_moisture,
  ts AS reading_timestamp, CAST(ts AS DATE) AS reading_date,
  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS batch_id, event_id
FROM events"""

WEATHER_SQL = """SELECT event_type AS city, value AS temperature,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity, ts AS forecast_timestamp,
  CAST(ts AS DATE) AS forecast_date,
  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS batch_id, event_id
FROM events"""


def when_every(step: int, planted: Column, value: Column, also: Column | None = None) -> Column:
    """Plant a fault in the values of every ``step``-th event; all other rows keep theirs."""
    chosen = F.col("event_id") % step == 0
    return F.when(chosen if also is None else chosen | also, planted).otherwise(value)


def bad_reading() -> Column:
    """Rows whose temperature is planted as text: more of them on some days of the week."""
    bad_day = (F.col("batch_id") % 7).isin(2, 3)
    return ((F.col("event_id") % 10 == 0) & bad_day) | (F.col("event_id") % 40 == 0)


BAD_READING_SQL = "((event_id % 10 = 0 AND batch_id % 7 IN (2, 3)) OR event_id % 40 = 0)"
