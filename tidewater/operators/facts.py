"""Gold facts: clean rows up to yesterday, and the dimensions around them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import Contract
from tidewater.operators.tables import Layers, create_table, drop_partitions, overwrite_partitions, switch_partitions
from tidewater.operators.upsert import changed_days, event_day
from tidewater.session import written


def up_to_yesterday(df: DataFrame, date: str, as_of: dt.date) -> DataFrame:
    """Rows of days before ``as_of``; on a date-partitioned table other days are not read."""
    return df.filter(F.col(date) < F.lit(as_of))


def sales_fact(silver: DataFrame, as_of: dt.date) -> DataFrame:
    return up_to_yesterday(silver, "transaction_date", as_of).select(
        "transaction_id",
        "customer_id",
        "amount",
        "currency",
        "transaction_date",
        F.col("_batch_id").cast("string").alias("batch_id"),
        F.col("_ingest_timestamp").alias("ingest_timestamp"),
    )


def inventory_fact(silver: DataFrame, as_of: dt.date) -> DataFrame:
    return up_to_yesterday(silver, "last_updated", as_of).select(
        "product_id",
        "warehouse_id",
        F.col("quantity_available").cast("long").alias("quantity"),
        F.col("last_updated").alias("movement_date"),
        F.col("_batch_id").cast("string").alias("batch_id"),
        F.col("_ingest_timestamp").alias("ingest_timestamp"),
    )


def write_fact(fact: DataFrame, name: str, day: str, since: dt.date | None = None) -> str:
    """Store a fact table by day; each day it has rows for replaces that day's partition, so a run can be repeated.

    ``since`` limits the run to days from then on, for a daily run after the first.
    """
    rows = fact if since is None else fact.filter(F.col(day) >= F.lit(since))
    create_table(fact.sparkSession, name, fact.schema, [day], "Facts up to yesterday")
    overwrite_partitions(rows, name, [day])
    return name


@dataclass(frozen=True)
class Fact:
    """How a fact table is made from a clean table: its rows, its name and its day column."""

    build: Callable[[DataFrame, dt.date], DataFrame]
    table: str
    day: str


# The fact tables and the datasets they come from.
FACTS = {
    "sales_online": Fact(sales_fact, "sales_fact_d1", "transaction_date"),
    "inventory_erp": Fact(inventory_fact, "inventory_fact_d1", "movement_date"),
}


def sync_fact(spark: SparkSession, layers: Layers, contract: Contract, as_of: dt.date) -> tuple[str, list[dt.date]]:
    """Bring the stored fact table up to the contract's window before ``as_of``; gives its name and the days that were made anew.

    Only days that merges have changed since the last run are read and written, and a day that has lost all its rows goes.
    Later days stay noted until their time comes.  A run that dies, or is repeated, makes the same days again.
    """
    fact, lifecycle = FACTS[contract.domain], contract.lifecycle
    until = as_of - dt.timedelta(days=(lifecycle.sync_days or 1) - 1)
    ledger, name = changed_days(spark, layers, contract), layers.table("gold", fact.table)
    runs = ledger.pending()
    noted = ledger.days(runs)
    due = [day for day in noted if day < until]
    silver = spark.table(layers.table("silver", contract.domain))
    rows = fact.build(silver.filter(F.col(event_day(contract)).isin(due)), until)
    create_table(spark, name, rows.schema, [fact.day], "Facts up to yesterday")
    if due:
        rows = written(rows, "facts")
        filled = {r[0] for r in rows.select(fact.day).distinct().collect()}  # some of the due days
        switch_partitions(rows, name, [fact.day])
        drop_partitions(spark, name, [{fact.day: day} for day in due if day not in filled])
    ledger.settle(runs, [day for day in noted if day >= until])
    spark.catalog.refreshTable(name)
    return name, due


def dimension(df: DataFrame, key: str, *attributes: str) -> DataFrame:
    """The distinct members of one dimension."""
    return df.select(key, *attributes).distinct()


def star_totals(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    group_by: list[str],
    measures: Mapping[str, str],
    grain: list[str],
) -> DataFrame:
    """Measures of a fact table by dimension attributes.

    The fact is first summed to one row per combination of dimension keys and
    ``grain``: a hot customer or product joins as few rows, and the joins move
    sums instead of facts.  How each dimension is joined is left to the optimizer,
    which broadcasts only what it knows to be small.
    """
    keys = list(dict.fromkeys([*dimensions, *grain]))
    summed = fact.groupBy(*keys).agg(F.count("*").alias("facts"), *(F.sum(c).alias(n) for n, c in measures.items()))
    for key, members in dimensions.items():
        summed = summed.join(members, key)
    return summed.groupBy(*group_by).agg(F.sum("facts").alias("facts"), *(F.sum(n).alias(n) for n in measures))
