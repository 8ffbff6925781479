"""Schema registry snapshots and the definitions of the gold and system tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import CONTRACTS, Contract, struct_type
from tidewater.operators.lifecycle import AUDIT_SCHEMA
from tidewater.operators.tables import SEGMENT, Layers, create_table, overwrite_partitions
from tidewater.operators.upsert import KEY_BUCKET, partition_layout

ACTIVE, DEPRECATED = "active", "deprecated"

# Columns of the gold and system tables, as Spark DDL, and their partition column.
TABLES: dict[tuple[str, str], tuple[str, tuple[str, ...], str]] = {
    ("gold", "sales_fact_d1"): (
        "transaction_id string, customer_id string, amount double, currency string, batch_id string, "
        "ingest_timestamp timestamp, transaction_date date",
        ("transaction_date",),
        "Sales facts up to yesterday",
    ),
    ("gold", "inventory_fact_d1"): (
        "product_id string, warehouse_id string, quantity bigint, batch_id string, ingest_timestamp timestamp, "
        "movement_date date",
        ("movement_date",),
        "Inventory movements up to yesterday",
    ),
    ("gold", "iot_daily_obt"): (
        "sensor_id string, location string, min_temperature double, max_temperature double, avg_temperature double, "
        "min_humidity double, max_humidity double, avg_humidity double, min_ph double, max_ph double, avg_ph double, "
        "min_soil_moisture double, max_soil_moisture double, avg_soil_moisture double, batch_id string, "
        "ingest_timestamp timestamp, date date",
        ("date",),
        "Daily sensor rollup",
    ),
    ("gold", "weather_daily_obt"): (
        "city string, min_temperature double, max_temperature double, avg_temperature double, min_humidity double, "
        "max_humidity double, avg_humidity double, batch_id string, ingest_timestamp timestamp, date date",
        ("date",),
        "Daily weather rollup",
    ),
    ("system", "alert_logs"): (
        "alert_id string, error_type string, error_message string, error_fingerprint string, "
        "first_occurrence timestamp, last_occurrence timestamp, occurrence_count bigint, silenced_until timestamp, "
        "domain string, batch_id string",
        (),
        "One row per error fingerprint",
    ),
    ("system", "schema_registry_snapshots"): (
        "schema_version string, schema_json string, created_timestamp timestamp, pipeline_git_hash string, "
        "status string, domain string",
        ("domain",),
        "One row per dataset and contract version",
    ),
    ("system", "lifecycle_audit"): (
        f"{AUDIT_SCHEMA}, _batch_id long",
        ("_batch_id", "operation_type", "table_name"),
        "One row per maintenance operation",
    ),
}


def create_tables(spark: SparkSession, layers: Layers, contracts: dict[str, Contract] = CONTRACTS) -> list[str]:
    """Create the layer databases, the clean table of every contract, and the gold and system tables."""
    layers.create(spark)
    names = []
    for contract in contracts.values():
        schema = struct_type(contract.fields)
        have = set(schema.names)
        for meta in contract.metadata:
            if meta.name not in have:
                schema = schema.add(meta.name, T.DataType.fromDDL(meta.datatype or "string"))
        parts = [*partition_layout(contract)]
        for p in parts:
            if p not in schema.names:
                schema = schema.add(p, T.IntegerType() if p == KEY_BUCKET else T.DateType())
        if contract.sink.mode == "append":
            schema = schema.add(SEGMENT, T.StringType())
            parts.append(SEGMENT)
        name = layers.table("silver", contract.domain)
        create_table(spark, name, schema, parts, "Clean rows", {"load_mode": contract.sink.mode})
        names.append(name)
    for (layer, table), (ddl, parts, comment) in TABLES.items():
        name = layers.table(layer, table)
        create_table(spark, name, T.DataType.fromDDL(ddl), parts, comment)
        names.append(name)
    return names


def registry(snapshots: DataFrame) -> DataFrame:
    """One row per (domain, schema_version), the newest version of each domain active.

    ``snapshots`` may report a version any number of times: reports collapse to
    one row per version before anything else, so only versions are compared.
    """
    versions = snapshots.groupBy("domain", "schema_version", "schema_json").agg(
        F.min("created_timestamp").alias("created_timestamp"), F.min("pipeline_git_hash").alias("pipeline_git_hash")
    )
    newest = versions.groupBy("domain").agg(F.max(F.struct("created_timestamp", "schema_version")).alias("_newest"))
    is_newest = F.struct("created_timestamp", "schema_version") == F.col("_newest")
    return (
        versions.join(newest, "domain")
        .withColumn("status", F.when(is_newest, ACTIVE).otherwise(DEPRECATED))
        .drop("_newest")
    )


def register_contract(
    spark: SparkSession, layers: Layers, contract: Contract, at: dt.datetime, git_hash: str = "unknown"
) -> str:
    """Record the contract's schema; the dataset's other versions become deprecated.

    Only the dataset's own partition is rewritten; an unchanged version keeps its first time.
    """
    name = layers.table("system", "schema_registry_snapshots")
    ddl, parts, comment = TABLES["system", "schema_registry_snapshots"]
    create_table(spark, name, T.DataType.fromDDL(ddl), parts, comment)
    line = spark.createDataFrame(
        [(contract.domain, contract.version, struct_type(contract.fields).json(), at, git_hash)],
        "domain string, schema_version string, schema_json string, created_timestamp timestamp, pipeline_git_hash string",
    )
    known = spark.table(name).filter(F.col("domain") == contract.domain).drop("status")
    overwrite_partitions(registry(known.unionByName(line)), name, parts)
    return name


def landed_schemas(fields_per_batch: DataFrame) -> DataFrame:
    """The schema each batch landed with, from rows (domain, batch_id, created_timestamp, name).

    A batch is reduced to its distinct field names first, so a group is as small
    as a schema.  The version is a short hash of the schema text.
    """
    names = fields_per_batch.groupBy("domain", "batch_id", "name").agg(F.min("created_timestamp").alias("at"))
    batches = names.groupBy("domain", "batch_id").agg(
        F.to_json(F.array_sort(F.collect_list("name"))).alias("schema_json"), F.min("at").alias("created_timestamp")
    )
    return batches.withColumn("schema_version", F.left(F.sha2("schema_json", 256), F.lit(8)))
