"""Dataset contracts: what a landed dataset must look like and how it is loaded.

A contract is a frozen dataclass.  Operators take the parts they need; nothing
here touches Spark data, only schemas.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import types as T

# The contract type names and the Spark types they stand for.
FIELD_TYPES: dict[str, T.DataType] = {
    "StringType": T.StringType(),
    "DoubleType": T.DoubleType(),
    "IntegerType": T.IntegerType(),
    "TimestampType": T.TimestampType(),
    "DateType": T.DateType(),
}

SOURCE_FORMATS = ("parquet", "json", "csv", "avro")
EVOLUTION_MODES = ("none", "additive", "all")
BREAKER_ACTIONS = ("degrade_mode", "fail_fast", "alert_only")
ROLLUP_OPERATIONS = ("min", "max", "avg")

# Which load mode each known domain must use.
REQUIRED_MODE = {
    "sales_online": "merge_into",
    "inventory_erp": "merge_into",
    "iot_sensors": "append",
    "weather_external": "append",
}


class ContractError(ValueError):
    """The contract breaks one of its own rules."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True

    def __post_init__(self) -> None:
        if self.type not in FIELD_TYPES:
            raise ContractError(
                f"field {self.name!r}: unknown type {self.type!r}; use one of {sorted(FIELD_TYPES)}"
            )

    @property
    def spark_type(self) -> T.DataType:
        return FIELD_TYPES[self.type]


@dataclass(frozen=True)
class MetadataColumn:
    """A lineage column: ``expression`` is evaluated for every row, then cast."""

    name: str
    expression: str
    datatype: str | None = None


@dataclass(frozen=True)
class WatermarkSpec:
    event_time_column: str
    delayed_threshold_minutes: int = 30
    allowed_lateness_minutes: int = 5
    monotone: bool = False


@dataclass(frozen=True)
class LateDataSpec:
    """``table_name`` is a name in the bronze layer; without one it is the dataset's, ending in ``_late``."""

    enabled: bool = False
    storage_days: int = 7
    table_name: str = ""


@dataclass(frozen=True)
class BreakerPolicy:
    max_error_percentage: float = 5.0
    degradation_minutes: int = 30
    action: str = "degrade_mode"
    auto_recover: bool = True

    def __post_init__(self) -> None:
        if self.action not in BREAKER_ACTIONS:
            raise ContractError(f"unknown breaker action {self.action!r}")


@dataclass(frozen=True)
class MaskingPolicy:
    enabled: bool = True
    silence_hours: int = 4


@dataclass(frozen=True)
class RollupMetric:
    metric: str
    operations: tuple[str, ...] = ROLLUP_OPERATIONS
    frequency: str = "daily"

    def __post_init__(self) -> None:
        unknown = set(self.operations) - set(ROLLUP_OPERATIONS)
        if unknown:
            raise ContractError(f"unknown rollup operations {sorted(unknown)}")


@dataclass(frozen=True)
class LifecycleSpec:
    ttl_days: int | None = None
    rollup_days_before_ttl: int = 1
    rollup_keys: tuple[str, ...] = ()
    rollups: tuple[RollupMetric, ...] = ()
    #: Gold table of the rollup, and columns that have another name there.
    output_table: str = ""
    #: Fact tables reach up to so many days before the day of the run; None: there are none.
    sync_days: int | None = None
    rollup_names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class SinkSpec:
    """Where and how clean rows are stored.

    ``partition_by`` names columns of the dataset.  ``partition_grain="month"``
    stores date partitions by month.  ``key_buckets`` replaces them by a hash of
    the merge keys, for keys without a bounded natural partition; a merge then
    never moves a row to another partition.  ``partition_moves=False`` promises the
    same for the columns of ``partition_by``, and spares the search for old versions
    of a row in other partitions.
    """

    mode: str
    merge_keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    partition_grain: str = "day"
    key_buckets: int = 0
    cluster_by: tuple[str, ...] = ()
    partition_moves: bool = True

    def __post_init__(self) -> None:
        if self.mode not in ("append", "merge_into"):
            raise ContractError(f"unknown sink mode {self.mode!r}")
        if self.mode == "merge_into" and not self.merge_keys:
            raise ContractError("merge_into needs merge keys")
        if self.mode == "append" and self.merge_keys:
            raise ContractError("append takes no merge keys")
        if self.partition_grain not in ("day", "month"):
            raise ContractError(f"unknown partition grain {self.partition_grain!r}")
        if self.key_buckets and self.mode != "merge_into":
            raise ContractError("key buckets need merge keys")


@dataclass(frozen=True)
class SourceSpec:
    format: str
    path: str = ""
    # Per-trigger read limit in bytes; None reads everything new in one batch.
    max_bytes_per_trigger: int | None = 134_217_728

    def __post_init__(self) -> None:
        if self.format not in SOURCE_FORMATS:
            raise ContractError(f"unknown source format {self.format!r}")


@dataclass(frozen=True)
class Contract:
    domain: str
    version: str
    fields: tuple[Field, ...]
    source: SourceSpec
    sink: SinkSpec
    event_time_column: str
    metadata: tuple[MetadataColumn, ...] = ()
    evolution_mode: str = "none"
    rescued_column: str = "_rescued_data"
    watermark: WatermarkSpec | None = None
    late_data: LateDataSpec = LateDataSpec()
    breaker: BreakerPolicy = BreakerPolicy()
    masking: MaskingPolicy = MaskingPolicy()
    lifecycle: LifecycleSpec = LifecycleSpec()
    max_retries: int = 3
    retry_wait_seconds: float = 0.0
    max_batch_minutes: int = 45

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.domain}: duplicate field names")
        if self.evolution_mode not in EVOLUTION_MODES:
            raise ContractError(f"unknown evolution mode {self.evolution_mode!r}")
        wanted = REQUIRED_MODE.get(self.domain)
        if wanted and self.sink.mode != wanted:
            raise ContractError(f"{self.domain} must be loaded with mode {wanted}")
        known = set(names) | {m.name for m in self.metadata}
        needed = (*self.sink.merge_keys, *self.sink.partition_by, *self.sink.cluster_by, self.event_time_column)
        if self.watermark:
            needed += (self.watermark.event_time_column,)
        missing = sorted(set(needed) - known)
        if missing:
            raise ContractError(f"{self.domain}: columns {missing} are not in the contract")

    @property
    def late_table(self) -> str:
        return self.late_data.table_name or f"{self.domain}_late"

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if not f.nullable)

    def with_options(self, **changes: Any) -> Contract:
        return replace(self, **changes)


def struct_type(fields: tuple[Field, ...]) -> T.StructType:
    """The Spark schema the contract's fields declare."""
    return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in fields])


def string_struct(fields: tuple[Field, ...], *extra: str) -> T.StructType:
    """The same columns as text, for sources whose values are typed after reading."""
    return T.StructType([T.StructField(n, T.StringType()) for n in (*(f.name for f in fields), *extra)])


def contract_from_config(config: dict[str, Any]) -> Contract:
    """Build a contract from a nested configuration mapping (as loaded from YAML or JSON)."""
    info, source = config["pipeline_info"], config["source"]
    validation, transforms = config["schema_validation"], config.get("transformations", {})
    sink, dlq = config["sink"], config.get("dlq", {})
    lifecycle = sink.get("lifecycle") or {}
    optimization = sink.get("optimization") or lifecycle.get("optimization") or {}
    watermark = transforms.get("watermarking") or {}
    metadata = tuple(
        MetadataColumn(m["name"], m["expression"], m.get("datatype"))
        for m in transforms.get("metadata_injection", ())
    )
    event_time = watermark.get("event_time_column")
    if event_time is None:
        timestamps = [f["name"] for f in validation["fields"] if f["type"] == "TimestampType"]
        if not timestamps:
            raise ContractError("no event time column: declare one or add a TimestampType field")
        event_time = timestamps[0]
    breaker, masking = dlq.get("circuit_breaker") or {}, dlq.get("exception_masking") or {}
    late, retry, watchdog = dlq.get("late_data") or {}, dlq.get("retry_policy") or {}, dlq.get("watchdog") or {}
    rollup = lifecycle.get("pre_aggregation") or {}
    ttl = lifecycle.get("ttl")
    window = str(lifecycle.get("sync_window") or "")
    if window and not (window.startswith("D-") and window[2:].isdigit() and int(window[2:])):
        raise ContractError(f"unknown sync window {window!r}; use D-1, D-2, ...")
    limit = (source.get("options") or {}).get("cloudFiles.maxBytesPerTrigger", 134_217_728)
    return Contract(
        domain=info["domain"],
        version=info["version"],
        fields=tuple(Field(f["name"], f["type"], f.get("nullable", True)) for f in validation["fields"]),
        source=SourceSpec(source["format"], source.get("path", ""), None if limit is None else int(limit)),
        sink=SinkSpec(
            mode=sink["mode"],
            merge_keys=tuple(sink.get("merge_keys") or ()),
            partition_by=tuple(sink.get("partition_by") or ()),
            cluster_by=tuple(optimization.get("z_order_by") or ()),
            partition_grain=sink.get("partition_grain", "day"),
            key_buckets=int(sink.get("key_buckets", 0)),
            partition_moves=bool(sink.get("partition_moves", True)),
        ),
        event_time_column=event_time,
        metadata=metadata,
        evolution_mode=validation.get("schema_evolution_mode", "none"),
        rescued_column=validation.get("rescued_data_column", "_rescued_data"),
        watermark=WatermarkSpec(
            event_time,
            watermark.get("delayed_threshold_minutes", 30),
            watermark.get("allowed_lateness_minutes", 5),
            bool(watermark.get("monotone", False)),
        )
        if watermark.get("enabled")
        else None,
        late_data=LateDataSpec(bool(late.get("enabled")), late.get("storage_days", 7), (late.get("table_name") or "").rpartition(".")[2]),
        breaker=BreakerPolicy(
            breaker.get("max_error_percentage", 5),
            breaker.get("degradation_duration_minutes", 30),
            breaker.get("action", "degrade_mode"),
            breaker.get("auto_recover", True),
        ),
        masking=MaskingPolicy(bool(masking.get("enabled")), masking.get("silence_expires_hours", 4)),
        lifecycle=LifecycleSpec(
            ttl_days=int(ttl) if ttl and str(ttl).isdigit() else None,
            rollup_days_before_ttl=rollup.get("trigger_days_before_ttl", 1),
            rollup_keys=tuple(
                f["name"]
                for f in validation["fields"]
                if f["type"] == "StringType" and not f.get("nullable", True)
            ),
            sync_days=int(window[2:]) if window else None,
            output_table=next((a["output_table"].rpartition(".")[2] for a in rollup.get("aggregations", ()) if a.get("output_table")), ""),
            rollups=tuple(
                RollupMetric(a["metric"], tuple(a["operations"]), a.get("frequency", "daily"))
                for a in rollup.get("aggregations", ())
                if rollup.get("enabled")
            ),
        ),
        max_retries=retry.get("max_retries", 3),
        retry_wait_seconds=float(retry.get("initial_interval_seconds", 0)),
        max_batch_minutes=watchdog.get("max_execution_minutes", 45),
    )


def _lineage(source: str, event_time: str, operation: str, ttl: str, date_column: str) -> tuple[MetadataColumn, ...]:
    """The 13 lineage columns of every clean row, then the derived event date."""
    return (
        MetadataColumn("_batch_id", "lit(batch_id)", "BIGINT"),
        MetadataColumn("_ingest_timestamp", "current_timestamp()", "TIMESTAMP"),
        MetadataColumn("_event_timestamp", f"col('{event_time}')", "TIMESTAMP"),
        MetadataColumn("_schema_version_id", "lit('1.0.0')", "STRING"),
        MetadataColumn("_pipeline_git_hash", "lit('unknown')", "STRING"),
        MetadataColumn("_source_system", f"lit('{source}')", "STRING"),
        MetadataColumn("_file_path", "col('_source_file')", "STRING"),
        MetadataColumn("_execution_user_id", "lit('ingest_service')", "STRING"),
        MetadataColumn("_environment_id", "lit('prod')", "STRING"),
        MetadataColumn("_cluster_id", "lit('unknown')", "STRING"),
        MetadataColumn("_processing_library_version", "lit('1.0.0')", "STRING"),
        MetadataColumn("_operation_type", f"lit('{operation}')", "STRING"),
        MetadataColumn("_retention_ttl", f"lit('{ttl}')", "STRING"),
        MetadataColumn(date_column, f"col('{event_time}').cast(DateType())", "DATE"),
    )


# The four dataset contracts.
SALES = Contract(
    domain="sales_online",
    version="1.0.0",
    fields=(
        Field("transaction_id", "StringType", False),
        Field("customer_id", "StringType", False),
        Field("product_id", "StringType", False),
        Field("amount", "DoubleType", False),
        Field("quantity", "IntegerType", False),
        Field("currency", "StringType", False),
        Field("transaction_timestamp", "TimestampType", False),
        Field("transaction_date", "DateType", False),
    ),
    source=SourceSpec("parquet"),
    sink=SinkSpec(
        "merge_into",
        merge_keys=("transaction_id",),
        partition_by=("transaction_date",),
        cluster_by=("transaction_date", "customer_id"),
    ),
    event_time_column="transaction_timestamp",
    metadata=_lineage("sales_online", "transaction_timestamp", "MERGE", "indefinite", "transaction_date"),
    lifecycle=LifecycleSpec(sync_days=1),
    breaker=BreakerPolicy(2, 30, "degrade_mode", True),
    max_retries=4,
    retry_wait_seconds=2.0,
)

INVENTORY = Contract(
    domain="inventory_erp",
    version="1.0.0",
    fields=(
        Field("product_id", "StringType", False),
        Field("warehouse_id", "StringType", False),
        Field("quantity_available", "IntegerType", False),
        Field("quantity_reserved", "IntegerType", True),
        Field("last_updated", "DateType", False),
        Field("last_updated_timestamp", "TimestampType", False),
        Field("operation_id", "StringType", False),
    ),
    source=SourceSpec("parquet"),
    sink=SinkSpec(
        "merge_into",
        merge_keys=("product_id", "warehouse_id"),
        partition_by=("warehouse_id",),
        key_buckets=32,
        cluster_by=("last_updated", "product_id"),
    ),
    event_time_column="last_updated_timestamp",
    metadata=_lineage("inventory_erp", "last_updated_timestamp", "MERGE", "indefinite", "last_updated"),
    lifecycle=LifecycleSpec(sync_days=1),
    breaker=BreakerPolicy(1, 15, "fail_fast", False),
    max_retries=3,
    retry_wait_seconds=5.0,
)

IOT = Contract(
    domain="iot_sensors",
    version="1.0.0",
    fields=(
        Field("sensor_id", "StringType", False),
        Field("location_id", "StringType", False),
        Field("temperature", "DoubleType", True),
        Field("humidity", "DoubleType", True),
        Field("ph", "DoubleType", True),
        Field("soil_moisture", "DoubleType", True),
        Field("reading_timestamp", "TimestampType", False),
        Field("reading_date", "DateType", False),
    ),
    source=SourceSpec("avro"),
    sink=SinkSpec("append", partition_by=("reading_date",), cluster_by=("reading_date", "sensor_id")),
    event_time_column="reading_timestamp",
    metadata=_lineage("iot_sensors", "reading_timestamp", "INSERT", "14", "reading_date"),
    watermark=WatermarkSpec("reading_timestamp", 30, 5),
    late_data=LateDataSpec(True, 14),
    breaker=BreakerPolicy(5, 30, "degrade_mode", True),
    lifecycle=LifecycleSpec(
        ttl_days=14,
        rollup_keys=("sensor_id", "location_id"),
        rollups=tuple(RollupMetric(m) for m in ("temperature", "humidity", "ph", "soil_moisture")),
        output_table="iot_daily_obt",
        rollup_names=(("location_id", "location"),),
    ),
)

WEATHER = Contract(
    domain="weather_external",
    version="1.0.0",
    fields=(
        Field("city", "StringType", False),
        Field("temperature", "DoubleType", True),
        Field("humidity", "DoubleType", True),
        Field("forecast_timestamp", "TimestampType", False),
        Field("forecast_date", "DateType", False),
    ),
    source=SourceSpec("json"),
    sink=SinkSpec("append", partition_by=("forecast_date",), cluster_by=("forecast_date", "city")),
    event_time_column="forecast_timestamp",
    metadata=_lineage("weather_external", "forecast_timestamp", "INSERT", "14", "forecast_date"),
    watermark=WatermarkSpec("forecast_timestamp", 30, 5),
    late_data=LateDataSpec(True, 14),
    breaker=BreakerPolicy(5, 30, "degrade_mode", True),
    lifecycle=LifecycleSpec(
        ttl_days=14,
        rollup_keys=("city",),
        rollups=tuple(RollupMetric(m) for m in ("temperature", "humidity")),
        output_table="weather_daily_obt",
    ),
)

CONTRACTS = {c.domain: c for c in (SALES, INVENTORY, IOT, WEATHER)}
