"""Rules on rows and on whole schemas.  Rules only report; they never drop a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import Contract

# Usual ranges of the numeric fields of each domain.
USUAL_RANGES: dict[str, dict[str, tuple[float, float]]] = {
    "iot_sensors": {
        "temperature": (15.0, 40.0),
        "humidity": (30.0, 95.0),
        "ph": (4.0, 9.0),
        "soil_moisture": (10.0, 80.0),
    },
    "weather_external": {"temperature": (-5.0, 45.0), "humidity": (20.0, 100.0)},
    "sales_online": {"amount": (1.0, 500.0), "quantity": (1, 20)},
    "inventory_erp": {"quantity_available": (0, 10000), "quantity_reserved": (0, 500)},
}


def range_rules(ranges: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    """Value present but outside its range."""
    return {
        f"out_of_range:{name}": F.col(name).isNotNull() & ~F.col(name).between(low, high)
        for name, (low, high) in ranges.items()
    }


def empty_rules(fields: Sequence[str]) -> dict[str, Column]:
    """Text present but blank."""
    return {f"empty:{name}": F.col(name).isNotNull() & (F.trim(name) == "") for name in fields}


def required_rules(contract: Contract) -> dict[str, Column]:
    return {f"missing:{name}": F.col(name).isNull() for name in contract.required}


def stale_rule(event_time: str, cutoff: Column) -> dict[str, Column]:
    return {f"stale:{event_time}": F.col(event_time).isNotNull() & (F.col(event_time) < cutoff)}


def type_rule(contract: Contract) -> dict[str, Column]:
    return {"wrong_type": F.col(contract.rescued_column).isNotNull()}


def contract_rules(contract: Contract) -> dict[str, Column]:
    """All rules that follow from the contract and the usual ranges of its domain."""
    texts = [f.name for f in contract.fields if isinstance(f.spark_type, T.StringType)]
    declared = {f.name for f in contract.fields}
    ranges = {k: v for k, v in USUAL_RANGES.get(contract.domain, {}).items() if k in declared}
    return type_rule(contract) | required_rules(contract) | empty_rules(texts) | range_rules(ranges)


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (row, broken rule), in a column ``rule``."""
    broken = F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules.items())))
    return df.withColumn("rule", F.explode(broken))


def violation_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Broken rows per rule.

    Counted as one aggregate of all rules over one scan; no row is multiplied,
    and every rule appears, with zero if never broken.
    """
    counts = df.agg(*(F.count_if(broken).alias(f"n{i}") for i, broken in enumerate(rules.values())))
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("violations")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, all rows, NULL rows.  One scan, one aggregate."""
    counts = df.agg(
        F.count("*").alias("_rows"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns))
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(i + 1).alias("ordinal"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def contract_fields(spark: SparkSession, contract: Contract) -> DataFrame:
    schema = "name string, declared_type string, nullable boolean"
    return spark.createDataFrame([(f.name, f.type, f.nullable) for f in contract.fields], schema)


def data_conformance(observed: DataFrame, total: Column, contract: Contract) -> DataFrame:
    """Landed fields against the contract: ``ok``, ``missing``, ``extra``, ``retyped`` or ``incomplete``.

    ``observed`` has one row per field name (see ``observed_fields``); ``total`` is
    the column of ``observed`` or a literal with the number of landed rows.
    """
    declared = contract_fields(observed.sparkSession, contract)
    joined = declared.join(observed.withColumn("total", total), "name", "full_outer")
    gaps = (F.col("present") - F.col("nulls")) < F.col("total")
    status = (
        F.when(F.col("declared_type").isNull(), "extra")
        .when(F.col("present").isNull(), "missing")
        .when(F.col("misfits") > 0, "retyped")
        .when(~F.col("nullable") & gaps, "incomplete")
        .otherwise("ok")
    )
    return joined.select(
        "name",
        "declared_type",
        F.coalesce("present", F.lit(0)).alias("present"),
        F.coalesce("misfits", F.lit(0)).alias("misfits"),
        status.alias("status"),
    )


def schema_conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """A table's columns against the contract's fields: missing, extra or retyped."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        [(f.name, f.spark_type.simpleString()) for f in contract.fields], "name string, declared string"
    )
    found = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "name string, actual string")
    status = (
        F.when(F.col("declared").isNull(), "extra")
        .when(F.col("actual").isNull(), "missing")
        .when(F.col("actual") != F.col("declared"), "retyped")
        .otherwise("ok")
    )
    return wanted.join(found, "name", "full_outer").withColumn("status", status)
