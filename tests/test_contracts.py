import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import (
    CONTRACTS,
    IOT,
    SALES,
    Contract,
    ContractError,
    Field,
    SinkSpec,
    SourceSpec,
    contract_from_config,
    struct_type,
)
from tidewater.functions.moments import collected
from tidewater.functions.expressions import ExpressionError, contract_column

AT = dt.datetime(2024, 5, 6, 7, 8, 9)


def test_schema_follows_the_contract():
    schema = struct_type(IOT.fields)
    assert schema["reading_timestamp"].dataType == T.TimestampType()
    assert not schema["sensor_id"].nullable and schema["ph"].nullable


def test_every_contract_carries_thirteen_lineage_columns():
    for contract in CONTRACTS.values():
        assert sum(m.name.startswith("_") for m in contract.metadata) == 13


@pytest.mark.parametrize(
    "broken",
    [
        lambda: Field("a", "DecimalType"),
        lambda: SinkSpec("merge_into"),
        lambda: SinkSpec("append", merge_keys=("a",)),
        lambda: SinkSpec("replace"),
        lambda: SourceSpec("xml"),
        lambda: SALES.with_options(sink=SinkSpec("append")),
        lambda: IOT.with_options(event_time_column="nowhere"),
        lambda: IOT.with_options(evolution_mode="some"),
        lambda: IOT.with_options(fields=IOT.fields + (Field("ph", "DoubleType"),)),
    ],
)
def test_broken_rules_are_refused(broken):
    with pytest.raises(ContractError):
        broken()


def test_contract_from_nested_configuration():
    contract = contract_from_config(
        {
            "pipeline_info": {"domain": "readings", "version": "2.0.0"},
            "source": {"format": "json", "path": "/in", "options": {"cloudFiles.maxBytesPerTrigger": "1000"}},
            "schema_validation": {
                "schema_evolution_mode": "additive",
                "fields": [
                    {"name": "sensor", "type": "StringType", "nullable": False},
                    {"name": "heat", "type": "DoubleType"},
                    {"name": "at", "type": "TimestampType", "nullable": False},
                    {"name": "day", "type": "DateType"},
                ],
            },
            "transformations": {
                "metadata_injection": [{"name": "day", "expression": "col('at').cast(DateType())", "datatype": "DATE"}],
                "watermarking": {"enabled": True, "event_time_column": "at", "delayed_threshold_minutes": 10},
            },
            "sink": {
                "mode": "append",
                "partition_by": ["sensor", "day"],
                "lifecycle": {
                    "ttl": "14",
                    "pre_aggregation": {"enabled": True, "aggregations": [{"metric": "heat", "operations": ["max"]}]},
                },
            },
            "dlq": {
                "late_data": {"enabled": True, "storage_days": 3},
                "circuit_breaker": {"max_error_percentage": 1, "action": "fail_fast", "auto_recover": False},
            },
        }
    )
    assert isinstance(contract, Contract)
    assert contract.source.max_bytes_per_trigger == 1000
    assert contract.watermark.delayed_threshold_minutes == 10 and contract.watermark.allowed_lateness_minutes == 5
    assert contract.lifecycle.ttl_days == 14 and contract.lifecycle.rollup_keys == ("sensor",)
    assert contract.breaker.action == "fail_fast" and not contract.breaker.auto_recover
    assert contract.late_data.storage_days == 3 and contract.evolution_mode == "additive"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("lit(batch_id)", 9),
        ("lit('x')", "x"),
        ("col('a').cast(StringType())", "5"),
        ("coalesce(col('missing'), lit(1))", 1),
        ("when(col('a') > 3, lit('big')).otherwise(lit('small'))", "big"),
        ("current_timestamp()", AT),
        ("current_date()", AT.date()),
        ("expr('a + 1')", 6),
        ("to_timestamp(lit('2024-01-02 03:04:05'))", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("word", "word"),
    ],
)
def test_allowed_expressions(spark, text, expected):
    row = spark.sql("SELECT 5 AS a, CAST(NULL AS INT) AS missing")
    found = row.select(contract_column(text, 9, AT)).first()[0]
    if isinstance(found, dt.datetime):
        # Handed over in the zone of this machine; times without a zone are UTC.
        found = collected(found).replace(tzinfo=None)
    assert found == expected


@pytest.mark.parametrize(
    "text",
    ["__import__('os')", "open('x')", "lit(1).__class__", "expr('reflect(\"a\", \"b\")')", "expr('1; drop')", "lit(", "[1 for x in y]"],
)
def test_refused_expressions(spark, text):
    with pytest.raises(ExpressionError):
        contract_column(text, 9, AT)


def test_current_timestamp_is_one_value_per_batch(spark):
    rows = spark.range(100).repartition(4).select(contract_column("current_timestamp()", 1, AT).alias("t"))
    assert rows.agg(F.count_distinct("t")).first()[0] == 1
