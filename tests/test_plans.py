"""What the optimizer makes of the queries."""

import re

import pytest

from tidewater.plans import QUERIES

SF = "/root/testdata/sf0.001"

# Queries that build a plan without running a stream or a table write first.
PLANNED = """scan_parquet rescue_json split_valid dedup_full_row merge_upsert merge_composite_key iot_daily_rollup
weather_daily_rollup rollup_from_contract sales_fact_d1 inventory_fact_d1 sales_star violation_report table_profile
batch_error_rate batch_watermark schema_registry error_fingerprint""".split()


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_rows_no_cross_join_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"PythonUDF|EvalPython|MapInPandas|FlatMapGroups", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # Only global aggregates, of one partial row per task, may meet in one partition.
    assert not re.search(r"Window.*\n.*Sort.*\n.*Exchange SinglePartition", text)


def test_scan_reads_only_declared_columns(spark):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["scan_parquet"](spark, SF))).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "l_extendedprice",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
    ]


def test_day_cut_reaches_the_scan(spark):
    text = plan(QUERIES["inventory_fact_d1"](spark, SF))
    assert "l_extendedprice" not in text and "l_shipdate" in re.search(r"DataFilters: \[([^\]]*)\]", text).group(1)


def test_lines_are_parsed_once(spark):
    text = plan(QUERIES["split_valid"](spark, SF))
    assert text.count("from_json(") <= 1


def test_rollup_reduces_before_its_only_shuffle(spark):
    text = plan(QUERIES["iot_daily_rollup"](spark, SF))
    assert text.count("Exchange ") == 1 and "partial_avg" in text


def test_winners_reduce_before_the_shuffle(spark):
    assert "partial_max" in plan(QUERIES["merge_composite_key"](spark, SF))
