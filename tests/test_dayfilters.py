"""Day filters and tiles of any size: large batches are not tested key by key, and no task ranks all values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import dayfilters
from tidewater.plans.registry import new_layers
from tidewater.plans.source_queries import last_of_tiles

DAY = dt.date(2024, 1, 1)


def keyed(spark, *rows):
    return spark.createDataFrame([(k, None if d is None else DAY + dt.timedelta(days=d)) for k, d in rows], "k string, d date")


def test_many_keys_name_all_days_within_the_horizon(spark, monkeypatch):
    filters = dayfilters.DayFilters(spark, new_layers(spark).table("silver", "few_filters"), ["k"], "d", 4)
    for rows in ((("a", 0), ("b", 5)), (("c", 0), ("e", None))):
        filters.add(keyed(spark, *rows))

    def days(batch, horizon):
        return sorted((None if d is None else (d - DAY).days for d in filters.possible(keyed(spark, *batch), horizon)), key=str)

    assert days([("a", 9), ("c", 9)], 30) == [0] and days([("b", 9)], 30) == [5] and days([("e", 9)], 3) == [None]
    monkeypatch.setattr(dayfilters, "MOST_TESTED", 1)
    assert days([("a", 9), ("x", 8)], 3) == [5, None]
    assert days([("a", 9), ("x", 8)], 30) == [0, 5, None]
    assert days([("a", 9), ("x", None)], 3) == [0, 5, None]


@pytest.mark.parametrize("rows", [0, 1, 7, 10, 1003])
def test_tiles_end_where_ntile_ends_them(spark, rows):
    numbers = spark.range(rows).select(F.format_string("%05d", F.col("id") * 7919 % 10007).alias("v"))
    ordered = sorted(r[0] for r in numbers.collect())
    small, larger = divmod(rows, 10)
    ends = [small * t + min(t, larger) for t in range(1, 11)]
    assert last_of_tiles(numbers, "v", 10) == [ordered[e - 1] for e in dict.fromkeys(ends) if e]
