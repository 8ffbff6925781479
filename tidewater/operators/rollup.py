"""Daily rollups, from code or from a contract's list of metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.contracts import Contract, RollupMetric

# Contract frequencies and the date unit they group by.
FREQUENCIES = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}
_AGGREGATES = {"min": F.min, "max": F.max, "avg": F.avg}


def rollup(df: DataFrame, keys: Sequence[str], event_time: str, metrics: Sequence[RollupMetric]) -> DataFrame:
    """``<operation>_<metric>`` columns per key and period.

    min, max and avg all reduce inside each task first, so a key with a third of
    all rows sends one line per task and period.  Averages are rounded to six
    digits because the order of a distributed sum is not fixed.
    """
    frequencies = {m.frequency for m in metrics}
    if len(frequencies) != 1:
        raise ValueError(f"one rollup has one frequency, not {sorted(frequencies)}")
    unit = FREQUENCIES[frequencies.pop()]
    period = F.to_date(event_time) if unit == "day" else F.date_trunc(unit, event_time)
    columns = []
    for m in metrics:
        for operation in m.operations:
            value = _AGGREGATES[operation](m.metric)
            columns.append((F.round(value, 6) if operation == "avg" else value).alias(f"{operation}_{m.metric}"))
    return df.groupBy(*keys, period.alias("date")).agg(*columns)


def partial_rollup(df: DataFrame, keys: Sequence[str], event_time: str, metrics: Sequence[RollupMetric]) -> DataFrame:
    """Rows, counts, sums and extremes per key and day: what rollups of parts of a day are merged from."""
    columns = [F.count("*").alias("_rows")]
    for m in metrics:
        columns += [f(m.metric).alias(f"_{name}_{m.metric}") for name, f in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))]
    return df.groupBy(*keys, F.to_date(event_time).alias("date")).agg(*columns)


def merged_rollup(parts: DataFrame, keys: Sequence[str], metrics: Sequence[RollupMetric]) -> DataFrame:
    """The rollup of all parts, with the columns that ``rollup`` gives."""
    columns = []
    for m in metrics:
        values = {
            "min": F.min(f"_min_{m.metric}"),
            "max": F.max(f"_max_{m.metric}"),
            "avg": F.round(F.sum(f"_sum_{m.metric}") / F.sum(f"_n_{m.metric}"), 6),
        }
        columns += [values[operation].alias(f"{operation}_{m.metric}") for operation in m.operations]
    return parts.groupBy(*keys, "date").agg(*columns)


def rollup_grains(df: DataFrame, keys: Sequence[str], event_time: str, metrics: Sequence[RollupMetric]) -> DataFrame:
    """(keys, grain, date, ``<operation>_<metric>``) for metrics of any frequencies; ``date`` is the start of the period.

    The data are read and reduced once, to the finest period that is asked for; those partial rows are merged upwards.  Hours and days
    are parts of every longer period, and weeks are made from days, as they cross months.  A column is NULL at a
    grain that its metric is not asked for.  Rows without event time are of no period.
    """
    units = {FREQUENCIES[m.frequency]: m.frequency for m in metrics}
    finest = "hour" if "hour" in units else "day"
    pairs = {m.metric for m in metrics}
    parts = [f(m).alias(f"_{name}_{m}") for m in sorted(pairs) for name, f in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))]
    partial = df.filter(F.col(event_time).isNotNull()).groupBy(*keys, F.date_trunc(finest, event_time).alias("_at")).agg(*parts)
    periods = [F.struct(F.lit(name).alias("grain"), F.date_trunc(unit, F.col("_at")).alias("date")) for unit, name in units.items()]
    grown = partial.withColumn("_p", F.explode(F.array(*periods))).select("*", "_p.*")
    asked = {}
    for m in metrics:
        for operation in m.operations:
            asked.setdefault((operation, m.metric), set()).add(m.frequency)
    columns = []
    for (operation, metric), grains in asked.items():
        merged = {
            "min": F.min(f"_min_{metric}"),
            "max": F.max(f"_max_{metric}"),
            # Of no value at all there is no average.
            "avg": F.round(F.try_divide(F.sum(f"_sum_{metric}"), F.sum(f"_n_{metric}")), 6),
        }[operation]
        columns.append(F.when(F.col("grain").isin(sorted(grains)), merged).alias(f"{operation}_{metric}"))
    return grown.groupBy(*keys, "grain", "date").agg(*columns)


def contract_rollup(df: DataFrame, contract: Contract) -> DataFrame:
    """What the contract lists: of one frequency without, of several with a column ``grain``."""
    life = contract.lifecycle
    several = len({m.frequency for m in life.rollups}) > 1
    return (rollup_grains if several else rollup)(df, life.rollup_keys, contract.event_time_column, life.rollups)


def iot_daily(df: DataFrame) -> DataFrame:
    metrics = [RollupMetric(m) for m in ("temperature", "humidity", "ph", "soil_moisture")]
    return rollup(df, ["sensor_id", "location_id"], "reading_timestamp", metrics).withColumnRenamed("location_id", "location")


def weather_daily(df: DataFrame) -> DataFrame:
    return rollup(df, ["city"], "forecast_timestamp", [RollupMetric("temperature"), RollupMetric("humidity")])
