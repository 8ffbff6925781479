"""Registered queries with the SQL they must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.tables import Layers
from tidewater.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, dates: str = "") -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is SQL over the given tables with the same columns and rows.

    ``dates`` names date columns.  Both sides give them as ISO text, since the two
    engines hand dates to Python in different forms.
    """

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Times in the given tables have no zone; they are read, and given back, as UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _zoneless(build(spark, sf_dir), dates.split())

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if oracle:
            texts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates.split())
            ORACLES[name] = f"SELECT * REPLACE ({texts}) FROM ({oracle})" if texts else oracle
        return build

    return register


def _zoneless(df: DataFrame, dates: list[str]) -> DataFrame:
    def plain(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(f.name)
        return column.cast("string").alias(f.name) if f.name in dates else column

    return df.select(*map(plain, df.schema.fields))


def new_layers(spark: SparkSession) -> Layers:
    """Layer databases of their own for one run, below the shared scratch folder."""
    layers = Layers(scratch_root(spark), f"t{uuid.uuid4().hex[:10]}_")
    layers.create(spark)
    return layers
