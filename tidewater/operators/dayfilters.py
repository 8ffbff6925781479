"""Bloom filters of stored keys by day: which days may hold a key, without reading them.

A filter is split into blocks by key hash, and a block is an array of longs.  Everything is column expressions: a block is built by
or-ing bits, and a key is tested against the blocks of its own number alone.  A filter may name a day that does not hold a key, never the reverse, as bits are
stored before the rows are and are only ever added.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.tables import create_table, overwrite_partitions
from tidewater.session import written

#: Bits of a block and bits that a key sets in it.
BITS, HASHES = 1 << 15, 4
BLOCK = "block"
#: Keys of a batch that are tested one by one: of more, one in a hundred false ones names each day that is near its size.
MOST_TESTED = 20_000


class DayFilters:
    """Filters of one table's keys by its date column.  ``blocks`` times about 3,000 keys a day keep false days below one key in a hundred."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], date: str, blocks: int):
        self.spark, self.name, self.keys, self.date, self.blocks = spark, name, list(keys), date, blocks

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.blocks)).cast("int")

    def _places(self) -> Column:
        """Bits of a key in its block."""
        first, step = F.xxhash64(F.lit(1), *self.keys), F.xxhash64(F.lit(2), *self.keys)
        # Kept small enough that no sum overflows.
        return F.array(*(((F.pmod(first, F.lit(BITS)) + k * (F.pmod(step, F.lit(BITS // 2)) * 2 + 1)) % BITS).cast("int") for k in range(HASHES)))

    def add(self, keyed: DataFrame) -> None:
        """Set the bits of rows that are about to be stored; only the filters of their days are written.

        A key goes to its block as one row and is split into its bits there.  Every word of a block is a row, so a block's array is its sorted words.
        """
        keys = keyed.select(F.col(self.date).alias("day"), self._block().alias(BLOCK), self._places().alias("bits")).repartition("day", BLOCK)
        places = keys.select("day", BLOCK, F.explode("bits").alias("bit"))
        words = places.select("day", BLOCK, F.expr("cast(bit div 64 as int)").alias("word"), F.expr("shiftleft(1L, bit % 64)").alias("bits"))
        fresh = written(words.groupBy("day", BLOCK, "word").agg(F.bit_or("bits").alias("bits")), "words")
        own = T.StructType([T.StructField(BLOCK, T.IntegerType()), T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("day", T.DateType())])
        create_table(self.spark, self.name, own, ["day"], "Bloom filters of the keys of each day")
        touched = fresh.select("day", BLOCK).distinct()
        days = [r[0] for r in touched.select("day").distinct().collect()]  # the days of one batch
        empty = touched.select("day", BLOCK, F.explode(F.sequence(F.lit(0), F.lit(BITS // 64 - 1))).alias("word"), F.lit(0).cast("long").alias("bits"))
        stored = self.spark.table(self.name).filter(self._listed("day", days)).select("day", BLOCK, F.posexplode("bits").alias("word", "bits"))
        merged = fresh.unionByName(empty).unionByName(stored).groupBy("day", BLOCK, "word").agg(F.bit_or("bits").alias("bits"))
        blocks = merged.groupBy("day", BLOCK).agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits"))
        overwrite_partitions(written(blocks.select(BLOCK, "bits", "day"), "filter"), self.name, ["day"])

    def possible(self, keyed: DataFrame, horizon_days: int) -> list[dt.date | None]:
        """Days from ``horizon_days`` before a key's own day on that may hold it; a key without a day may be of any.

        Rows without a day are a day of their own, within everyone's horizon.  Of many keys some pass the filter of any day that is not small, so
        they are not tested one by one against each day: all days within the horizon may hold one of them.
        """
        if not self.spark.catalog.tableExists(self.name):
            return []
        batch = keyed.agg(F.count("*").alias("keys"), F.min(self.date).alias("least"), F.count_if(F.col(self.date).isNull()).alias("dayless")).first()
        if batch["keys"] > MOST_TESTED:
            stored = self.spark.table(self.name)
            if not batch["dayless"]:
                stored = stored.filter(F.col("day").isNull() | (F.col("day") >= F.date_sub(F.lit(batch["least"]), horizon_days)))
            return [r[0] for r in stored.select("day").distinct().collect()]
        tested = keyed.select(F.col(self.date).alias("own"), self._block().alias(BLOCK), self._places().alias("places"))
        set_ = F.forall("places", lambda p: F.get("bits", F.floor(p / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p % 64)) != 0)
        near = F.col("day").isNull() | F.col("own").isNull() | (F.col("day") >= F.date_sub("own", horizon_days))
        found = tested.join(self.spark.table(self.name), BLOCK).filter(near & set_)
        return [r[0] for r in found.select("day").distinct().collect()]

    @staticmethod
    def _listed(column: str, days: Sequence[dt.date | None]) -> Column:
        """A filter on the date column, answered from the catalog."""
        named = F.col(column).isin([d for d in days if d is not None])
        return named | F.col(column).isNull() if None in days else named

    def listed(self, days: Sequence[dt.date | None]) -> Column:
        return self._listed(self.date, days)
