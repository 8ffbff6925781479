"""Where each merge key is stored: a table from key hashes to partitions, kept up by every merge.

A merge has to find the stored versions of its keys, and a key may have moved to another partition.  The index answers that
from the buckets of the batch's keys, so the clean table is read in the touched partitions alone.

What makes it safe: the index may name too many partitions for a key, never too few.  Entries are added *before* a merge switches
partitions and are committed after it; a run that dies in between leaves both places listed.  Folding the index keeps of each key the latest committed
entry and everything added since.  Keys that share a hash would share their places: two 64-bit hashes tell them apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.tables import create_table, switch_partitions
from tidewater.session import written

#: Merges after which the index is folded even if it has not doubled.
FOLD_AFTER = 32
BUCKET = "_bucket"


def key_hashes(keys: Sequence[str]) -> dict[str, Column]:
    return {"h1": F.xxhash64(*keys), "h2": F.xxhash64(F.lit(1), *keys)}


class KeyIndex:
    """The index of one merged table.  ``keyed`` rows have the merge keys and the partition columns, and no NULL key."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], parts: Sequence[str], buckets: int):
        self.spark, self.name, self.keys, self.parts = spark, name, list(keys), list(parts)
        self.buckets = buckets

    @property
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def build(self, keyed: DataFrame) -> None:
        """Create the index from the rows that are stored by now: the one time that all their keys are read."""
        entries = self._entries(keyed, 0)
        schema = entries.schema
        create_table(self.spark, self.name, schema, [BUCKET], "Partitions that hold a merge key", {"buckets": str(self.buckets), "merges": "0"})
        self._append(entries)
        self._set(base=str(self.spark.table(self.name).count()), added="0", folded="0")

    @property
    def empty(self) -> bool:
        return self.spark.table(self.name).isEmpty()

    def locate(self, keyed: DataFrame) -> DataFrame:
        """Each key's hashes and coming place, with ``entries``, the number of its places in the index, and of these the ``first`` and the ``last``.

        One join of narrow rows; only buckets that the keys fall into are read, none of an empty index.  A written table.
        """
        hashed = self._hashed(keyed).select(BUCKET, "h1", "h2", *self.parts)
        if self.empty:
            nothing = F.lit(None).cast(hashed.select(F.struct(*self.parts).alias("p")).schema["p"].dataType)
            return hashed.withColumns({"entries": F.lit(0).cast("long"), "first": nothing, "last": nothing})
        buckets = [r[0] for r in hashed.select(BUCKET).distinct().collect()]  # as many as the index has, at most
        own = {p: f"_own{i}" for i, p in enumerate(self.parts)}
        entries = self.spark.table(self.name).filter(F.col(BUCKET).isin(buckets)).select("h1", "h2", "at", *self.parts)
        pairs = hashed.withColumnsRenamed(own).join(entries, ["h1", "h2"], "left")
        # Grouped where they were joined; columns of fixed width are aggregated without a sort, so each is its own.
        ends = [F.min_by(p, "at").alias(f"_first{i}") for i, p in enumerate(self.parts)]
        ends += [F.max_by(p, "at").alias(f"_last{i}") for i, p in enumerate(self.parts)]
        grouped = pairs.groupBy("h1", "h2", BUCKET, *own.values()).agg(F.count("at").alias("entries"), *ends)

        def place(end: str) -> Column:
            return F.struct(*(F.col(f"_{end}{i}").alias(p) for i, p in enumerate(self.parts))).alias(end)

        placed = (F.col(o).alias(p) for p, o in own.items())
        return written(grouped.select(BUCKET, "h1", "h2", *placed, "entries", place("first"), place("last")), "located")

    def places(self, located: DataFrame) -> DataFrame:
        """The partitions that may hold a stored version of a key, each once."""
        known = located.filter("entries > 0")
        ends = known.select("first.*").union(known.select("last.*")).distinct()
        more = located.filter("entries > 2")
        if more.isEmpty():
            return ends
        # A key's entries between its first and its last one.
        buckets = [r[0] for r in more.select(BUCKET).distinct().collect()]
        entries = self.spark.table(self.name).filter(F.col(BUCKET).isin(buckets))
        between = entries.join(more.select("h1", "h2"), ["h1", "h2"], "left_semi").select(*self.parts)
        return ends.union(between).distinct()

    def announce(self, located: DataFrame) -> None:
        """Add the places that this merge is about to give its keys; keys that stay where they are add nothing."""
        at = int(self._properties()["merges"]) + 1
        stays = (F.col("entries") > 0) & F.struct(*self.parts).eqNullSafe(F.col("last"))
        self._append(located.filter(~stays).withColumn("at", F.lit(at).cast("long")))

    def commit(self) -> None:
        """The merge is done: its entries are the true places of their keys."""
        properties = self._properties()
        merges = int(properties["merges"]) + 1
        self._set(merges=str(merges))
        base, stored = int(properties["base"]), self.spark.table(self.name).count()
        added = stored - base
        if not base:
            # The first entries of an empty index: there is nothing to fold.
            self._set(base=str(stored), folded=str(merges))
        elif merges - int(properties["folded"]) >= FOLD_AFTER or added > max(base, self.buckets * 1000):
            self.fold(merges)

    def fold(self, committed: int) -> None:
        """Keep of each key the latest committed entry and all later ones; whole buckets are replaced, so a run that dies here loses none."""
        stored = self.spark.table(self.name)
        settled = F.when(F.col("at") <= committed, F.col("at"))
        latest = F.max(settled).over(Window.partitionBy(BUCKET, "h1", "h2"))
        kept = stored.withColumn("settled", latest).filter(F.col("settled").isNull() | (F.col("at") >= F.col("settled")))
        switch_partitions(kept.drop("settled").distinct(), self.name, [BUCKET], ["h1"])
        self._set(base=str(self.spark.table(self.name).count()), folded=str(committed))

    # -- storage ---------------------------------------------------------------

    def _hashed(self, keyed: DataFrame) -> DataFrame:
        buckets = int(self._properties()["buckets"]) if self.exists else self.buckets
        return keyed.withColumns(key_hashes(self.keys)).withColumn(BUCKET, F.pmod("h1", F.lit(buckets)).cast("int"))

    def _entries(self, keyed: DataFrame, at: int) -> DataFrame:
        return self._hashed(keyed).select("h1", "h2", *self.parts, F.lit(at).cast("long").alias("at"), BUCKET)

    def _append(self, entries: DataFrame) -> None:
        """Added to what is there, one file a bucket and task at most: a repeated run adds its entries twice, which does no harm."""
        columns = self.spark.table(self.name).columns
        entries.hint("rebalance", BUCKET).select(*columns).sortWithinPartitions(BUCKET, "h1").write.mode("append").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def _properties(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def _set(self, **properties: str) -> None:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({listed})")
