"""Dimensions with history: one row per version of a member, and the version that was valid when a fact happened.

A version is valid from its own moment up to the next version's.  Its surrogate key follows from member and moment, so a run that is repeated gives the
same keys, and facts that hold one keep it.  The table is kept in buckets of members; a change rewrites the buckets of its members alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.dedup import best_per_key
from tidewater.operators.tables import create_table, switch_partitions

BUCKET = "_bucket"


class Dimension:
    """The stored versions of one dimension's members."""

    def __init__(self, spark: SparkSession, name: str, key: str, attributes: Sequence[str], buckets: int = 16):
        self.spark, self.name, self.key, self.attributes, self.buckets = spark, name, key, list(attributes), buckets

    def apply(self, changes: DataFrame, at: str) -> None:
        """Take in what members were from a moment on; ``changes`` has the key, the attributes and the moment ``at``.

        Changes may come in any order and more than once.  Of two reports about the same member and moment the later applied one
        counts, then the one with the greater attributes; a report that says what is known is no new version.  Rows without key or moment are no members.
        """
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        fresh = changes.select(self.key, *self.attributes, F.col(at).cast("timestamp").alias("valid_from"), F.lit(1).alias("_new"), bucket.alias(BUCKET))
        fresh = fresh.filter(F.col(self.key).isNotNull() & F.col("valid_from").isNotNull())
        result = self._versions(fresh)
        create_table(self.spark, self.name, result.schema, [BUCKET], "Members of a dimension and their versions")
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most all buckets
        if not touched:
            return
        known = self.spark.table(self.name).filter(F.col(BUCKET).isin(touched))
        known = known.select(self.key, *self.attributes, "valid_from", F.lit(0).alias("_new"), BUCKET)
        switch_partitions(self._versions(known.unionByName(fresh)), self.name, [BUCKET], [self.key, "valid_from"])

    def _versions(self, reports: DataFrame) -> DataFrame:
        """Versions of members: reports that differ from the one before, each up to the next."""
        # Repeated reports collapse inside the tasks; what is sorted is a member's own changes.
        reports = best_per_key(reports, [self.key, "valid_from", BUCKET], ["_new"]).drop("_new")
        member = Window.partitionBy(self.key).orderBy("valid_from")
        now = F.struct(*self.attributes)
        changed = reports.withColumn("_before", F.lag(now).over(member)).withColumn("_row", F.row_number().over(member))
        changed = changed.filter((F.col("_row") == 1) | ~now.eqNullSafe(F.col("_before")))
        moment = F.unix_micros("valid_from").cast("string")
        return changed.withColumn("valid_to", F.lead("valid_from").over(member)).select(
            F.left(F.sha2(F.concat_ws("|", F.col(self.key).cast("string"), moment), 256), F.lit(32)).alias("surrogate"),
            self.key,
            *self.attributes,
            "valid_from",
            "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
            BUCKET,
        )

    def as_of(self, facts: DataFrame, at: str) -> DataFrame:
        """Facts with the surrogate key and the attributes of the member's version at the moment ``at``; NULL where there was none.

        The join is on the member, and its versions are few: only their moments are compared.
        """
        versions = self.spark.table(self.name).select(F.col(self.key).alias("_member"), "surrogate", *self.attributes, "valid_from", "valid_to")
        moment = F.col(at).cast("timestamp")
        valid = (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
        return facts.join(versions, (facts[self.key] == F.col("_member")) & valid, "left").drop("_member", "valid_from", "valid_to")
