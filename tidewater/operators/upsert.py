"""Key-based upsert: source rows replace target rows of the same key, other source rows are added.

* Several source rows of one key: the latest by event time wins, then the
  greatest by the other columns.
* A NULL key matches nothing, so such source rows are always added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import Contract
from tidewater.operators.changes import ChangedDays
from tidewater.operators.dedup import best_per_key, distinct_rows
from tidewater.operators.keyindex import KeyIndex
from tidewater.operators.tables import Layers, append_batch, create_table, drop_partitions, partition_values, switch_partitions
from tidewater.session import written

# Table providers that can MERGE by themselves.
MERGE_PROVIDERS = ("delta", "iceberg")
KEY_BUCKET = "_key_bucket"
#: Buckets of the index of key places: enough that a batch's tasks share them, few enough that each is a file or two.
INDEX_BUCKETS = 64


def has_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def source_winners(source: DataFrame, keys: Sequence[str], event_time: str, latest: bool = True, then: Sequence[str] = ()) -> DataFrame:
    """One row per key, the latest or earliest by ``event_time`` and ``then``; rows with a NULL key are kept, exact copies of them once.

    A row with a NULL key is grouped by all its values, so one pass serves both.
    """
    whole_row = F.struct(*(c for c in source.columns if c not in (*keys, "_file_path")))
    marked = source.withColumn("_keyless", F.when(~has_keys(keys), whole_row))
    return best_per_key(marked, [*keys, "_keyless"], [event_time, *then], latest).drop("_keyless")


def matched(winners: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that update a target row."""
    return winners.join(target.select(*keys), list(keys), "left_semi")


def unmatched(winners: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that are added."""
    return winners.join(target.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """The target after the merge.

    Target rows without a source row stay, all source winners follow.  Both sides
    hold a key at most once, so no key is hot.  The winners are stored once: they
    are needed twice, and their true size decides whether the target is shuffled.
    """
    winners = written(source_winners(source, keys, event_time), "winners")
    kept = target.join(winners.select(*keys), list(keys), "left_anti")
    return kept.unionByName(winners)


def partition_layout(contract: Contract) -> dict[str, Column]:
    """Physical partition columns of the clean table, and how a row gets its values."""
    sink = contract.sink
    if sink.key_buckets:
        return {KEY_BUCKET: F.pmod(F.xxhash64(*sink.merge_keys), F.lit(sink.key_buckets)).cast("int")}
    if sink.partition_grain == "month":
        return {f"{c}_month": F.trunc(c, "month") for c in sink.partition_by}
    return {c: F.col(c) for c in sink.partition_by}


def merge_table(
    spark: SparkSession,
    source: DataFrame,
    layers: Layers,
    contract: Contract,
    constants: Mapping[str, Column] | None = None,
) -> str:
    """Upsert ``source`` into the contract's clean table.

    ``constants`` are columns with one value for all source rows; only the winners get them.

    A table whose provider can merge does so.  For plain parquet tables only the
    partitions with a changed row are rewritten: those of the source rows and
    those that hold the old version of an updated row.  Where rows may move, the old versions' partitions come from
    the stored index of key places (``KeyIndex``); no other partition is read.  Where the partition
    follows from the key, or the contract promises that rows do not move, there is no index.  Running the same batch again gives the same table.
    """
    name, keys = layers.table("silver", contract.domain), list(contract.sink.merge_keys)
    layout = partition_layout(contract)
    parts = list(layout)
    rows = source.withColumns({p: c for p, c in layout.items() if p not in source.columns})
    constants = dict(constants or {})
    create_table(spark, name, rows.withColumns(constants).schema, parts, "Clean rows, one per key")
    if provider(spark, name) in MERGE_PROVIDERS:
        same = reduce(lambda a, b: a & b, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys))
        winners = source_winners(rows, keys, contract.event_time_column).withColumns(constants).alias("s")
        winners.mergeInto(f"{name} t", same).whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return name

    target = spark.table(name)
    # Stored once: the index, the days, the old versions and the write each read the columns they need.
    winners = written(source_winners(rows, keys, contract.event_time_column), "winners")
    nothing_stored = partition_values(spark, name).isEmpty()
    arriving = {tuple(r) for r in winners.select(*parts).distinct().collect()}
    leaving: set[tuple] = set()
    index = None
    if contract.sink.partition_moves and not contract.sink.key_buckets:
        index = key_index(spark, layers, contract, parts)
        if not index.exists:
            index.build(target.filter(has_keys(keys)).select(*keys, *parts))
        keyed = winners.filter(has_keys(keys)).select(*keys, *parts)
        located = index.locate(keyed)
        leaving = {tuple(r) for r in index.places(located).collect()}
        index.announce(located)
    touched = sorted(arriving | leaving, key=str)
    inside = target.filter(_in_partitions(parts, touched))
    if contract.lifecycle.sync_days is not None:
        changed_days(spark, layers, contract).note(_days(contract, parts, touched, inside, winners))
    result = winners.withColumns(constants)
    if not nothing_stored:
        kept = inside.join(winners.select(*keys), keys, "left_anti")
        result = kept.unionByName(result.select(*kept.columns))
    filled = switch_partitions(result, name, parts, contract.sink.cluster_by)
    # Partitions that only lost rows may be empty now; a write leaves them as they were.
    emptied = leaving - arriving
    if emptied:
        emptied -= _values_of(target, parts, filled)
        drop_partitions(spark, name, [dict(zip(parts, values)) for values in sorted(emptied, key=str)])
    if index:
        index.commit()
    return name


def _values_of(table: DataFrame, parts: Sequence[str], specs: Sequence[Mapping[str, str | None]]) -> set[tuple]:
    """Partition values in the types of their columns."""
    texts = table.sparkSession.createDataFrame([tuple(spec[p] for p in parts) for spec in specs], ", ".join(f"`{p}` string" for p in parts))
    return {tuple(r) for r in texts.select(*(F.col(f"`{p}`").cast(table.schema[p].dataType) for p in parts)).collect()}


def event_day(contract: Contract) -> str:
    """The day column of a merged dataset: its one date field."""
    dates = [f.name for f in contract.fields if f.type == "DateType"]
    if len(dates) != 1:
        raise ValueError(f"{contract.domain}: a daily run needs one date field, found {dates}")
    return dates[0]


def changed_days(spark: SparkSession, layers: Layers, contract: Contract) -> ChangedDays:
    return ChangedDays(spark, layers.table("system", f"{contract.domain}_changed_days"))


def _days(contract: Contract, parts: Sequence[str], touched: Sequence[tuple], inside: DataFrame, winners: DataFrame) -> set:
    """Days of the rows that a merge brings and of those it replaces: the touched partitions where these are days, else read from them."""
    day = event_day(contract)
    if list(parts) == [day]:
        return {values[0] for values in touched}
    replaced = inside.join(winners.select(*contract.sink.merge_keys), list(contract.sink.merge_keys), "left_semi")
    both = replaced.select(day).union(winners.select(day)).distinct()
    return {r[0] for r in both.collect()}


def key_index(spark: SparkSession, layers: Layers, contract: Contract, parts: Sequence[str]) -> KeyIndex:
    return KeyIndex(spark, layers.table("system", f"{contract.domain}_key_places"), contract.sink.merge_keys, parts, INDEX_BUCKETS)


def write_clean(
    spark: SparkSession,
    rows: DataFrame,
    layers: Layers,
    contract: Contract,
    constants: Mapping[str, Column] | None = None,
) -> str:
    """Store clean rows the way the contract's sink asks for.

    The rescued-data column is not part of a clean table.  Copies of a row are
    stored once; an upsert needs no separate step for that, as it keeps one row per key.
    """
    rows = rows.drop(contract.rescued_column)
    if contract.sink.mode == "merge_into":
        return merge_table(spark, rows, layers, contract, constants)
    name, sink = layers.table("silver", contract.domain), contract.sink
    distinct = distinct_rows(rows, ["_file_path"])
    return append_batch(distinct, name, sink.partition_by, sink.cluster_by, "Clean rows", constants)


def _in_partitions(parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """A filter on partition columns only, answered from the catalog before any file is opened."""
    if len(parts) == 1:
        listed = F.col(parts[0]).isin([v[0] for v in values if v[0] is not None])
        return listed | F.col(parts[0]).isNull() if (None,) in values else listed
    return reduce(
        lambda a, b: a | b,
        (reduce(lambda x, y: x & y, (F.col(p).eqNullSafe(v) for p, v in zip(parts, row))) for row in values),
        F.lit(False),
    )


def provider(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").select("data_type").first()
    return details[0].lower() if details else ""
