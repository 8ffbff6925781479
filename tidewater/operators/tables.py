"""Catalog tables of the layers, and the writes that may be repeated safely.

Every append table ends its partitioning with ``_segment``, which says what batches a partition is of.  A batch overwrites
only the partitions it fills, so a batch that is run again replaces its own rows; closed batches are folded later (``compaction``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import Contract
from tidewater.functions.scalars import row_salt

#: Last partition column of an append table: first and last batch of the partition's rows.
SEGMENT = "_segment"

LAYERS = {
    "bronze": "Raw rows as landed",
    "silver": "Clean rows with lineage columns",
    "quarantine": "Rows that break their contract",
    "gold": "Daily rollups and fact tables up to yesterday",
    "system": "State, audit, alerts and schema versions",
}


@dataclass(frozen=True)
class Layers:
    """Names of the layer databases.  ``root`` is where their files go; ``prefix`` keeps runs apart."""

    root: str
    prefix: str = ""

    def table(self, layer: str, name: str) -> str:
        return f"{self.prefix}{layer}.{name}"

    def create(self, spark: SparkSession) -> None:
        for layer, description in LAYERS.items():
            database = f"{self.prefix}{layer}"
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{self.root}/{database}'")
            spark.sql(f"ALTER SCHEMA {database} SET DBPROPERTIES ('description' = '{description}')")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    comment: str = "",
    properties: dict[str, str] | None = None,
) -> None:
    """Create the table unless it exists; partition columns go last, as parquet tables need."""
    if spark.catalog.tableExists(name):
        return
    fields = [f for f in schema.fields if f.name not in partition_by] + [schema[p] for p in partition_by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})"
    if comment:
        ddl += f" COMMENT '{comment}'"
    if properties:
        ddl += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(ddl)


def add_missing_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Widen the table by columns it lacks; rows already stored read as NULL there."""
    have = set(spark.table(name).columns)
    new = [f for f in schema.fields if f.name not in have]
    if new:
        spark.sql(
            f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")"
        )


def overwrite_partitions(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    constants: Mapping[str, Column] | None = None,
) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    The rebalance hint gathers each partition into few files, and splits a
    partition that holds most of the rows over several tasks.  ``constants`` are
    columns with one value for all rows; they are added after that shuffle.
    """
    with _dynamic_overwrite(df.sparkSession):
        _for_table(df, name, partition_by, cluster_by, constants or {}).write.mode("overwrite").insertInto(name)


def _for_table(
    df: DataFrame, name: str, partition_by: Sequence[str], cluster_by: Sequence[str], constants: Mapping[str, Column]
) -> DataFrame:
    """Rows with the table's columns in its order, few files to a partition."""
    rows = df.drop(*constants)
    varying = [p for p in partition_by if p in rows.columns]
    if varying:
        rows = rows.hint("rebalance", *varying)
    rows = rows.withColumns(dict(constants))
    # Columns go by position; missing ones are NULL.
    aligned = rows.select(
        *(
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in df.sparkSession.table(name).schema.fields
        )
    )
    if cluster_by:
        aligned = aligned.sortWithinPartitions(*dict.fromkeys([*partition_by, *cluster_by]))
    return aligned


def switch_partitions(df: DataFrame, name: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> list[dict[str, str | None]]:
    """Replace the partitions that ``df`` has rows for without touching the stored ones before the new ones are whole.

    The rows go to a folder of this run; then new partitions are added by the hundred and stored ones pointed to
    their new folder.  A run that ends in between leaves every row in one version or the other, for rows that no replay
    of the batch would bring back.  Folders that are no longer pointed to stay for one more run, for queries that still read them:
    the next run removes them.  Gives the values of the partitions that were written, as text.
    """
    spark = df.sparkSession
    location = table_location(spark, name)
    _remove_retired(spark, location)
    specs = append_rows_to(df, f"{location}/_versions/{uuid.uuid4().hex[:12]}", name, partition_by, cluster_by)
    written = set(specs)
    stored = {tuple(sorted(r["spec"].items())) for r in partition_values(spark, name).collect()} if written else set()
    new = sorted(path for path, spec in specs.items() if tuple(sorted(spec.items())) not in stored)
    old = sorted(written.difference(new))
    retired = {_partition_location(f) for f in _files_of(spark.table(name), [specs[path] for path in old])}
    add_partitions(spark, name, [(specs[path], path) for path in new])
    for path in old:
        spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(specs[path])}) SET LOCATION {_quoted(path)}")
    if retired:
        list_of = spark.createDataFrame([(unquote(f),) for f in sorted(retired)], "folder string")
        list_of.coalesce(1).write.mode("overwrite").parquet(f"{location}/_retired")
    spark.catalog.refreshTable(name)
    return list(specs.values())


def table_location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return details.select("data_type").first()[0].rstrip("/")


def append_rows_to(df: DataFrame, folder: str, name: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> dict[str, dict[str, str | None]]:
    """Write rows of the table to a new folder, by partition; gives the partitions' folders and values."""
    rows = _for_table(df, name, partition_by, cluster_by, {})
    rows.write.partitionBy(*partition_by).parquet(folder)
    files = df.sparkSession.read.schema(rows.drop(*partition_by).schema).parquet(folder).select(F.col("_metadata.file_path").alias("path"))
    paths = {unquote(_partition_location(r["path"])) for r in files.distinct().collect()}
    return {path: _folder_spec(path, len(partition_by)) for path in sorted(paths)}


def add_partitions(spark: SparkSession, name: str, places: Sequence[tuple[Mapping[str, object], str]]) -> None:
    """Add partitions with their folders, by the hundred; those that are there already stay as they are."""
    for start in range(0, len(places), 100):
        clauses = " ".join(f"PARTITION ({_spec(spec)}) LOCATION {_quoted(path)}" for spec, path in places[start : start + 100])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {clauses}")


def _folder_spec(path: str, depth: int) -> dict[str, str | None]:
    """Partition values of a folder; names in paths are escaped once more than the values they stand for."""
    spec = dict(map(unquote, p.split("=", 1)) for p in path.split("/")[-depth:])
    return {k: None if v == "__HIVE_DEFAULT_PARTITION__" else v for k, v in spec.items()}


def _partition_location(file: str) -> str:
    """Folder of one of a partition's files."""
    return file.rpartition("/")[0]


def _files_of(table: DataFrame, specs: Sequence[Mapping[str, object]]) -> list[str]:
    """Files of some partitions, listed without opening them."""
    files: list[str] = []
    for start in range(0, len(specs), 100):
        wanted = F.lit(False)
        for spec in specs[start : start + 100]:
            own = F.lit(True)
            for column, value in spec.items():
                own = own & F.col(f"`{column}`").eqNullSafe(F.lit(value).cast(table.schema[column].dataType))
            wanted = wanted | own
        files += table.filter(wanted).inputFiles()
    return files


def _remove_retired(spark: SparkSession, location: str) -> None:
    """Remove the folders that the last run took out of the table."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/_retired")
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop):
        return
    for row in spark.read.schema("folder string").parquet(f"{location}/_retired").collect():
        _remove_folder(spark, row["folder"])
    system.delete(hadoop, True)


def _quoted(value: object) -> str:
    return "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(spec: Mapping[str, object]) -> str:
    return ", ".join(f"`{k}` = {_quoted(v)}" for k, v in spec.items())


def _remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite by partition inside the block; the session's own setting comes back after it."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(mode, before)


def bronze_append(df: DataFrame, layers: Layers, contract: Contract, batch_id: int) -> str:
    """Distinct raw rows of one batch, rescued data included; new columns widen the table."""
    batch = {"_batch_id": F.lit(batch_id).cast("bigint")}
    return append_batch(df.dropDuplicates(), layers.table("bronze", contract.domain), comment="Raw rows as landed", constants=batch)


def append_batch(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comment: str = "",
    constants: Mapping[str, Column] | None = None,
) -> str:
    """Rows of one batch, by their ``_batch_id``, as a segment of their own; new columns widen the table."""
    constants = dict(constants or {})
    if "_batch_id" in constants:
        constants[SEGMENT] = _own_segment(constants["_batch_id"])
    else:
        df = df.withColumn(SEGMENT, _own_segment(F.col("_batch_id")))
    partitions = [*partition_by, SEGMENT]
    schema = df.withColumns(constants).schema
    create_table(df.sparkSession, name, schema, partitions, comment)
    add_missing_columns(df.sparkSession, name, schema)
    overwrite_partitions(df, name, partitions, cluster_by, constants)
    return name


def _own_segment(batch: Column) -> Column:
    text = batch.cast("string")
    return F.concat(text, F.lit("-"), text)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def partition_values(spark: SparkSession, name: str) -> DataFrame:
    """The table's partition values, read from the catalog alone, as text columns.

    Names come escaped as in paths (``%3A``); the values given are the real ones, NULL for the default partition.
    """
    listed = spark.sql(f"SHOW PARTITIONS {name}")

    def plain(escaped: Column) -> Column:
        return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))

    def piece(p: Column) -> Column:
        value = F.split(p, "=", 2)[1]
        return F.struct(plain(F.split(p, "=", 2)[0]).alias("key"), F.when(value != "__HIVE_DEFAULT_PARTITION__", plain(value)).alias("value"))

    pieces = F.transform(F.split("partition", "/"), piece)
    return listed.select(F.map_from_entries(pieces).alias("spec"))


def drop_partitions(spark: SparkSession, name: str, specs: Sequence[dict[str, object]]) -> None:
    """Remove whole partitions: a catalog and file-system operation, no rows are read.

    Dropped by the hundred, so one statement stays of a reasonable length.
    """
    for start in range(0, len(specs), 100):
        clauses = ", ".join(
            f"PARTITION ({_spec(spec)})"
            for spec in specs[start : start + 100]
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {clauses}")


#: Bits of a column's rank in a space-filling order: 256 ranges of equal numbers of rows.
RANK_BITS = 8


def _ordinal(df: DataFrame, column: str) -> Column:
    """A number in the column's order; of text the six bytes after those that all values share."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        least, most = df.agg(F.min(value.cast("binary")), F.max(value.cast("binary"))).first()
        shared = next((i for i, (x, y) in enumerate(zip(least, most)) if x != y), min(len(least), len(most))) if least is not None else 0
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), shared + 1, 6)), 12, "0"), 16, 10).cast("double")
    return (F.unix_date(value) if isinstance(kind, T.DateType) else value).cast("double")


def _bisected(value: Column, known: Column) -> Callable[[Column, Column], Column]:
    """Step of a bisection: how many of the ``known`` numbers are not above ``value``."""
    return lambda so_far, step: F.when(F.get(known, so_far + step - 1) <= value, so_far + step).otherwise(so_far)


def in_space_filling_order(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Add a number that is near for rows which are near in all ``columns``: the columns' ranks with their bits interleaved.

    A rank is the number of quantiles up to the value, found by bisection; they come from one aggregate over the rows, 255 numbers a column.  NULL is less
    than any value.
    """
    shares = [k / 2**RANK_BITS for k in range(1, 2**RANK_BITS)]
    values = [_ordinal(df, c) for c in columns]
    cuts = df.agg(*(F.percentile_approx(v, shares, 10_000).alias(f"q{k}") for k, v in enumerate(values))).first()
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(RANK_BITS))))
    ranks = {}
    for k, value in enumerate(values):
        known = F.array(*(F.lit(float(x)) for x in cuts[k])) if cuts[k] else F.array().cast("array<double>")
        ranks[f"{name}{k}"] = F.aggregate(steps, F.lit(0), _bisected(value, known))
    place = F.lit(0).cast("long")
    for k, rank in enumerate(ranks):
        for b in range(RANK_BITS):
            place = place + F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"), b * len(columns) + len(columns) - 1 - k)
    return df.withColumns(ranks).withColumn(name, place).drop(*ranks)


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of ``columns``, sorted within each, so that files cover narrow ranges of every one of them.

    One column is its own order; of several the ranges follow a space-filling order, so a filter on any of them skips files.
    A hash of the row ends the range key; the rows of one hot value, or of one hot combination, can then
    spread over several ranges instead of filling one.
    """
    keys = [F.col(f"`{columns[0]}`")] if len(columns) == 1 else [F.col("_place")]
    placed = df if len(columns) == 1 else in_space_filling_order(df, columns, "_place")
    ranges = [*keys, row_salt(df)]
    ordered = placed.repartitionByRange(partitions, *ranges) if partitions else placed.repartitionByRange(*ranges)
    return ordered.sortWithinPartitions(*keys, *columns).drop("_place")
