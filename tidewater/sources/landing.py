"""Landed files as batches or streams, typed by a contract."""

from __future__ import annotations

import csv
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import Contract, string_struct, struct_type
from tidewater.functions.scalars import from_epoch_days, from_epoch_millis
from tidewater.sources.rescue import SOURCE_FILE, type_columnar, type_json_lines, type_text_columns

CORRUPT_COLUMN = "_corrupt_line"


class SourceUnavailable(RuntimeError):
    """The session lacks the reader for a declared source format."""


def read_landing(
    spark: SparkSession, contract: Contract, path: str, own_schema: bool = False, source_file: bool = True
) -> DataFrame:
    """All files below ``path`` as one typed batch.

    ``own_schema`` reads columnar files with the types they carry, for files that
    may have drifted; otherwise a wrong column type fails the scan.
    """
    return _typed(spark.read, contract, path, own_schema, source_file)


def stream_landing(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """New files below ``path`` as an unbounded typed frame.

    The stream's checkpoint remembers which files were read; each trigger takes
    at most the contract's byte limit.
    """
    reader = spark.readStream
    if contract.source.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", contract.source.max_bytes_per_trigger)
    return _typed(reader, contract, path, own_schema=False, source_file=True)


def _typed(reader, contract: Contract, path: str, own_schema: bool, source_file: bool) -> DataFrame:
    def traced(rows: DataFrame) -> DataFrame:
        return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)) if source_file else rows

    match contract.source.format:
        case "json":
            return type_json_lines(traced(reader.format("text").load(path)), contract)
        case "csv":
            rows = (
                reader.format("csv")
                .schema(string_struct(contract.fields, CORRUPT_COLUMN))
                .option("header", "true")
                # A header in another order must fail: by position its values would swap columns.
                .option("enforceSchema", "false")
                .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
                .load(path)
            )
            return type_text_columns(traced(rows), contract, CORRUPT_COLUMN)
        case "parquet":
            if not own_schema:
                reader = reader.schema(struct_type(contract.fields))
            return type_columnar(traced(reader.format("parquet").load(path)), contract)
        case "avro":
            return decode_epochs(traced(_avro(reader, contract, path)), contract)
    raise SourceUnavailable(contract.source.format)


def stream_lines(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """New lines of text with their file, not typed yet: for contracts whose fields may grow with the batch."""
    reader = spark.readStream
    if contract.source.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", contract.source.max_bytes_per_trigger)
    return reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))


def landed_schema(contract: Contract) -> T.StructType:
    """Columns of typed rows: the contract's, rescued data and the source file."""
    fields = [T.StructField(f.name, f.spark_type) for f in contract.fields]
    return T.StructType([*fields, T.StructField(contract.rescued_column, T.StringType()), T.StructField(SOURCE_FILE, T.StringType())])


def stream_file_names(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """The file of every row of new files, no column of which is read: see ``read_landed_files`` and ``read_csv_files``."""
    reader = spark.readStream
    if contract.source.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", contract.source.max_bytes_per_trigger)
    rows = reader.schema(struct_type(contract.fields)).parquet(path) if contract.source.format == "parquet" else reader.text(path)
    return rows.select(F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_landed_files(spark: SparkSession, contract: Contract, files: list[str]) -> DataFrame:
    """Columnar files with the types that each carries; files whose types do not conflict are read together.

    Values of another type and undeclared columns are rescued; no file stops the others.
    """
    groups = []
    for schema, group in _without_conflict(spark, files):
        rows = spark.read.schema(schema).parquet(*group)
        groups.append(type_columnar(rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)), contract))
    return reduce(DataFrame.unionByName, groups)


def _without_conflict(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files): all files at once if their columns agree in type, which one job over the footers finds out; else halves of them.

    A few drifted files among many cost as many jobs as the logarithm of the number of files, each.
    """
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*files).schema, files)]
    except (PySparkException, Py4JJavaError):
        # The session hands the failed job's own error on.
        if len(files) == 1:
            raise
    middle = len(files) // 2
    merged: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, group in _without_conflict(spark, files[:middle]) + _without_conflict(spark, files[middle:]):
        merged.setdefault(schema.json(), (schema, []))[1].extend(group)
    return list(merged.values())


#: Ways of writing the header that the files of one batch may have.
MOST_HEADERS = 1000


def read_csv_files(spark: SparkSession, contract: Contract, files: list[str]) -> DataFrame:
    """CSV files by the names in their headers, in whatever order each has them.

    One job finds the header lines; files of one header are read together.  Undeclared columns are rescued and missing ones NULL.  A file whose header names no
    declared column, or a column twice, is no file of this dataset: each of its lines is kept whole under ``_malformed``, so that it ends in quarantine and no file
    stops the stream.
    """
    lines = spark.read.text(files).select("value", F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"), F.col("_metadata.file_path").alias("file"))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    alike: dict[str, list[str]] = {}
    for row in first.collect():  # the files of one batch
        alike.setdefault(row["header"], []).append(row["file"])
    if len(alike) > MOST_HEADERS:
        raise ValueError(f"{contract.domain}: {len(alike)} different CSV headers in one batch")
    declared = {f.name for f in contract.fields}
    groups = []
    for header, group in sorted(alike.items()):
        names = [n.strip() for n in next(csv.reader([header.removeprefix("\ufeff")]), [])]
        traced = F.col("_metadata.file_path").alias(SOURCE_FILE)
        if declared.isdisjoint(names) or len({n.lower() for n in names}) < len(names):
            odd = spark.read.text(group).select(F.col("value").alias(CORRUPT_COLUMN), traced)
            groups.append(type_text_columns(odd, contract, CORRUPT_COLUMN))
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT_COLUMN)])
        reader = spark.read.schema(schema).option("header", "true").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        rows = reader.csv(group).select("*", traced)
        groups.append(type_text_columns(rows, contract, CORRUPT_COLUMN, [n for n in names if n not in declared]))
    return reduce(DataFrame.unionByName, groups)


def _avro(reader, contract: Contract, path: str) -> DataFrame:
    try:
        return reader.format("avro").schema(epoch_struct(contract)).load(path)
    except AnalysisException as error:
        raise SourceUnavailable("start the session with the spark-avro package to read avro") from error


def epoch_struct(contract: Contract) -> T.StructType:
    """The encoded form of the contract: timestamps as long millis, dates as int days."""
    encoded = {T.TimestampType(): T.LongType(), T.DateType(): T.IntegerType()}
    return T.StructType(
        [T.StructField(f.name, encoded.get(f.spark_type, f.spark_type), f.nullable) for f in contract.fields]
    )


def decode_epochs(rows: DataFrame, contract: Contract) -> DataFrame:
    """Encoded rows to contract types; a strict reader leaves nothing to rescue."""
    decode = {T.TimestampType(): from_epoch_millis, T.DateType(): from_epoch_days}
    names = {f.name for f in contract.fields}
    return rows.select(
        *(decode.get(f.spark_type, lambda c: c)(F.col(f.name)).alias(f.name) for f in contract.fields),
        F.lit(None).cast("string").alias(contract.rescued_column),
        *(c for c in rows.columns if c not in names),
    )


def write_landing(
    df: DataFrame, path: str, file_format: str, partition_by: tuple[str, ...] = (), mode: str = "append"
) -> None:
    """Append a drop of files, partitioned by those of the columns that the frame has."""
    present = [c for c in partition_by if c in df.columns]
    if present:
        # Rebalancing gives each directory few files, yet splits a directory that holds most rows.
        df = df.hint("rebalance", *present)
    writer = df.write.format(file_format).mode(mode)
    if file_format == "csv":
        writer = writer.option("header", "true")
    if present:
        writer = writer.partitionBy(*present)
    writer.save(path)
