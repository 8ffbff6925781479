"""Sources, rescued data, schema evolution and scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.contracts import IOT, WEATHER, Contract, Field, LateDataSpec, SinkSpec, SourceSpec
from tidewater.functions.expressions import contract_column
from tidewater.functions.scalars import error_fingerprint, short_message
from tidewater.operators.metadata import derive_event_date, inject_metadata
from tidewater.operators.quality import table_profile
from tidewater.operators.tables import append_batch, clustered
from tidewater.plans.mapping import (
    BAD_READING_SQL,
    INGEST_TIME,
    IOT_SQL,
    WEATHER_SQL,
    bad_reading,
    iot,
    table,
    weather,
    when_every,
)
from tidewater.plans.registry import new_layers, query
from tidewater.session import scratch_path, written
from tidewater.sources.evolution import evolve, observed_fields
from tidewater.sources.landing import decode_epochs, read_landing, stream_landing, write_landing
from tidewater.sources.rescue import type_json_lines
from tidewater.streaming.ingest import Ingest

IOT_FIELDS = [f.name for f in IOT.fields]
WEATHER_FIELDS = [f.name for f in WEATHER.fields]
IOT_JSON = IOT.with_options(source=SourceSpec("json", max_bytes_per_trigger=None))


def json_lines(df: DataFrame, fields: list[str], keep: list[str], **planted: Column) -> DataFrame:
    """One JSON text per row; ``planted`` replaces or adds fields, NULL ones are left out."""
    texts = {n: planted.get(n, F.col(n)).cast("string").alias(n) for n in [*fields, *planted]}
    return df.select(F.to_json(F.struct(*texts.values())).alias("value"), *keep)


def iot_lines(spark: SparkSession, sf_dir: str, **planted: Column) -> DataFrame:
    return json_lines(iot(spark, sf_dir), IOT_FIELDS, ["event_id", "batch_id"], **planted)


def bad_temperature() -> Column:
    return F.when(bad_reading(), F.lit("bad")).otherwise(F.col("temperature").cast("string"))


BAD_LINES_SQL = f"""WITH iot AS ({IOT_SQL}), landed AS (
  SELECT * REPLACE (CASE WHEN {BAD_READING_SQL} THEN NULL ELSE temperature END AS temperature),
    CASE WHEN {BAD_READING_SQL} THEN '{{"temperature":"bad"}}' END AS _rescued_data
  FROM iot)"""


# -- scans -------------------------------------------------------------------

LINE_CONTRACT = Contract(
    domain="order_lines",
    version="1.0.0",
    fields=(
        Field("l_linenumber", "IntegerType", False),
        Field("l_quantity", "DoubleType"),
        Field("l_extendedprice", "DoubleType"),
        Field("l_returnflag", "StringType"),
        Field("l_shipdate", "TimestampType", False),
    ),
    source=SourceSpec("parquet"),
    sink=SinkSpec("append"),
    event_time_column="l_shipdate",
)


@query(
    "scan_parquet",
    """SELECT l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate,
      CAST(NULL AS VARCHAR) AS _rescued_data FROM lineitem""",
)
def scan_parquet(spark, sf_dir):
    """A strict schema reads only its own columns of the files."""
    return read_landing(spark, LINE_CONTRACT, f"{sf_dir}/lineitem.parquet", source_file=False)


EVENT_CONTRACT = LINE_CONTRACT.with_options(
    domain="events",
    fields=(
        Field("event_id", "IntegerType", False),
        Field("ts", "TimestampType", False),
        Field("event_type", "DoubleType"),
        Field("value", "DoubleType"),
    ),
    event_time_column="ts",
)


@query(
    "scan_parquet_drifted",
    """SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(NULL AS DOUBLE) AS event_type, value,
      CAST(json_object('event_type', event_type, 'user_id', CAST(user_id AS VARCHAR), 'props', props) AS VARCHAR)
        AS _rescued_data FROM events""",
)
def scan_parquet_drifted(spark, sf_dir):
    """Files with other types and more columns than declared: misfits and extras are rescued."""
    return read_landing(spark, EVENT_CONTRACT, f"{sf_dir}/events.parquet", own_schema=True, source_file=False)


@query("scan_json", BAD_LINES_SQL + f" SELECT {', '.join(IOT_FIELDS)}, _rescued_data FROM landed", dates="reading_date")
def scan_json(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(iot_lines(spark, sf_dir, temperature=bad_temperature()).select("value"), path, "text")
    return read_landing(spark, IOT_JSON, path, source_file=False)


@query(
    "scan_csv",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city,
      CASE WHEN {BAD_READING_SQL} THEN NULL ELSE temperature END AS temperature, humidity, forecast_timestamp,
      forecast_date, CASE WHEN {BAD_READING_SQL} THEN '{{"temperature":"bad"}}' END AS _rescued_data FROM weather""", dates="forecast_date")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "landing")
    rows = weather(spark, sf_dir).withColumn("temperature", bad_temperature())
    texts = rows.select(*(F.col(c).cast("string").alias(c) for c in WEATHER_FIELDS))
    write_landing(texts, path, "csv")
    return read_landing(spark, WEATHER.with_options(source=SourceSpec("csv")), path, source_file=False)


@query(
    "epoch_decode",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, temperature, humidity,
      date_trunc('milliseconds', forecast_timestamp) AS forecast_timestamp, forecast_date FROM weather""", dates="forecast_date")
def epoch_decode(spark, sf_dir):
    """Timestamps stored as epoch milliseconds and dates as epoch days."""
    encoded = weather(spark, sf_dir).select(
        "city",
        "temperature",
        "humidity",
        F.unix_millis("forecast_timestamp").alias("forecast_timestamp"),
        F.unix_date("forecast_date").alias("forecast_date"),
    )
    return decode_epochs(encoded, WEATHER).drop("_rescued_data")


# -- rescue and evolution ------------------------------------------------------


@query("rescue_json", BAD_LINES_SQL + " SELECT event_id, temperature, humidity, _rescued_data FROM landed")
def rescue_json(spark, sf_dir):
    lines = iot_lines(spark, sf_dir, temperature=bad_temperature())
    return type_json_lines(lines, IOT).select("event_id", "temperature", "humidity", "_rescued_data")


def firmware() -> Column:
    return when_every(37, F.lit("v2"), F.lit(None))


@query(
    "rescue_extra_fields",
    """SELECT event_id, value AS temperature,
      CASE WHEN event_id % 37 = 0 THEN '{"firmware":"v2"}' END AS _rescued_data FROM events""",
)
def rescue_extra_fields(spark, sf_dir):
    lines = iot_lines(spark, sf_dir, firmware=firmware())
    return type_json_lines(lines, IOT).select("event_id", "temperature", "_rescued_data")


@query(
    "rescue_trailing_text",
    """SELECT event_id, CASE WHEN event_id % 71 > 1 THEN value END AS temperature, event_id % 71 <= 1 AS malformed FROM events""",
)
def rescue_trailing_text(spark, sf_dir):
    """A line with text or a second object after its object is kept whole, not cut."""
    lines = iot_lines(spark, sf_dir)
    after = F.when(F.col("event_id") % 71 == 0, F.concat("value", F.lit(" trailing"))).when(F.col("event_id") % 71 == 1, F.concat("value", "value"))
    lines = lines.withColumn("landed", F.coalesce(after, F.col("value")))
    rows = type_json_lines(lines.drop("value").withColumnRenamed("landed", "value"), IOT)
    whole = F.coalesce(F.get_json_object("_rescued_data", "$._malformed").isNotNull(), F.lit(False))
    return rows.select("event_id", "temperature", whole.alias("malformed"))


@query(
    "rescue_malformed_lines",
    """SELECT event_id, CASE WHEN event_id % 67 <> 0 THEN value END AS temperature,
      CASE WHEN event_id % 67 = 0 THEN '{"_malformed":"{bad"}' END AS _rescued_data FROM events""",
)
def rescue_malformed_lines(spark, sf_dir):
    lines = iot_lines(spark, sf_dir)
    broken = lines.withColumn("value", when_every(67, F.lit("{bad"), F.col("value")))
    return type_json_lines(broken, IOT).select("event_id", "temperature", "_rescued_data")


@query(
    "schema_additive",
    """SELECT event_id, value AS temperature, CASE WHEN event_id % 37 = 0 THEN 'v2' END AS firmware,
      CAST(NULL AS VARCHAR) AS _rescued_data FROM events""",
)
def schema_additive(spark, sf_dir):
    """New fields become columns."""
    lines = iot_lines(spark, sf_dir, firmware=firmware())
    widened = evolve(IOT.with_options(evolution_mode="additive"), observed_fields(lines, IOT))
    return type_json_lines(lines, widened).select("event_id", "temperature", "firmware", "_rescued_data")


@query(
    "schema_all",
    BAD_LINES_SQL + f""" SELECT event_id, CASE WHEN {BAD_READING_SQL} THEN 'bad' ELSE 'number' END AS temperature,
      humidity, CASE WHEN event_id % 37 = 0 THEN 'v2' END AS firmware, CAST(NULL AS VARCHAR) AS _rescued_data
    FROM landed""",
)
def schema_all(spark, sf_dir):
    """New fields become columns, and a field with values of another type becomes text."""
    lines = iot_lines(spark, sf_dir, temperature=bad_temperature(), firmware=firmware())
    widened = evolve(IOT.with_options(evolution_mode="all"), observed_fields(lines, IOT))
    rows = type_json_lines(lines, widened)
    kind = F.when(F.col("temperature").try_cast("double").isNull(), F.col("temperature")).otherwise("number")
    return rows.select("event_id", kind.alias("temperature"), "humidity", "firmware", "_rescued_data")


# -- streams over landed files -------------------------------------------------


@query("stream_ingest_append", BAD_LINES_SQL + f" SELECT {', '.join(IOT_FIELDS)}, _rescued_data FROM landed", dates="reading_date")
def stream_ingest_append(spark, sf_dir):
    """Landed files to a file sink, exactly once, by one-shot trigger."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    write_landing(iot_lines(spark, sf_dir, temperature=bad_temperature()).select("value"), landing, "text")
    stream = stream_landing(spark, IOT_JSON, landing).drop("_source_file")
    run = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


DROPS = 3
DROP_DAYS = 10
_DROP = f"CAST(floor(batch_id / {DROP_DAYS}.0) AS BIGINT)"
DROP_SQL = f"coalesce(({_DROP} % {DROPS} + {DROPS}) % {DROPS}, 0)"


def drop_of(batch: str = "batch_id") -> Column:
    """Which landing drop brings an event: its ten days, counted round and round; without a day, the first."""
    return F.coalesce(F.pmod(F.floor(F.col(batch) / DROP_DAYS), F.lit(DROPS)), F.lit(0))


@query(
    "stream_resume",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, temperature, forecast_timestamp,
      CAST({DROP_SQL} AS BIGINT) AS _batch_id FROM weather""",
)
def stream_resume(spark, sf_dir):
    """Each run after a drop reads only the files that are new since the checkpoint."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    layers = new_layers(spark)
    name = layers.table("silver", "resumed")
    contract = WEATHER.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None))

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("_source_file").withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        append_batch(rows, name, ["forecast_date"])

    rows = weather(spark, sf_dir)
    for drop in range(DROPS):
        write_landing(rows.filter(drop_of() == drop).select(*WEATHER_FIELDS), landing, "parquet")
        stream = stream_landing(spark, contract, landing)
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.table(name).select("city", "temperature", "forecast_timestamp", "_batch_id")


@query(
    "stream_parquet_drifted",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, forecast_timestamp, CASE WHEN event_id % 3 < 2 THEN temperature END AS temperature,
      CASE event_id % 3 WHEN 1 THEN '{{"firmware":"v2"}}' WHEN 2 THEN '{{"temperature":"warm"}}' END AS rescued,
      CASE WHEN event_id % 3 = 0 THEN 'silver' ELSE 'quarantine' END AS layer FROM weather""",
)
def stream_parquet_drifted(spark, sf_dir):
    """Files with a new column or another type are rescued to quarantine and stop nothing."""
    landing = scratch_path(spark, "landing")
    contract = WEATHER.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None), watermark=None, late_data=LateDataSpec())
    rows = weather(spark, sf_dir)
    third = [rows.filter(F.col("event_id") % 3 == k).select(*WEATHER_FIELDS) for k in range(3)]
    write_landing(third[0], landing, "parquet")
    write_landing(third[1].withColumn("firmware", F.lit("v2")), landing, "parquet")
    write_landing(third[2].withColumn("temperature", F.lit("warm")), landing, "parquet")
    job = Ingest(spark, contract, new_layers(spark), clock=lambda _: INGEST_TIME)
    job.run(landing, scratch_path(spark, "checkpoint"))
    columns = ["city", "forecast_timestamp", "temperature"]
    clean = spark.table(job.layers.table("silver", contract.domain)).select(*columns, F.lit(None).cast("string").alias("rescued"), F.lit("silver").alias("layer"))
    kept = spark.table(job.layers.table("quarantine", contract.domain))
    return clean.unionByName(kept.select(*columns, F.col("_rescued_data").alias("rescued"), F.lit("quarantine").alias("layer")))


# -- table reads and landing writes ---------------------------------------------


def _profile_sql(name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS ordinal, count(*) AS row_count, count(*) - count({c}) AS null_count FROM {name}"
        for i, c in enumerate(columns, 1)
    )


@query("table_profile", _profile_sql("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()))
def profile(spark, sf_dir):
    return table_profile(table(spark, sf_dir, "lineitem"))


@query(
    "lineage_file_path",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS landing_partition, event_type AS city, count(*) AS n
    FROM events GROUP BY ALL""",
)
def lineage_file_path(spark, sf_dir):
    """Each row knows the file it came from."""
    path = scratch_path(spark, "landing")
    write_landing(weather(spark, sf_dir).select(*WEATHER_FIELDS), path, "parquet", ("forecast_date",))
    rows = read_landing(spark, WEATHER.with_options(source=SourceSpec("parquet")), path)
    partition = F.regexp_extract("_source_file", r"forecast_date=(\d{4}-\d{2}-\d{2})/", 1)
    return rows.groupBy(partition.alias("landing_partition"), "city").agg(F.count("*").alias("n"))


@query("landing_partitioned", f"WITH weather AS ({WEATHER_SQL}) SELECT {', '.join(WEATHER_FIELDS)} FROM weather", dates="forecast_date")
def landing_partitioned(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(weather(spark, sf_dir).select(*WEATHER_FIELDS), path, "parquet", ("forecast_date", "absent"))
    rows = read_landing(spark, WEATHER.with_options(source=SourceSpec("parquet")), path)
    return rows.select(*WEATHER_FIELDS)


@query("clustered_write", f"WITH iot AS ({IOT_SQL}) SELECT {', '.join(IOT_FIELDS)} FROM iot", dates="reading_date")
def clustered_write(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    clustered(iot(spark, sf_dir).select(*IOT_FIELDS), IOT.sink.cluster_by).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "scan_csv_reordered",
    f"""WITH weather AS ({WEATHER_SQL}), rows AS (SELECT *, {DROP_SQL} AS b FROM weather)
    SELECT 'silver' AS side, city, temperature, forecast_timestamp, count(*) AS n FROM rows WHERE b = 0 GROUP BY ALL
    UNION ALL SELECT 'quarantine', city, temperature, forecast_timestamp, count(*) FROM rows WHERE b = 1 GROUP BY ALL
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, count(*) FROM rows WHERE b = 2 HAVING count(*) > 0""",
)
def scan_csv_reordered(spark, sf_dir):
    """CSV files in the stream: columns in another order, with one more that is rescued, and files of another dataset."""
    contract = WEATHER.with_options(source=SourceSpec("csv", max_bytes_per_trigger=None), watermark=None, late_data=LateDataSpec())
    rows = weather(spark, sf_dir)
    texts = rows.select("event_id", drop_of().alias("b"), *(F.col(c).cast("string").alias(c) for c in WEATHER_FIELDS))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    names = list(reversed(WEATHER_FIELDS))
    for b, columns in ((0, names), (1, [names[-1], "event_id", *names[:-1]]), (2, ["event_id"])):
        write_landing(texts.filter(F.col("b") == b).select(*columns), landing, "csv")
    job = Ingest(spark, contract, new_layers(spark), lambda batch: INGEST_TIME)
    job.run(landing, checkpoint)
    silver = spark.table(job.layers.table("silver", contract.domain)).withColumn("side", F.lit("silver"))
    aside = spark.table(job.layers.table("quarantine", contract.domain)).withColumn("side", F.lit("quarantine"))
    # Of the odd files the header line is a line, too.
    aside = aside.filter("not contains(_rescued_data, '_malformed') or not contains(_rescued_data, 'event_id')")
    both = silver.unionByName(aside, allowMissingColumns=True)
    return both.groupBy("side", "city", "temperature", "forecast_timestamp").agg(F.count("*").alias("n"))


def opened_share(df, column: str) -> float:
    """The largest share of files that a filter for one of the column's deciles opens, by the ranges in the files."""
    text = F.col(column).cast("string")
    files = df.groupBy(F.input_file_name()).agg(F.min(text).alias("least"), F.max(text).alias("most")).collect()  # one row a file
    deciles = last_of_tiles(df.select(text.alias("v")).distinct(), "v", 10)
    return max(sum(f["least"] <= v <= f["most"] for f in files) / len(files) for v in deciles)


def last_of_tiles(rows, column: str, tiles: int) -> list:
    """The greatest value of each of ``tiles`` equal parts of the rows in the column's order, as ``ntile`` deals them.

    Rows go to ranges; counts of the ranges tell which of them hold the wanted places, and only those are ranked, each by itself.
    """
    rows = rows.filter(F.col(column).isNotNull())
    ranged = written(rows.repartitionByRange(column).withColumn("_range", F.spark_partition_id()), "ranges")
    before, first = 0, {}
    for r in ranged.groupBy("_range").count().orderBy("_range").collect():  # one row a range
        first[r["_range"]] = (before, before + r["count"])
        before += r["count"]
    small, larger = divmod(before, tiles)
    places = [p for p in dict.fromkeys(small * t + min(t, larger) for t in range(1, tiles + 1)) if p]
    wanted = [(r, p - start) for p in places for r, (start, end) in first.items() if start < p <= end]
    if not wanted:
        return []
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    ranked = ranged.filter(F.col("_range").isin([r for r, _ in wanted])).withColumn("_place", place)
    found = ranked.join(F.broadcast(rows.sparkSession.createDataFrame(wanted, "_range int, _place int")), ["_range", "_place"])
    return [r[0] for r in found.orderBy(column).select(column).collect()]


@query(
    "clustered_two_columns",
    f"WITH iot AS ({IOT_SQL}) SELECT {', '.join(IOT_FIELDS)}, true AS either_skips FROM iot",
    dates="reading_date",
)
def clustered_two_columns(spark, sf_dir):
    """Readings by time and sensor at once: a filter on either one opens under a third of the files."""
    path = scratch_path(spark, "clustered")
    clustered(iot(spark, sf_dir).select(*IOT_FIELDS), ["reading_timestamp", "sensor_id"], 64).write.parquet(path)
    stored = spark.read.parquet(path)
    skips = max(opened_share(stored, c) for c in ("reading_timestamp", "sensor_id")) < 1 / 3
    return stored.withColumn("either_skips", F.lit(skips))


# -- projections and expressions -------------------------------------------------

LINEAGE_SQL = """CAST(7 AS BIGINT) AS _batch_id, TIMESTAMP '2024-02-01 00:00:00' AS _ingest_timestamp,
  forecast_timestamp AS _event_timestamp, '1.0.0' AS _schema_version_id, 'unknown' AS _pipeline_git_hash,
  'weather_external' AS _source_system, 'landing/' || city AS _file_path, 'ingest_service' AS _execution_user_id,
  'prod' AS _environment_id, 'unknown' AS _cluster_id, '1.0.0' AS _processing_library_version,
  'INSERT' AS _operation_type, '14' AS _retention_ttl"""


@query(
    "inject_metadata",
    f"""WITH weather AS ({WEATHER_SQL})
    SELECT city, temperature, humidity, forecast_timestamp, forecast_date, {LINEAGE_SQL} FROM weather""", dates="forecast_date")
def metadata(spark, sf_dir):
    rows = weather(spark, sf_dir).withColumn("_source_file", F.concat(F.lit("landing/"), "city"))
    return inject_metadata(rows.drop("batch_id", "event_id"), WEATHER, 7, INGEST_TIME)


@query(
    "inject_metadata_defaults",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, forecast_timestamp, CAST(7 AS BIGINT) AS _batch_id,
      TIMESTAMP '2024-02-01 00:00:00' AS _ingest_timestamp, '1.0.0' AS _schema_version_id FROM weather""",
)
def metadata_defaults(spark, sf_dir):
    bare = WEATHER.with_options(metadata=())
    return inject_metadata(weather(spark, sf_dir).select("city", "forecast_timestamp"), bare, 7, INGEST_TIME)


@query(
    "contract_expressions",
    """SELECT event_id, CAST(7 AS INTEGER) AS batch, CAST(ts AS DATE) AS day, coalesce(event_type, 'none') AS kind,
      CASE WHEN value > 100 THEN 'high' ELSE 'usual' END AS level, round(value * 2, 2) AS doubled,
      'plain' AS word FROM events""", dates="day")
def contract_expressions(spark, sf_dir):
    """Texts as they stand in a contract."""
    texts = {
        "batch": "lit(batch_id)",
        "day": "col('ts').cast(DateType())",
        "kind": "coalesce(col('event_type'), lit('none'))",
        "level": "when(col('value') > 100, lit('high')).otherwise(lit('usual'))",
        "doubled": "expr('round(value * 2, 2)')",
        "word": "plain",
    }
    events = table(spark, sf_dir, "events")
    return events.select("event_id", *(contract_column(t, 7, INGEST_TIME).alias(n) for n, t in texts.items()))


@query(
    "derive_event_date",
    "SELECT event_id, ts AS reading_timestamp, CAST(ts AS DATE) AS reading_date FROM events", dates="reading_date")
def event_date(spark, sf_dir):
    """The landed date is replaced by the date of the event time."""
    landed = iot(spark, sf_dir).withColumn("reading_date", F.date_sub("reading_date", 1))
    return derive_event_date(landed, "reading_timestamp", "reading_date").select(
        "event_id", "reading_timestamp", "reading_date"
    )


@query(
    "cast_and_try_cast",
    """SELECT event_id, CAST(value AS VARCHAR) IS NOT NULL AS has_text, CAST(user_id AS INTEGER) AS user_id,
      CASE WHEN event_id % 40 = 0 THEN NULL ELSE value END AS tried, CAST(ts AS DATE) AS day FROM events""", dates="day")
def cast_and_try_cast(spark, sf_dir):
    text = when_every(40, F.lit("bad"), F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.isNotNull().alias("has_text"),
        F.col("user_id").cast("int").alias("user_id"),
        text.try_cast("double").alias("tried"),
        F.col("ts").cast("string").try_cast("date").alias("day"),
    )


@query(
    "parse_timestamp",
    """SELECT event_id, ts AS parsed, CASE WHEN event_id % 40 = 0 THEN NULL ELSE ts END AS tried FROM events""",
)
def parse_timestamp(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    form = F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"),
        F.try_to_timestamp(when_every(40, F.lit("bad"), text), form).alias("tried"),
    )


@query(
    "coalesce_when",
    """SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN value END, -1.0) AS filled,
      CASE WHEN value > 100 THEN 'high' WHEN value > 50 THEN 'middle' ELSE 'low' END AS level FROM events""",
)
def coalesce_when(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(when_every(3, F.lit(None), F.col("value")), F.lit(-1.0)).alias("filled"),
        F.when(F.col("value") > 100, "high").when(F.col("value") > 50, "middle").otherwise("low").alias("level"),
    )


@query(
    "epoch_functions",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, epoch_us(TIMESTAMP '2024-02-01') // 1000000 AS ingest_seconds,
      DATE '2024-02-01' AS ingest_date FROM events""", dates="ingest_date")
def epoch_functions(spark, sf_dir):
    return iot(spark, sf_dir).select(
        "event_id",
        contract_column("unix_timestamp(col('reading_timestamp'))", 0, INGEST_TIME).alias("seconds"),
        contract_column("unix_timestamp()", 0, INGEST_TIME).alias("ingest_seconds"),
        contract_column("current_date()", 0, INGEST_TIME).alias("ingest_date"),
    )


@query(
    "error_fingerprint",
    """SELECT doc_id, left(sha256(source || ':' || text), 16) AS fingerprint, left(text, 500) AS message FROM documents""",
)
def fingerprints(spark, sf_dir):
    """Whole texts as messages: the fingerprint covers all of a message, the stored form its start."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        error_fingerprint(F.col("source"), F.col("text")).alias("fingerprint"),
        short_message(F.col("text")).alias("message"),
    )
