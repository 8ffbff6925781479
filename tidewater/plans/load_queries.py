"""Duplicate removal, upserts, table writes and the ingestion streams."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import (
    INVENTORY,
    IOT,
    SALES,
    WEATHER,
    Contract,
    LateDataSpec,
    SourceSpec,
    WatermarkSpec,
)
from tidewater.operators.compaction import Compactor
from tidewater.operators.dedup import distinct_rows
from tidewater.operators.metadata import inject_metadata
from tidewater.operators.splits import split_valid
from tidewater.operators.tables import SEGMENT, append_batch, bronze_append, partition_values
from tidewater.operators.upsert import matched, merge_table, source_winners, unmatched, upsert, write_clean
from tidewater.plans.batch_queries import FAULTY_SQL, faulty_iot
from tidewater.plans.mapping import (
    BAD_READING_SQL,
    EPOCH_DAY,
    INGEST_TIME,
    INVENTORY_SQL,
    IOT_SQL,
    SALES_SQL,
    WEATHER_SQL,
    inventory,
    iot,
    sales,
    weather,
    when_every,
)
from tidewater.plans.registry import new_layers, query
from tidewater.plans.source_queries import (
    DROP_SQL,
    DROPS,
    IOT_FIELDS,
    IOT_JSON,
    WEATHER_FIELDS,
    bad_temperature,
    drop_of,
    firmware,
    json_lines,
)
from tidewater.session import scratch_path
from tidewater.sources.landing import stream_landing, write_landing
from tidewater.streaming.dedup import FirstSeen
from tidewater.streaming.ingest import Ingest

SALES_FIELDS = [f.name for f in SALES.fields]
INVENTORY_FIELDS = [f.name for f in INVENTORY.fields]
LOADS = range(3)
#: Which load brings an order line; the last one has every flag that is neither A nor N, and none.
LOAD_SQL = "CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def load_of() -> Column:
    return F.when(F.col("flag") == "A", 0).when(F.col("flag") == "N", 1).otherwise(2)


# -- distinct ------------------------------------------------------------------


@query(
    "dedup_full_row",
    f"WITH inventory AS ({INVENTORY_SQL}) SELECT DISTINCT {', '.join(INVENTORY_FIELDS)} FROM inventory",
    dates="last_updated",
)
def dedup_full_row(spark, sf_dir):
    """Every row landed twice, in two drops; a row is the same whichever drop brought it."""
    rows = inventory(spark, sf_dir).select(*INVENTORY_FIELDS)
    landed = rows.withColumn("drop", F.lit(1)).unionByName(rows.withColumn("drop", F.lit(2)))
    return distinct_rows(landed, ["drop"]).drop("drop")


# -- upsert ----------------------------------------------------------------------


def _ordered(columns: list[str], keys: list[str], event_time: str) -> str:
    rest = [c for c in columns if c not in keys]
    return ", ".join(f"{c} DESC NULLS LAST" for c in [event_time, *rest])


def _winners_sql(source: str, columns: list[str], keys: list[str], event_time: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)}
      ORDER BY {_ordered(columns, keys, event_time)}) AS rn FROM {source}) WHERE rn = 1"""


def _upsert_sql(base: str, columns: list[str], keys: list[str], event_time: str) -> str:
    """Two loads: rows of flags A and N, then rows of flag R, which win."""
    names = ", ".join(columns)
    same = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"""WITH base AS ({base}), old AS (SELECT {names} FROM base WHERE flag IS DISTINCT FROM 'R'),
      new AS (SELECT {names} FROM base WHERE flag = 'R'),
      t AS ({_winners_sql('old', columns, keys, event_time)}),
      s AS ({_winners_sql('new', columns, keys, event_time)}),
      merged AS (SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {same}))"""


SALES_KEYS, INVENTORY_KEYS = list(SALES.sink.merge_keys), list(INVENTORY.sink.merge_keys)
SALES_UPSERT_SQL = _upsert_sql(SALES_SQL, SALES_FIELDS, SALES_KEYS, "transaction_timestamp")
INVENTORY_UPSERT_SQL = _upsert_sql(INVENTORY_SQL, INVENTORY_FIELDS, INVENTORY_KEYS, "last_updated_timestamp")


def two_loads(rows: DataFrame, fields: list[str], contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(target, source): what is stored after the first load, and the rows of the second."""
    first, second = rows.filter("not flag <=> 'R'").select(*fields), rows.filter("flag <=> 'R'").select(*fields)
    return source_winners(first, contract.sink.merge_keys, contract.event_time_column), second


@query("merge_upsert", SALES_UPSERT_SQL + " SELECT * FROM merged", dates="transaction_date")
def merge_upsert(spark, sf_dir):
    target, source = two_loads(sales(spark, sf_dir), SALES_FIELDS, SALES)
    return upsert(target, source, SALES_KEYS, SALES.event_time_column)


@query("merge_composite_key", INVENTORY_UPSERT_SQL + " SELECT * FROM merged", dates="last_updated")
def merge_composite_key(spark, sf_dir):
    target, source = two_loads(inventory(spark, sf_dir), INVENTORY_FIELDS, INVENTORY)
    return upsert(target, source, INVENTORY_KEYS, INVENTORY.event_time_column)


@query(
    "merge_inserts",
    INVENTORY_UPSERT_SQL + " SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.product_id = s.product_id AND t.warehouse_id = s.warehouse_id)",
    dates="last_updated",
)
def merge_inserts(spark, sf_dir):
    target, source = two_loads(inventory(spark, sf_dir), INVENTORY_FIELDS, INVENTORY)
    return unmatched(source_winners(source, INVENTORY_KEYS, INVENTORY.event_time_column), target, INVENTORY_KEYS)


@query(
    "merge_updates",
    INVENTORY_UPSERT_SQL + " SELECT s.* FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.product_id = s.product_id AND t.warehouse_id = s.warehouse_id)",
    dates="last_updated",
)
def merge_updates(spark, sf_dir):
    target, source = two_loads(inventory(spark, sf_dir), INVENTORY_FIELDS, INVENTORY)
    return matched(source_winners(source, INVENTORY_KEYS, INVENTORY.event_time_column), target, INVENTORY_KEYS)


NULL_WAREHOUSE = "CASE WHEN warehouse_id <> '7' THEN warehouse_id END AS warehouse_id"


@query(
    "merge_null_keys",
    f"""WITH base AS (SELECT * REPLACE ({NULL_WAREHOUSE}) FROM ({INVENTORY_SQL})),
      keyed AS (SELECT * FROM base WHERE warehouse_id IS NOT NULL),
      best AS ({_winners_sql(
          "(SELECT *, coalesce(flag = 'R', false) AS is_new FROM keyed)",
          ["is_new", *INVENTORY_FIELDS],
          INVENTORY_KEYS,
          "is_new DESC, last_updated_timestamp",
      )})
    SELECT {', '.join(INVENTORY_FIELDS)} FROM best
    UNION ALL SELECT * FROM (SELECT DISTINCT {', '.join(INVENTORY_FIELDS)} FROM base WHERE warehouse_id IS NULL AND flag IS DISTINCT FROM 'R')
    UNION ALL SELECT * FROM (SELECT DISTINCT {', '.join(INVENTORY_FIELDS)} FROM base WHERE warehouse_id IS NULL AND flag = 'R')""",
    dates="last_updated",
)
def merge_null_keys(spark, sf_dir):
    """Rows without a key match nothing: all of them are added."""
    rows = inventory(spark, sf_dir).withColumn("warehouse_id", F.when(F.col("warehouse_id") != "7", F.col("warehouse_id")))
    target, source = two_loads(rows, INVENTORY_FIELDS, INVENTORY)
    return upsert(target, source, INVENTORY_KEYS, INVENTORY.event_time_column)


def _moved_sql() -> str:
    """Three loads: all lines on one of twenty days, then returned and accepted ones three days on, then accepted ones two more."""
    rest = ", ".join(c for c in SALES_FIELDS if c not in ("amount", "transaction_timestamp", "transaction_date"))
    loads = " UNION ALL ".join(
        f"""SELECT {rest}, amount + {b} AS amount, DATE '2024-01-01' + CAST(quantity % 20 + {days} AS INTEGER) AS transaction_date,
          transaction_date AS transaction_timestamp, {b} AS b FROM sales WHERE {chosen}"""
        for b, (chosen, days) in enumerate((("true", 1), ("flag IN ('R', 'A')", 4), ("flag = 'A'", 6)))
    )
    order = _ordered(SALES_FIELDS, SALES_KEYS, "transaction_timestamp")
    return f"""WITH sales AS (SELECT * EXCLUDE (transaction_date, transaction_timestamp) FROM ({SALES_SQL})), loads AS ({loads}),
      placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY b DESC, {order}) AS rn FROM loads)
    SELECT transaction_id, customer_id, amount, transaction_date FROM placed WHERE rn = 1"""


@query("merge_moved_keys", _moved_sql(), dates="transaction_date")
def merge_moved_keys(spark, sf_dir):
    """Lines land on one of twenty days; most are corrected once or twice, and move to later days.

    The sink is the contract's own, by day: moved keys are found in the index of key places.
    """
    layers, contract = new_layers(spark), SALES.with_options(metadata=())
    rows = sales(spark, sf_dir)
    for flags, days, more in ((None, 1, 0), (("R", "A"), 4, 1), (("A",), 6, 2)):
        load = rows if flags is None else rows.filter(F.col("flag").isin(*flags))
        day = F.date_add(F.lit(EPOCH_DAY), (F.col("quantity") % 20 + days).cast("int"))
        load = load.withColumns({"transaction_date": day, "transaction_timestamp": day.cast("timestamp"), "amount": F.col("amount") + more})
        name = merge_table(spark, load.select(*SALES_FIELDS), layers, contract)
    return spark.table(name).select("transaction_id", "customer_id", "amount", "transaction_date")


# -- table writes ------------------------------------------------------------------


@query(
    "bronze_append",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, temperature, humidity, forecast_timestamp, forecast_date, event_id,
      CAST(NULL AS VARCHAR) AS _rescued_data, CAST(NULL AS VARCHAR) AS firmware, CAST(0 AS BIGINT) AS _batch_id FROM weather
    UNION ALL SELECT city, temperature, humidity, forecast_timestamp, forecast_date, event_id,
      CAST(NULL AS VARCHAR), CASE WHEN event_id % 37 = 0 THEN 'v2' END, CAST(1 AS BIGINT) FROM weather""",
    dates="forecast_date",
)
def bronze(spark, sf_dir):
    """Copies collapse, a repeated batch replaces itself, a new column widens the table."""
    layers = new_layers(spark)
    rows = weather(spark, sf_dir).drop("batch_id").withColumn("_rescued_data", F.lit(None).cast("string"))
    for _ in range(2):
        bronze_append(rows.unionByName(rows), layers, WEATHER, 0)
    name = bronze_append(rows.withColumn("firmware", firmware()), layers, WEATHER, 1)
    return spark.table(name).drop(SEGMENT)


@query(
    "silver_append",
    f"""WITH iot AS ({IOT_SQL}) SELECT {', '.join(IOT_FIELDS)}, CAST({DROP_SQL} AS BIGINT) AS _batch_id,
      TIMESTAMP '2024-02-01' AS _ingest_timestamp FROM iot""",
    dates="reading_date",
)
def silver_append(spark, sf_dir):
    """One batch a drop; the second one runs once more and is stored once."""
    layers = new_layers(spark)
    rows = iot(spark, sf_dir).withColumn("_rescued_data", F.lit(None).cast("string"))
    bare = IOT.with_options(metadata=())
    for drop in (*range(DROPS), 1):
        batch = rows.filter(drop_of() == drop).drop("batch_id", "event_id")
        name = write_clean(spark, inject_metadata(batch, bare, drop, INGEST_TIME).drop("_schema_version_id"), layers, bare)
    return spark.table(name).drop(SEGMENT)


@query(
    "silver_route",
    f"""WITH iot AS ({IOT_SQL}), inventory AS ({INVENTORY_SQL})
    SELECT 'iot_sensors' AS domain, 'append' AS mode, count(*) AS n FROM iot
    UNION ALL SELECT 'inventory_erp', 'merge_into', count(DISTINCT product_id || '/' || warehouse_id) FROM inventory""",
)
def silver_route(spark, sf_dir):
    """The contract's mode decides between append and upsert."""
    layers = new_layers(spark)
    sources = {
        IOT: iot(spark, sf_dir).drop("batch_id", "event_id"),
        INVENTORY: inventory(spark, sf_dir).drop("flag"),
    }
    counts = []
    for contract, rows in sources.items():
        bare = contract.with_options(metadata=())
        name = write_clean(spark, inject_metadata(rows, bare, 0, INGEST_TIME), layers, bare)
        counts.append(
            spark.table(name).agg(
                F.lit(contract.domain).alias("domain"), F.lit(contract.sink.mode).alias("mode"), F.count("*").alias("n")
            )
        )
    return counts[0].unionByName(counts[1])


#: Batches of the compaction query, and how many segments of a size are folded.
FOLDED_BATCHES, FAN = 9, 3


@query(
    "compact_batches",
    f"""WITH weather AS ({WEATHER_SQL}), batches AS (SELECT *, CAST(event_id % {FOLDED_BATCHES} AS BIGINT) AS b FROM weather)
    SELECT forecast_date, b AS _batch_id, count(*) AS n, count(DISTINCT event_id) AS events, max(temperature) AS hottest, true AS few_segments
    FROM batches GROUP BY forecast_date, b""",
    dates="forecast_date",
)
def compact_batches(spark, sf_dir):
    """Nine batches, each with rows of every day; closed ones are folded after each batch, and the last one runs again."""
    layers = new_layers(spark)
    rows = weather(spark, sf_dir).drop("batch_id").withColumn("_batch_id", F.col("event_id") % FOLDED_BATCHES)
    name, compactor = layers.table("silver", "weather"), Compactor(spark, layers.table("system", "weather_folds"), FAN)
    for b in (*range(FOLDED_BATCHES), FOLDED_BATCHES - 1):
        append_batch(rows.filter(F.col("_batch_id") == b), name, ["forecast_date"])
        compactor.compact(name, b, ["forecast_date", "city"])
    segments = partition_values(spark, name).groupBy(F.col("spec")["forecast_date"].alias("day")).count()
    # Fewer than the fan of each size, and the open batch.
    few = segments.agg(F.max("count") <= 2 * (FAN - 1) + 1).first()[0]
    counts = spark.table(name).groupBy("forecast_date", "_batch_id").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("events"), F.max("temperature").alias("hottest")
    )
    return counts.withColumn("few_segments", F.lit(few))


@query("quarantine_rows", FAULTY_SQL + " SELECT event_id, reason, CAST(3 AS BIGINT) AS batch FROM faulty WHERE reason IS NOT NULL")
def quarantine_rows(spark, sf_dir):
    """Corrupt rows with their reason, stored once although they landed twice and ran twice."""
    layers = new_layers(spark)
    rows = faulty_iot(spark, sf_dir)
    _, corrupt = split_valid(rows.unionByName(rows), IOT)
    name = layers.table("quarantine", IOT.domain)
    for _ in range(2):
        append_batch(distinct_rows(corrupt.withColumn("_batch_id", F.lit(3).cast("bigint"))), name)
    return spark.table(name).select("event_id", F.col("_reason").alias("reason"), F.col("_batch_id").alias("batch"))


# -- streams ------------------------------------------------------------------------


def clock(batch_id: int) -> dt.datetime:
    return INGEST_TIME + dt.timedelta(hours=batch_id)


def ingest_drops(spark: SparkSession, contract: Contract, drops: list[DataFrame], landing_format: str) -> Ingest:
    """Land each drop and run the one-shot stream on it, all on one checkpoint."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    job = Ingest(spark, contract, new_layers(spark), clock)
    for drop in drops:
        write_landing(drop, landing, landing_format)
        job.run(landing, checkpoint)
    return job


# Drops span ten days, so lateness is counted from that; late events are a month old.
WIDE = {"delayed_threshold_minutes": 15_840, "allowed_lateness_minutes": 5}
CUTOFF_MINUTES = 15_845


@query(
    "ingest_iot",
    f"""WITH iot AS ({IOT_SQL}), landed AS (
      SELECT CAST({DROP_SQL} AS BIGINT) AS b, sensor_id, location_id, temperature,
        CASE WHEN event_id % 50 = 0 THEN reading_timestamp - INTERVAL 30 DAYS ELSE reading_timestamp END AS moment,
        {BAD_READING_SQL} AS bad, event_id % 53 = 0 AS no_sensor FROM iot),
      cut AS (SELECT b, max(moment) - INTERVAL {CUTOFF_MINUTES} MINUTES AS cutoff FROM landed GROUP BY b)
    SELECT DISTINCT sensor_id, location_id, temperature, moment AS reading_timestamp, CAST(moment AS DATE) AS reading_date,
      b AS _batch_id, TIMESTAMP '2024-02-01' + to_hours(b) AS _ingest_timestamp, '1.0.0' AS _schema_version_id,
      'INSERT' AS _operation_type, '14' AS _retention_ttl
    FROM landed JOIN cut USING (b) WHERE moment >= cutoff AND NOT bad AND NOT no_sensor""",
    dates="reading_date",
)
def ingest_iot(spark, sf_dir):
    """Whole path with faults: clean rows after late, mistyped and incomplete ones were set aside."""
    return ingested_iot(spark, sf_dir).select(
        "sensor_id",
        "location_id",
        "temperature",
        "reading_timestamp",
        "reading_date",
        "_batch_id",
        "_ingest_timestamp",
        "_schema_version_id",
        "_operation_type",
        "_retention_ttl",
    )


def ingested_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = run_iot(spark, sf_dir)
    return spark.table(job.layers.table("silver", IOT.domain))


def run_iot(spark: SparkSession, sf_dir: str) -> Ingest:
    old = F.col("reading_timestamp") - F.expr("INTERVAL 30 DAYS")
    rows = iot(spark, sf_dir)
    contract = IOT_JSON.with_options(watermark=WatermarkSpec("reading_timestamp", **WIDE))
    drops = [
        json_lines(
            rows.filter(drop_of() == d),
            IOT_FIELDS,
            [],
            temperature=bad_temperature(),
            sensor_id=when_every(53, F.lit(None), F.col("sensor_id")),
            reading_timestamp=when_every(50, old, F.col("reading_timestamp")),
        )
        for d in range(DROPS)
    ]
    return ingest_drops(spark, contract, drops, "text")


@query(
    "ingest_weather",
    f"""WITH weather AS ({WEATHER_SQL}), landed AS (
      SELECT CAST({DROP_SQL} AS BIGINT) AS b, city, temperature, humidity,
        CASE WHEN event_id % 50 = 0 THEN forecast_timestamp - INTERVAL 30 DAYS ELSE forecast_timestamp END AS moment FROM weather),
      cut AS (SELECT b, max(moment) - INTERVAL {CUTOFF_MINUTES} MINUTES AS cutoff FROM landed GROUP BY b)
    SELECT b AS batch_id, count(*) AS total, count(*) FILTER (moment < cutoff) AS late, count(*) FILTER (moment >= cutoff) AS silver_rows,
      CAST(0 AS BIGINT) AS corrupt, max(moment) AS max_event_time, max(cutoff) AS cutoff, 'CLOSED' AS breaker_state
    FROM landed JOIN cut USING (b) GROUP BY b""",
)
def ingest_weather(spark, sf_dir):
    """The state each batch leaves behind."""
    old = F.col("forecast_timestamp") - F.expr("INTERVAL 30 DAYS")
    rows = weather(spark, sf_dir)
    contract = WEATHER.with_options(
        source=SourceSpec("json", max_bytes_per_trigger=None),
        watermark=WatermarkSpec("forecast_timestamp", **WIDE),
        late_data=LateDataSpec(True, 14),
    )
    drops = [
        json_lines(
            rows.filter(drop_of() == d),
            WEATHER_FIELDS,
            [],
            forecast_timestamp=when_every(50, old, F.col("forecast_timestamp")),
        )
        for d in range(DROPS)
    ]
    job = ingest_drops(spark, contract, drops, "text")
    return spark.table(job.state_table).select(
        F.col("_batch_id").alias("batch_id"),
        "total",
        "late",
        "silver_rows",
        "corrupt",
        "max_event_time",
        "cutoff",
        "breaker_state",
    )


@query(
    "ingest_additive",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, forecast_timestamp, temperature,
      CASE WHEN event_id % 37 = 0 AND {DROP_SQL} > 0 THEN 'v2' END AS firmware, CAST({DROP_SQL} AS BIGINT) AS batch_id FROM weather""",
)
def ingest_additive(spark, sf_dir):
    """A field that later drops bring becomes a column of the clean table; older rows have none."""
    rows = weather(spark, sf_dir)
    contract = WEATHER.with_options(
        source=SourceSpec("json", max_bytes_per_trigger=None), evolution_mode="additive", watermark=None, late_data=LateDataSpec()
    )
    drops = [rows.filter(drop_of() == d) for d in range(DROPS)]
    drops = [json_lines(r, WEATHER_FIELDS, [], **({"firmware": firmware()} if d else {})) for d, r in enumerate(drops)]
    job = ingest_drops(spark, contract, drops, "text")
    clean = spark.table(job.layers.table("silver", contract.domain))
    return clean.select("city", "forecast_timestamp", "temperature", "firmware", F.col("_batch_id").alias("batch_id"))


BREAKER_DROPS = 6


@query(
    "ingest_breaker",
    f"""WITH iot AS ({IOT_SQL}), drops AS (SELECT *, coalesce(((batch_id % {BREAKER_DROPS}) + {BREAKER_DROPS}) % {BREAKER_DROPS}, 0) AS b FROM iot),
      rates AS (SELECT b, count(*) AS total, count(*) FILTER (b = 1 AND event_id % 10 = 0) AS corrupt FROM drops GROUP BY b)
    SELECT CAST(b AS BIGINT) AS batch_id, total, corrupt, total - corrupt AS silver_rows,
      CASE b WHEN 1 THEN 'OPEN' WHEN 2 THEN 'HALF_OPEN' ELSE 'CLOSED' END AS breaker_state FROM rates""",
)
def ingest_breaker(spark, sf_dir):
    """Six drops, the second with a tenth of its rows corrupt: the breaker opens, is half open, and closes."""
    rows = iot(spark, sf_dir)
    contract = IOT_JSON.with_options(watermark=None, late_data=LateDataSpec())
    drop = F.coalesce(F.pmod(F.col("batch_id"), F.lit(BREAKER_DROPS)), F.lit(0))
    bad = F.when((drop == 1) & (F.col("event_id") % 10 == 0), F.lit("bad")).otherwise(F.col("temperature").cast("string"))
    drops = [json_lines(rows.filter(drop == d), IOT_FIELDS, [], temperature=bad) for d in range(BREAKER_DROPS)]
    job = ingest_drops(spark, contract, drops, "text")
    return spark.table(job.state_table).select(F.col("_batch_id").alias("batch_id"), "total", "corrupt", "silver_rows", "breaker_state")


@query(
    "ingest_tables",
    f"""WITH weather AS ({WEATHER_SQL}), landed AS (
      SELECT CAST({DROP_SQL} AS BIGINT) AS b, city, event_id % 40 = 0 AS bad, event_id,
        CASE WHEN event_id % 50 = 0 THEN forecast_timestamp - INTERVAL 30 DAYS ELSE forecast_timestamp END AS moment FROM weather),
      cut AS (SELECT b, max(moment) - INTERVAL {CUTOFF_MINUTES} MINUTES AS cutoff FROM landed GROUP BY b),
      sides AS (SELECT *, CASE WHEN moment < cutoff THEN 'late' WHEN bad THEN 'quarantine' ELSE 'silver' END AS side FROM landed JOIN cut USING (b))
    SELECT side, city, moment AS forecast_timestamp, b AS batch_id FROM sides UNION ALL SELECT 'bronze', city, moment, b FROM sides""",
)
def ingest_tables(spark, sf_dir):
    """All rows that the stream leaves, by table: nothing is lost and nothing is in two places."""
    old = F.col("forecast_timestamp") - F.expr("INTERVAL 30 DAYS")
    contract = WEATHER.with_options(
        source=SourceSpec("json", max_bytes_per_trigger=None),
        watermark=WatermarkSpec("forecast_timestamp", **WIDE),
        late_data=LateDataSpec(True, 14),
    )
    rows = weather(spark, sf_dir)
    bad = F.when(F.col("event_id") % 40 == 0, F.lit("bad")).otherwise(F.col("temperature").cast("string"))
    drops = [
        json_lines(rows.filter(drop_of() == d), WEATHER_FIELDS, [], temperature=bad, forecast_timestamp=when_every(50, old, F.col("forecast_timestamp")))
        for d in range(DROPS)
    ]
    job = ingest_drops(spark, contract, drops, "text")
    name = WEATHER.domain
    tables = {"silver": ("silver", name), "quarantine": ("quarantine", name), "late": ("bronze", f"{name}_late"), "bronze": ("bronze", name)}
    sides = [
        spark.table(job.layers.table(*where)).select(F.lit(side).alias("side"), "city", "forecast_timestamp", F.col("_batch_id").alias("batch_id"))
        for side, where in tables.items()
    ]
    return reduce(DataFrame.unionByName, sides)


def _merged_drops_sql(base: str, columns: list[str], keys: list[str], event_time: str) -> str:
    """Three loads in order of the flag: the last load that has a key wins, then its latest row."""
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [event_time, *rest])
    return f"""SELECT {', '.join(columns)}, b AS _batch_id FROM (
      SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY b DESC, {order}) AS rn
      FROM (SELECT *, {LOAD_SQL} AS b FROM ({base}))) WHERE rn = 1"""


@query(
    "ingest_sales",
    _merged_drops_sql(SALES_SQL, SALES_FIELDS, SALES_KEYS, "transaction_timestamp"),
    dates="transaction_date",
)
def ingest_sales(spark, sf_dir):
    """Three drops; an updated row leaves the month it was in."""
    contract = SALES.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None), sink=MONTHLY)
    rows = sales(spark, sf_dir)
    drops = [rows.filter(load_of() == load).select(*SALES_FIELDS) for load in LOADS]
    job = ingest_drops(spark, contract, drops, "parquet")
    return spark.table(job.layers.table("silver", SALES.domain)).select(*SALES_FIELDS, "_batch_id")


# The given order lines spread thinly over seven years, so days would be tiny partitions.
MONTHLY = replace(SALES.sink, partition_grain="month")


@query(
    "ingest_inventory",
    _merged_drops_sql(INVENTORY_SQL, INVENTORY_FIELDS, INVENTORY_KEYS, "last_updated_timestamp"),
    dates="last_updated",
)
def ingest_inventory(spark, sf_dir):
    contract = INVENTORY.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None))
    rows = inventory(spark, sf_dir)
    drops = [rows.filter(load_of() == load).select(*INVENTORY_FIELDS) for load in LOADS]
    job = ingest_drops(spark, contract, drops, "parquet")
    return spark.table(job.layers.table("silver", INVENTORY.domain)).select(*INVENTORY_FIELDS, "_batch_id")


@query(
    "stream_dedup",
    f"""WITH inventory AS ({INVENTORY_SQL}), ranked AS (
      SELECT *, {LOAD_SQL} AS b, row_number() OVER (PARTITION BY operation_id
        ORDER BY {LOAD_SQL}, last_updated_timestamp, product_id, warehouse_id, quantity_available) AS rn FROM inventory)
    SELECT operation_id, product_id, warehouse_id, quantity_available, last_updated_timestamp,
      CAST(b AS BIGINT) AS _batch_id FROM ranked WHERE rn = 1""",
)
def stream_dedup(spark, sf_dir):
    """Each operation is kept once, from the batch that brought it first."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    fields = ["operation_id", "product_id", "warehouse_id", "quantity_available", "last_updated_timestamp"]
    contract = INVENTORY.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None))
    name = new_layers(spark).table("silver", "operations")
    # Copies of the given operations lie years apart, so the horizon covers them all.
    sink = FirstSeen(name, ["operation_id"], "last_updated_timestamp", "month", horizon_days=36_500, grain="month")
    rows = inventory(spark, sf_dir)
    for load in LOADS:
        write_landing(rows.filter(load_of() == load).select(*INVENTORY_FIELDS), landing, "parquet")
        stream = stream_landing(spark, contract, landing).select(*fields)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.table(name).select(*fields, "_batch_id")


def _first_seen_sql(days: int) -> str:
    """What three loads leave, each checked against the stored rows of those before it."""
    columns = "operation_id, product_id, warehouse_id, quantity_available, moment"
    order = "moment IS NULL, moment, product_id, warehouse_id, quantity_available"

    def near(one: str, other: str) -> str:
        return f"({one}.moment IS NULL OR {other}.moment IS NULL OR date_trunc('month', {other}.moment) >= date_trunc('month', {one}.moment) - INTERVAL {days} DAYS)"

    stored, tables = "SELECT * FROM s0", ["s0 AS (SELECT * FROM firsts WHERE b = 0)"]
    for b in (1, 2):
        tables.append(
            f"s{b} AS (SELECT * FROM firsts f WHERE b = {b} AND NOT EXISTS (SELECT 1 FROM ({stored}) s WHERE s.operation_id = f.operation_id AND {near('f', 's')}))"
        )
        stored += f" UNION ALL SELECT * FROM s{b}"
    return f"""WITH inventory AS ({INVENTORY_SQL}), timed AS (
      SELECT operation_id, product_id, warehouse_id, quantity_available, {LOAD_SQL} AS b,
        CASE WHEN quantity_reserved = 7 THEN NULL ELSE last_updated_timestamp END AS moment FROM inventory),
      firsts AS (SELECT {columns}, b FROM (
        SELECT *, row_number() OVER (PARTITION BY b, operation_id ORDER BY {order}) AS rn FROM timed) WHERE rn = 1),
      {", ".join(tables)}
    SELECT operation_id, product_id, warehouse_id, quantity_available, moment AS last_updated_timestamp, CAST(b AS BIGINT) AS _batch_id FROM ({stored})"""


BOUNDED_DAYS = 400


@query("stream_dedup_bounded", _first_seen_sql(BOUNDED_DAYS))
def stream_dedup_bounded(spark, sf_dir):
    """Each operation is kept once within a horizon; some have no event time.  Months that cannot hold a key are not read."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    fields = ["operation_id", "product_id", "warehouse_id", "quantity_available", "last_updated_timestamp"]
    contract = INVENTORY.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None))
    name = new_layers(spark).table("silver", "operations")
    sink = FirstSeen(name, ["operation_id"], "last_updated_timestamp", "month", horizon_days=BOUNDED_DAYS, grain="month")
    rows = inventory(spark, sf_dir)
    timeless = F.when(F.col("quantity_reserved") != 7, F.col("last_updated_timestamp"))
    rows = rows.withColumn("last_updated_timestamp", timeless)
    for load in LOADS:
        write_landing(rows.filter(load_of() == load).select(*INVENTORY_FIELDS), landing, "parquet")
        stream = stream_landing(spark, contract, landing).select(*fields)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.table(name).select(*fields, "_batch_id")
