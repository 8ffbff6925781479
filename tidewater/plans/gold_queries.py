"""Rollups, facts, retention and governance."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import INVENTORY, IOT, SALES, WEATHER, RollupMetric
from tidewater.functions.moments import timestamp
from tidewater.operators import lifecycle
from tidewater.operators.facts import dimension, inventory_fact, sales_fact, star_totals, sync_fact
from tidewater.operators.governance import create_tables, landed_schemas, registry
from tidewater.operators.history import Dimension
from tidewater.operators.lifecycle import audited, purge_table, roll_up_expiring, rollup_then_purge, within_ttl
from tidewater.operators.metadata import inject_metadata
from tidewater.operators.rollup import contract_rollup, iot_daily, rollup, weather_daily
from tidewater.operators.tables import SEGMENT, Layers, append_batch, overwrite_partitions
from tidewater.operators.upsert import write_clean
from tidewater.plans.mapping import (
    AS_OF,
    INGEST_TIME,
    INVENTORY_SQL,
    IOT_SQL,
    SALES_SQL,
    WEATHER_SQL,
    inventory,
    iot,
    sales,
    table,
    weather,
    when_every,
)
from tidewater.plans.registry import new_layers, query
from tidewater.plans.source_queries import IOT_FIELDS, json_lines
from tidewater.sources.rescue import TEXT_MAP


def _rollup_sql(metrics: list[str]) -> str:
    return ", ".join(
        f"min({m}) AS min_{m}, max({m}) AS max_{m}, round(avg({m}), 6) AS avg_{m}" for m in metrics
    )


IOT_METRICS = ["temperature", "humidity", "ph", "soil_moisture"]
WEATHER_METRICS = ["temperature", "humidity"]


# -- rollups ------------------------------------------------------------------


@query(
    "iot_daily_rollup",
    f"""WITH iot AS ({IOT_SQL}) SELECT sensor_id, location_id AS location, reading_date AS date, {_rollup_sql(IOT_METRICS)}
    FROM iot GROUP BY ALL""",
    dates="date",
)
def iot_daily_rollup(spark, sf_dir):
    return iot_daily(iot(spark, sf_dir))


@query(
    "weather_daily_rollup",
    f"""WITH weather AS ({WEATHER_SQL}) SELECT city, forecast_date AS date, {_rollup_sql(WEATHER_METRICS)}
    FROM weather GROUP BY ALL""",
    dates="date",
)
def weather_daily_rollup(spark, sf_dir):
    return weather_daily(weather(spark, sf_dir))


@query(
    "rollup_from_contract",
    f"""WITH iot AS ({IOT_SQL}) SELECT sensor_id, location_id, reading_date AS date, {_rollup_sql(IOT_METRICS)}
    FROM iot GROUP BY ALL""",
    dates="date",
)
def rollup_from_contract(spark, sf_dir):
    """The metrics and operations the contract lists."""
    return contract_rollup(iot(spark, sf_dir), IOT)


@query(
    "rollup_monthly",
    f"""WITH inventory AS ({INVENTORY_SQL}) SELECT warehouse_id,
      CAST(date_trunc('month', last_updated_timestamp) AS TIMESTAMP) AS date,
      min(quantity_available) AS min_quantity_available, max(quantity_available) AS max_quantity_available
    FROM inventory GROUP BY ALL""",
)
def rollup_monthly(spark, sf_dir):
    """Another frequency and other operations."""
    metrics = [RollupMetric("quantity_available", ("min", "max"), "monthly")]
    return rollup(inventory(spark, sf_dir), ["warehouse_id"], "last_updated_timestamp", metrics)


MIXED = (
    RollupMetric("temperature", ("min", "max", "avg"), "hourly"),
    RollupMetric("temperature", ("avg",), "monthly"),
    RollupMetric("humidity", ("avg",), "daily"),
    RollupMetric("ph", ("max",), "weekly"),
)


def _mixed_sql() -> str:
    names = list(dict.fromkeys(f"{o}_{m.metric}" for m in MIXED for o in m.operations))
    grains = []
    for frequency, unit in (("hourly", "hour"), ("daily", "day"), ("weekly", "week"), ("monthly", "month")):
        own = {f"{o}_{m.metric}": f"{o}({m.metric})" for m in MIXED if m.frequency == frequency for o in m.operations}
        columns = ", ".join(f"{f'round({own[n]}, 6)' if n.startswith('avg') and n in own else own.get(n, 'CAST(NULL AS DOUBLE)')} AS {n}" for n in names)
        grains.append(f"SELECT sensor_id, location_id, '{frequency}' AS grain, CAST(date_trunc('{unit}', reading_timestamp) AS TIMESTAMP) AS date, {columns} FROM iot GROUP BY ALL")
    return f"WITH iot AS ({IOT_SQL}) " + " UNION ALL ".join(grains)


@query("rollup_mixed_grains", _mixed_sql())
def rollup_mixed_grains(spark, sf_dir):
    """One contract, four frequencies: hours are made once, the others from them."""
    contract = IOT.with_options(lifecycle=replace(IOT.lifecycle, rollups=MIXED))
    return contract_rollup(iot(spark, sf_dir), contract)


# -- facts ---------------------------------------------------------------------

FACT_DAY = dt.date(2000, 1, 1)


@query(
    "sales_fact_d1",
    f"""WITH sales AS ({SALES_SQL}) SELECT transaction_id, customer_id, amount, currency, transaction_date, '7' AS batch_id,
      TIMESTAMP '2024-02-01' AS ingest_timestamp FROM sales WHERE transaction_date < DATE '2000-01-01'""",
    dates="transaction_date",
)
def sales_fact_d1(spark, sf_dir):
    silver = inject_metadata(sales(spark, sf_dir), SALES.with_options(metadata=()), 7, INGEST_TIME)
    return sales_fact(silver, FACT_DAY)


@query(
    "inventory_fact_d1",
    f"""WITH inventory AS ({INVENTORY_SQL}) SELECT product_id, warehouse_id, CAST(quantity_available AS BIGINT) AS quantity,
      last_updated AS movement_date, '7' AS batch_id, TIMESTAMP '2024-02-01' AS ingest_timestamp
    FROM inventory WHERE last_updated < DATE '2000-01-01'""",
    dates="movement_date",
)
def inventory_fact_d1(spark, sf_dir):
    silver = inject_metadata(inventory(spark, sf_dir), INVENTORY.with_options(metadata=()), 7, INGEST_TIME)
    return inventory_fact(silver, FACT_DAY)


@query(
    "sales_star",
    f"""WITH sales AS ({SALES_SQL}) SELECT c_mktsegment AS segment, p_brand AS brand, year(transaction_date) AS year,
      count(*) AS facts, round(sum(amount), 2) AS amount, CAST(sum(quantity) AS BIGINT) AS quantity
    FROM sales JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR)
      JOIN part ON product_id = CAST(p_partkey AS VARCHAR)
    WHERE transaction_date < DATE '2000-01-01' GROUP BY ALL""",
)
def sales_star(spark, sf_dir):
    """Sales by attributes of customer and product."""
    facts = sales(spark, sf_dir).filter(F.col("transaction_date") < F.lit(FACT_DAY))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_brand").alias("brand")
    )
    totals = star_totals(
        facts.withColumn("year", F.year("transaction_date").cast("long")),
        {
            "customer_id": dimension(customers, "customer_id", "segment"),
            "product_id": dimension(products, "product_id", "brand"),
        },
        ["segment", "brand", "year"],
        {"amount": "amount", "quantity": "quantity"},
        ["year"],
    )
    return totals.withColumn("amount", F.round("amount", 2))


@query(
    "sales_dimensions",
    f"""WITH sales AS ({SALES_SQL}), inventory AS ({INVENTORY_SQL})
    SELECT 'customer' AS dimension, customer_id AS member FROM sales GROUP BY customer_id
    UNION ALL SELECT 'product', product_id FROM sales GROUP BY product_id
    UNION ALL SELECT 'warehouse', warehouse_id FROM inventory GROUP BY warehouse_id""",
)
def sales_dimensions(spark, sf_dir):
    """Members of the dimensions, taken from the facts themselves."""
    sold = sales(spark, sf_dir)
    parts = [
        (sold, "customer_id", "customer"),
        (sold, "product_id", "product"),
        (inventory(spark, sf_dir), "warehouse_id", "warehouse"),
    ]
    frames = [
        dimension(df, key).select(F.lit(name).alias("dimension"), F.col(key).alias("member")) for df, key, name in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


SECOND_RUN = dt.date(2024, 1, 16)


@query(
    "facts_incremental",
    f"""WITH sales AS ({SALES_SQL}), loads AS (
      SELECT transaction_id, customer_id, currency, product_id, quantity, amount, 0 AS b, DATE '2024-01-01' + CAST(quantity % 20 AS INTEGER) AS day FROM sales
      UNION ALL SELECT transaction_id, customer_id, currency, product_id, quantity, amount + 1, 1, DATE '2024-01-01' + CAST(quantity % 20 + 4 AS INTEGER) FROM sales WHERE flag = 'R'),
      placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY b DESC, day DESC, customer_id DESC, product_id DESC, amount DESC, quantity DESC) AS rn FROM loads)
    SELECT transaction_id, customer_id, amount, currency, day AS transaction_date, CAST(b AS VARCHAR) AS batch_id FROM placed
    WHERE rn = 1 AND day < DATE '2024-01-16'""",
    dates="transaction_date",
)
def facts_incremental(spark, sf_dir):
    """Stored facts after two daily runs: returned lines were corrected and moved in between, and days had come of age."""
    layers, contract = new_layers(spark), SALES.with_options(metadata=())
    rows = sales(spark, sf_dir)
    for batch, (load, days, run) in enumerate(((rows, 0, dt.date(2024, 1, 11)), (rows.filter("flag = 'R'"), 4, SECOND_RUN))):
        day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("quantity") % 20 + days).cast("int"))
        load = load.withColumns({"transaction_date": day, "transaction_timestamp": day.cast("timestamp"), "amount": F.col("amount") + batch})
        stamped = inject_metadata(load.drop("flag"), contract, batch, INGEST_TIME)
        write_clean(spark, stamped, layers, contract)
        name, _ = sync_fact(spark, layers, contract, run)
    return spark.table(name).select("transaction_id", "customer_id", "amount", "currency", "transaction_date", "batch_id")


@query(
    "star_as_of",
    f"""WITH sales AS ({SALES_SQL}), sold AS (
      SELECT CASE WHEN c_custkey % 3 = 0 AND transaction_date >= DATE '1996-01-01' THEN 'MOVED'
        WHEN c_custkey % 6 = 0 AND transaction_date >= DATE '1994-01-01' THEN 'EARLY' ELSE c_mktsegment END AS segment,
        year(transaction_date) AS year, amount, c_custkey % 6 = 0 AND transaction_date >= DATE '1994-01-01' AND transaction_date < DATE '1996-01-01' AS early
      FROM sales JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR))
    SELECT segment, year, count(*) AS facts, round(sum(amount), 2) AS amount FROM sold GROUP BY ALL""",
)
def star_as_of(spark, sf_dir):
    """Sales by the segment that the customer was in at the time; one change is reported late, behind a later one."""
    dim = Dimension(spark, new_layers(spark).table("gold", "dim_customer"), "customer_id", ["segment"])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey"), F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    reports = (
        (customers, dt.datetime(1990, 1, 1), None),
        (customers.filter("c_custkey % 3 = 0"), dt.datetime(1996, 1, 1), "MOVED"),
        (customers.filter("c_custkey % 6 = 0"), dt.datetime(1994, 1, 1), "EARLY"),
    )
    for members, at, segment in reports:
        changed = members if segment is None else members.withColumn("segment", F.lit(segment))
        dim.apply(changed.withColumn("at", timestamp(at)), "at")
    # A customer's day is one row before it meets the versions.
    days = sales(spark, sf_dir).groupBy("customer_id", "transaction_date").agg(F.count("*").alias("facts"), F.sum("amount").alias("amount"))
    placed = dim.as_of(days, "transaction_date").withColumn("year", F.year("transaction_date").cast("long"))
    return placed.groupBy("segment", "year").agg(F.sum("facts").alias("facts"), F.round(F.sum("amount"), 2).alias("amount"))


# -- retention --------------------------------------------------------------------


def stored_iot(spark: SparkSession, sf_dir: str) -> Layers:
    """The whole readings table, stored clean by day."""
    layers = new_layers(spark)
    bare = IOT.with_options(metadata=())
    rows = inject_metadata(iot(spark, sf_dir).drop("batch_id", "event_id"), bare, 0, INGEST_TIME)
    write_clean(spark, rows, layers, bare)
    return layers


@query(
    "ttl_purge",
    """SELECT CAST(ts AS DATE) AS reading_date, count(*) AS n FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 14 GROUP BY ALL""",
    dates="reading_date",
)
def ttl_purge(spark, sf_dir):
    """What is left after the purge, which must equal what the filter keeps."""
    layers = stored_iot(spark, sf_dir)
    name = layers.table("silver", IOT.domain)
    purge_table(spark, name, "reading_date", AS_OF, 14)
    return spark.table(name).groupBy("reading_date").agg(F.count("*").alias("n"))


@query(
    "ttl_filter",
    """SELECT event_id, CAST(ts AS DATE) AS reading_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 14""",
    dates="reading_date",
)
def ttl_filter(spark, sf_dir):
    return within_ttl(iot(spark, sf_dir), "reading_date", AS_OF, 14).select("event_id", "reading_date")


@query(
    "rollup_then_purge",
    f"""WITH iot AS ({IOT_SQL}) SELECT 'gold' AS side, sensor_id, location_id, reading_date AS date,
      CAST(NULL AS BIGINT) AS n, {_rollup_sql(['temperature'])} FROM iot WHERE reading_date <= DATE '2024-01-31' - 13 GROUP BY ALL
    UNION ALL SELECT 'silver', sensor_id, location_id, reading_date, count(*), NULL, NULL, NULL
    FROM iot WHERE reading_date >= DATE '2024-01-31' - 14 GROUP BY ALL""",
    dates="date",
)
def rolled_then_purged(spark, sf_dir):
    """Expiring days in gold, remaining days in silver: no day is lost."""
    layers = stored_iot(spark, sf_dir)
    gold, _ = rollup_then_purge(spark, layers, IOT, AS_OF)
    kept = spark.table(layers.table("silver", IOT.domain))
    left = kept.groupBy("sensor_id", "location_id", F.col("reading_date").alias("date")).agg(F.count("*").alias("n"))
    rolled = spark.table(gold).select(
        F.lit("gold").alias("side"), "sensor_id", F.col("location").alias("location_id"), "date", "min_temperature", "max_temperature", "avg_temperature"
    )
    return rolled.unionByName(left.withColumn("side", F.lit("silver")), allowMissingColumns=True)


@query(
    "rollup_straggler",
    f"""WITH iot AS ({IOT_SQL}) SELECT sensor_id, location_id AS location, reading_date AS date, {_rollup_sql(IOT_METRICS)} FROM (
      SELECT * FROM iot UNION ALL SELECT * REPLACE (temperature + 100 AS temperature) FROM iot WHERE reading_date < DATE '2024-01-31' - 14)
    WHERE reading_date <= DATE '2024-01-31' - 13 GROUP BY ALL""",
    dates="date",
)
def rollup_straggler(spark, sf_dir):
    """Readings that come after their day was purged add to its gold rows; the run is repeated without effect."""
    layers = stored_iot(spark, sf_dir)
    rollup_then_purge(spark, layers, IOT, AS_OF)
    old = within_ttl_not(iot(spark, sf_dir)).withColumn("temperature", F.col("temperature") + 100).drop("batch_id", "event_id")
    bare = IOT.with_options(metadata=())
    write_clean(spark, inject_metadata(old, bare, 1, INGEST_TIME), layers, bare)
    for _ in range(2):
        gold, _ = rollup_then_purge(spark, layers, IOT, AS_OF)
    return spark.table(gold).select("sensor_id", "location", "date", *[f"{o}_{m}" for m in IOT_METRICS for o in ("min", "max", "avg")])


@query(
    "rollup_crash",
    f"""WITH iot AS ({IOT_SQL}) SELECT sensor_id, location_id AS location, reading_date AS date, {_rollup_sql(IOT_METRICS)} FROM (
      SELECT * FROM iot UNION ALL SELECT * REPLACE (temperature + 40 AS temperature) FROM iot WHERE reading_date < DATE '2024-01-31' - 14)
    WHERE reading_date <= DATE '2024-01-31' - 13 GROUP BY ALL""",
    dates="date",
)
def rollup_crash(spark, sf_dir):
    """A run ends after it dropped the expired days and before it could say so; as many readings come later, and are added to gold."""
    layers = stored_iot(spark, sf_dir)
    roll_up_expiring(spark, layers, IOT, AS_OF)
    places = lifecycle._stored_places(spark, layers, IOT)
    lifecycle.intend_purge(spark, layers, IOT, AS_OF, places)
    purge_table(spark, layers.table("silver", IOT.domain), "reading_date", AS_OF, 14)
    old = within_ttl_not(iot(spark, sf_dir)).withColumn("temperature", F.col("temperature") + 40).drop("batch_id", "event_id")
    bare = IOT.with_options(metadata=())
    write_clean(spark, inject_metadata(old, bare, 1, INGEST_TIME), layers, bare)
    for _ in range(2):
        gold, _ = rollup_then_purge(spark, layers, IOT, AS_OF)
    return spark.table(gold).select("sensor_id", "location", "date", *[f"{o}_{m}" for m in IOT_METRICS for o in ("min", "max", "avg")])


def within_ttl_not(rows):
    """Readings past their time to live."""
    return rows.filter(F.col("reading_date") < F.lit(AS_OF - dt.timedelta(days=14)))


@query(
    "ttl_purge_escaped",
    """SELECT event_type || ':'' %=/' AS kind, CAST(ts AS DATE) AS d, count(*) AS n FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 14 GROUP BY ALL""",
    dates="d",
)
def ttl_purge_escaped(spark, sf_dir):
    """Partition names that paths must escape are purged like others."""
    name = new_layers(spark).table("silver", "kinds")
    rows = iot(spark, sf_dir).select(
        "event_id", F.concat(F.expr("substring(location_id, 5)"), F.lit(":' %=/")).alias("kind"), F.col("reading_date").alias("d"), F.lit(0).cast("long").alias("_batch_id")
    )
    append_batch(rows, name, ["kind", "d"])
    purge_table(spark, name, "d", AS_OF, 14)
    return spark.table(name).groupBy("kind", "d").agg(F.count("*").alias("n"))


@query(
    "batch_audit",
    """SELECT 'ROLLUP' AS operation_type, 'gold.iot_daily_obt' AS table_name,
      (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) FROM events
        WHERE CAST(ts AS DATE) <= DATE '2024-01-31' - 13)) AS rows_affected, 'SUCCESS' AS status, '7' AS batch_id
    UNION ALL SELECT 'PURGE', 'silver.iot_sensors', (SELECT count(*) FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-31' - 14), 'SUCCESS', '7'""",
)
def batch_audit(spark, sf_dir):
    """One audit row per maintenance step; run times differ and are left out."""
    layers = stored_iot(spark, sf_dir)
    silver = layers.table("silver", IOT.domain)

    def roll() -> int:
        return spark.table(roll_up_expiring(spark, layers, IOT, AS_OF)).count()

    audited(spark, layers, "ROLLUP", layers.table("gold", IOT.lifecycle.output_table), 7, INGEST_TIME, roll)
    audited(spark, layers, "PURGE", silver, 7, INGEST_TIME, lambda: purge_table(spark, silver, "reading_date", AS_OF, 14))
    log = spark.table(layers.table("system", "lifecycle_audit"))
    return log.select(
        "operation_type",
        F.replace(F.col("table_name"), F.lit(layers.prefix), F.lit("")).alias("table_name"),
        "rows_affected",
        "status",
        "batch_id",
    )


# -- governance ---------------------------------------------------------------------

# Tables of a new installation and their number of columns.
NEW_TABLES = {
    "silver.sales_online": 21,
    "silver.inventory_erp": 21,
    "silver.iot_sensors": 21,
    "silver.weather_external": 18,
    "gold.sales_fact_d1": 7,
    "gold.inventory_fact_d1": 6,
    "gold.iot_daily_obt": 17,
    "gold.weather_daily_obt": 10,
    "system.alert_logs": 10,
    "system.schema_registry_snapshots": 6,
    "system.lifecycle_audit": 10,
}
_COUNTS = {
    "silver.weather_external": "(SELECT count(*) FROM events)",
    "gold.weather_daily_obt": "(SELECT count(*) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events))",
}


@query(
    "create_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {columns} AS n_columns, {_COUNTS.get(name, '0')} AS n_rows"
        for name, columns in NEW_TABLES.items()
    ),
)
def new_tables(spark, sf_dir):
    """All tables are created, then the weather readings and their daily rollup are stored in theirs."""
    layers = new_layers(spark)
    names = create_tables(spark, layers)
    rows = weather(spark, sf_dir).drop("batch_id", "event_id").withColumn("_source_file", F.lit("events"))
    write_clean(spark, inject_metadata(rows, WEATHER, 0, INGEST_TIME), layers, WEATHER)
    silver = spark.table(layers.table("silver", WEATHER.domain))
    daily = weather_daily(silver).withColumns({"batch_id": F.lit("0"), "ingest_timestamp": F.lit(INGEST_TIME)})
    overwrite_partitions(daily, layers.table("gold", "weather_daily_obt"), ["date"])
    counts = None
    for name in names:
        stored = spark.table(name)
        line = stored.agg(
            F.lit(name.removeprefix(layers.prefix)).alias("table_name"),
            F.lit(len([c for c in stored.columns if c != SEGMENT])).alias("n_columns"),
            F.count("*").alias("n_rows"),
        )
        counts = line if counts is None else counts.unionByName(line)
    return counts


@query(
    "schema_registry",
    f"""WITH iot AS ({IOT_SQL}), fields AS (
      SELECT location_id AS domain, batch_id, reading_timestamp AS at_time, unnest([
        'sensor_id', 'location_id', 'temperature', 'humidity', 'ph', 'soil_moisture', 'reading_timestamp', 'reading_date',
        CASE WHEN event_id % 37 = 0 AND batch_id >= 10 THEN 'firmware' END,
        CASE WHEN event_id % 37 = 0 AND batch_id >= 20 THEN 'signal' END]) AS name FROM iot),
      batches AS (SELECT domain, batch_id, min(at_time) AS created,
        '["' || string_agg(DISTINCT name, '","' ORDER BY name) || '"]' AS schema_json FROM fields WHERE name IS NOT NULL GROUP BY ALL),
      versions AS (SELECT domain, schema_json, left(sha256(schema_json), 8) AS schema_version,
        min(created) AS created_timestamp FROM batches GROUP BY ALL)
    SELECT *, 'unknown' AS pipeline_git_hash, CASE WHEN row_number() OVER (PARTITION BY domain
        ORDER BY created_timestamp DESC, schema_version DESC) = 1 THEN 'active' ELSE 'deprecated' END AS status
    FROM versions""",
)
def schema_registry(spark, sf_dir):
    """The schemas that really landed: new fields appear over time."""
    lines = json_lines(
        iot(spark, sf_dir),
        IOT_FIELDS,
        ["location_id", "batch_id", "reading_timestamp"],
        firmware=F.when(F.col("batch_id") >= 10, when_every(37, F.lit("v2"), F.lit(None))),
        signal=F.when(F.col("batch_id") >= 20, when_every(37, F.lit("-70"), F.lit(None))),
    )
    names = lines.select(
        F.col("location_id").alias("domain"),
        "batch_id",
        F.col("reading_timestamp").alias("created_timestamp"),
        F.explode(F.map_keys(F.from_json("value", TEXT_MAP))).alias("name"),
    )
    return registry(landed_schemas(names).withColumn("pipeline_git_hash", F.lit("unknown")))
