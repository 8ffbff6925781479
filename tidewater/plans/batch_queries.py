"""Row classes, batch metrics, breaker, alerts and quality rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import IOT, WEATHER, BreakerPolicy, MaskingPolicy, WatermarkSpec
from tidewater.operators.alerts import advance_stored, mask_alerts
from tidewater.operators.breaker import breaker_actions, breaker_states
from tidewater.operators.metrics import batch_counts, batch_watermarks, error_rate, monotone_watermark, with_cutoff
from tidewater.operators.quality import (
    contract_rules,
    data_conformance,
    empty_rules,
    range_rules,
    required_rules,
    stale_rule,
    violation_report,
    violations,
)
from tidewater.operators.splits import REASON, is_corrupt, is_late, split_late, split_valid
from tidewater.plans.mapping import BAD_READING_SQL, IOT_SQL, WEATHER_SQL, iot, table, weather, when_every
from tidewater.plans.registry import new_layers, query
from tidewater.plans.source_queries import BAD_LINES_SQL, IOT_FIELDS, bad_temperature, firmware, iot_lines, json_lines
from tidewater.session import written
from tidewater.sources.evolution import observed_fields
from tidewater.sources.rescue import type_json_lines


def typed_iot(spark: SparkSession, sf_dir: str, **planted: Column) -> DataFrame:
    return type_json_lines(iot_lines(spark, sf_dir, **planted), IOT)


def faulty_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with wrong types, missing sensors and missing event times."""
    return typed_iot(
        spark,
        sf_dir,
        temperature=bad_temperature(),
        sensor_id=when_every(53, F.lit(None), F.col("sensor_id")),
        reading_timestamp=when_every(61, F.lit(None), F.col("reading_timestamp")),
    )


FAULTY_SQL = f"""WITH iot AS ({IOT_SQL}), faulty AS (
  SELECT event_id, batch_id, CASE WHEN event_id % 53 <> 0 THEN sensor_id END AS sensor_id,
    CASE WHEN NOT {BAD_READING_SQL} THEN temperature END AS temperature,
    CASE WHEN event_id % 61 <> 0 THEN reading_timestamp END AS reading_timestamp,
    CASE WHEN {BAD_READING_SQL} THEN 'rescued' WHEN event_id % 61 = 0 THEN 'null_event_time'
      WHEN event_id % 53 = 0 THEN 'missing:sensor_id' END AS reason
  FROM iot)"""


# -- splits -------------------------------------------------------------------


@query("split_valid", FAULTY_SQL + " SELECT event_id, sensor_id, temperature FROM faulty WHERE reason IS NULL")
def valid_rows(spark, sf_dir):
    valid, _ = split_valid(faulty_iot(spark, sf_dir), IOT)
    return valid.select("event_id", "sensor_id", "temperature")


@query("split_corrupt", FAULTY_SQL + " SELECT event_id, reason FROM faulty WHERE reason IS NOT NULL")
def corrupt_rows(spark, sf_dir):
    _, corrupt = split_valid(faulty_iot(spark, sf_dir), IOT)
    return corrupt.select("event_id", F.col(REASON).alias("reason"))


@query(
    "split_is_partition",
    FAULTY_SQL + """ SELECT count(*) AS rows_in, count(*) FILTER (reason IS NULL) AS clean,
      count(*) FILTER (reason IS NOT NULL) AS corrupt, CAST(0 AS BIGINT) AS lost FROM faulty""",
)
def split_is_partition(spark, sf_dir):
    """The two parts of a split are disjoint and together are the input."""
    rows = faulty_iot(spark, sf_dir)
    valid, corrupt = split_valid(rows, IOT)
    parts = rows.select("event_id", F.lit(0).alias("side"))
    parts = parts.unionByName(valid.select("event_id", F.lit(1).alias("side")))
    parts = parts.unionByName(corrupt.select("event_id", F.lit(2).alias("side")))
    seen = parts.groupBy("event_id").agg(*(F.count_if(F.col("side") == i).alias(f"s{i}") for i in range(3)))
    return seen.agg(
        F.sum("s0").alias("rows_in"),
        F.sum("s1").alias("clean"),
        F.sum("s2").alias("corrupt"),
        F.count_if(F.col("s0") != F.col("s1") + F.col("s2")).alias("lost"),
    )


# -- lateness -----------------------------------------------------------------

DAY_WATERMARK = WatermarkSpec("reading_timestamp", 1440, 5)


def late_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day batches in which some events are three days older than their batch."""
    old = F.col("reading_timestamp") - F.expr("INTERVAL 3 DAYS")
    return iot(spark, sf_dir).withColumn("reading_timestamp", when_every(50, old, F.col("reading_timestamp")))


LATE_SQL = f"""WITH iot AS ({IOT_SQL}), late_iot AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 = 0 THEN reading_timestamp - INTERVAL 3 DAYS ELSE reading_timestamp END
    AS reading_timestamp) FROM iot),
marks AS (SELECT batch_id, max(reading_timestamp) AS max_event_time,
  max(reading_timestamp) - INTERVAL 1440 MINUTES AS watermark,
  max(reading_timestamp) - INTERVAL 1445 MINUTES AS cutoff FROM late_iot GROUP BY batch_id)"""


@query("batch_watermark", LATE_SQL + " SELECT batch_id, max_event_time, watermark, cutoff FROM marks")
def watermarks(spark, sf_dir):
    return batch_watermarks(late_iot(spark, sf_dir), DAY_WATERMARK)


@query(
    "late_rows",
    LATE_SQL + " SELECT event_id, batch_id, reading_timestamp FROM late_iot JOIN marks USING (batch_id) WHERE reading_timestamp < cutoff",
)
def late_rows(spark, sf_dir):
    _, late = split_late(with_cutoff(late_iot(spark, sf_dir), DAY_WATERMARK), "reading_timestamp", F.col("cutoff"))
    return late.select("event_id", "batch_id", "reading_timestamp")


@query(
    "late_split",
    LATE_SQL + """ SELECT event_id, CASE WHEN event_id % 61 = 0 THEN 'no_time'
      WHEN reading_timestamp < cutoff THEN 'late' ELSE 'on_time' END AS side FROM late_iot JOIN marks USING (batch_id)""",
)
def late_split(spark, sf_dir):
    """A row without event time is neither late nor lost: it stays and is found corrupt."""
    rows = with_cutoff(late_iot(spark, sf_dir), DAY_WATERMARK).withColumn(
        "reading_timestamp", when_every(61, F.lit(None), F.col("reading_timestamp"))
    )
    on_time, late = split_late(rows, "reading_timestamp", F.col("cutoff"))
    side = F.when(F.col("reading_timestamp").isNull(), "no_time").otherwise("on_time")
    return on_time.select("event_id", side.alias("side")).unionByName(late.select("event_id", F.lit("late").alias("side")))


@query(
    "watermark_state",
    LATE_SQL + """ SELECT 'iot_sensors' AS domain, batch_id, 'watermark_time' AS key,
      strftime(watermark, '%Y-%m-%d %H:%M:%S.%f') AS value FROM marks
    UNION ALL SELECT 'iot_sensors', batch_id, 'batch_id', CAST(batch_id AS VARCHAR) FROM marks""",
)
def watermark_state(spark, sf_dir):
    """The watermark of every batch as key/value rows."""
    marks = batch_watermarks(late_iot(spark, sf_dir), DAY_WATERMARK)
    pairs = F.array(
        F.struct(F.lit("watermark_time").alias("key"), F.date_format("watermark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("value")),
        F.struct(F.lit("batch_id").alias("key"), F.col("batch_id").cast("string").alias("value")),
    )
    return marks.select(F.lit("iot_sensors").alias("domain"), "batch_id", F.inline(pairs))


@query(
    "watermark_monotone",
    f"""WITH weather AS ({WEATHER_SQL}), marks AS (
      SELECT city AS domain, batch_id, max(CASE WHEN batch_id % 5 = 4 THEN forecast_timestamp - INTERVAL 9 DAYS
        ELSE forecast_timestamp END) - INTERVAL 30 MINUTES AS watermark FROM weather GROUP BY ALL)
    SELECT domain, batch_id, watermark, max(watermark) OVER (PARTITION BY domain ORDER BY batch_id) AS monotone_watermark
    FROM marks""",
)
def watermark_monotone(spark, sf_dir):
    """Batches whose events jump back do not pull the watermark back."""
    back = F.col("forecast_timestamp") - F.expr("INTERVAL 9 DAYS")
    rows = weather(spark, sf_dir).withColumn(
        "forecast_timestamp",
        F.when(F.col("batch_id") % 5 == 4, back).otherwise(F.col("forecast_timestamp")),
    )
    marks = batch_watermarks(rows.withColumnRenamed("city", "domain"), WEATHER.watermark, ["domain", "batch_id"])
    return monotone_watermark(marks.select("domain", "batch_id", "watermark"))


# -- metrics and breaker --------------------------------------------------------


@query(
    "batch_error_rate",
    BAD_LINES_SQL + """ SELECT batch_id, count(*) AS total, count(_rescued_data) AS corrupt,
      round(count(_rescued_data) / count(*) * 100, 6) AS error_pct FROM landed GROUP BY batch_id""",
)
def batch_error_rate(spark, sf_dir):
    rows = typed_iot(spark, sf_dir, temperature=bad_temperature())
    counts = batch_counts(rows, F.col("_rescued_data").isNotNull(), F.lit(False))
    return counts.select("batch_id", "total", "corrupt", F.round("error_pct", 6).alias("error_pct"))


@query(
    "batch_metrics",
    LATE_SQL + f""", classed AS (SELECT batch_id, reading_timestamp < cutoff AS late, {BAD_READING_SQL} AS corrupt,
        max_event_time FROM late_iot JOIN marks USING (batch_id))
    SELECT batch_id, count(*) AS total, count(*) FILTER (late) AS late, count(*) FILTER (NOT late) AS on_time,
      count(*) FILTER (NOT late AND corrupt) AS corrupt,
      round(count(*) FILTER (NOT late AND corrupt) / count(*) FILTER (NOT late) * 100, 6) AS error_pct,
      max(max_event_time) AS max_event_time
    FROM classed GROUP BY batch_id""",
)
def batch_metrics(spark, sf_dir):
    """All counts of a batch in one aggregation; late rows do not count as errors."""
    lines = json_lines(
        late_iot(spark, sf_dir), IOT_FIELDS, ["event_id", "batch_id"], temperature=bad_temperature()
    )
    # The lines are parsed once: marks, cutoffs and counts need three columns of the parsed rows.
    rows = type_json_lines(lines, IOT).select("batch_id", "reading_timestamp", is_corrupt(IOT).alias("corrupt"))
    rows = written(rows, "parsed")
    marks = batch_watermarks(rows, DAY_WATERMARK)
    late = is_late("reading_timestamp", F.col("cutoff"))
    counts = batch_counts(with_cutoff(rows, DAY_WATERMARK), F.col("corrupt"), late)
    return counts.join(marks.select("batch_id", "max_event_time"), "batch_id").withColumn(
        "error_pct", F.round("error_pct", 6)
    )


POLICY = BreakerPolicy(5, 30, "degrade_mode", True)


def breaker_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rate and time of the day batches of every location."""
    rows = typed_iot(spark, sf_dir, temperature=bad_temperature()).withColumnRenamed("location_id", "domain")
    keys = ["domain", "batch_id"]
    counts = rows.groupBy(*keys).agg(
        F.max("reading_timestamp").alias("batch_time"), F.count("*").alias("total"), F.count_if(F.col("_rescued_data").isNotNull()).alias("corrupt")
    )
    return counts.select(*keys, "batch_time", error_rate(F.col("corrupt"), F.col("total")).alias("error_pct"))


# One recursive step per batch, in order: state and end of the open time.
BREAKER_SQL = BAD_LINES_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, batches AS (
  SELECT location_id AS domain, batch_id, max(reading_timestamp) AS batch_time,
    count(_rescued_data) / count(*) * 100 AS error_pct,
    row_number() OVER (PARTITION BY location_id ORDER BY batch_id) AS n
  FROM landed GROUP BY location_id, batch_id),
walk AS (
  SELECT domain, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS batch_id, 'CLOSED' AS state,
    CAST(NULL AS TIMESTAMP) AS open_until FROM (SELECT DISTINCT domain FROM batches)
  UNION ALL
  SELECT b.domain, b.n, b.batch_id,
    CASE WHEN b.error_pct > 5 THEN (CASE WHEN w.state = 'CLOSED' THEN 'OPEN' ELSE w.state END)
      WHEN w.state = 'OPEN' AND b.batch_time >= w.open_until THEN 'HALF_OPEN'
      WHEN w.state = 'HALF_OPEN' THEN 'CLOSED' ELSE w.state END,
    CASE WHEN b.error_pct > 5 AND w.state = 'CLOSED' THEN b.batch_time + INTERVAL 30 MINUTES ELSE w.open_until END
  FROM walk w JOIN batches b ON b.domain = w.domain AND b.n = w.n + 1)"""


@query("circuit_breaker_states", BREAKER_SQL + " SELECT domain, batch_id, state AS breaker_state FROM walk WHERE n > 0")
def circuit_breaker_states(spark, sf_dir):
    return breaker_states(breaker_batches(spark, sf_dir), POLICY).select("domain", "batch_id", "breaker_state")


@query(
    "breaker_action",
    BREAKER_SQL + """ SELECT domain, batch_id, state AS breaker_state,
      CAST(CASE state WHEN 'CLOSED' THEN 4 WHEN 'OPEN' THEN 1 ELSE 2 END AS INTEGER) AS quarantine_attempts,
      action = 'degrade_mode' AND state <> 'CLOSED' AS tolerate_errors,
      action = 'fail_fast' AND state <> 'CLOSED' AS refuse_batch,
      action = 'alert_only' AND state <> 'CLOSED' AS raise_alert, action
    FROM walk, (VALUES ('degrade_mode'), ('fail_fast'), ('alert_only')) a(action) WHERE n > 0""",
)
def breaker_action(spark, sf_dir):
    """What each batch's state means under each action."""
    states = breaker_states(breaker_batches(spark, sf_dir), POLICY).select("domain", "batch_id", "breaker_state")
    states = written(states, "breaker-states")
    parts = [
        breaker_actions(states, BreakerPolicy(5, 30, action), max_retries=3).withColumn("action", F.lit(action))
        for action in ("degrade_mode", "fail_fast", "alert_only")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- alerts ----------------------------------------------------------------------

ALERTS_SQL = """WITH RECURSIVE seen AS (
  SELECT left(sha256(event_type || ':' || 'user ' || user_id), 16) AS fp, event_type, user_id, ts, event_id
  FROM events WHERE event_type = 'error'),
times AS (SELECT DISTINCT fp, ts FROM seen),
walk AS (
  SELECT fp, min(ts) AS ts FROM times GROUP BY fp
  UNION ALL
  SELECT w.fp, (SELECT min(t.ts) FROM times t WHERE t.fp = w.fp AND t.ts > w.ts + INTERVAL 4 HOURS)
  FROM walk w
  WHERE EXISTS (SELECT 1 FROM times t WHERE t.fp = w.fp AND t.ts > w.ts + INTERVAL 4 HOURS)),
counted AS (SELECT fp, count(*) AS occurrence_count, max(ts) AS notified FROM walk GROUP BY fp)
SELECT fp AS alert_id, event_type AS error_type, 'user ' || user_id AS error_message, fp AS error_fingerprint,
  first_occurrence, last_occurrence, occurrence_count, notified + INTERVAL 4 HOURS AS silenced_until,
  'iot_sensors' AS domain, first_batch AS batch_id
FROM (SELECT fp, min(event_type) AS event_type, min(user_id) AS user_id, min(ts) AS first_occurrence,
        max(ts) AS last_occurrence, CAST(min(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) AS VARCHAR) AS first_batch
      FROM seen GROUP BY fp) JOIN counted USING (fp)"""


def error_occurrences(spark, sf_dir):
    """Every error event is an occurrence."""
    events = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return events.select(
        F.col("event_type").alias("error_type"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("error_message"),
        F.lit("iot_sensors").alias("domain"),
        F.datediff("ts", F.lit(dt.date(2024, 1, 1))).alias("batch_id"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
    )


@query("alert_masking", ALERTS_SQL)
def alert_masking(spark, sf_dir):
    """Each kind of error is silent for four hours after it notified."""
    return mask_alerts(error_occurrences(spark, sf_dir), MaskingPolicy(silence_hours=4))


@query("alert_incremental", ALERTS_SQL)
def alert_incremental(spark, sf_dir):
    """The same log, kept from batch to batch: each reads its own occurrences and the kinds that they are of."""
    name = new_layers(spark).table("system", "alert_state")
    occurrences = written(error_occurrences(spark, sf_dir), "occurrences")
    for first, last in ((-100_000, 9), (10, 19), (20, 100_000)):
        advance_stored(spark, name, occurrences.filter(F.col("batch_id").between(first, last)), MaskingPolicy(silence_hours=4))
    return spark.table(name).drop("_bucket")


# -- quality rules -----------------------------------------------------------------


@query(
    "check_range",
    f"""WITH iot AS ({IOT_SQL})
    SELECT event_id, 'out_of_range:temperature' AS rule FROM iot WHERE NOT temperature BETWEEN -50 AND 100
    UNION ALL SELECT event_id, 'out_of_range:humidity' FROM iot WHERE NOT humidity BETWEEN 5 AND 95""",
)
def check_range(spark, sf_dir):
    rules = range_rules({"temperature": (-50, 100), "humidity": (5, 95)})
    return violations(iot(spark, sf_dir), rules).select("event_id", "rule")


@query("check_empty", "SELECT event_id, 'empty:location_id' AS rule FROM events WHERE event_id % 59 = 0")
def check_empty(spark, sf_dir):
    rows = typed_iot(spark, sf_dir, location_id=when_every(59, F.lit("  "), F.col("location_id")))
    return violations(rows, empty_rules(["sensor_id", "location_id"])).select("event_id", "rule")


@query("check_required", "SELECT event_id, 'missing:sensor_id' AS rule FROM events WHERE event_id % 53 = 0")
def check_required(spark, sf_dir):
    rows = typed_iot(spark, sf_dir, sensor_id=when_every(53, F.lit(None), F.col("sensor_id")))
    return violations(rows, required_rules(IOT)).select("event_id", "rule")


STALE_BEFORE = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)


@query(
    "violation_report",
    FAULTY_SQL + """, broken AS (
      SELECT 'wrong_type' AS rule, count(*) FILTER (reason = 'rescued') AS violations FROM faulty
      UNION ALL SELECT 'missing:sensor_id', count(*) - count(sensor_id) FROM faulty
      UNION ALL SELECT 'missing:location_id', 0
      UNION ALL SELECT 'missing:reading_timestamp', count(*) - count(reading_timestamp) FROM faulty
      UNION ALL SELECT 'missing:reading_date', 0
      UNION ALL SELECT 'empty:sensor_id', 0
      UNION ALL SELECT 'empty:location_id', 0
      UNION ALL SELECT 'out_of_range:temperature', count(*) FILTER (NOT temperature BETWEEN 15 AND 40) FROM faulty
      UNION ALL SELECT 'out_of_range:humidity', count(*) FILTER (NOT humidity BETWEEN 30 AND 95) FROM iot
      UNION ALL SELECT 'out_of_range:ph', count(*) FILTER (NOT ph BETWEEN 4 AND 9) FROM iot
      UNION ALL SELECT 'out_of_range:soil_moisture', count(*) FILTER (NOT soil_moisture BETWEEN 10 AND 80) FROM iot
      UNION ALL SELECT 'stale:reading_timestamp', count(*) FILTER (reading_timestamp < TIMESTAMP '2024-01-10') FROM faulty)
    SELECT rule, CAST(violations AS BIGINT) AS violations FROM broken""",
)
def report(spark, sf_dir):
    rules = contract_rules(IOT) | stale_rule("reading_timestamp", F.lit(STALE_BEFORE))
    return violation_report(faulty_iot(spark, sf_dir), rules)


@query(
    "schema_conformance",
    f"""WITH iot AS ({IOT_SQL}) SELECT * FROM (VALUES ('sensor_id', 'StringType'), ('location_id', 'StringType'),
        ('temperature', 'DoubleType'), ('humidity', 'DoubleType'), ('ph', 'DoubleType'), ('soil_moisture', 'DoubleType'),
        ('reading_timestamp', 'TimestampType'), ('reading_date', 'DateType'), ('firmware', NULL)) d(name, declared_type)
      JOIN (SELECT unnest(['sensor_id', 'location_id', 'temperature', 'humidity', 'ph', 'soil_moisture',
              'reading_timestamp', 'reading_date', 'firmware']) AS name,
            unnest([count(*) FILTER (event_id % 53 <> 0), count(*), count(*), count(*), 0, count(*), count(*), count(*),
              count(*) FILTER (event_id % 37 = 0)]) AS present,
            unnest([0, 0, count(*) FILTER ({BAD_READING_SQL}), 0, 0, 0, 0, 0, 0]) AS misfits,
            unnest(['incomplete', 'ok', 'retyped', 'ok', 'missing', 'ok', 'ok', 'ok', 'extra']) AS status FROM iot)
      USING (name)""",
)
def conformance(spark, sf_dir):
    """Landed fields against the contract: one missing, one new, one of another type, one with gaps."""
    lines = iot_lines(
        spark,
        sf_dir,
        sensor_id=when_every(53, F.lit(None), F.col("sensor_id")),
        temperature=bad_temperature(),
        ph=F.lit(None),
        firmware=firmware(),
    )
    total = lines.agg(F.count("*")).first()[0]
    return data_conformance(observed_fields(lines, IOT), F.lit(total), IOT)
