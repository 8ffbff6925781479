"""Upserts into partitioned tables, the ingestion stream, retention."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.contracts import (
    INVENTORY,
    IOT,
    SALES,
    WEATHER,
    BreakerPolicy,
    RollupMetric,
    SinkSpec,
    SourceSpec,
    WatermarkSpec,
)
from tidewater.operators.alerts import alert_log, refresh_alert_log
from tidewater.operators.facts import star_totals
from tidewater.operators.governance import register_contract
from tidewater.operators.lifecycle import audited, purge_late, purge_table, rollup_then_purge
from tidewater.operators.rollup import rollup_grains
from tidewater.operators.tables import Layers, append_batch, clustered, partition_values
from tidewater.operators.upsert import merge_table, provider, source_winners, upsert
from tidewater.session import scratch_path
from tidewater.sources.landing import read_landing
from tidewater.streaming.dedup import FirstSeen, within_watermark
from tidewater.streaming.ingest import BatchRefused, Ingest

DAY = dt.date(2024, 1, 1)
AT = dt.datetime(2024, 1, 1)


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers(str(tmp_path / "tables"), f"x{uuid.uuid4().hex[:8]}_")
    layers.create(spark)
    return layers


SALES_SMALL = SALES.with_options(metadata=())


def sale(key, day, amount, hour=0):
    at = AT + dt.timedelta(days=day, hours=hour)
    return (key, "c", "p", float(amount), 1, "EUR", at, at.date())


def sales(spark, *rows):
    schema = ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in SALES.fields)
    return spark.createDataFrame(list(rows), schema)


def stored(spark, name):
    return sorted((r["transaction_id"], r["amount"], r["transaction_date"].day) for r in spark.table(name).collect())


def test_merge_moves_rows_and_drops_emptied_partitions(spark, layers):
    name = merge_table(spark, sales(spark, sale("a", 0, 1), sale("b", 1, 2), sale("c", 1, 3)), layers, SALES_SMALL)
    second = sales(spark, sale("a", 2, 10), sale("b", 2, 20), sale("d", 3, 4))
    for _ in range(2):  # a repeated batch changes nothing
        merge_table(spark, second, layers, SALES_SMALL)
        assert stored(spark, name) == [("a", 10.0, 3), ("b", 20.0, 3), ("c", 3.0, 2), ("d", 4.0, 4)]
        days = {r["spec"]["transaction_date"] for r in partition_values(spark, name).collect()}
        assert days == {"2024-01-02", "2024-01-03", "2024-01-04"}
    assert provider(spark, name) == "parquet"


def test_merge_takes_the_latest_of_several_source_rows(spark, layers):
    rows = sales(spark, sale("a", 0, 1, hour=1), sale("a", 0, 2, hour=5), sale("a", 0, 3, hour=5), sale("a", 0, 9))
    name = merge_table(spark, rows, layers, SALES_SMALL)
    assert stored(spark, name) == [("a", 3.0, 1)]


def test_merge_by_key_bucket_and_by_month(spark, layers):
    for sink in (
        SinkSpec("merge_into", ("transaction_id",), ("transaction_date",), key_buckets=4),
        SinkSpec("merge_into", ("transaction_id",), ("transaction_date",), partition_grain="month"),
    ):
        contract = SALES_SMALL.with_options(sink=sink)
        own = Layers(layers.root, f"{layers.prefix}{sink.key_buckets}_")
        own.create(spark)
        merge_table(spark, sales(spark, *(sale(f"k{i}", i, i) for i in range(20))), own, contract)
        name = merge_table(spark, sales(spark, *(sale(f"k{i}", 40, 100) for i in range(10, 25))), own, contract)
        assert spark.table(name).count() == 25
        assert spark.table(name).filter("amount = 100").count() == 15


def test_merge_into_partitions_that_do_not_move_reads_only_those(spark, layers):
    sink = SinkSpec("merge_into", ("transaction_id",), ("transaction_date",), partition_moves=False)
    contract = SALES_SMALL.with_options(sink=sink)
    merge_table(spark, sales(spark, sale("a", 0, 1), sale("b", 1, 2)), layers, contract)
    name = merge_table(spark, sales(spark, sale("a", 0, 5)), layers, contract)
    assert stored(spark, name) == [("a", 5.0, 1), ("b", 2.0, 2)]


def test_null_keys_are_always_added(spark):
    schema = "k string, j string, t int"
    target = spark.createDataFrame([("a", "x", 1), (None, "x", 1)], schema)
    source = spark.createDataFrame([("a", "x", 2), (None, "x", 1), (None, "x", 1), (None, "y", 0), ("b", None, 3)], schema)
    got = upsert(target, source, ["k", "j"], "t").collect()
    want = [("a", "x", 2), ("b", None, 3), (None, "x", 1), (None, "x", 1), (None, "y", 0)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_merge_twice_equals_merge_once(spark):
    target = spark.createDataFrame([(i, 0, "old") for i in range(20)], "k int, t int, v string")
    source = spark.createDataFrame([(i % 30, i, f"new{i}") for i in range(10, 90)], "k int, t int, v string")
    once = upsert(target, source, ["k"], "t")
    twice = upsert(once, source, ["k"], "t")
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert source_winners(source, ["k"], "t").count() == 30


# -- stream ---------------------------------------------------------------------

JSON_WEATHER = WEATHER.with_options(
    source=SourceSpec("json", max_bytes_per_trigger=None), watermark=WatermarkSpec("forecast_timestamp", 60, 5)
)


def land(spark, path, *rows):
    texts = []
    for city, minute, temperature in rows:
        at = None if minute is None else (AT + dt.timedelta(minutes=minute)).isoformat(" ")
        fields = {"city": city, "temperature": temperature, "forecast_timestamp": at}
        texts.append((json.dumps({k: v for k, v in fields.items() if v is not None}),))
    spark.createDataFrame(texts, "value string").coalesce(1).write.mode("append").text(path)


def ingest(spark, layers, contract=JSON_WEATHER):
    return Ingest(spark, contract, layers, clock=lambda batch: AT + dt.timedelta(hours=batch))


def cities(spark, name):
    return sorted(str(r["city"]) for r in spark.table(name).collect())


def test_rows_reach_their_tables_and_the_state_is_kept(spark, layers):
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    job = ingest(spark, layers)
    land(spark, landing, ("a", 100, 1), ("a", 100, 1), ("late", 34, 1), ("edge", 35, 1), ("bad", 90, "x"), (None, 90, 1), ("none", None, 1))
    job.run(landing, checkpoint)
    assert cities(spark, layers.table("silver", "weather_external")) == ["a", "edge"]
    assert cities(spark, layers.table("bronze", "weather_external_late")) == ["late"]
    quarantined = spark.table(layers.table("quarantine", "weather_external")).collect()
    assert {(r["city"], r["_reason"]) for r in quarantined} == {
        ("bad", "rescued"),
        (None, "missing:city"),
        ("none", "null_event_time"),
    }
    assert spark.table(layers.table("bronze", "weather_external")).count() == 6
    state = spark.table(job.state_table).first()
    assert (state["total"], state["late"], state["on_time"], state["corrupt"]) == (7, 1, 6, 3)
    assert state["breaker_state"] == "OPEN" and state["error_pct"] == 50.0

    # A second run reads only the new file; a good batch after the open time half-opens the breaker.
    land(spark, landing, ("new", 200, 1))
    job.run(landing, checkpoint)
    assert cities(spark, layers.table("silver", "weather_external")) == ["a", "edge", "new"]
    states = {r["_batch_id"]: r["breaker_state"] for r in spark.table(job.state_table).collect()}
    assert states == {0: "OPEN", 1: "HALF_OPEN"}
    lineage = spark.table(layers.table("silver", "weather_external")).filter("city = 'new'").first()
    assert lineage["_batch_id"] == 1 and lineage["_file_path"].startswith("file:")


def test_a_batch_that_runs_again_replaces_itself(spark, layers):
    landing = scratch_path(spark, "landing")
    job = ingest(spark, layers)
    land(spark, landing, ("a", 100, 1), ("late", 1, 1), ("bad", 90, "x"))
    job.run(landing, scratch_path(spark, "checkpoint"))
    job.process(read_landing(spark, JSON_WEATHER, landing), 0)
    for layer, name in (("silver", ""), ("quarantine", ""), ("bronze", "_late")):
        assert spark.table(layers.table(layer, f"weather_external{name}")).count() == 1
    assert spark.table(layers.table("bronze", "weather_external")).count() == 3
    assert spark.table(job.state_table).count() == 1


def test_all_times_missing_filters_nothing_as_late(spark, layers):
    landing = scratch_path(spark, "landing")
    land(spark, landing, ("a", None, 1), ("b", None, 2))
    job = ingest(spark, layers)
    job.run(landing, scratch_path(spark, "checkpoint"))
    state = spark.table(job.state_table).first()
    assert (state["late"], state["corrupt"], state["cutoff"]) == (0, 2, None)


def test_monotone_watermark_holds_between_batches(spark, layers):
    contract = JSON_WEATHER.with_options(watermark=WatermarkSpec("forecast_timestamp", 60, 5, monotone=True))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    job = ingest(spark, layers, contract)
    land(spark, landing, ("a", 500, 1))
    job.run(landing, checkpoint)
    land(spark, landing, ("old", 100, 1))
    job.run(landing, checkpoint)
    assert cities(spark, layers.table("bronze", "weather_external_late")) == ["old"]


def test_fail_fast_refuses_the_batch(spark, layers):
    contract = JSON_WEATHER.with_options(breaker=BreakerPolicy(1, 15, "fail_fast", False))
    job = ingest(spark, layers, contract)
    landed = job_input(spark, ("a", 1, 1), ("bad", 1, "x"))
    with pytest.raises(BatchRefused):
        job.process(landed, 0)
    assert spark.table(job.state_table).first()["breaker_state"] == "OPEN"
    assert not spark.catalog.tableExists(layers.table("silver", "weather_external"))


def job_input(spark, *rows):
    path = scratch_path(spark, "landing")
    land(spark, path, *rows)
    return read_landing(spark, JSON_WEATHER, path)


def test_alert_only_writes_and_records_an_alert(spark, layers):
    contract = JSON_WEATHER.with_options(breaker=BreakerPolicy(1, 15, "alert_only"))
    job = ingest(spark, layers, contract)
    for batch in (0, 1):
        job.process(job_input(spark, ("a", 1, 1), ("bad", 1, "x")), batch)
    log = spark.table(refresh_alert_log(spark, layers, contract.masking)).collect()
    # The second hour falls into the silence of the first.
    assert [(r["error_type"], r["occurrence_count"]) for r in log] == [("ErrorRateExceeded", 1)]
    assert cities(spark, layers.table("silver", "weather_external")) == ["a", "a"]


def test_write_errors_are_tolerated_only_when_degraded(spark, layers, monkeypatch):
    tries = []

    def fails(self, rows, constants):
        tries.append(1)
        raise OSError("disk gone")

    monkeypatch.setattr(Ingest, "_quarantine", fails)
    job = ingest(spark, layers, JSON_WEATHER.with_options(max_retries=2))
    job.process(job_input(spark, ("a", 1, 1), ("bad", 1, "x")), 0)  # 50% errors: OPEN, one attempt, tolerated
    assert len(tries) == 1 and spark.table(job.state_table).count() == 1
    calm = JSON_WEATHER.with_options(breaker=BreakerPolicy(90, 15), max_retries=2)
    tries.clear()
    with pytest.raises(OSError):
        ingest(spark, layers, calm).process(job_input(spark, ("a", 1, 1), ("bad", 1, "x")), 5)
    assert len(tries) == 3
    log = alert_log(spark, layers, calm.masking).first()
    assert log["error_type"] == "OSError" and log["error_message"] == "disk gone"


def test_an_empty_batch_carries_the_state_on(spark, layers):
    job = ingest(spark, layers)
    job.process(job_input(spark, ("a", 1, 1), ("bad", 1, "x")), 0)
    job.process(job_input(spark, ("a", 1, 1)).limit(0), 1)
    states = {r["_batch_id"]: (r["breaker_state"], r["total"]) for r in spark.table(job.state_table).collect()}
    assert states == {0: ("OPEN", 2), 1: ("OPEN", 0)}


def test_read_limit_splits_the_input_into_batches(spark, layers):
    landing = scratch_path(spark, "landing")
    for i in range(3):
        land(spark, landing, (f"c{i}", 100, 1))
    job = ingest(spark, layers, JSON_WEATHER.with_options(source=SourceSpec("json", max_bytes_per_trigger=1)))
    job.run(landing, scratch_path(spark, "checkpoint"))
    assert spark.table(job.state_table).count() == 3
    assert cities(spark, layers.table("silver", "weather_external")) == ["c0", "c1", "c2"]


def test_inventory_contract_on_parquet_landing(spark, layers):
    landing = scratch_path(spark, "landing")
    rows = [("p", "w", 5, 1, DAY, AT, "o1"), ("p", "w", 7, 1, DAY, AT + dt.timedelta(hours=1), "o2"), ("q", "w", 1, None, DAY, AT, "o3")]
    schema = ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in INVENTORY.fields)
    spark.createDataFrame(rows, schema).write.parquet(landing)
    ingest(spark, layers, INVENTORY).run(landing, scratch_path(spark, "checkpoint"))
    silver = spark.table(layers.table("silver", "inventory_erp"))
    assert {(r["product_id"], r["quantity_available"]) for r in silver.collect()} == {("p", 7), ("q", 1)}
    assert silver.filter("_operation_type = 'MERGE' AND _source_system = 'inventory_erp'").count() == 2


# -- stream duplicates ------------------------------------------------------------


def test_first_seen_keeps_the_first_batch_and_survives_a_repeat(spark, layers):
    name = layers.table("silver", "seen")
    sink = FirstSeen(name, ["k"], "t", "d", horizon_days=2)

    def batch(*rows):
        return spark.createDataFrame([(k, AT + dt.timedelta(hours=h)) for k, h in rows], "k string, t timestamp")

    sink(batch(("a", 5), ("a", 1), ("b", 2)), 0)
    for _ in range(2):
        sink(batch(("a", 30), ("c", 30), ("c", 31)), 1)
    got = sorted((r["k"], r["t"].hour + 24 * (r["t"].day - 1), r["_batch_id"]) for r in spark.table(name).collect())
    assert got == [("a", 1, 0), ("b", 2, 0), ("c", 30, 1)]


def test_state_store_variant(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("a", AT), ("a", AT), ("b", AT)], "k string, t timestamp").write.parquet(path)
    stream = within_watermark(spark.readStream.schema("k string, t timestamp").parquet(path), ["k"], "t", "1 hour")
    run = stream.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(r["k"] for r in spark.table("deduped").collect()) == ["a", "b"]


# -- retention -----------------------------------------------------------------------


def test_purge_never_takes_a_day_that_was_not_rolled_up(spark, layers):
    name = layers.table("silver", "iot_sensors")
    rows = spark.range(60).select(
        F.lit("s").alias("sensor_id"),
        F.lit("l").alias("location_id"),
        *(F.col("id").cast("double").alias(m) for m in ("temperature", "humidity", "ph", "soil_moisture")),
        (F.lit(AT) + F.make_dt_interval(hours=(F.col("id") * 12).cast("int"))).alias("reading_timestamp"),
        F.lit(0).cast("long").alias("_batch_id"),
    ).withColumn("reading_date", F.to_date("reading_timestamp"))
    append_batch(rows, name, ["reading_date"])
    days = {r[0] for r in rows.select("reading_date").distinct().collect()}
    rolled: set = set()
    for step in range(0, 30, 3):
        as_of = DAY + dt.timedelta(days=step)
        gold, _ = rollup_then_purge(spark, layers, IOT, as_of)
        rolled |= {r[0] for r in spark.table(gold).select("date").distinct().collect()}
        left = {r[0] for r in spark.table(name).select("reading_date").distinct().collect()}
        assert days - left <= rolled
        assert all(d >= as_of - dt.timedelta(days=14) for d in left)
    assert spark.table(gold).filter("date = DATE'2024-01-01'").first()["max_temperature"] == 1.0


def test_failed_maintenance_is_audited(spark, layers):
    def fails():
        raise RuntimeError("no such table")

    with pytest.raises(RuntimeError):
        audited(spark, layers, "PURGE", "silver.x", 1, AT, fails)
    audited(spark, layers, "PURGE", "silver.y", 1, AT, lambda: 3)
    log = {r["table_name"]: r for r in spark.table(layers.table("system", "lifecycle_audit")).collect()}
    assert log["silver.x"]["status"] == "FAILED" and log["silver.x"]["message"] == "no such table"
    assert log["silver.y"]["rows_affected"] == 3


def test_late_rows_are_kept_for_their_storage_time(spark, layers):
    job = Ingest(spark, JSON_WEATHER, layers, clock=lambda batch: AT + dt.timedelta(days=10 * batch))
    for batch in (0, 1):
        job.process(job_input(spark, ("a", 500, 1), (f"late{batch}", 1, 1)), batch)
    assert purge_late(spark, layers, JSON_WEATHER, DAY + dt.timedelta(days=14)) == 0
    assert purge_late(spark, layers, JSON_WEATHER, DAY + dt.timedelta(days=15)) == 1
    assert cities(spark, layers.table("bronze", "weather_external_late")) == ["late1"]


def test_contract_versions_are_registered_once(spark, layers):
    for version, day in (("1.0.0", 0), ("1.1.0", 1), ("1.1.0", 2)):
        for contract in (WEATHER, IOT):
            changed = contract.with_options(version=version)
            name = register_contract(spark, layers, changed, AT + dt.timedelta(days=day))
    rows = {(r["domain"], r["schema_version"]): (r["status"], r["created_timestamp"].day) for r in spark.table(name).collect()}
    assert rows["iot_sensors", "1.0.0"] == ("deprecated", 1) and rows["iot_sensors", "1.1.0"] == ("active", 2)
    assert len(rows) == 4


def test_purge_removes_files_of_expired_days(spark, layers):
    name = layers.table("silver", "days")
    rows = spark.createDataFrame([(DAY + dt.timedelta(days=i), i, 0) for i in range(5)], "d date, v int, _batch_id long")
    append_batch(rows, name, ["d"])
    files = len(spark.table(name).inputFiles())
    assert purge_table(spark, name, "d", DAY + dt.timedelta(days=16), 14) == 2
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 3 and len(spark.table(name).inputFiles()) < files


# -- layout and facts -------------------------------------------------------------------


def test_clustering_splits_one_hot_value(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    sizes = clustered(rows, ["k"], 8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000 and max(r["count"] for r in sizes) < 6_000


def test_two_columns_are_clustered_at_once(spark, tmp_path):
    """A third of the rows have one value in a, and text with a long common start; nulls are rows too."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 101 != 0, F.xxhash64("id") % 1000).alias("a"),
        F.concat(F.lit("SENSOR-000"), F.lpad((F.xxhash64("id", F.lit(1)) % 900 + 900).cast("string"), 4, "0")).alias("b"),
        "id",
    )
    clustered(rows, ["a", "b"], 32).write.parquet(str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 20_000 and stored.exceptAll(rows).isEmpty()
    files = stored.groupBy(F.input_file_name()).agg(*(f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))), F.count("*").alias("n")).collect()
    assert len(files) == 32 and max(f["n"] for f in files) < 3000
    for column, values in (("a", (-700, -20, 333, 900)), ("b", ("SENSOR-0000100", "SENSOR-0000900", "SENSOR-0001700"))):
        for v in values:
            opened = sum(f[f"lo_{column}"] is not None and f[f"lo_{column}"] <= v <= f[f"hi_{column}"] for f in files)
            assert opened < 32 / 3, (column, v, opened)


def test_grains_are_merged_upwards(spark):
    at = [AT + dt.timedelta(days=d, hours=h) for d in range(0, 40, 3) for h in (0, 5)]
    rows = spark.createDataFrame([("s", t, float(i), None) for i, t in enumerate(at)] + [("s", None, 1e9, 1.0)], "k string, t timestamp, v double, w double")
    metrics = [RollupMetric("v", ("min", "avg"), "daily"), RollupMetric("v", ("max",), "weekly"), RollupMetric("w", ("avg",), "monthly")]
    got = rollup_grains(rows, ["k"], "t", metrics).collect()
    by = {g: [r for r in got if r["grain"] == g] for g in ("daily", "weekly", "monthly")}
    assert len(by["daily"]) == 14 and len(by["weekly"]) == 6 and len(by["monthly"]) == 2 and len(got) == 22
    assert sorted(r["avg_v"] for r in by["daily"]) == [i + 0.5 for i in range(0, 28, 2)]
    assert max(r["max_v"] for r in by["weekly"]) == 27.0 and {r["max_v"] for r in by["daily"]} == {None}
    assert {r["avg_w"] for r in got} == {None}


def test_star_totals(spark):
    fact = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("b", "y", 4.0)], "c string, p string, v double")
    customers = spark.createDataFrame([("a", "north"), ("b", "north")], "c string, region string")
    row = star_totals(fact, {"c": customers}, ["region"], {"v": "v"}, []).first()
    assert (row["region"], row["facts"], row["v"]) == ("north", 3, 7.0)
