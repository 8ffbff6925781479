"""Rows that were once lost, and text that was once let through."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.contracts import IOT, WEATHER, BreakerPolicy, LifecycleSpec, SinkSpec, SourceSpec, WatermarkSpec
from tidewater.functions.expressions import ExpressionError, sql_column
from tidewater.operators.facts import write_fact
from tidewater.operators import lifecycle
from tidewater.operators.lifecycle import purge_table, rollup_then_purge
from tidewater.operators.tables import Layers, append_batch, partition_values
from tidewater.plans.load_queries import load_of, two_loads
from tidewater.plans.source_queries import drop_of
from tidewater.session import scratch_path
from tidewater.sources.landing import read_landed_files, read_landing
from tidewater.streaming.dedup import FirstSeen
from tidewater.streaming.ingest import BatchRefused, Ingest, OtherCheckpoint

AT = dt.datetime(2024, 1, 1)
JSON_WEATHER = WEATHER.with_options(source=SourceSpec("json", max_bytes_per_trigger=None), watermark=WatermarkSpec("forecast_timestamp", 60, 5))


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers(str(tmp_path / "tables"), f"k{uuid.uuid4().hex[:8]}_")
    layers.create(spark)
    return layers


def lines(spark, path, *values):
    spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string").coalesce(1).write.mode("append").text(path)


def reading(city, minute=1, temperature=1.0):
    return {"city": city, "temperature": temperature, "forecast_timestamp": (AT + dt.timedelta(minutes=minute)).isoformat(" ")}


def seen_rows(spark, name):
    return sorted(((r["k"], r["t"] and r["t"].day, r["_batch_id"]) for r in spark.table(name).collect()), key=str)


def seen_batch(spark, *rows):
    return spark.createDataFrame([(k, None if d is None else AT + dt.timedelta(days=d - 1)) for k, d in rows], "k string, t timestamp")


def test_rows_without_event_time_are_kept_once(spark, layers):
    name = layers.table("silver", "seen")
    sink = FirstSeen(name, ["k"], "t", "d", horizon_days=2)
    sink(seen_batch(spark, ("a", None), ("b", None), ("b", 3)), 0)  # all without a day but one
    for _ in range(2):
        sink(seen_batch(spark, ("a", None), ("b", None), ("c", None), ("a", 20), ("d", 20)), 1)
    assert seen_rows(spark, name) == [("a", None, 0), ("b", 3, 0), ("c", None, 1), ("d", 20, 1)]
    sink(seen_batch(spark, (None, None), (None, 5)), 2)
    sink(seen_batch(spark, (None, 5)), 3)
    assert [r for r in seen_rows(spark, name) if r[0] is None] == [(None, 5, 2), (None, 5, 3), (None, None, 2)]


def test_a_key_may_come_again_beyond_the_horizon(spark, layers):
    name = layers.table("silver", "seen")
    sink = FirstSeen(name, ["k"], "t", "d", horizon_days=2)
    for batch, day in enumerate((5, 7, 4, 10, 20)):
        sink(seen_batch(spark, ("a", day), ("x", 5 + batch)), batch)
    assert seen_rows(spark, name) == [("a", 10, 3), ("a", 20, 4), ("a", 5, 0), ("x", 5, 0), ("x", 8, 3)]


def test_days_that_cannot_hold_a_key_are_not_read(spark, layers):
    name = layers.table("silver", "seen")
    sink = FirstSeen(name, ["k"], "t", "d", horizon_days=30)
    sink(seen_batch(spark, *((f"k{d}", d) for d in range(1, 11))), 0)
    for file in spark.table(name).filter("d = '2024-01-04'").inputFiles():
        with open(file.removeprefix("file://").removeprefix("file:"), "wb") as out:
            out.write(b"whoever reads this fails")
    sink(seen_batch(spark, ("k2", 12), ("k9", 12), ("new", 12)), 1)
    rest = spark.table(name).filter("d > '2024-01-10'").collect()
    assert [(r["k"], r["_batch_id"]) for r in rest] == [("new", 1)]


def test_every_day_and_flag_is_landed(spark):
    days = spark.createDataFrame([(d,) for d in (None, -1, 0, 9, 10, 29, 30, 45, 400)], "batch_id long")
    drops = [r[0] for r in days.select(drop_of()).collect()]
    assert set(drops) == {0, 1, 2} and drops[0] == 0 and drops[7] == 1
    flags = spark.createDataFrame([("A", 1), ("N", 2), ("R", 3), ("X", 4), (None, 5)], "flag string, k long")
    assert [r[0] for r in flags.select(load_of()).collect()] == [0, 1, 2, 2, 2]
    rows = flags.select("flag", F.col("k").cast("string").alias("product_id"), F.lit("w").alias("warehouse_id"), F.lit(AT).alias("last_updated_timestamp"))
    from tidewater.contracts import INVENTORY

    old, new = two_loads(rows, ["product_id", "warehouse_id", "last_updated_timestamp"], INVENTORY)
    assert old.count() + new.count() == 5


def test_rows_without_a_key_are_all_first_seen(spark, layers):
    name = layers.table("silver", "seen")
    sink = FirstSeen(name, ["k"], "at", "d", horizon_days=5)
    rows = spark.createDataFrame([(None, 1, AT), (None, 2, AT), ("a", 3, AT), ("a", 4, AT + dt.timedelta(1))], "k string, v int, at timestamp")
    sink(rows, 0)
    sink(rows, 1)
    got = sorted((r["v"], r["_batch_id"]) for r in spark.table(name).collect())
    assert got == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]


def test_another_checkpoint_is_refused(spark, layers):
    landing = scratch_path(spark, "landing")
    job = Ingest(spark, JSON_WEATHER, layers, clock=lambda _: AT)
    lines(spark, landing, reading("a"))
    job.run(landing, scratch_path(spark, "checkpoint"))
    lines(spark, landing, reading("b"))
    with pytest.raises(OtherCheckpoint):
        job.run(landing, scratch_path(spark, "checkpoint"))
    assert [r["city"] for r in spark.table(layers.table("silver", JSON_WEATHER.domain)).collect()] == ["a"]


def test_fail_fast_refuses_a_batch_once_and_recovers(spark, layers):
    contract = JSON_WEATHER.with_options(breaker=BreakerPolicy(1, 30, "fail_fast", True))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    hour = [0]
    job = Ingest(spark, contract, layers, clock=lambda _: AT + dt.timedelta(hours=hour[0]))
    states = []
    for hour[0], values in enumerate([[reading("a"), reading("bad", temperature="x")], [], [reading("b")], [reading("c")], [reading("d")]]):
        if values:
            lines(spark, landing, *values)
        try:
            job.run(landing, checkpoint)
            states.append("ran")
        except Exception as error:
            assert BatchRefused.__name__ in str(error)
            states.append("refused")
    assert states[0] == "refused" and "ran" in states[1:]
    for hour[0] in range(5, 9):
        try:
            job.run(landing, checkpoint)
        except Exception as error:
            assert BatchRefused.__name__ in str(error)
    silver = layers.table("silver", contract.domain)
    assert sorted(r["city"] for r in spark.table(silver).collect()) == ["a", "b", "c", "d"]
    assert [r["city"] for r in spark.table(layers.table("quarantine", contract.domain)).collect()] == ["bad"]
    spark.catalog.refreshTable(job.state_table)
    last = spark.table(job.state_table).orderBy(F.col("_batch_id").desc()).first()
    assert last["breaker_state"] == "CLOSED"


def test_stragglers_add_to_the_gold_rows_of_their_day(spark, layers):
    name, day = layers.table("silver", IOT.domain), dt.date(2024, 1, 1)

    def store(batch, *rows):
        made = [(s, "l", t, 1.0, 1.0, 1.0, dt.datetime(2024, 1, 1, h), day, batch) for s, t, h in rows]
        schema = "sensor_id string, location_id string, temperature double, humidity double, ph double, soil_moisture double, reading_timestamp timestamp, reading_date date, _batch_id long"
        append_batch(spark.createDataFrame(made, schema), name, ["reading_date"])

    def gold(as_of):
        table, _ = rollup_then_purge(spark, layers, IOT, as_of)
        return sorted((r["sensor_id"], r["min_temperature"], r["max_temperature"], r["avg_temperature"]) for r in spark.table(table).collect())

    store(0, ("s", 10.0, 1), ("s", 20.0, 2), ("t", 5.0, 3))
    whole = [("s", 10.0, 20.0, 15.0), ("t", 5.0, 5.0, 5.0)]
    assert gold(day + dt.timedelta(days=13)) == whole  # rolled up, still in silver
    assert gold(day + dt.timedelta(days=15)) == whole and spark.table(name).count() == 0
    store(1, ("s", 45.0, 4))
    added = [("s", 10.0, 45.0, 25.0), ("t", 5.0, 5.0, 5.0)]
    assert gold(day + dt.timedelta(days=16)) == added and gold(day + dt.timedelta(days=17)) == added


@pytest.mark.parametrize("dies_in", ["intend_purge", "drop_partitions", "overwrite_partitions"])
def test_a_lost_purge_keeps_gold_whole(spark, layers, monkeypatch, dies_in):
    """Ten degrees are rolled up; the run dies before, in or after the drop; fifty degrees come late."""
    name, day = layers.table("silver", IOT.domain), dt.date(2024, 1, 1)

    def store(batch, degrees):
        made = [("s", "l", degrees, 1.0, 1.0, 1.0, AT, day, batch)]
        schema = "sensor_id string, location_id string, temperature double, humidity double, ph double, soil_moisture double, reading_timestamp timestamp, reading_date date, _batch_id long"
        append_batch(spark.createDataFrame(made, schema), name, ["reading_date"])

    def run():
        gold, _ = rollup_then_purge(spark, layers, IOT, day + dt.timedelta(days=20))
        (row,) = spark.table(gold).collect()
        return row["min_temperature"], row["max_temperature"], row["avg_temperature"]

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    store(0, 10.0)
    own, calls = getattr(lifecycle, dies_in), []

    def last_but_one(*args, **kwargs):
        # The ledger is written when the purge is noted, and again, as the last step, when it is done.
        calls.append(args)
        if dies_in != "overwrite_partitions" or (args[1].endswith("_purges") and sum(a[1].endswith("_purges") for a in calls) == 2):
            die()
        return own(*args, **kwargs)

    def on_dropping(spark_, name_, specs):
        return die() if specs else own(spark_, name_, specs)

    with monkeypatch.context() as patch:
        patch.setattr(lifecycle, dies_in, on_dropping if dies_in == "drop_partitions" else last_but_one)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    store(1, 50.0)
    for _ in range(2):
        assert run() == (10.0, 50.0, 30.0)
    store(0, 10.0)  # a batch that was purged is run once more
    assert run() == (10.0, 50.0, 30.0) and spark.table(name).count() == 0


def test_purge_takes_partitions_of_any_name(spark, layers):
    name = layers.table("silver", "odd")
    keys = ["s:x", "s:'x", "a b/c", "100%", "x=y", "plus+", None, "back\\slash"]
    rows = [(1, k, d, 0) for k in keys for d in (dt.date(2024, 1, 1), dt.date(2024, 1, 20))]
    append_batch(spark.createDataFrame(rows, "v int, k string, d date, _batch_id long"), name, ["k", "d"])
    assert {r["spec"]["k"] for r in partition_values(spark, name).collect()} == set(keys)
    assert purge_table(spark, name, "d", dt.date(2024, 1, 31), 14) == len(keys)
    assert spark.table(name).count() == len(keys)


def test_retention_on_two_partition_columns(spark, layers):
    contract = IOT.with_options(sink=SinkSpec("append", partition_by=("sensor_id", "reading_date")), lifecycle=LifecycleSpec(14, 1, IOT.lifecycle.rollup_keys, IOT.lifecycle.rollups))
    rows = spark.range(40).select(
        F.concat(F.lit("s:"), F.col("id") % 2).alias("sensor_id"), F.lit("l").alias("location_id"),
        *(F.col("id").cast("double").alias(m) for m in ("temperature", "humidity", "ph", "soil_moisture")),
        (F.lit(AT) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("reading_timestamp"), F.lit(0).cast("long").alias("_batch_id"),
    ).withColumn("reading_date", F.to_date("reading_timestamp"))
    name = layers.table("silver", contract.domain)
    append_batch(rows, name, contract.sink.partition_by)
    gold, purged = rollup_then_purge(spark, layers, contract, dt.date(2024, 1, 31))
    assert purged == 16 and spark.table(name).count() == 24 and spark.table(gold).count() == 18


@pytest.mark.parametrize(
    "text",
    [
        "`reflect`('java.lang.System', 'getProperty', 'user.name')",
        "reflect('java.lang.System', 'getProperty', 'user.name')",
        "(select id from secret limit 1)",
        "exists(select 1 from secret)",
        "temperature in (select 1)",
        "java_method('java.lang.System', 'exit')",
        "transform(array(1), x -> x)",
        "spark_catalog.default.f(1)",
    ],
)
def test_bypasses_of_the_function_list_are_refused(spark, text):
    with pytest.raises(ExpressionError):
        sql_column(text)


def test_plain_sql_expressions_still_work(spark):
    row = spark.range(1).select(
        sql_column("coalesce(if(id > 0, null, 'a'), 'b')").alias("a"),
        sql_column("cast(case when id is null then 1 when id between 0 and 3 then id * 2 + 1 else -1 end as int)").alias("b"),
        sql_column("concat(upper('x'), trim(' y '), substring('abc', 2, 1))").alias("c"),
        sql_column("id in (0, 1) and not (id = 2 or id <> 0)").alias("d"),
        sql_column("date_add(to_date('2024-01-01'), 1)").alias("e"),
    ).first()
    assert tuple(row) == ("a", 1, "Xyb", True, dt.date(2024, 1, 2))


def test_text_after_a_json_object_is_kept(spark):
    path = scratch_path(spark, "landing")
    good = json.dumps(reading("ok"))
    nested = json.dumps({**reading("deep"), "extra": {"a": [{"b": "}"}]}})
    lines(spark, path, good, good + " trailing", good + good, f"{good}, {good}", good + " x}", nested, good + "  ", json.dumps(reading("br}ace{")))
    rows = read_landing(spark, JSON_WEATHER, path).collect()
    bad = [r for r in rows if "_malformed" in (r["_rescued_data"] or "")]
    assert len(rows) == 8 and len(bad) == 4
    assert sorted(r["city"] for r in rows if r not in bad) == ["br}ace{", "deep", "ok", "ok"]


def test_csv_with_columns_in_another_order_fails(spark):
    path = scratch_path(spark, "landing")
    contract = WEATHER.with_options(source=SourceSpec("csv"))
    names = [f.name for f in contract.fields]
    row = spark.createDataFrame([("a", "1.5", "60.0", "2024-01-01 00:00:00", "2024-01-01")], ", ".join(f"{n} string" for n in names))
    row.select(names[0], names[2], names[1], *names[3:]).write.option("header", "true").csv(path)
    with pytest.raises(Exception, match="header|schema"):
        read_landing(spark, contract, path).collect()


def test_streamed_csv_goes_by_the_names_in_its_header(spark, layers, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    files = {
        "plain": "city,temperature,humidity,forecast_timestamp,forecast_date\na,1.5,60,2024-01-01 00:00:00,2024-01-01\n",
        "turned": '\ufeff"humidity", temperature,city,forecast_date,forecast_timestamp\n61,2.5,b,2024-01-01,2024-01-01 01:00:00\n',
        "more": "city,firmware,temperature,humidity,forecast_timestamp,forecast_date\nc,v2,3.5,62,2024-01-01 02:00:00,2024-01-01\n",
        "fewer": "city,forecast_timestamp,forecast_date\nd,2024-01-01 03:00:00,2024-01-01\n",
        "odd": "x,y\n1,2\n",
        "twice": "city,City\ne,f\n",
        "empty": "",
    }
    for name, text in files.items():
        (landing / f"{name}.csv").write_text(text, encoding="utf-8")
    contract = WEATHER.with_options(source=SourceSpec("csv", max_bytes_per_trigger=None), watermark=None)
    Ingest(spark, contract, layers, clock=lambda _: AT).run(str(landing), str(tmp_path / "cp"))
    got = sorted((r["city"], r["temperature"], r["humidity"]) for r in spark.table(layers.table("silver", contract.domain)).collect())
    assert got == [("a", 1.5, 60.0), ("b", 2.5, 61.0), ("d", None, None)]
    aside = sorted(r["_rescued_data"] for r in spark.table(layers.table("quarantine", contract.domain)).collect())
    assert aside == ['{"_malformed":"1,2"}', '{"_malformed":"city,City"}', '{"_malformed":"e,f"}', '{"_malformed":"x,y"}', '{"firmware":"v2"}']


def test_schemas_of_many_files_cost_few_jobs(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.range(500).select(F.col("id").cast("string").alias("city"), F.lit(1.0).alias("temperature"), F.lit(2.0).alias("humidity"), F.lit(AT).alias("forecast_timestamp"), F.lit(AT.date()).alias("forecast_date"))
    rows.repartition(500, "city").write.parquet(path)
    files = spark.read.parquet(path).inputFiles()
    contract = WEATHER.with_options(source=SourceSpec("parquet"))
    spark.sparkContext.setJobGroup("schemas", "schemas")
    try:
        frame = read_landed_files(spark, contract, files)
        assert len(files) > 250 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("schemas")) < 5
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert frame.count() == 500 and frame.filter("_rescued_data is not null").count() == 0


def test_streamed_parquet_rescues_drift(spark, layers):
    landing = scratch_path(spark, "landing")
    contract = WEATHER.with_options(source=SourceSpec("parquet", max_bytes_per_trigger=None), watermark=None)
    base = spark.range(1).select(F.lit("a").alias("city"), F.lit(1.0).alias("temperature"), F.lit(2.0).alias("humidity"), F.lit(AT).alias("forecast_timestamp"), F.lit(AT.date()).alias("forecast_date"))
    base.write.parquet(landing)
    base.withColumns({"city": F.lit("b"), "firmware": F.lit("v2")}).write.mode("append").parquet(landing)
    base.withColumns({"city": F.lit("c"), "temperature": F.lit("warm")}).write.mode("append").parquet(landing)
    job = Ingest(spark, contract, layers, clock=lambda _: AT)
    job.run(landing, scratch_path(spark, "checkpoint"))
    assert [r["city"] for r in spark.table(layers.table("silver", contract.domain)).collect()] == ["a"]
    kept = {r["city"]: r["_rescued_data"] for r in spark.table(layers.table("quarantine", contract.domain)).collect()}
    assert json.loads(kept["b"]) == {"firmware": "v2"} and json.loads(kept["c"]) == {"temperature": "warm"}


def test_facts_are_stored_by_day(spark, layers):
    name = layers.table("gold", "facts")
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    write_fact(rows, name, "d")
    more = spark.createDataFrame([(9, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 2)), (4, dt.date(2024, 1, 3))], "v int, d date")
    write_fact(more, name, "d", since=dt.date(2024, 1, 2))
    assert sorted((r["v"], r["d"].day) for r in spark.table(name).collect()) == [(1, 1), (3, 2), (4, 3)]


def test_a_merge_that_dies_before_the_switch_loses_nothing(spark, layers, monkeypatch):
    from tidewater.contracts import SALES
    from tidewater.operators import tables
    from tidewater.operators.upsert import merge_table

    contract = SALES.with_options(metadata=())
    schema = ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in SALES.fields)

    def sales(*rows):
        made = [(k, "c", "p", float(v), 1, "EUR", AT + dt.timedelta(days=d), (AT + dt.timedelta(days=d)).date()) for k, d, v in rows]
        return spark.createDataFrame(made, schema)

    def stored(name):
        return sorted((r["transaction_id"], r["amount"]) for r in spark.table(name).collect())

    name = merge_table(spark, sales(("a", 0, 1), ("b", 0, 2), ("c", 1, 3)), layers, contract)
    second = sales(("a", 1, 10), ("d", 2, 4))

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_partition_location", dies)
        with pytest.raises(RuntimeError):
            merge_table(spark, second, layers, contract)
    assert stored(name) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]
    for _ in range(2):
        merge_table(spark, second, layers, contract)
        assert stored(name) == [("a", 10.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)]
