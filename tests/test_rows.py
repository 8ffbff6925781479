"""Typing, rescue, splits, quality rules, duplicates."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.contracts import IOT, WEATHER, SourceSpec
from tidewater.functions.moments import collected
from tidewater.operators.dedup import best_per_key, distinct_rows
from tidewater.operators.metrics import monotone_watermark
from tidewater.operators.quality import empty_rules, range_rules, schema_conformance, violation_report
from tidewater.operators.splits import split_late, split_valid
from tidewater.sources.evolution import evolve, observed_fields
from tidewater.sources.landing import epoch_struct, read_landing, write_landing
from tidewater.sources.rescue import type_json_lines


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def weather_line(**fields):
    base = {
        "city": "Madrid",
        "temperature": 20.5,
        "humidity": 50,
        "forecast_timestamp": "2024-01-02 03:04:05",
        "forecast_date": "2024-01-02",
    }
    return json.dumps({k: v for k, v in (base | fields).items() if v is not ...})


def test_clean_line_has_nothing_rescued(spark):
    row = type_json_lines(lines(spark, weather_line()), WEATHER).first()
    assert row["_rescued_data"] is None
    assert row["humidity"] == 50.0 and collected(row["forecast_timestamp"]) == dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def test_every_misfit_of_a_line_is_rescued_with_its_text(spark):
    text = weather_line(temperature="hot", forecast_date="soon", wind={"speed": 3}, humidity=None)
    row = type_json_lines(lines(spark, text), WEATHER).first()
    assert row["temperature"] is None and row["humidity"] is None
    assert json.loads(row["_rescued_data"]) == {"temperature": "hot", "forecast_date": "soon", "wind": '{"speed":3}'}


def test_a_repeated_key_does_not_stop_the_batch(spark):
    text = '{"city": "A", "x": 1, "x": 2, "temperature": "hot", "humidity": 1, "humidity": 2}'
    row = type_json_lines(lines(spark, text), WEATHER).first()
    assert row["_rescued_data"] == '{"temperature":"hot","x":"1","x":"2"}' and row["humidity"] in (1.0, 2.0)


def test_blank_and_null_lines(spark):
    rows = type_json_lines(lines(spark, None, "{}", ""), WEATHER).collect()
    assert rows[0]["_rescued_data"] is None and rows[1]["_rescued_data"] is None
    assert all(r["city"] is None for r in rows)


def test_whether_a_line_is_one_object_is_told_without_a_look_at_each_character(spark):
    flat, nested = '{"city": "aé"}', '{"city": {"a": "}{"}}'
    alone = [flat, f"{flat}  ", nested, '{"city": "{"}', '{"city": "}"}', "{}"]
    others = [f"{flat} x", flat + flat, f"{flat},{flat}", "}}", "{{", "", "é"]
    rows = type_json_lines(lines(spark, *alone, *others, None), WEATHER)
    assert "translate" not in rows._jdf.queryExecution().toString()
    malformed = [json.loads(r["_rescued_data"] or "{}").get("_malformed") for r in rows.collect()]
    assert malformed == [None] * len(alone) + others + [None]


def test_unreadable_lines_are_kept_whole(spark):
    rows = type_json_lines(lines(spark, "{bad", "[1, 2]"), WEATHER).collect()
    assert [json.loads(r["_rescued_data"])["_malformed"] for r in rows] == ["{bad", "[1, 2]"]


def test_csv_with_too_many_values_is_kept_whole(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "city,temperature,humidity,forecast_timestamp,forecast_date\n"
        "A,1.5,2,2024-01-01 00:00:00,2024-01-01\n"
        "B,x,2,2024-01-01 00:00:00,2024-01-01\n"
        "C,1,2,2024-01-01 00:00:00,2024-01-01,extra,more\n"
    )
    rows = read_landing(spark, WEATHER.with_options(source=SourceSpec("csv")), str(path)).orderBy("city").collect()
    rescued = {r["city"]: r["_rescued_data"] for r in rows}
    assert rescued["A"] is None and json.loads(rescued["B"]) == {"temperature": "x"}
    assert "extra" in json.loads(rescued["C"])["_malformed"]


def test_partition_directories_fill_their_columns(spark, tmp_path):
    path = str(tmp_path / "landing")
    frame = spark.createDataFrame([(weather_line(city=...), "Leon"), (weather_line(city=...), "Lugo")], "value string, city string")
    write_landing(frame, path, "text", ("city", "absent"))
    rows = read_landing(spark, WEATHER, path)
    assert sorted(r["city"] for r in rows.collect()) == ["Leon", "Lugo"]


def test_epoch_schema_encodes_times(spark):
    schema = epoch_struct(WEATHER)
    assert schema["forecast_timestamp"].dataType.simpleString() == "bigint"
    assert schema["forecast_date"].dataType.simpleString() == "int"


def test_evolution_modes(spark):
    landed = lines(spark, weather_line(temperature="hot", wind="3"), weather_line())
    seen = observed_fields(landed, WEATHER)
    assert evolve(WEATHER, seen).fields == WEATHER.fields
    additive = evolve(WEATHER.with_options(evolution_mode="additive"), seen)
    assert [f.name for f in additive.fields][-1] == "wind"
    widest = evolve(WEATHER.with_options(evolution_mode="all"), seen)
    assert {f.name: f.type for f in widest.fields}["temperature"] == "StringType"
    assert type_json_lines(landed, widest).filter("_rescued_data IS NOT NULL").isEmpty()


moments = st.one_of(st.none(), st.integers(0, 20))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(moments, st.booleans(), st.booleans()), max_size=30), st.integers(0, 20))
def test_every_row_gets_exactly_one_class(spark, rows, cutoff):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    frame = spark.createDataFrame(
        [
            (i, None if named else "s", "{}" if bad else None, None if m is None else start + dt.timedelta(minutes=m))
            for i, (m, bad, named) in enumerate(rows)
        ],
        "id int, city string, _rescued_data string, forecast_timestamp timestamp",
    ).withColumn("forecast_date", F.to_date("forecast_timestamp"))
    on_time, late = split_late(frame, "forecast_timestamp", start + dt.timedelta(minutes=cutoff))
    clean, corrupt = split_valid(on_time, WEATHER)
    got = {
        "late": {r["id"] for r in late.collect()},
        "clean": {r["id"] for r in clean.collect()},
        "corrupt": {r["id"] for r in corrupt.collect()},
    }
    want = {"late": set(), "clean": set(), "corrupt": set()}
    for i, (m, bad, named) in enumerate(rows):
        if m is not None and m < cutoff:
            want["late"].add(i)
        else:
            want["corrupt" if bad or named or m is None else "clean"].add(i)
    assert got == want


def test_row_exactly_at_the_cutoff_is_on_time(spark):
    at = dt.datetime(2024, 1, 1)
    on_time, late = split_late(spark.createDataFrame([(at,)], "t timestamp"), "t", at)
    assert on_time.count() == 1 and late.isEmpty()


def test_without_cutoff_nothing_is_late(spark):
    on_time, late = split_late(spark.createDataFrame([(None,)], "t timestamp"), "t", None)
    assert on_time.count() == 1 and late.isEmpty()


def test_rules_count_without_dropping(spark):
    rows = spark.createDataFrame([(" ", 5.0), (None, None), ("a", 50.0)], "name string, x double")
    report = violation_report(rows, empty_rules(["name"]) | range_rules({"x": (0, 10)}) | {"never": F.lit(False)})
    assert {r["rule"]: r["violations"] for r in report.collect()} == {"empty:name": 1, "out_of_range:x": 1, "never": 0}


def test_schema_conformance_lists_differences(spark):
    rows = spark.createDataFrame([("a", "b", 1)], "city string, temperature string, more int")
    status = {r["name"]: r["status"] for r in schema_conformance(rows, WEATHER).collect()}
    assert status["city"] == "ok" and status["temperature"] == "retyped"
    assert status["humidity"] == "missing" and status["more"] == "extra"


def test_distinct_rows_ignore_where_a_copy_came_from(spark):
    rows = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (2, "x", "c")], "a int, b string, _file string")
    kept = distinct_rows(rows, ["_file"]).collect()
    assert sorted(map(tuple, kept), key=str) == [(1, None, "a"), (2, "x", "c")]


def test_best_row_breaks_ties_by_all_columns(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 0, "z"), ("m", None, "n")], "k string, t int, v string")
    assert sorted(map(tuple, best_per_key(rows, ["k"], ["t"]).collect())) == [("k", 1, "b"), ("m", None, "n")]
    assert sorted(map(tuple, best_per_key(rows, ["k"], ["t"], latest=False).collect())) == [("k", 0, "z"), ("m", None, "n")]


def test_monotone_watermark_across_blocks(spark):
    values = [(i, (i * 7919) % 5000 + i) for i in range(3000)]
    rows = spark.createDataFrame([("d", i, v) for i, v in values], "domain string, batch_id long, watermark long")
    got = {r["batch_id"]: r["monotone_watermark"] for r in monotone_watermark(rows).collect()}
    best = 0
    for i, v in values:
        best = max(best, v)
        assert got[i] == best


def test_required_date_is_derived_not_demanded_from_the_file():
    assert "reading_date" in IOT.required and any(m.name == "reading_date" for m in IOT.metadata)
