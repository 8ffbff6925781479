"""Folding closed batches: rows and their batches stay, partitions do not grow, a lost run does no harm."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from test_tables import AT, JSON_WEATHER, cities, ingest, land, layers  # noqa: F401

from tidewater.operators import compaction
from tidewater.operators.compaction import Compactor, folds, span
from tidewater.operators.lifecycle import purge_late
from tidewater.operators.tables import SEGMENT, append_batch, partition_values


def store(spark, name, batch, *rows):
    made = [(v, dt.date(2024, 1, d), batch) for v, d in rows]
    append_batch(spark.createDataFrame(made, "v int, d date, _batch_id long"), name, ["d"])


def rows(spark, name):
    return sorted((r["v"], r["d"].day, r["_batch_id"]) for r in spark.table(name).collect())


def segments(spark, name):
    return sorted(((r["spec"].get("d") or "none")[-2:], r["spec"][SEGMENT]) for r in partition_values(spark, name).collect())


def test_plan_keeps_fewer_than_the_fan_of_each_size():
    for fan in (2, 3, 8):
        stored, written = [], 0
        for batch in range(400):
            stored.append(f"{batch}-{batch}")
            for new, old in folds(stored, fan):
                written += len(old)
                assert span(new) == (min(span(o)[0] for o in old), max(span(o)[1] for o in old))
                stored = [s for s in stored if s not in old] + [new]
            assert len(stored) <= (fan - 1) * (1 + math.log(batch + 1, fan)) + 1
        assert len({i for s in stored for i in range(span(s)[0], span(s)[1] + 1)}) == 400


def test_closed_batches_are_folded_and_the_open_one_is_replaced(spark, layers):  # noqa: F811
    name = layers.table("silver", "folded")
    compactor = Compactor(spark, layers.table("system", "folds"), fan=3)
    want = []
    for batch in range(5):
        store(spark, name, batch, (batch, 1), (10 + batch, 1 + batch % 2))
        want += [(batch, 1, batch), (10 + batch, 1 + batch % 2, batch)]
        compactor.compact(name, batch)
    assert rows(spark, name) == sorted(want)
    assert segments(spark, name) == [("01", "0-2"), ("01", "3-3"), ("01", "4-4"), ("02", "1-1"), ("02", "3-3")]
    store(spark, name, 4, (4, 1), (14, 1), (99, 1))  # the last batch once more, with another row
    assert rows(spark, name) == sorted([*want, (99, 1, 4)])
    assert compactor.compact(name, 4) == 0


def test_rows_without_a_day_and_odd_names_are_folded(spark, layers):  # noqa: F811
    name = layers.table("silver", "odd")
    for batch in range(3):
        made = [(1, k, batch) for k in ("a b/c", "x='y", None, "100%", "s:x")]
        append_batch(spark.createDataFrame(made, "v int, k string, _batch_id long"), name, ["k"])
    assert Compactor(spark, layers.table("system", "folds"), fan=3).compact(name, 3) == 15
    got = sorted((str(r["k"]), r["_batch_id"]) for r in spark.table(name).collect())
    assert got == sorted((k, b) for k in ("a b/c", "x='y", "None", "100%", "s:x") for b in range(3))
    assert partition_values(spark, name).count() == 5


@pytest.mark.parametrize("dies_in", ["append_rows_to", "create_table", "add_partitions", "drop_partitions"])
def test_a_lost_fold_is_finished_or_was_never_there(spark, layers, monkeypatch, dies_in):  # noqa: F811
    name = layers.table("silver", "lost")
    for batch in range(4):
        store(spark, name, batch, (batch, 1))
    compactor = Compactor(spark, layers.table("system", "folds"), fan=3)

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, dies_in, die)
        with pytest.raises(RuntimeError, match="lost"):
            compactor.compact(name, 3)
    compactor.recover()
    spark.catalog.refreshTable(name)
    assert rows(spark, name) == [(b, 1, b) for b in range(4)]
    compactor.compact(name, 3)
    assert rows(spark, name) == [(b, 1, b) for b in range(4)]
    assert segments(spark, name) == [("01", "0-2"), ("01", "3-3")]
    assert spark.table(compactor.ledger).count() == 0


def test_the_stream_folds_its_tables(spark, layers, tmp_path):  # noqa: F811
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    job = ingest(spark, layers)
    for k in range(5):
        # A clean row, one of another type, and from the second batch on one behind the cutoff.
        land(spark, landing, (f"c{k}", 200 + k, 1.0), ("bad", 200 + k, "x"), ("old", 1, 1.0))
        job.start(landing, checkpoint).awaitTermination()
    tables = [layers.table(*t) for t in (("bronze", JSON_WEATHER.domain), ("silver", JSON_WEATHER.domain), ("quarantine", JSON_WEATHER.domain))]
    late = layers.table("bronze", f"{JSON_WEATHER.domain}_late")
    before = {t: sorted(map(str, spark.table(t).drop(SEGMENT).collect())) for t in (*tables, late, job.state_table)}
    assert job.compact(fan=3) > 0
    for t, was in before.items():
        assert sorted(map(str, spark.table(t).drop(SEGMENT).collect())) == was
        assert spark.table(t).select(SEGMENT).distinct().count() <= 3
    land(spark, landing, ("c5", 206, 1.0))
    job.run(landing, checkpoint)
    assert "c5" in cities(spark, tables[1]) and spark.table(job.state_table).count() == 6
    # A segment is as old as its last batch: the folded one and the later ones go at their time.
    c = JSON_WEATHER
    assert purge_late(spark, layers, c, AT.date() + dt.timedelta(days=c.late_data.storage_days)) == 0
    left = spark.table(late).select(F.count("*")).first()[0]
    assert left == len(before[late])
    assert purge_late(spark, layers, c, AT.date() + dt.timedelta(days=c.late_data.storage_days + 2)) > 0
    assert spark.table(late).count() == 0
