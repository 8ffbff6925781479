"""Stored facts that follow the changed days, and dimensions that keep their history."""

import datetime as dt
import random

import pytest
from test_tables import AT, SALES_SMALL, layers, sale, sales  # noqa: F401

from tidewater.contracts import SALES, ContractError, contract_from_config
from tidewater.functions.moments import collected
from tidewater.operators import facts
from tidewater.operators.facts import sync_fact
from tidewater.operators.history import Dimension
from tidewater.operators.metadata import inject_metadata
from tidewater.operators.upsert import merge_table

D = [dt.date(2024, 1, d) for d in range(1, 20)]


def load(spark, layers, contract, batch, *rows):  # noqa: F811
    return merge_table(spark, inject_metadata(sales(spark, *rows), contract, batch, AT), layers, contract)


def stored(spark, name):
    return sorted((r["transaction_id"], r["amount"], r["transaction_date"].day) for r in spark.table(name).collect())


@pytest.mark.parametrize("grain", ["day", "month"])
def test_facts_follow_late_corrections(spark, layers, grain):  # noqa: F811
    sink = SALES.sink if grain == "day" else SALES.sink.__class__(**{**vars(SALES.sink), "partition_grain": "month"})
    contract = SALES_SMALL.with_options(sink=sink)
    load(spark, layers, contract, 0, *(sale(f"k{d}", d, d) for d in range(4)))
    name, days = sync_fact(spark, layers, contract, D[2])
    assert stored(spark, name) == [("k0", 0.0, 1), ("k1", 1.0, 2)] and days == D[:2]
    assert sync_fact(spark, layers, contract, D[2])[1] == []
    # k1's day loses its only row to a day to come, k0 is corrected; days two and three come of age.
    load(spark, layers, contract, 1, sale("k1", 9, 11), sale("k0", 0, 10))
    name, days = sync_fact(spark, layers, contract, D[4])
    assert days == D[:4] and stored(spark, name) == [("k0", 10.0, 1), ("k2", 2.0, 3), ("k3", 3.0, 4)]
    assert sync_fact(spark, layers, contract, D[10])[1] == [D[9]]
    assert stored(spark, name)[1] == ("k1", 11.0, 10)


def test_unchanged_days_are_not_read(spark, layers):  # noqa: F811
    name = load(spark, layers, SALES_SMALL, 0, *(sale(f"k{d}", d, d) for d in range(4)))
    sync_fact(spark, layers, SALES_SMALL, D[10])
    for file in spark.table(name).filter("transaction_date = '2024-01-02'").inputFiles():
        with open(file.removeprefix("file://").removeprefix("file:"), "wb") as out:
            out.write(b"whoever reads this fails")
    load(spark, layers, SALES_SMALL, 1, sale("k3", 3, 30))
    fact, days = sync_fact(spark, layers, SALES_SMALL, D[10])
    assert days == [D[3]] and stored(spark, fact) == [("k0", 0.0, 1), ("k1", 1.0, 2), ("k2", 2.0, 3), ("k3", 30.0, 4)]


def test_a_lost_daily_run_is_made_again(spark, layers, monkeypatch):  # noqa: F811
    load(spark, layers, SALES_SMALL, 0, sale("a", 0, 1))

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    for step in ("switch_partitions", "drop_partitions"):
        with monkeypatch.context() as patch:
            patch.setattr(facts, step, die)
            with pytest.raises(RuntimeError, match="lost"):
                sync_fact(spark, layers, SALES_SMALL, D[10])
    name, days = sync_fact(spark, layers, SALES_SMALL, D[10])
    assert days == D[:1] and stored(spark, name) == [("a", 1.0, 1)]


def test_the_contract_says_how_far_facts_reach(spark, layers):  # noqa: F811
    config = {
        "pipeline_info": {"domain": "sold", "version": "1"},
        "source": {"format": "json"},
        "schema_validation": {"fields": [{"name": "k", "type": "StringType"}, {"name": "at", "type": "TimestampType"}]},
        "sink": {"mode": "merge_into", "merge_keys": ["k"], "partition_moves": False, "lifecycle": {"sync_window": "D-3"}},
        "dlq": {"late_data": {"enabled": True, "table_name": "bronze.sold_too_late"}},
    }
    contract = contract_from_config(config)
    assert contract.lifecycle.sync_days == 3 and not contract.sink.partition_moves and contract.late_table == "sold_too_late"
    config["sink"]["lifecycle"]["sync_window"] = "weekly"
    with pytest.raises(ContractError, match="sync window"):
        contract_from_config(config)
    three = SALES_SMALL.with_options(lifecycle=contract.lifecycle)
    load(spark, layers, three, 0, *(sale(f"k{d}", d, d) for d in range(4)))
    assert sync_fact(spark, layers, three, D[4])[1] == D[:2]


# -- history --------------------------------------------------------------------------


def report(spark, *rows):
    made = [(k, s, None if d is None else AT + dt.timedelta(days=d)) for k, s, d in rows]
    return spark.createDataFrame(made, "id string, segment string, at timestamp")


def versions(spark, name):
    def day(moment):
        return None if moment is None else (collected(moment).replace(tzinfo=None) - AT).days

    return sorted(((r["id"], r["segment"], day(r["valid_from"]), day(r["valid_to"]), r["is_current"]) for r in spark.table(name).collect()), key=str)


def test_versions_in_any_order_and_repeated(spark, layers):  # noqa: F811
    dim = Dimension(spark, layers.table("gold", "dim"), "id", ["segment"], buckets=2)
    dim.apply(report(spark, ("a", "x", 0), ("b", None, 0), (None, "x", 0), ("c", "x", None)), "at")
    later = report(spark, ("a", "z", 9), ("a", "x", 3), ("b", "y", 5), ("b", "y", 5))
    for _ in range(2):
        dim.apply(later, "at")
    keys = {r["surrogate"] for r in spark.table(dim.name).collect()}
    dim.apply(report(spark, ("a", "y", 4), ("d", "x", 1)), "at")  # behind a later one
    dim.apply(report(spark, ("a", "w", 9)), "at")  # the same moment, said anew
    assert versions(spark, dim.name) == sorted(
        [("a", "x", 0, 4, False), ("a", "y", 4, 9, False), ("a", "w", 9, None, True), ("b", None, 0, 5, False), ("b", "y", 5, None, True), ("d", "x", 1, None, True)],
        key=str,
    )
    assert keys < {r["surrogate"] for r in spark.table(dim.name).collect()}
    dim.apply(report(spark), "at")
    assert spark.table(dim.name).count() == 6


def test_facts_meet_the_version_of_their_moment(spark, layers):  # noqa: F811
    rng = random.Random(4)
    changes = {("k%d" % rng.randrange(4), rng.randrange(0, 30)): rng.choice("xyz") for _ in range(25)}
    dim = Dimension(spark, layers.table("gold", "dim"), "id", ["segment"], buckets=3)
    listed = [(k, s, d) for (k, d), s in changes.items()]
    for part in (listed[::2], listed[1::2]):
        dim.apply(report(spark, *part), "at")
    moments = [(f"k{k}", None, d) for k in range(5) for d in range(-1, 32, 3)] + [(None, None, 3), ("k1", None, None)]
    met = dim.as_of(report(spark, *moments).drop("segment").withColumnRenamed("at", "happened"), "happened").collect()

    def valid(key, moment):
        known = [(d, s) for (k, d), s in changes.items() if k == key and moment is not None and AT + dt.timedelta(days=d) <= moment]
        return max(known)[1] if known else None

    assert len(met) == len(moments)
    for r in met:
        happened = r["happened"] and collected(r["happened"]).replace(tzinfo=None)
        assert r["segment"] == valid(r["id"], happened) and (r["surrogate"] is None) == (r["segment"] is None)
