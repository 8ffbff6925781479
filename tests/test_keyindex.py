"""The index of key places: moved keys are found without reading the table, in any state a dead run can leave."""

import glob
import random

import pytest
from test_tables import SALES_SMALL, layers, sale, sales, stored  # noqa: F401

from tidewater.operators import keyindex, tables, upsert
from tidewater.operators.upsert import key_index, merge_table


def index_of(spark, layers):  # noqa: F811
    return key_index(spark, layers, SALES_SMALL, ["transaction_date"])


def places(spark, layers):  # noqa: F811
    return sorted((r["at"], r["transaction_date"].day) for r in spark.table(index_of(spark, layers).name).collect())


def test_a_moved_key_is_found_without_reading_other_partitions(spark, layers):  # noqa: F811
    name = merge_table(spark, sales(spark, *(sale(f"k{d}", d, d) for d in range(6))), layers, SALES_SMALL)
    # Whoever reads a row or a footer of the fourth day fails.
    folder = spark.table(name).filter("transaction_date = '2024-01-04'").inputFiles()[0].rpartition("/")[0].removeprefix("file:")
    for file in glob.glob(f"{folder}/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"not a parquet file at all")
    merge_table(spark, sales(spark, sale("k0", 2, 100), sale("new", 5, 7)), layers, SALES_SMALL)
    rest = spark.table(name).filter("transaction_date <> '2024-01-04'")
    got = sorted((r["transaction_id"], r["amount"], r["transaction_date"].day) for r in rest.collect())
    assert got == [("k0", 100.0, 3), ("k1", 1.0, 2), ("k2", 2.0, 3), ("k4", 4.0, 5), ("k5", 5.0, 6), ("new", 7.0, 6)]


@pytest.mark.parametrize("dies_in", ["switch_partitions", "drop_partitions"])
def test_a_run_that_dies_loses_no_place(spark, layers, monkeypatch, dies_in):  # noqa: F811
    name = merge_table(spark, sales(spark, sale("a", 0, 1), sale("b", 1, 2)), layers, SALES_SMALL)

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(upsert, dies_in, die)
        with pytest.raises(RuntimeError, match="lost"):
            merge_table(spark, sales(spark, sale("a", 3, 10)), layers, SALES_SMALL)
    # Another batch than the one that died, then that one once more.
    merge_table(spark, sales(spark, sale("a", 4, 20)), layers, SALES_SMALL)
    assert stored(spark, name) == [("a", 20.0, 5), ("b", 2.0, 2)]
    merge_table(spark, sales(spark, sale("a", 3, 10)), layers, SALES_SMALL)
    assert stored(spark, name) == [("a", 10.0, 4), ("b", 2.0, 2)]


def test_folding_keeps_the_latest_committed_place_and_later_ones(spark, layers, monkeypatch):  # noqa: F811
    for day in (0, 1, 2, 0):
        merge_table(spark, sales(spark, sale("a", day, day), sale("still", 5, day)), layers, SALES_SMALL)
    assert places(spark, layers) == [(1, 1), (1, 6), (2, 2), (3, 3), (4, 1)]
    index = index_of(spark, layers)
    index.fold(3)  # as if the last merge had died
    assert places(spark, layers) == [(1, 6), (3, 3), (4, 1)]
    index.fold(4)
    assert places(spark, layers) == [(1, 6), (4, 1)]


def test_many_merges_with_folds_equal_a_dictionary(spark, layers, monkeypatch):  # noqa: F811
    monkeypatch.setattr(keyindex, "FOLD_AFTER", 2)
    monkeypatch.setattr(upsert, "INDEX_BUCKETS", 3)
    rng, want = random.Random(2), {}
    for load in range(6):
        rows = {f"k{rng.randrange(12)}": rng.randrange(8) for _ in range(6)}
        name = merge_table(spark, sales(spark, *(sale(k, d, load) for k, d in rows.items())), layers, SALES_SMALL)
        want |= {k: (k, float(load), d + 1) for k, d in rows.items()}
    assert stored(spark, name) == sorted(want.values())
    current = {r[0] for r in spark.table(index_of(spark, layers).name).select("transaction_date").collect()}
    assert current >= {r["transaction_date"] for r in spark.table(name).collect()}


def test_an_index_is_built_for_a_table_that_has_none(spark, layers):  # noqa: F811
    name = merge_table(spark, sales(spark, sale("a", 0, 1), sale(None, 2, 9)), layers, SALES_SMALL)
    spark.sql(f"DROP TABLE {index_of(spark, layers).name}")
    merge_table(spark, sales(spark, sale("a", 3, 5)), layers, SALES_SMALL)
    got = [(r["transaction_id"], r["amount"], r["transaction_date"].day) for r in spark.table(name).collect()]
    assert sorted(got, key=str) == [("a", 5.0, 4), (None, 9.0, 3)]


def test_old_folders_stay_for_one_run(spark, layers):  # noqa: F811
    name = merge_table(spark, sales(spark, sale("a", 0, 1)), layers, SALES_SMALL)
    before = spark.table(name)
    before.count()  # its files are listed
    merge_table(spark, sales(spark, sale("a", 0, 2)), layers, SALES_SMALL)
    assert [r["amount"] for r in before.collect()] in ([1.0], [2.0])
    old = spark.table(name).inputFiles()[0]
    for amount in (3, 4):
        merge_table(spark, sales(spark, sale("a", 0, amount)), layers, SALES_SMALL)
    assert not glob.glob(old.removeprefix("file://").removeprefix("file:")) and stored(spark, name) == [("a", 4.0, 1)]


def test_switching_many_partitions_takes_few_statements(spark, layers, monkeypatch):  # noqa: F811
    statements = []
    own = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), own(self, text, *a, **k))[1])
    rows = sales(spark, *(sale(f"k{d}", d, d) for d in range(120)))
    name = merge_table(spark, rows, layers, SALES_SMALL)
    assert spark.table(name).count() == 120
    assert len([s for s in statements if "ADD IF NOT EXISTS" in s and "transaction_date" in s]) == 2
    assert not [s for s in statements if s.startswith("DESCRIBE") and "PARTITION" in s]
    assert tables.partition_values(spark, name).count() == 120


def test_a_first_load_is_neither_joined_nor_folded(spark, layers, monkeypatch):  # noqa: F811
    def never(*args, **kwargs):
        raise AssertionError("there is nothing to fold")

    monkeypatch.setattr(upsert, "INDEX_BUCKETS", 1)
    monkeypatch.setattr(keyindex.KeyIndex, "fold", never)
    rows = sales(spark, *(sale(f"k{i}", i % 5, i) for i in range(1100)))
    name = merge_table(spark, rows, layers, SALES_SMALL)
    assert spark.table(name).count() == 1100 and index_of(spark, layers)._properties()["base"] == "1100"


def test_all_places_of_a_key_are_named(spark, layers):  # noqa: F811
    for day in (0, 1, 2, 3):
        merge_table(spark, sales(spark, sale("a", day, day), sale("b", 6, day)), layers, SALES_SMALL)
    index, keyed = index_of(spark, layers), sales(spark, sale("a", 4, 4), sale("new", 5, 5)).select("transaction_id", "transaction_date")
    assert sorted(r[0].day for r in index.places(index.locate(keyed)).collect()) == [1, 2, 3, 4]
