"""Snapshots of the feature store: crashes, races, old readers, cleaning up; and the sink by table name."""

import datetime as dt
import threading

import pytest

from cartwise.sources.files import Files
from cartwise.sources.store import ConcurrentWrite, FeatureStore, replace_table

D1, D2 = dt.date(2001, 7, 2), dt.date(2001, 8, 1)
SCHEMA = "household_key long, select_date date, f1 double"
KEYS = ["household_key", "select_date"]


@pytest.fixture
def store(spark, tmp_path):
    s = FeatureStore(spark, str(tmp_path / "store"))
    s.create_table("t", KEYS, spark.createDataFrame([], SCHEMA).schema, "test rows")
    s.write_table("t", spark.createDataFrame([(1, D1, 1.0), (2, D1, 2.0), (1, D2, 3.0)], SCHEMA))
    return s


def rows(df):
    return sorted(tuple(r) for r in df.collect())


FIRST = [(1, D1, 1.0), (1, D2, 3.0), (2, D1, 2.0)]


def test_a_crash_between_write_and_switch_leaves_the_old_state(spark, store, monkeypatch):
    def lost(*a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(FeatureStore, "_commit", lost)
        m.setattr(Files, "remove", lambda *a: None)  # a dead driver cleans nothing up
        with pytest.raises(RuntimeError, match="driver lost"):
            store.write_table("t", spark.createDataFrame([(2, D1, 20.0), (9, D1, 90.0)], SCHEMA))
    assert rows(store.read_table("t")) == FIRST and store.snapshot("t").version == 1
    left = store.files.children(store.path("t") + "/data")
    assert len(left) == 2
    store.write_table("t", spark.createDataFrame([(2, D1, 20.0)], SCHEMA))
    assert rows(store.read_table("t")) == [(1, D1, 1.0), (1, D2, 3.0), (2, D1, 20.0)]


def test_the_loser_of_a_race_is_told_and_changes_nothing(spark, store, monkeypatch):
    commit, raced = FeatureStore._commit, []

    def late(self, name, snapshot):
        if not raced:  # another driver commits just before
            raced.append(1)
            FeatureStore(spark, store.root).write_table("t", spark.createDataFrame([(5, D2, 5.0)], SCHEMA))
        commit(self, name, snapshot)

    monkeypatch.setattr(FeatureStore, "_commit", late)
    with pytest.raises(ConcurrentWrite):
        store.write_table("t", spark.createDataFrame([(1, D1, -1.0)], SCHEMA))
    assert rows(store.read_table("t")) == sorted(FIRST + [(5, D2, 5.0)])
    named = {f"write={w}" for w in store.snapshot("t").parts.values()}
    assert named <= set(store.files.children(store.path("t") + "/data")) and len(named) == 2


def test_only_one_of_many_creators_of_a_state_wins(spark, tmp_path):
    files, won = Files(spark), []
    (tmp_path / "s").mkdir()
    threads = [threading.Thread(target=lambda i=i: won.append(files.create(str(tmp_path / "s/1.json"), str(i)))) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won)[-1] and files.create(str(tmp_path / "s/1.json"), "x") is False
    assert files.read(str(tmp_path / "s/1.json")) in "0123"


def test_readers_keep_their_snapshot(spark, store):
    before = store.read_table("t")
    store.write_table("t", spark.createDataFrame([(1, D1, 7.0)], SCHEMA))
    store.write_table("t", spark.createDataFrame([(8, D1, 8.0)], SCHEMA), mode="overwrite")
    assert rows(before) == FIRST
    assert rows(store.read_table("t")) == [(8, D1, 8.0)] and rows(store.read_table("t", version=1)) == FIRST
    assert rows(store.read_table("t", D2)) == [] and rows(store.read_table("t", "2001-08-01", version=1)) == [(1, D2, 3.0)]
    assert store.snapshot("t").dates() == ["2001-07-02"] and store.snapshot("t").description == "test rows"


def test_each_row_of_a_merge_is_written_once_and_other_dates_stay(spark, store):
    old = store.snapshot("t").parts
    store.write_table("t", spark.createDataFrame([(2, D1, 20.0)], SCHEMA))
    new = store.snapshot("t").parts
    assert new["select_date=2001-08-01"] == old["select_date=2001-08-01"]
    folder = f"{store.path('t')}/data/write={new['select_date=2001-07-02']}"
    assert sorted(r.household_key for r in spark.read.parquet(folder).collect()) == [1, 2]


def test_old_folders_go_by_age(spark, store):
    for x in (7.0, 8.0):
        store.write_table("t", spark.createDataFrame([(1, D1, x)], SCHEMA))
    assert len(store.files.children(store.path("t") + "/data")) == 3
    store.vacuum("t", older_than_seconds=3600)
    assert rows(store.read_table("t", version=1)) == FIRST
    store.vacuum("t", older_than_seconds=-1)
    assert len(store._versions("t")) == 1 and rows(store.read_table("t")) == [(1, D1, 8.0), (1, D2, 3.0), (2, D1, 2.0)]
    left = {f"{w}/{p}" for w in store.files.children(store.path("t") + "/data") for p in store.files.children(f"{store.path('t')}/data/{w}") if p.startswith("select")}
    assert left == {f"write={w}/{p}" for p, w in store.snapshot("t").parts.items()}


def test_null_dates_empty_updates_and_column_order(spark, store):
    store.write_table("t", spark.createDataFrame([], SCHEMA))
    assert store.snapshot("t").version == 1 and rows(store.read_table("t")) == FIRST
    store.write_table("t", spark.createDataFrame([(4.0, None, 4)], "f1 double, select_date date, household_key long"))
    store.write_table("t", spark.createDataFrame([(4, None, 5.0), (None, D2, 6.0)], SCHEMA))
    assert sorted(store.read_table("t").collect(), key=repr) == sorted([*FIRST, (4, None, 5.0), (None, D2, 6.0)], key=repr)
    store.write_table("t", spark.createDataFrame([], SCHEMA), mode="overwrite")
    assert rows(store.read_table("t")) == []


def test_a_read_of_one_date_reads_its_folder_only(store):
    files = store.read_table("t", D1).inputFiles()
    assert files and all("select_date=2001-07-02" in f for f in files)


def test_replaced_table_is_read_by_name(spark, tmp_path):
    root = str(tmp_path / "tables")
    make = lambda n, cols="a long, b string": spark.createDataFrame([(i, "x") for i in range(n)], cols)
    assert rows(replace_table(make(3), "predictions_test", root)) == [(0, "x"), (1, "x"), (2, "x")]
    held = spark.table("predictions_test")
    assert replace_table(make(5), "predictions_test", root).count() == 5
    assert held.count() == 3  # the rows that it was resolved to
    broken = make(2).selectExpr("assert_true(a < 1) as a", "b")
    with pytest.raises(Exception):
        replace_table(broken, "predictions_test", root)
    assert spark.table("predictions_test").count() == 5
    other = replace_table(make(1, "k long, v string"), "predictions_test", root, retention_seconds=-1)
    assert other.columns == ["k", "v"] and rows(other) == [(0, "x")]
    assert len(Files(spark).children(f"{root}/predictions_test")) == 1
    spark.sql("DROP TABLE predictions_test")
