import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwise.sources.store import FeatureStore, key_check

SCHEMA = "household_key long, select_date date, f1 double"


@pytest.fixture
def store(spark):
    return FeatureStore(spark, tempfile.mkdtemp(prefix="cartwise-store-"))


def _rows(df):
    return sorted((r["household_key"], r["select_date"], r["f1"]) for r in df.collect())


def test_create_read_empty(spark, store):
    assert not store.exists("t")
    store.create_table("t", ["household_key", "select_date"], spark.createDataFrame([], SCHEMA).schema)
    assert store.exists("t")
    assert store.read_table("t").count() == 0
    assert store.primary_keys("t") == ["household_key", "select_date"]


def test_merge_upsert(spark, store):
    d1, d2 = dt.date(2001, 7, 2), dt.date(2001, 8, 1)
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store.create_table("t", ["household_key", "select_date"], df([]).schema)
    store.write_table("t", df([(1, d1, 1.0), (2, d1, 2.0)]))
    store.write_table("t", df([(1, d2, 10.0)]))
    # replaces key (2, d1), adds (3, d1), keeps (1, d1) and leaves d2 alone
    store.write_table("t", df([(2, d1, 20.0), (3, d1, 30.0)]))
    assert _rows(store.read_table("t")) == [(1, d1, 1.0), (1, d2, 10.0), (2, d1, 20.0), (3, d1, 30.0)]
    # idempotent
    store.write_table("t", df([(2, d1, 20.0), (3, d1, 30.0)]))
    assert store.read_table("t").count() == 4
    kc = store.key_check("t").first()
    assert (kc["rows"], kc["distinct_keys"], kc["duplicate_keys"]) == (4, 4, 0)
    # partition pruning on read
    assert _rows(store.read_table("t", d2)) == [(1, d2, 10.0)]


def test_merge_null_key_is_replaced(spark, store):
    d1 = dt.date(2001, 7, 2)
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store.create_table("t", ["household_key", "select_date"], df([]).schema)
    store.write_table("t", df([(None, d1, 1.0)]))
    store.write_table("t", df([(None, d1, 2.0)]))
    assert [r["f1"] for r in store.read_table("t").collect()] == [2.0]


def test_overwrite_and_unpartitioned(spark, store):
    schema = "model_name string, version int, roc_auc double"
    store.create_table("reg", ["model_name", "version"], spark.createDataFrame([], schema).schema)
    store.write_table("reg", spark.createDataFrame([("m", 1, 0.7)], schema))
    store.write_table("reg", spark.createDataFrame([("m", 2, 0.8), ("m", 1, 0.71)], schema))
    got = sorted((r["version"], r["roc_auc"]) for r in store.read_table("reg").collect())
    assert got == [(1, 0.71), (2, 0.8)]
    store.write_table("reg", spark.createDataFrame([("m", 9, 0.5)], schema), mode="overwrite")
    assert [r["version"] for r in store.read_table("reg").collect()] == [9]


def test_write_requires_table(spark, store):
    with pytest.raises(ValueError):
        store.write_table("nope", spark.createDataFrame([], SCHEMA))


def test_key_check_finds_duplicates(spark):
    df = spark.createDataFrame([(1, dt.date(2001, 1, 1), 1.0)] * 2 + [(2, dt.date(2001, 1, 1), 1.0)], SCHEMA)
    r = key_check(df, ["household_key", "select_date"]).first()
    assert (r["rows"], r["distinct_keys"], r["duplicate_keys"]) == (3, 2, 1)
    assert df.filter(F.col("f1") > 0).count() == 3
