"""The refresh stream on late rows and on batches of several days."""

import datetime as dt

from pyspark.sql import functions as F

from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions
from cartwise.streaming.refresh import start_feature_refresh

from .conftest import SF001


def _arrive(spark, tx, rows, tmp_path, store, **kw):
    rows.write.mode("append").parquet(str(tmp_path / "arrivals"))
    q = start_feature_refresh(spark, str(tmp_path / "arrivals"), tx.schema, load_products(spark, SF001, "p_type"), store, str(tmp_path / "ckpt"), **kw)
    q.awaitTermination(300)
    assert q.exception() is None and not q.isActive
    return {r[0]: r[1] for r in store.read_table("household_features").groupBy("select_date").agg(F.sum("line_items_30d")).collect()}


def test_late_rows_reach_the_stored_table(spark, tmp_path):
    tx = load_transactions(spark, SF001)
    store = FeatureStore(spark, str(tmp_path / "store"))
    late = F.col("day").between("2001-07-10", "2001-07-20")
    assert _arrive(spark, tx, tx.filter(~late), tmp_path, store) == {dt.date(2001, 8, 1): 95}
    assert _arrive(spark, tx, tx.filter(late), tmp_path, store)[dt.date(2001, 8, 1)] == 141


def test_each_arrived_day_after_the_first_load_gets_its_tables(spark, tmp_path):
    tx = load_transactions(spark, SF001)
    store = FeatureStore(spark, str(tmp_path / "store"))
    days = sorted(r[0] for r in tx.select("day").distinct().collect())
    loaded, new = days[-4], days[-3:]
    assert set(_arrive(spark, tx, tx.filter(F.col("day") <= loaded), tmp_path, store)) == {loaded}
    got = _arrive(spark, tx, tx.filter(F.col("day") > loaded), tmp_path, store)
    assert set(got) == {loaded, *new}
    assert got[new[-1]] == 141
    for name in ("commodity_features", "household_commodity_features"):
        assert {r[0] for r in store.read_table(name).select("select_date").distinct().collect()} == set(got)
