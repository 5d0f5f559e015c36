"""Facts by day prune folders; bucketed lookups join without exchanges; the alias log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.functions.dates import resolve_windows
from cartwise.operators import registry as R
from cartwise.operators.features import additive_aggregate
from cartwise.operators.labels import training_set
from cartwise.sources.layout import publish_lookups, read_facts_by_day, write_facts_by_day
from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions, with_commodity

from .conftest import SF001

D = dt.date(2001, 7, 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_by_day_prune_folders_and_hold_all_rows(spark, tmp_path):
    products = load_products(spark, SF001)
    tx = load_transactions(spark, SF001).filter(F.col("day") >= "2001-05-01")
    tx = tx.unionByName(tx.limit(1).withColumn("day", F.lit(None).cast("date")))
    write_facts_by_day(tx, products, str(tmp_path / "facts"))
    facts = with_commodity(tx, products)
    read = read_facts_by_day(spark, str(tmp_path / "facts"), facts.schema)
    assert read.columns == facts.columns and read.exceptAll(facts).count() == facts.exceptAll(read).count() == 0
    wins = resolve_windows("2001-08-01", ["30d", "60d"])
    in_window = additive_aggregate(read, ["household_key"], wins)
    filters = [line for line in plan(in_window).splitlines() if "PartitionFilters" in line]
    assert filters and all("day#" in f.split("PartitionFilters")[1].split("]")[0] and ">=" in f for f in filters)


@pytest.fixture
def tables(spark):
    rows = lambda n, cols, schema: spark.createDataFrame([cols(i) for i in range(n)], schema)
    spine = rows(20, lambda i: (i if i else None, "PROMO", i % 2, D), "household_key long, commodity_desc string, purchased int, select_date date")
    hh = rows(30, lambda i: (i, D if i % 5 else dt.date(2001, 1, 1), float(i)), "household_key long, select_date date, f double")
    cc = rows(2, lambda i: (("PROMO", "OTHER")[i], D, 1.0 + i), "commodity_desc string, select_date date, f double")
    hc = rows(40, lambda i: (i // 2, ("PROMO", "OTHER")[i % 2], D, float(i)), "household_key long, commodity_desc string, select_date date, f double")
    return spine, hh, cc, hc


def test_bucketed_lookups_join_where_they_lie(spark, tables, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        published = publish_lookups(*tables, D, "PROMO", buckets=4)
        got = published.looked_up(spark)
        text = plan(got)
        assert text.count("SortMergeJoin") == 2 and "Exchange hashpartitioning" not in text and "Exchange range" not in text
        want = training_set(*tables, keep_keys=True)  # every key joined
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        published.drop(spark)
        assert not spark.catalog.tableExists(published.household)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("args", [{}, {"select_date": D}, {"select_date": D, "commodity_desc": "PROMO"}])
def test_lookups_by_fewer_keys_are_the_same(tables, args):
    want = training_set(*tables, keep_keys=True)
    got = training_set(*tables, keep_keys=True, **args)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_alias_log_follows_the_promotion_rule(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    R.register(store, "m", [(1, 0.6, None)])
    assert R.alias_version(store, "m") is None and R.next_version(store, "m") == 2
    R.register(store, "m", [(2, 0.8, None)])
    assert R.alias_version(store, "m") == 2
    R.register(store, "m", [(3, 0.78, 0.8)])
    assert (R.alias_version(store, "m"), R.alias_version(store, "m", R.CHALLENGER)) == (2, 3)
    R.register(store, "m", [(4, 0.81, 0.8)])
    R.register(store, "other", [(1, 0.9, None)])
    assert (R.alias_version(store, "m"), R.alias_version(store, "m", R.CHALLENGER)) == (4, None)
    log = [(r["change"], r["alias"], r["version"]) for r in store.read_table(R.ALIAS_TABLE).filter("model_name = 'm'").orderBy("change").collect()]
    assert log == [(1, "Champion", 2), (2, "Challenger", 3), (3, "Champion", 4), (4, "Challenger", None)]
    R.sync_aliases(store, "m")  # nothing to add
    assert store.read_table(R.ALIAS_TABLE).count() == 5


def test_a_lost_alias_write_is_made_good(spark, tmp_path, monkeypatch):
    store = FeatureStore(spark, str(tmp_path))
    with monkeypatch.context() as m:
        m.setattr(R, "sync_aliases", lambda *a: None)  # the job died after the first write
        R.register(store, "m", [(1, 0.9, None)])
    assert R.alias_version(store, "m") is None
    R.sync_aliases(store, "m")
    assert R.alias_version(store, "m") == 1 and R.next_version(store, "m") == 2
