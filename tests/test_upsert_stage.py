"""The upsert queries join the facts once for their three dates, in shares of the baskets if they are many, and leave no stage behind."""

import datetime as dt
import time

import pytest

from cartwise import queries as Q
from cartwise.operators import feature_tables as FT
from cartwise.session import checkpoint_root, shuffles_removed
from cartwise.sources import tables as T
from cartwise.sources.files import Files

from .conftest import SF001, TX_SCHEMA


def stages(spark):
    return set(Files(spark).children(f"{checkpoint_root(spark).rstrip('/')}/materialized"))


@pytest.mark.parametrize("query", [Q.q_feature_table_key_check, Q.q_feature_table_upsert])
def test_facts_are_staged_once_and_removed(spark, monkeypatch, query):
    calls, real = [], T.stage_facts
    monkeypatch.setattr(Q, "stage_facts", lambda *a: calls.append(a) or real(*a))
    monkeypatch.setattr(FT, "with_commodity", None)  # a date joins nothing
    before = stages(spark)
    out = query(spark, SF001)
    assert len(calls) == 1 and stages(spark) == before
    assert out.count() >= 1


def test_shares_hold_every_row_once(spark, monkeypatch, tmp_path):
    day = dt.date(2001, 7, 1)
    rows = [(i % 5, i % 3, None if i % 7 == 0 else i % 11, day, 1.0, 0.0, 0.0, 0.0, 0.0, float(i % 4)) for i in range(60)] * 2
    tx = spark.createDataFrame([(*r, None) for r in rows], TX_SCHEMA).drop("commodity_desc")
    products = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "d")], "product_id long, commodity_desc string")
    used = ["commodity_desc", "basket_id", "amount_paid"]
    want = sorted(map(tuple, T.with_commodity(tx, products).select(*used).collect()), key=repr)
    for n in (None, 20):
        monkeypatch.setattr(T, "pieces", lambda df: n)
        got = T.stage_facts(tx, products, used, str(tmp_path / str(n)))
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_shuffle_files_go_when_a_query_ends(spark, tmp_path):
    def files():
        manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
        return set(manager.getAllFiles().mkString("\n").split("\n"))

    before = files()
    with shuffles_removed(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "a"))
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not {f for f in files() - before if "shuffle_" in f}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
