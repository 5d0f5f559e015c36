"""Steps whose cost must not grow faster than the input: dealing by size, one join of the facts, one table of state."""

import datetime as dt

from pyspark.sql import functions as F

from cartwise.llm import repeats as R
from cartwise.operators import feature_state as S, feature_tables as FT, features as G
from cartwise.operators.spine import top_commodities
from cartwise.sources import store as ST, tables as T
from cartwise.sources.store import FeatureStore

from .conftest import SF001, TX_SCHEMA


def test_large_input_is_dealt_in_proportion(spark, monkeypatch):
    rows = lambda: top_commodities(T.with_commodity(T.load_transactions(spark, SF001), T.load_products(spark, SF001)), 10)
    want = [tuple(r) for r in rows().collect()]
    tx = T.load_transactions(spark, SF001)
    assert T.pieces(tx) is None  # a small input stays as Spark has it
    size = T.Files(spark).size(tx.inputFiles())
    monkeypatch.setattr(T, "PIECE_BYTES", size // 30)
    assert 30 <= T.pieces(tx) <= 31
    assert [tuple(r) for r in rows().collect()] == want
    assert "REPARTITION_BY_NUM" in rows()._jdf.queryExecution().executedPlan().toString()


def test_facts_are_joined_once(spark):
    inp = FT.prepare(T.load_transactions(spark, SF001), T.load_products(spark, SF001), "2001-08-01")
    assert inp.tx_asof.inputFiles() and all("/facts/" in f for f in inp.tx_asof.inputFiles())


def test_get_features_reads_its_plan_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [(1, 2, i, dt.date(2001, 7, 1), 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, "A") for i in range(5)]
    df = spark.createDataFrame(rows, TX_SCHEMA).mapInPandas(read, TX_SCHEMA)
    assert G.get_features(df, "household_key", "30d").first()["baskets_30d"] == 5
    assert seen.value == 5


def test_state_holds_a_line_item_once(spark, tmp_path):
    tx, products = T.load_transactions(spark, SF001).filter("day >= '2001-07-01'"), T.load_products(spark, SF001)
    state = FeatureStore(spark, str(tmp_path))
    S.absorb(tx, products, state, "0")
    stored = sum(state.read_table(n).count() for n in state.files.children(state.root))
    assert 0 < stored <= tx.count()


def test_repeated_keys_are_found_by_hash_and_compared_by_value(spark, monkeypatch):
    df = spark.createDataFrame([(1, None), (None, 1), (2, 3), (2, 3), (None, None), (None, None)], "a long, b long")
    assert ST.repeated_keys(df, ["a", "b"]) == 2  # (1, null) and (null, 1) share a hash, not a key
    assert ST.repeated_keys(df.distinct(), ["a", "b"]) == 0


def test_kept_texts_move_once(spark):
    text = "the same passage of words comes in both of these two documents " * 3
    docs = spark.createDataFrame([(1, text), (2, "head " + text), (2, "head " + text), (3, "other")], "doc_id long, text string")
    out = R.without_repeats(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "kept" in x.split("hashpartitioning", 1)[1]]
    assert sorted(r["doc_id"] for r in out.select(F.col("doc_id")).collect())[0] == 1
