"""Edge cases of metrics, promotion, store writes and the feature build's plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.operators.evaluate import average_precision, roc_auc
from cartwise.operators.registry import promote
from cartwise.sources.store import FeatureStore


def test_ranking_metrics_leave_out_rows_without_label_or_score(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (None, 0.95), (None, 0.1), (1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    clean = spark.createDataFrame(rows[:3], "label int, score double")
    assert average_precision(df).first() == average_precision(clean).first()
    assert roc_auc(df).first()[0] == pytest.approx(0.5)


def test_ranking_metrics_of_one_class_are_null(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8)], "label int, score double")
    assert average_precision(df).first()[0] is None
    assert roc_auc(df).first()[0] is None


def test_auc_of_billions_of_rows_does_not_overflow(spark, monkeypatch):
    from cartwise.operators import evaluate

    n = 3_000_000_000
    counts = spark.createDataFrame([(0.9, n, 0), (0.1, 0, n)], "score double, pos long, neg long")
    monkeypatch.setattr(evaluate, "score_counts", lambda *a, **k: counts)
    assert evaluate.roc_auc(counts).first()[0] == 1.0


def test_a_lucky_champion_is_unseated_on_the_newcomers_rows(spark):
    history = spark.createDataFrame([("m", 1, 0.95, None), ("m", 2, 0.80, 0.78), ("m", 3, 0.79, 0.85), ("m", 4, 0.6, 0.5)],
                                    "model_name string, version int, roc_auc double, champion_auc double")
    alias = {r.version: r.alias for r in promote(history).collect()}
    assert alias == {1: None, 2: "Champion", 3: "Challenger", 4: None}


def test_a_write_with_a_repeated_key_is_refused_and_changes_nothing(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(1, day, 1.0)], "k int, select_date date, v double")
    store.create_table("t", ["k", "select_date"], rows.schema)
    store.write_table("t", rows)
    twice = spark.createDataFrame([(1, day, 2.0), (1, day, 3.0)], rows.schema)
    for mode in ("merge", "overwrite"):
        with pytest.raises(ValueError, match="more than once"):
            store.write_table("t", twice, mode=mode)
    assert [tuple(r) for r in store.read_table("t").collect()] == [(1, day, 1.0)]


def test_all_feature_tables_read_the_facts_twice_and_expand_nothing(spark, tmp_path, monkeypatch):
    from cartwise.operators import feature_tables as FT
    from cartwise.sources.tables import load_products, load_transactions

    sf = "/root/testdata/sf0.001"
    plans = []
    real = FT.materialize

    def seen(df, *args, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **kw)

    monkeypatch.setattr(FT, "materialize", seen)
    inp = FT.prepare(load_transactions(spark, sf), load_products(spark, sf, "p_type"), "2001-08-01")
    tables = FT.all_feature_tables(inp, str(tmp_path / "stage"))
    scans = sum(p.split("Subqueries")[0].count("lineitem.parquet") for p in plans)
    assert scans <= 2
    for df in tables.values():
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert "lineitem.parquet" not in plans[-1]
    # one stack feeds the distinct counts of all grains
    assert sum(p.count("Generate stack") for p in plans) == 1 and not any("Expand" in p for p in plans)
    assert tables["household"].agg(F.count("*")).first()[0] > 0
