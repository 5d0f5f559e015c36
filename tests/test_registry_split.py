import duckdb
import pytest

from cartwise.operators.registry import latest_version, promote, version_for_alias
from cartwise.operators.split import assign_split, split_bucket_sql

SCHEMA = "model_name string, version int, roc_auc double"


def aliases(spark, rows):
    reg = promote(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r["version"]: r["alias"] for r in reg}


def test_nothing_passes(spark):
    assert aliases(spark, [("m", 1, 0.6), ("m", 2, 0.7)]) == {1: None, 2: None}


def test_first_pass_becomes_champion(spark):
    assert aliases(spark, [("m", 1, 0.6), ("m", 2, 0.8)]) == {1: None, 2: "Champion"}


def test_better_or_equal_replaces_champion(spark):
    assert aliases(spark, [("m", 1, 0.8), ("m", 2, 0.8)]) == {1: None, 2: "Champion"}
    assert aliases(spark, [("m", 1, 0.8), ("m", 2, 0.9)]) == {1: None, 2: "Champion"}


def test_worse_stays_challenger(spark):
    assert aliases(spark, [("m", 1, 0.9), ("m", 2, 0.8)]) == {1: "Champion", 2: "Challenger"}


def test_failed_gate_keeps_previous_state(spark):
    got = aliases(spark, [("m", 1, 0.9), ("m", 2, 0.8), ("m", 3, 0.5)])
    assert got == {1: "Champion", 2: "Challenger", 3: None}
    got = aliases(spark, [("m", 1, 0.9), ("m", 2, 0.8), ("m", 3, 0.95), ("m", 4, 0.1)])
    assert got == {1: None, 2: None, 3: "Champion", 4: None}


def test_models_are_independent(spark):
    reg = promote(spark.createDataFrame([("a", 1, 0.9), ("b", 1, 0.5), ("b", 2, 0.76)], SCHEMA))
    champs = {(r["model_name"], r["version"]) for r in version_for_alias(reg).collect()}
    assert champs == {("a", 1), ("b", 2)}


def test_latest_version(spark):
    got = {r["model_name"]: r["latest_version"] for r in
           latest_version(spark.createDataFrame([("a", 3, 0.1), ("a", 7, 0.2), ("b", 0, 0.3)], SCHEMA)).collect()}
    assert got == {"a": 7, "b": 1}


def test_split_matches_sql_and_proportions(spark):
    keys = list(range(1, 5001)) + [10**12 + 7, 2**40]
    df = assign_split(spark.createDataFrame([(k,) for k in keys], "household_key long"))
    spark_b = {r["household_key"]: r["bucket"] for r in df.collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1::BIGINT[]) AS household_key", [keys])
    sql_b = dict(con.sql(f"SELECT household_key, {split_bucket_sql('household_key')} FROM t").fetchall())
    assert spark_b == sql_b
    counts = {s: 0 for s in ("train", "validate", "test")}
    for r in df.collect():
        counts[r["split"]] += 1
    n = len(keys)
    assert counts["train"] / n == pytest.approx(0.70, abs=0.03)
    assert counts["validate"] / n == pytest.approx(0.15, abs=0.03)
