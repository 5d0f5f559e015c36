"""The driver contract, and every oracle query checked at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cartwise import queries as Q
from cartwise.functions.metrics import feature_columns

from .conftest import SF001



def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["household_key", "select_date"] + feature_columns()
    assert df.count() > 0


def test_every_query_has_an_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    own, own_sql = set(Q.REGISTRY), set(Q.oracle_registry())
    assert own <= set(qs) and own_sql <= set(sql)
    assert own == own_sql  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(rows, cols):
    return sorted((tuple(_canon(r[c]) for c in cols) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(Q.oracle_registry())))
def test_query_matches_oracle(spark, con, name, monkeypatch):
    for rounds in ("QUERY_ROUNDS", "TUNING_ROUNDS"):  # the checked facts don't depend on them
        monkeypatch.setattr(Q, rounds, 3)
    if not os.path.exists(f"{SF001}/lineitem.parquet"):
        pytest.skip("test data missing")
    sdf = E.queries()[name](spark, SF001)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.sql(E.oracle_sql()[name])
    ocols = rel.columns
    orows = [dict(zip(ocols, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    cols = sorted(ocols)
    assert _bag(srows, cols) == _bag(orows, cols)
