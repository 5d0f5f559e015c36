"""Feature tables from mergeable state: equal to the full rebuild, however the transactions arrive."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.operators import feature_state as S, feature_tables as FT
from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions

from .conftest import SF001

DATES = ("2001-08-01", "2001-07-02")


@pytest.fixture(scope="module")
def facts(spark):
    tx, products = load_transactions(spark, SF001), load_products(spark, SF001, "p_name")
    odd = spark.createDataFrame([(None, 1, 7, dt.date(2001, 7, 30)), (3, None, 7, dt.date(2001, 7, 30)), (3, 2, None, dt.date(2001, 6, 30)), (3, 2, 9, None)],
                                "household_key long, product_id long, basket_id long, day date")
    tx = tx.unionByName(odd, allowMissingColumns=True)
    path = f"{S.stage_path(spark, 'facts')}"
    tx.write.parquet(path)
    return spark.read.schema(tx.schema).parquet(path), products


@pytest.fixture(scope="module")
def arrived(spark, facts, tmp_path_factory):
    """All transactions, in three batches: the history, late rows with the newest days, the rest; the second one tried twice."""
    tx, products = facts
    state = FeatureStore(spark, str(tmp_path_factory.mktemp("state")))
    day = F.col("day")
    late = day.between("2000-03-05", "2000-03-25") | day.between("2001-06-10", "2001-06-20")
    S.absorb(tx.filter((day <= "2001-07-10") & ~late), products, state, "0")
    S.feature_tables_from_state(state, DATES[1])  # leaves history folders behind, which the late rows make stale
    for _ in range(2):
        S.absorb(tx.filter(day.between("2001-07-11", "2001-07-28") | late), products, state, "1")
    S.absorb(tx.filter((day > "2001-07-28") | day.isNull()), products, state, "2")
    return state


@pytest.mark.parametrize("date", DATES)
def test_tables_from_state_equal_the_full_rebuild(facts, arrived, date):
    want = FT.all_feature_tables(FT.prepare(*facts, date))
    got = S.feature_tables_from_state(arrived, date)
    for grain, table in want.items():
        assert got[grain].schema.names == table.schema.names and got[grain].count() == table.count() > 0
        assert got[grain].exceptAll(table).count() == table.exceptAll(got[grain]).count() == 0


def test_the_newest_days_cost_the_newest_months(spark, facts, arrived, monkeypatch):
    """A second build reads months of state by their folders, and no history older than the stored parts."""
    S.feature_tables_from_state(arrived, DATES[0])
    read, real = [], FeatureStore.read_dates
    monkeypatch.setattr(FeatureStore, "read_dates", lambda self, name, dates, *a: read.append((name, sorted(map(str, dates)))) or real(self, name, dates, *a))
    written = set(arrived.files.children(f"{arrived.root}/{S.HISTORY}"))
    S.feature_tables_from_state(arrived, DATES[0])
    assert set(arrived.files.children(f"{arrived.root}/{S.HISTORY}")) == written
    window = [f"2001-{m:02d}-01" for m in range(5, 9)]
    assert {d for name, dates in read for d in dates} <= {*window, "2000-08-01", "2000-09-01"}


def test_late_rows_rebuild_history_from_the_last_month_before_them(spark, facts, arrived, monkeypatch):
    tx, products = facts
    for m in ("2000-08-01", "2000-12-01", "2001-08-01"):
        S.history_before(arrived, dt.date.fromisoformat(m))
    S.absorb(tx.filter(F.col("day").between("2000-08-01", "2000-08-31")).limit(1), products, arrived, "late")
    read, real = [], FeatureStore.read_dates
    monkeypatch.setattr(FeatureStore, "read_dates", lambda self, name, dates, *a: read.append(sorted(map(str, dates))) or real(self, name, dates, *a))
    S.history_before(arrived, dt.date(2001, 8, 1))
    assert len(read) == 1 and read[0][0] == "2000-08-01" and read[0][-1] == "2001-07-01"
    S.absorb(tx.limit(0), products, arrived, "late")  # a batch that is tried again with nothing leaves what it had


def test_repeated_batch_replaces_its_rows(spark, facts, tmp_path):
    tx, products = facts
    state, one = FeatureStore(spark, str(tmp_path)), tx.filter(F.col("day") == "2001-07-30")
    S.absorb(one, products, state, "7")
    rows = sorted(state.read_table(S.DAILY).collect(), key=repr)
    S.absorb(one, products, state, "7")
    assert sorted(state.read_table(S.DAILY).collect(), key=repr) == rows and state.key_check(S.ENTITIES).first()["duplicate_keys"] == 0
    S.absorb(one, products, state, "8")
    assert state.read_table(S.DAILY).count() == 2 * len(rows)


def test_empty_state_is_refused(spark, facts, tmp_path):
    state = FeatureStore(spark, str(tmp_path))
    S.absorb(facts[0].limit(0), facts[1], state, "0")
    with pytest.raises(LookupError):
        S.feature_tables_from_state(state, DATES[0])
