"""Several dates of the refresh: prepared ahead, merged in order, and their shared history folders written once."""

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from cartwise.operators import feature_state as S
from cartwise.plans import feature_job as J
from cartwise.sources.store import FeatureStore

from .conftest import TX_SCHEMA

DAYS = [dt.date(2001, 7, d) for d in (1, 2, 3, 4)]


def _run(spark, tmp_path, monkeypatch, build, merge, ahead=2):
    monkeypatch.setattr(J, "feature_tables_from_state", lambda state, date, top_n, stage: build(date))
    monkeypatch.setattr(J, "_merge_tables", lambda tables, store, stage: merge(tables))
    J.run_incremental_feature_jobs(None, DAYS, FeatureStore(spark, str(tmp_path)), ahead=ahead)


def test_the_next_date_is_prepared_while_one_is_written(spark, tmp_path, monkeypatch):
    begun, merged = {d: threading.Event() for d in DAYS}, []

    def build(date):
        begun[date].set()
        return date

    def merge(date):
        later = DAYS[DAYS.index(date) + 1:][:2]
        assert all(begun[d].wait(30) for d in later)
        assert not any(begun[d].is_set() for d in DAYS[DAYS.index(date) + 3:])  # no further ahead than asked
        merged.append(date)

    _run(spark, tmp_path, monkeypatch, build, merge)
    assert merged == DAYS


def test_a_failing_date_leaves_the_earlier_ones_merged(spark, tmp_path, monkeypatch):
    merged = []

    def build(date):
        if date == DAYS[2]:
            raise LookupError("no rows")
        return date

    with pytest.raises(LookupError):
        _run(spark, tmp_path, monkeypatch, build, merged.append)
    assert merged == DAYS[:2]


def test_dates_side_by_side_write_a_history_folder_once(spark, tmp_path, monkeypatch):
    rows = [(h, 1, h * 10 + m, dt.date(2001, m, 5), 2.0, 0.5, 0.0, 0.0, 0.0, 1.5, "A") for h in (1, 2) for m in (5, 6, 7)]
    tx = spark.createDataFrame(rows, TX_SCHEMA).drop("commodity_desc")
    state = FeatureStore(spark, str(tmp_path / "state"))
    S.absorb(tx, spark.createDataFrame([(1, "A")], "product_id long, commodity_desc string"), state, "0")
    made, both, real = [], threading.Barrier(2), S._since_parts

    def since(daily):
        made.append(1)
        return real(daily)

    def before(month):
        both.wait(30)
        return sorted(map(tuple, S.history_before(state, month).collect()), key=str)

    monkeypatch.setattr(S, "_since_parts", since)
    with ThreadPoolExecutor(2) as pool:
        one, two = pool.map(before, [dt.date(2001, 7, 1)] * 2)
    assert made == [1] and one == two and len(one) == 2
