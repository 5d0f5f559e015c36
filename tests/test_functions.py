import datetime as dt

import pytest

from cartwise.functions.dates import label_period, resolve_windows
from cartwise.functions.metrics import feature_columns, metric_names
from cartwise.functions.text import normalize_commodity, normalize_commodity_py


def test_catalogue_sizes():
    assert len(metric_names()) == 94
    cols = feature_columns()
    assert len(cols) == 376 and len(set(cols)) == 376
    assert "products_per_day_30d_30d" in cols and "products_per_day_1yr_1yr" in cols


def test_windows():
    w = {x.name: x for x in resolve_windows("2001-08-01")}
    assert (w["30d"].start, w["30d"].end, w["30d"].days_in_window) == (dt.date(2001, 7, 3), dt.date(2001, 8, 1), 30)
    assert (w["60d"].start, w["60d"].days_in_window) == (dt.date(2001, 6, 3), 60)
    assert (w["90d"].start, w["90d"].days_in_window) == (dt.date(2001, 5, 4), 90)
    assert (w["1yr"].start, w["1yr"].end, w["1yr"].days_in_window) == (dt.date(2000, 8, 2), dt.date(2000, 8, 31), 30)
    with pytest.raises(ValueError):
        resolve_windows("2001-08-01", ["2yr"])


def test_label_period():
    p = label_period("2001-08-01")
    assert p.features_end_day == dt.date(2001, 7, 2)
    assert p.labels_start_day == dt.date(2001, 7, 3)
    assert p.labels_end_day == dt.date(2001, 8, 1)
    assert p.label_days == 30


@pytest.mark.parametrize("raw, expected", [
    ("red bolt", "red_bolt"),
    ("A/B-C'D \"E\"", "A_B_C_D__E_"),
    ("a|b:c;d,e.f", "a_b_c_d_e_f"),
    ("back\\slash", "back\\slash"),
    ("EGGS", "EGGS"),
])
def test_normalize(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "c string").select(normalize_commodity("c")).first()[0]
    assert got == expected
    assert normalize_commodity_py(raw) == expected


def test_normalize_null(spark):
    assert spark.createDataFrame([(None,)], "c string").select(normalize_commodity("c")).first()[0] is None


def test_window_bounds_frame_matches_resolver(spark):
    from cartwise.functions.dates import window_bounds_frame
    bounds = spark.createDataFrame([(dt.date(1995, 1, 1), dt.date(2001, 8, 1))], "min_day date, max_day date")
    rows = {r["window"]: r for r in window_bounds_frame(spark, bounds).collect()}
    for w in resolve_windows("2001-08-01"):
        r = rows[w.name]
        assert (r["min_day"], r["max_day"], r["days_in_window"]) == (w.start, w.end, w.days_in_window)


def test_get_features_with_given_max_day(spark):
    from cartwise.operators.features import get_features
    from .conftest import FIXTURE_ROWS, FIXTURE_SCHEMA
    df = spark.createDataFrame(FIXTURE_ROWS, FIXTURE_SCHEMA)
    a = get_features(df, ["household_key"], "30d").orderBy("household_key").collect()
    b = get_features(df, ["household_key"], "30d", max_day=dt.date(2023, 1, 2)).orderBy("household_key").collect()
    assert a == b
