"""get_features on the original two-row fixture: the original cases plus values."""

import pytest

from cartwise.functions.metrics import feature_columns, metric_names, output_name
from cartwise.operators.features import get_features


@pytest.mark.parametrize("grouping_keys, window", [
    (["household_key"], "30d"),
    (["commodity_desc"], "60d"),
    (["household_key", "commodity_desc"], "90d"),
    (["household_key"], "1yr"),
])
def test_get_features_not_empty(transactional_data, grouping_keys, window):
    df = get_features(transactional_data, grouping_keys, window)
    assert df.count() > 0
    assert df.columns == grouping_keys + [output_name(m, window) for m in metric_names()]
    assert all(t == "double" for c, t in df.dtypes if c not in grouping_keys)


def test_case_insensitive_key(transactional_data):
    # the fixture declares COMMODITY_DESC; the keys use the lower-case name
    df = get_features(transactional_data, "commodity_desc", "30d")
    assert df.count() == 2


def test_household_30d_values(transactional_data):
    rows = {r["household_key"]: r.asDict() for r in
            get_features(transactional_data, ["household_key"], "30d").collect()}
    h1, h2 = rows[1], rows[2]
    for h in (h1, h2):
        for m in ("days", "baskets", "products", "line_items"):
            assert h[f"{m}_30d"] == 1.0
    assert (h1["amount_list_30d"], h1["amount_paid_30d"]) == (10.0, 9.5)
    assert (h2["amount_list_30d"], h2["amount_paid_30d"]) == (15.0, 14.0)
    assert [h1[f"{d}_30d"] for d in ("instore_discount", "campaign_coupon_discount",
                                     "manuf_coupon_discount", "total_coupon_discount")] == [0.5, 0.5, 0.0, 0.5]
    assert [h2[f"{d}_30d"] for d in ("instore_discount", "campaign_coupon_discount",
                                     "manuf_coupon_discount", "total_coupon_discount")] == [1.0, 0.0, 1.0, 1.0]
    assert h1["baskets_with_manuf_coupon_discount_30d"] == 0.0
    assert h2["baskets_with_manuf_coupon_discount_30d"] == 1.0
    assert h1["line_items_with_manuf_coupon_discount_30d"] is None      # sum of no 1s is NULL
    assert h2["line_items_with_manuf_coupon_discount_30d"] == 1.0
    assert h1["line_items_with_campaign_coupon_discount_30d"] == 1.0
    assert h2["line_items_with_campaign_coupon_discount_30d"] is None
    assert h1["amount_list_per_days_in_set_30d"] == pytest.approx(10 / 30)
    assert h2["amount_list_per_days_in_set_30d"] == pytest.approx(15 / 30)
    assert h1["amount_paid_to_amount_list_30d"] == pytest.approx(0.95)
    assert h2["amount_paid_to_amount_list_30d"] == pytest.approx(14 / 15)
    assert "products_per_day_30d_30d" in h1                              # doubled suffix kept
    since = ["instore", "campaign_coupon", "manuf_coupon", "total_coupon"]
    assert [h1[f"days_since_{d}_discount_30d"] for d in since] == [1.0, 1.0, 29.0, 1.0]
    assert [h2[f"days_since_{d}_discount_30d"] for d in since] == [0.0, 29.0, 0.0, 0.0]


def test_unknown_window_raises_before_any_job(transactional_data):
    with pytest.raises(ValueError):
        get_features(transactional_data, ["household_key"], "7d")
    with pytest.raises(ValueError):
        get_features(transactional_data, ["household_key"])


def test_all_windows_at_once(transactional_data):
    df = get_features(transactional_data, ["household_key"], ["30d", "60d", "90d", "1yr"])
    assert df.columns == ["household_key"] + feature_columns()
    one = get_features(transactional_data, ["household_key"], "60d").orderBy("household_key").collect()
    both = df.orderBy("household_key").collect()
    for a, b in zip(one, both):
        for c in one[0].asDict():
            assert a[c] == b[c]


def test_empty_input_keeps_schema(transactional_data):
    empty = transactional_data.limit(0)
    df = get_features(empty, ["household_key"], "30d")
    assert df.count() == 0
    assert len(df.columns) == 95
