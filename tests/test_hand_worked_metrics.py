"""All 94 metrics of one household against values worked out by hand.

Nothing here is taken from the catalogue's formula tables, so a wrong
numerator or denominator there fails this test.
"""

import datetime as dt

import pytest

from cartwise.functions.metrics import metric_names, output_name
from cartwise.operators.features import get_features

from .conftest import TX_SCHEMA

D1, D11, D21, D26 = (dt.date(2024, 1, d) for d in (1, 11, 21, 26))
# household, product, basket, day, list, in-store, campaign, manufacturer, total, paid
ROWS = [
    (1, 1, 1, D1, 10.0, 2.0, 1.0, 0.0, 1.0, 7.0, "a"),
    (1, 2, 1, D1, 20.0, 0.0, 0.0, 4.0, 4.0, 16.0, "a"),
    (1, 3, 2, D11, 30.0, 3.0, 0.0, 0.0, 0.0, 27.0, "a"),
    (1, 4, 3, D21, 40.0, 0.0, 0.0, 5.0, 5.0, 35.0, "a"),
    (1, 4, 4, D21, 50.0, 0.0, 0.0, 2.0, 2.0, 48.0, "a"),
    (1, None, 4, D21, 60.0, 0.0, 0.0, 0.0, 8.0, 52.0, "a"),
    (2, 9, 9, D26, 99.0, 9.0, 9.0, 9.0, 9.0, 99.0, "b"),  # sets the window's last day
]

EXPECTED = {
    # 3 days, 4 baskets, 6 line items, 5 of them with a product ("products" counts those, not distinct ones)
    "days": 3, "baskets": 4, "products": 5, "line_items": 6,
    "amount_list": 210, "instore_discount": 5, "campaign_coupon_discount": 1,
    "manuf_coupon_discount": 11, "total_coupon_discount": 20, "amount_paid": 185,
    "days_with_instore_discount": 2, "days_with_campaign_coupon_discount": 1,
    "days_with_manuf_coupon_discount": 2, "days_with_total_coupon_discount": 2,
    "baskets_with_instore_discount": 2, "baskets_with_campaign_coupon_discount": 1,
    "baskets_with_manuf_coupon_discount": 3, "baskets_with_total_coupon_discount": 3,
    "products_with_instore_discount": 2, "products_with_campaign_coupon_discount": 1,
    "products_with_manuf_coupon_discount": 2, "products_with_total_coupon_discount": 3,
    "line_items_with_instore_discount": 2, "line_items_with_campaign_coupon_discount": 1,
    "line_items_with_manuf_coupon_discount": 3, "line_items_with_total_coupon_discount": 5,
    # per day with a purchase (3)
    "baskets_per_day": 4 / 3, "products_per_day": 5 / 3, "line_items_per_day": 2.0,
    "amount_list_per_day": 70.0, "instore_discount_per_day": 5 / 3, "campaign_coupon_discount_per_day": 1 / 3,
    "manuf_coupon_discount_per_day": 11 / 3, "total_coupon_discount_per_day": 20 / 3, "amount_paid_per_day": 185 / 3,
    "days_with_instore_discount_per_days": 2 / 3, "days_with_campaign_coupon_discount_per_days": 1 / 3,
    "days_with_manuf_coupon_discount_per_days": 2 / 3, "days_with_total_coupon_discount_per_days": 2 / 3,
    # per calendar day of the window (30)
    "days_to_days_in_set": 0.1, "baskets_per_days_in_set": 4 / 30, "products_to_days_in_set": 5 / 30,
    "line_items_per_days_in_set": 0.2, "amount_list_per_days_in_set": 7.0,
    "instore_discount_per_days_in_set": 5 / 30, "campaign_coupon_discount_per_days_in_set": 1 / 30,
    "manuf_coupon_discount_per_days_in_set": 11 / 30, "total_coupon_discount_per_days_in_set": 20 / 30,
    "amount_paid_per_days_in_set": 185 / 30,
    "days_with_instore_discount_per_days_in_set": 2 / 30, "days_with_campaign_coupon_discount_per_days_in_set": 1 / 30,
    "days_with_manuf_coupon_discount_per_days_in_set": 2 / 30, "days_with_total_coupon_discount_per_days_in_set": 2 / 30,
    # per basket (4)
    "products_per_basket": 1.25, "line_items_per_basket": 1.5, "amount_list_per_basket": 52.5,
    "instore_discount_per_basket": 1.25, "campaign_coupon_discount_per_basket": 0.25,
    "manuf_coupon_discount_per_basket": 2.75, "total_coupon_discount_per_basket": 5.0, "amount_paid_per_basket": 46.25,
    "baskets_with_instore_discount_per_baskets": 0.5, "baskets_with_campaign_coupon_discount_per_baskets": 0.25,
    "baskets_with_manuf_coupon_discount_per_baskets": 0.75, "baskets_with_total_coupon_discount_per_baskets": 0.75,
    # per line item with a product (5)
    "line_items_per_product": 1.2, "amount_list_per_product": 42.0, "instore_discount_per_product": 1.0,
    "campaign_coupon_discount_per_product": 0.2, "manuf_coupon_discount_per_product": 2.2,
    "total_coupon_discount_per_product": 4.0, "amount_paid_per_product": 37.0,
    "products_with_instore_discount_per_product": 0.4, "products_with_campaign_coupon_discount_per_product": 0.2,
    "products_with_manuf_coupon_discount_per_product": 0.4, "products_with_total_coupon_discount_per_product": 0.6,
    # per line item (6)
    "amount_list_per_line_item": 35.0, "instore_discount_per_line_item": 5 / 6,
    "campaign_coupon_discount_per_line_item": 1 / 6, "manuf_coupon_discount_per_line_item": 11 / 6,
    "total_coupon_discount_per_line_item": 20 / 6, "amount_paid_per_line_item": 185 / 6,
    "products_with_instore_discount_per_line_item": 2 / 6, "products_with_campaign_coupon_discount_per_line_item": 1 / 6,
    "products_with_manuf_coupon_discount_per_line_item": 2 / 6, "products_with_total_coupon_discount_per_line_item": 0.5,
    # of the list amount (210)
    "campaign_coupon_discount_to_amount_list": 1 / 210, "manuf_coupon_discount_to_amount_list": 11 / 210,
    "total_coupon_discount_to_amount_list": 20 / 210, "amount_paid_to_amount_list": 185 / 210,
    # days from the last discount to 26 January
    "days_since_instore_discount": 15, "days_since_campaign_coupon_discount": 25,
    "days_since_manuf_coupon_discount": 5, "days_since_total_coupon_discount": 5,
}


def test_every_metric_has_a_hand_worked_value():
    assert set(EXPECTED) == set(metric_names()) and len(EXPECTED) == 94


@pytest.mark.parametrize("keys", [["household_key"], ["commodity_desc"], ["household_key", "commodity_desc"]])
def test_all_94_metrics(spark, keys):
    df = get_features(spark.createDataFrame(ROWS, TX_SCHEMA), keys, "30d")
    first = [r for r in df.collect() if r[keys[0]] in (1, "a")]
    assert len(first) == 1
    got = first[0].asDict()
    assert {m: got[output_name(m, "30d")] for m in EXPECTED} == pytest.approx(EXPECTED)
