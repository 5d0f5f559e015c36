"""The metric catalogue: 26 aggregates, 64 ratios and 4 days-since metrics.

These names and formulas define the feature-table schema, so they are fixed
values that must equal the original pipeline's output.  They are kept here
as data; both the Spark build (``operators.features``) and the DuckDB oracle
(``oracle.sql``) generate their expressions from these lists, independently.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's schema and formulas)
# ---------------------------------------------------------------------------

# the four discount columns that drive every conditional metric
DISCOUNTS = (
    "instore_discount",
    "campaign_coupon_discount",
    "manuf_coupon_discount",
    "total_coupon_discount",
)

# money columns summed per group, in output order
MONEY = (
    "amount_list",
    "instore_discount",
    "campaign_coupon_discount",
    "manuf_coupon_discount",
    "total_coupon_discount",
    "amount_paid",
)

# look-back windows: name -> (days back from the latest day to the window
# start, days back to the window end).  '1yr' is the 30 days that start 364
# days before the latest day.
WINDOWS = {
    "30d": (29, 0),
    "60d": (59, 0),
    "90d": (89, 0),
    "1yr": (364, 335),
}
WINDOW_ORDER = ("30d", "60d", "90d", "1yr")

# the 26 aggregates, in output order
AGGREGATES = (
    "days",
    "baskets",
    "products",
    "line_items",
    "amount_list",
    "instore_discount",
    "campaign_coupon_discount",
    "manuf_coupon_discount",
    "total_coupon_discount",
    "amount_paid",
    "days_with_instore_discount",
    "days_with_campaign_coupon_discount",
    "days_with_manuf_coupon_discount",
    "days_with_total_coupon_discount",
    "baskets_with_instore_discount",
    "baskets_with_campaign_coupon_discount",
    "baskets_with_manuf_coupon_discount",
    "baskets_with_total_coupon_discount",
    "products_with_instore_discount",
    "products_with_campaign_coupon_discount",
    "products_with_manuf_coupon_discount",
    "products_with_total_coupon_discount",
    "line_items_with_instore_discount",
    "line_items_with_campaign_coupon_discount",
    "line_items_with_manuf_coupon_discount",
    "line_items_with_total_coupon_discount",
)

# denominator token for "number of calendar days in the window"
DAYS_IN_WINDOW = "days_in_window"

# the 64 ratios: (name, numerator, denominator), in output order.
# 'products_per_day' carries the window suffix twice in the final schema.
RATIOS = (
    ("baskets_per_day", "baskets", "days"),
    ("products_per_day", "products", "days"),
    ("line_items_per_day", "line_items", "days"),
    ("amount_list_per_day", "amount_list", "days"),
    ("instore_discount_per_day", "instore_discount", "days"),
    ("campaign_coupon_discount_per_day", "campaign_coupon_discount", "days"),
    ("manuf_coupon_discount_per_day", "manuf_coupon_discount", "days"),
    ("total_coupon_discount_per_day", "total_coupon_discount", "days"),
    ("amount_paid_per_day", "amount_paid", "days"),
    ("days_with_instore_discount_per_days", "days_with_instore_discount", "days"),
    ("days_with_campaign_coupon_discount_per_days", "days_with_campaign_coupon_discount", "days"),
    ("days_with_manuf_coupon_discount_per_days", "days_with_manuf_coupon_discount", "days"),
    ("days_with_total_coupon_discount_per_days", "days_with_total_coupon_discount", "days"),
    ("days_to_days_in_set", "days", DAYS_IN_WINDOW),
    ("baskets_per_days_in_set", "baskets", DAYS_IN_WINDOW),
    ("products_to_days_in_set", "products", DAYS_IN_WINDOW),
    ("line_items_per_days_in_set", "line_items", DAYS_IN_WINDOW),
    ("amount_list_per_days_in_set", "amount_list", DAYS_IN_WINDOW),
    ("instore_discount_per_days_in_set", "instore_discount", DAYS_IN_WINDOW),
    ("campaign_coupon_discount_per_days_in_set", "campaign_coupon_discount", DAYS_IN_WINDOW),
    ("manuf_coupon_discount_per_days_in_set", "manuf_coupon_discount", DAYS_IN_WINDOW),
    ("total_coupon_discount_per_days_in_set", "total_coupon_discount", DAYS_IN_WINDOW),
    ("amount_paid_per_days_in_set", "amount_paid", DAYS_IN_WINDOW),
    ("days_with_instore_discount_per_days_in_set", "days_with_instore_discount", DAYS_IN_WINDOW),
    ("days_with_campaign_coupon_discount_per_days_in_set", "days_with_campaign_coupon_discount", DAYS_IN_WINDOW),
    ("days_with_manuf_coupon_discount_per_days_in_set", "days_with_manuf_coupon_discount", DAYS_IN_WINDOW),
    ("days_with_total_coupon_discount_per_days_in_set", "days_with_total_coupon_discount", DAYS_IN_WINDOW),
    ("products_per_basket", "products", "baskets"),
    ("line_items_per_basket", "line_items", "baskets"),
    ("amount_list_per_basket", "amount_list", "baskets"),
    ("instore_discount_per_basket", "instore_discount", "baskets"),
    ("campaign_coupon_discount_per_basket", "campaign_coupon_discount", "baskets"),
    ("manuf_coupon_discount_per_basket", "manuf_coupon_discount", "baskets"),
    ("total_coupon_discount_per_basket", "total_coupon_discount", "baskets"),
    ("amount_paid_per_basket", "amount_paid", "baskets"),
    ("baskets_with_instore_discount_per_baskets", "baskets_with_instore_discount", "baskets"),
    ("baskets_with_campaign_coupon_discount_per_baskets", "baskets_with_campaign_coupon_discount", "baskets"),
    ("baskets_with_manuf_coupon_discount_per_baskets", "baskets_with_manuf_coupon_discount", "baskets"),
    ("baskets_with_total_coupon_discount_per_baskets", "baskets_with_total_coupon_discount", "baskets"),
    ("line_items_per_product", "line_items", "products"),
    ("amount_list_per_product", "amount_list", "products"),
    ("instore_discount_per_product", "instore_discount", "products"),
    ("campaign_coupon_discount_per_product", "campaign_coupon_discount", "products"),
    ("manuf_coupon_discount_per_product", "manuf_coupon_discount", "products"),
    ("total_coupon_discount_per_product", "total_coupon_discount", "products"),
    ("amount_paid_per_product", "amount_paid", "products"),
    ("products_with_instore_discount_per_product", "products_with_instore_discount", "products"),
    ("products_with_campaign_coupon_discount_per_product", "products_with_campaign_coupon_discount", "products"),
    ("products_with_manuf_coupon_discount_per_product", "products_with_manuf_coupon_discount", "products"),
    ("products_with_total_coupon_discount_per_product", "products_with_total_coupon_discount", "products"),
    ("amount_list_per_line_item", "amount_list", "line_items"),
    ("instore_discount_per_line_item", "instore_discount", "line_items"),
    ("campaign_coupon_discount_per_line_item", "campaign_coupon_discount", "line_items"),
    ("manuf_coupon_discount_per_line_item", "manuf_coupon_discount", "line_items"),
    ("total_coupon_discount_per_line_item", "total_coupon_discount", "line_items"),
    ("amount_paid_per_line_item", "amount_paid", "line_items"),
    ("products_with_instore_discount_per_line_item", "products_with_instore_discount", "line_items"),
    ("products_with_campaign_coupon_discount_per_line_item", "products_with_campaign_coupon_discount", "line_items"),
    ("products_with_manuf_coupon_discount_per_line_item", "products_with_manuf_coupon_discount", "line_items"),
    ("products_with_total_coupon_discount_per_line_item", "products_with_total_coupon_discount", "line_items"),
    ("campaign_coupon_discount_to_amount_list", "campaign_coupon_discount", "amount_list"),
    ("manuf_coupon_discount_to_amount_list", "manuf_coupon_discount", "amount_list"),
    ("total_coupon_discount_to_amount_list", "total_coupon_discount", "amount_list"),
    ("amount_paid_to_amount_list", "amount_paid", "amount_list"),
)

# the 4 days-since metrics: (name, discount column)
DAYS_SINCE = (
    ("days_since_instore_discount", "instore_discount"),
    ("days_since_campaign_coupon_discount", "campaign_coupon_discount"),
    ("days_since_manuf_coupon_discount", "manuf_coupon_discount"),
    ("days_since_total_coupon_discount", "total_coupon_discount"),
)

# metric whose name already ends in the window suffix before suffixing
DOUBLE_SUFFIXED = "products_per_day"

# ---------------------------------------------------------------------------
# Derived helpers
# ---------------------------------------------------------------------------

# the distinct-count aggregates: metric -> (entity, discount or None)
DISTINCT_ENTITIES = ("days", "baskets", "products")
ENTITY_COLUMN = {"days": "day", "baskets": "basket_id", "products": "product_id"}


def metric_names() -> list[str]:
    """The 94 per-window metric names in output order (before suffixing)."""
    return list(AGGREGATES) + [r[0] for r in RATIOS] + [d[0] for d in DAYS_SINCE]


def output_name(metric: str, window: str) -> str:
    """Final column name of ``metric`` in ``window``."""
    suffix = "_" + window
    if metric == DOUBLE_SUFFIXED:
        return metric + suffix + suffix
    return metric + suffix


def feature_columns(windows=WINDOW_ORDER) -> list[str]:
    """All metric columns of a wide feature table, in output order."""
    return [output_name(m, w) for w in windows for m in metric_names()]


assert len(AGGREGATES) == 26 and len(RATIOS) == 64 and len(DAYS_SINCE) == 4
