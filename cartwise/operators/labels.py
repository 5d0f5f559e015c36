"""Purchase labels and exact-key feature lookups (operators G8-G11, J5, J6,
P8, P10, P11, F8).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import LabelPeriod, as_date
from cartwise.functions.text import normalize_commodity, normalize_commodity_py

LOOKUP_KEYS = {
    "household": ["household_key", "select_date"],
    "commodity": ["commodity_desc", "select_date"],
    "household_commodity": ["household_key", "commodity_desc", "select_date"],
}
PREFIX = {"household": "household__", "commodity": "commodity__",
          "household_commodity": "household_commodity__"}
KEY_COLUMNS = ["household_key", "select_date", "commodity_desc"]


def _commodity_products(products: DataFrame, commodity: str) -> DataFrame:
    """Products of one commodity (matched on the normalised name, D4/D10)."""
    target = normalize_commodity_py(commodity)
    return (products.filter(normalize_commodity("commodity_desc") == F.lit(target))
            .select("product_id", F.lit(target).alias("commodity_desc")))


def positive_labels(transactions: DataFrame, products: DataFrame, period: LabelPeriod,
                    commodity: str) -> DataFrame:
    """Operator G8: households that bought the commodity in the label period."""
    return (transactions
            .filter(F.col("day").between(F.lit(period.labels_start_day), F.lit(period.labels_end_day)))
            .join(_commodity_products(products, commodity), "product_id", "inner")
            .select("household_key", "commodity_desc")
            .distinct()
            .withColumn("purchased", F.lit(1)))


def labels(transactions: DataFrame, products: DataFrame, period: LabelPeriod, commodity: str) -> DataFrame:
    """Operator G9 (J5 + F8): every household ever seen, labelled 0/1.

    The original builds positives, the distinct households and a left join.
    The same answer comes from one aggregate: left-join each line item to
    the (single-commodity) product list and take, per household, whether
    any line item in the label period matched.  One shuffle, partially
    aggregated, instead of two aggregates and a join.  A NULL household
    never matches the original's equi-join, so it is labelled 0 (D14).
    """
    target = normalize_commodity_py(commodity)
    in_period = F.col("day").between(F.lit(period.labels_start_day), F.lit(period.labels_end_day))
    hit = _commodity_products(products, commodity).select("product_id", F.lit(1).alias("is_target"))
    flagged = transactions.select("household_key", "product_id", "day").join(hit, "product_id", "left")
    bought = F.max(F.when(in_period & (F.col("is_target") == 1), F.lit(1)).otherwise(F.lit(0)))
    return (flagged.groupBy("household_key").agg(bought.alias("purchased"))
            .select("household_key",
                    F.lit(target).alias("commodity_desc"),
                    F.when(F.col("household_key").isNull(), F.lit(0)).otherwise(F.col("purchased"))
                    .cast("int").alias("purchased"),
                    F.lit(period.features_end_day).alias("select_date")))


def feature_lookup(spine: DataFrame, table: DataFrame, grain: str, broadcast_table: bool = False, fixed: tuple = ()) -> DataFrame:
    """Operator J6 for one table: exact match on keys + select_date.

    Every non-key column comes back prefixed (P11); keys that are absent
    from the table give NULL features, as a feature-store lookup does.
    ``broadcast_table`` is only set for tables whose row count is bounded
    by construction (the commodity table holds at most top-n rows per date).
    Keys in ``fixed`` have one and the same value in the spine and the table
    and are left out of the join.
    """
    keys = [k for k in LOOKUP_KEYS[grain] if k not in fixed]
    feats = [c for c in table.columns if c not in LOOKUP_KEYS[grain]]
    side = table.selectExpr(*[f"`{k}`" for k in keys], *[f"`{c}` AS `{PREFIX[grain]}{c}`" for c in feats])
    if broadcast_table:
        side = F.broadcast(side)
    return spine.join(side, keys, "left")


def lookup_all(spine: DataFrame, household: DataFrame, commodity: DataFrame,
               household_commodity: DataFrame, select_date=None, commodity_desc: str | None = None) -> DataFrame:
    """Operator J6: the three lookups chained, each a left join.

    With ``select_date`` every table is narrowed to that date first (a
    partition filter on store tables).  The commodity table is then at most
    top-n rows, the one side broadcast explicitly; without a date it is
    joined like the others and AQE decides.

    With ``commodity_desc`` too (labels and scoring spines hold one commodity
    and one date) the household and the pair table are both joined on the
    household alone: the spine and the wide rows looked up first stay where
    they are, and tables bucketed by household (``sources.layout``) join
    without any exchange.
    """
    fixed: tuple = ()
    if select_date is not None:
        d = F.lit(as_date(select_date))
        household = household.filter(F.col("select_date") == d)
        commodity = commodity.filter(F.col("select_date") == d)
        household_commodity = household_commodity.filter(F.col("select_date") == d)
        if commodity_desc is not None:
            fixed = ("select_date", "commodity_desc")
            household_commodity = household_commodity.filter(F.col("commodity_desc") == F.lit(normalize_commodity_py(commodity_desc)))
    out = feature_lookup(spine, household, "household", fixed=fixed)
    out = feature_lookup(out, household_commodity, "household_commodity", fixed=fixed)
    out = feature_lookup(out, commodity, "commodity", broadcast_table=select_date is not None)
    wide = [c for g in ("household", "commodity", "household_commodity") for c in out.columns if c.startswith(PREFIX[g])]
    return out.select(*spine.columns, *wide)


def training_set(label_df: DataFrame, household: DataFrame, commodity: DataFrame,
                 household_commodity: DataFrame, keep_keys: bool = False, select_date=None,
                 commodity_desc: str | None = None) -> DataFrame:
    """Operator G10: labels + looked-up features, key columns excluded (P10).

    ``select_date`` is the labels' feature date (select date - 30) and
    ``commodity_desc`` their commodity, if they have one only."""
    out = lookup_all(label_df, household, commodity, household_commodity, select_date, commodity_desc)
    return out if keep_keys else out.drop(*KEY_COLUMNS)


def scoring_spine(transactions: DataFrame, commodity: str, select_date) -> DataFrame:
    """Operator G11 (first half): all households x one commodity x date."""
    return (transactions.select("household_key").distinct()
            .withColumn("commodity_desc", F.lit(normalize_commodity_py(commodity)))
            .withColumn("select_date", F.lit(as_date(select_date))))


def scoring_set(transactions: DataFrame, commodity: str, select_date, household: DataFrame,
                commodity_table: DataFrame, household_commodity: DataFrame) -> DataFrame:
    """Operator G11: the scoring spine with the three lookups, keys kept."""
    return lookup_all(scoring_spine(transactions, commodity, select_date), household,
                      commodity_table, household_commodity, select_date, commodity)


def lookup_coverage(looked_up: DataFrame) -> DataFrame:
    """How many spine rows found a row in each feature table (decision D9).

    A lookup at a date the feature job never wrote matches nothing and the
    model would see all-zero inputs; this one-row aggregate makes that
    visible.  Presence is judged on each table's first looked-up column.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for grain, prefix in PREFIX.items():
        first = next((c for c in looked_up.columns if c.startswith(prefix)), None)
        hit = F.count(F.col(first)) if first else F.lit(0).cast("long")
        aggs.append(hit.alias(f"{grain}_hits"))
    return looked_up.agg(*aggs)


@dataclass(frozen=True)
class ClassBalance:
    total: int
    positives: int

    @property
    def weight(self) -> float | None:
        return None if not self.positives else self.total / self.positives


def class_balance(label_df: DataFrame, label_col: str = "purchased") -> DataFrame:
    """Operator A12/M2: rows, positives and total/positives in one aggregate
    (NULL weight when there is no positive, D19)."""
    return (label_df.agg(F.count(F.lit(1)).alias("total"),
                         F.count(F.when(F.col(label_col) == 1, F.lit(1))).alias("positives"))
            .withColumn("pos_class_weight",
                        F.try_divide(F.col("total").cast("double"), F.col("positives").cast("double"))))
