"""Named queries (one per operator of the inventory) and their oracles.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables of ``sf_dir``.  Parameters are fixed per query so the Spark
result and the DuckDB oracle describe the same computation:

* feature select date 2001-08-01 (the last day in the test data)
* label select date 2001-08-01: features end 2001-07-02, labels 07-03..08-01
* commodity = part name for the feature tables (64 names with spaces),
  part type for the training flow (dense labels: 'PROMO')
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.dates import day_bounds, label_period, window_bounds_frame
from cartwise.functions.metrics import (
    AGGREGATES, DAYS_SINCE, DISCOUNTS, MONEY, RATIOS, WINDOW_ORDER, WINDOWS, feature_columns, output_name,
)
from cartwise.functions.text import normalize_commodity
from cartwise.oracle import sql as O
from cartwise.operators import feature_tables as FT
from cartwise.operators.features import get_features
from cartwise.operators import model as M
from cartwise.operators.evaluate import average_precision, confusion_metrics, roc_auc
from cartwise.operators.labels import (
    class_balance, feature_lookup, labels, lookup_coverage, positive_labels, scoring_set, training_set,
)
from cartwise.operators import registry as R
from cartwise.operators.registry import latest_version, promote
from cartwise.operators.split import assign_split, split_bucket_sql
from cartwise.operators.spine import (
    commodity_purchases, distinct_households, household_commodity_spine, top_commodities,
)
from cartwise.operators import feature_state as FS
from cartwise.plans.feature_job import TABLE_NAMES, run_feature_job
from cartwise.plans.inference_job import run_inference_job
from cartwise.plans.training_job import run_training_job
from cartwise.session import checkpoint_root, materialize, remove_path, shuffles_removed, stage_path
from cartwise.sources.layout import publish_lookups, read_facts_by_day, write_facts_by_day
from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions, stage_facts, transactions_asof, with_commodity

FEATURE_DATE = "2001-08-01"
FEATURE_COMMODITY = "p_name"

GRAINS = {
    "household": ["household_key"],
    "commodity": ["commodity_desc"],
    "household_commodity": ["household_key", "commodity_desc"],
}

REGISTRY: dict = {}
_ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        REGISTRY[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def oracle_registry() -> dict[str, str]:
    return {k: (v() if callable(v) else v) for k, v in _ORACLES.items()}


def _tx(spark, sf_dir):
    return load_transactions(spark, sf_dir)


def _products(spark, sf_dir, col=FEATURE_COMMODITY):
    return load_products(spark, sf_dir, col)


def _money_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in MONEY else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------
# sources, projections, filters, joins
# --------------------------------------------------------------------------

@register("transactions_scan", lambda: f"WITH {O.base_ctes()} SELECT household_key, product_id, basket_id, \"day\", "
          + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MONEY) + " FROM txn")
def q_transactions_scan(spark, sf_dir):
    """The transactions relation (money as double)."""
    return _money_double(_tx(spark, sf_dir))


@register("transactions_products_join", lambda: f"WITH {O.base_ctes()} SELECT household_key, product_id, "
          "basket_id, \"day\", commodity_desc, CAST(amount_paid AS DOUBLE) AS amount_paid FROM txp")
def q_transactions_products_join(spark, sf_dir):
    """Transactions x products on product_id."""
    return (with_commodity(_tx(spark, sf_dir), _products(spark, sf_dir))
            .select("household_key", "product_id", "basket_id", "day", "commodity_desc",
                    F.col("amount_paid").cast("double").alias("amount_paid")))


@register("transactions_asof", lambda: f"WITH {O.base_ctes()} SELECT household_key, basket_id, \"day\", "
          f"commodity_desc FROM txp WHERE \"day\" <= DATE '2000-06-30'")
def q_transactions_asof(spark, sf_dir):
    """Transactions with commodity up to a date (pushed to the scan)."""
    return (transactions_asof(_tx(spark, sf_dir), _products(spark, sf_dir), "2000-06-30")
            .select("household_key", "basket_id", "day", "commodity_desc"))


@register("window_filter", lambda: f"WITH {O.base_ctes()} SELECT household_key, basket_id, \"day\" FROM txn "
          "WHERE \"day\" BETWEEN DATE '2001-05-04' AND DATE '2001-08-01'")
def q_window_filter(spark, sf_dir):
    """Inclusive date range."""
    return (_tx(spark, sf_dir).filter(F.col("day").between(F.lit("2001-05-04").cast("date"),
                                                           F.lit("2001-08-01").cast("date")))
            .select("household_key", "basket_id", "day"))


@register("normalize_commodity", lambda: "SELECT p_name AS commodity_raw, "
          + O.norm_sql("p_name") + " AS commodity_desc FROM (SELECT DISTINCT p_name FROM part)")
def q_normalize_commodity(spark, sf_dir):
    """Commodity names mapped to feature keys."""
    return (_products(spark, sf_dir).select(F.col("commodity_desc").alias("commodity_raw")).distinct()
            .select("commodity_raw", normalize_commodity("commodity_raw").alias("commodity_desc")))


# --------------------------------------------------------------------------
# bounds, ranking, spine
# --------------------------------------------------------------------------

@register("day_bounds", lambda: f"WITH {O.base_ctes()} SELECT min(\"day\") AS min_day, max(\"day\") AS max_day FROM txp")
def q_day_bounds(spark, sf_dir):
    """A1: first and last day."""
    return day_bounds(with_commodity(_tx(spark, sf_dir), _products(spark, sf_dir)))


def _window_bounds_sql():
    rows = " UNION ALL ".join(
        f"SELECT {i} AS window_order, '{w}' AS \"window\", {WINDOWS[w][0]} AS bs, {WINDOWS[w][1]} AS be"
        for i, w in enumerate(WINDOW_ORDER))
    return (f"WITH {O.base_ctes()}, b AS (SELECT max(\"day\") AS max_day FROM txp), o AS ({rows}) "
            "SELECT window_order, \"window\", CAST(max_day - bs AS DATE) AS min_day, "
            "CAST(max_day - be AS DATE) AS max_day, CAST(bs - be + 1 AS INTEGER) AS days_in_window "
            "FROM b CROSS JOIN o")


@register("window_bounds", _window_bounds_sql)
def q_window_bounds(spark, sf_dir):
    """The four look-back windows anchored on the last day."""
    tx = with_commodity(_tx(spark, sf_dir), _products(spark, sf_dir))
    return window_bounds_frame(spark, day_bounds(tx))


@register("commodity_purchases", lambda: f"WITH {O.base_ctes()} SELECT commodity_desc, "
          "count(DISTINCT basket_id) AS purchases FROM txp GROUP BY commodity_desc")
def q_commodity_purchases(spark, sf_dir):
    """A10: distinct baskets per commodity."""
    return commodity_purchases(with_commodity(_tx(spark, sf_dir), _products(spark, sf_dir)))


@register("top_commodities", lambda: f"WITH {O.base_ctes()} SELECT " + O.norm_sql("commodity_desc")
          + " AS commodity_desc, purchases FROM (SELECT commodity_desc, count(DISTINCT basket_id) AS purchases "
          "FROM txp GROUP BY commodity_desc ORDER BY purchases DESC, commodity_desc ASC LIMIT 10)")
def q_top_commodities(spark, sf_dir):
    """Top-10 commodities by baskets, tie broken by name, normalised."""
    return top_commodities(with_commodity(_tx(spark, sf_dir), _products(spark, sf_dir)), 10)


@register("distinct_households", lambda: f"WITH {O.base_ctes()} SELECT DISTINCT household_key FROM txn")
def q_distinct_households(spark, sf_dir):
    """Distinct households."""
    return distinct_households(_tx(spark, sf_dir))


def _spine_sql():
    return (f"WITH {O.base_ctes()}, top AS (SELECT " + O.norm_sql("commodity_desc")
            + " AS commodity_desc FROM (SELECT commodity_desc, count(DISTINCT basket_id) AS purchases FROM txp "
            "GROUP BY commodity_desc ORDER BY purchases DESC, commodity_desc ASC LIMIT 10)) "
            f"SELECT DISTINCT h.household_key, t.commodity_desc FROM (SELECT DISTINCT household_key FROM txp "
            f"WHERE \"day\" <= DATE '{FEATURE_DATE}') h CROSS JOIN top t")


@register("household_commodity_spine", _spine_sql)
def q_household_commodity_spine(spark, sf_dir):
    """Households up to the date x top-10 commodities."""
    inp = FT.prepare(_tx(spark, sf_dir), _products(spark, sf_dir), FEATURE_DATE, staged=False)
    return household_commodity_spine(distinct_households(inp.tx_asof), inp.top)


# --------------------------------------------------------------------------
# per-window feature function (G1) and the wide feature tables
# --------------------------------------------------------------------------

def _asof_normalized(spark, sf_dir, select_date=FEATURE_DATE):
    tx = transactions_asof(_tx(spark, sf_dir), _products(spark, sf_dir), select_date)
    return tx.withColumn("commodity_desc", normalize_commodity("commodity_desc"))


def _q_get_features(spark, sf_dir, grain, window):
    return get_features(_asof_normalized(spark, sf_dir), GRAINS[grain], window)


for _g in GRAINS:
    for _w in WINDOW_ORDER:
        register(f"get_features_{_g}_{_w}",
                 partial(O.get_features_sql, GRAINS[_g], _w, FEATURE_DATE, FEATURE_COMMODITY))(
            partial(_q_get_features, grain=_g, window=_w))


def _q_feature_table(spark, sf_dir, grain):
    inp = FT.prepare(_tx(spark, sf_dir), _products(spark, sf_dir), FEATURE_DATE)
    return FT.BUILDERS[grain](inp)


for _g in GRAINS:
    register(f"{_g}_features", partial(O.feature_table_sql, _g, FEATURE_DATE, FEATURE_COMMODITY))(
        partial(_q_feature_table, grain=_g))


def household_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _q_feature_table(spark, sf_dir, "household")


@register("household_features_by_day", lambda: O.feature_table_sql("household", FEATURE_DATE, FEATURE_COMMODITY))
def q_household_features_by_day(spark, sf_dir):
    """The facts are laid out by day; the household table reads its windows' days by their folders."""
    tx, products = _tx(spark, sf_dir), _products(spark, sf_dir)
    path = f"{checkpoint_root(spark).rstrip('/')}/facts-by-day-{uuid.uuid4().hex}"
    write_facts_by_day(tx, products, path)
    return FT.household_features(FT.prepare(read_facts_by_day(spark, path, with_commodity(tx, products).schema), None, FEATURE_DATE))


def _absorbed(spark, sf_dir) -> FeatureStore:
    """State of all transactions, which came in three batches: the older half, then the even baskets, then the rest, late rows among both."""
    tx, products = _tx(spark, sf_dir), _products(spark, sf_dir)
    state = _fresh_store(spark)
    older, even = F.col("day") < "1998-07-01", F.col("basket_id") % 2 == 0
    for i, part in enumerate((older & even, ~older & even, ~even)):
        FS.absorb(tx.filter(part), products, state, str(i))
    return state


def _q_from_state(spark, sf_dir, grain):
    return FS.feature_tables_from_state(_absorbed(spark, sf_dir), FEATURE_DATE)[grain]


for _g in ("household", "household_commodity"):
    register(f"{_g}_features_from_state", partial(O.feature_table_sql, _g, FEATURE_DATE, FEATURE_COMMODITY))(
        partial(_q_from_state, grain=_g))


# --------------------------------------------------------------------------
# labels, lookups, training and scoring sets
# --------------------------------------------------------------------------

LABEL_DATE = "2001-08-01"
LABEL_COMMODITY_COLUMN = "p_type"
LABEL_COMMODITY = "PROMO"


def _period():
    return label_period(LABEL_DATE)


@register("label_bounds", lambda: f"WITH {O.base_ctes()} SELECT max_day AS select_date, "
          "CAST(max_day - 30 AS DATE) AS features_end_day, CAST(max_day - 29 AS DATE) AS labels_start_day, "
          "max_day AS labels_end_day FROM (SELECT max(\"day\") AS max_day FROM txn)")
def q_label_bounds(spark, sf_dir):
    """Feature and label periods for a select date (the last day)."""
    return (day_bounds(_tx(spark, sf_dir))
            .select(F.col("max_day").alias("select_date"),
                    F.date_sub("max_day", 30).alias("features_end_day"),
                    F.date_sub("max_day", 29).alias("labels_start_day"),
                    F.col("max_day").alias("labels_end_day")))


def _labels_sql_ctes():
    p = _period()
    return (f"{O.base_ctes(LABEL_COMMODITY_COLUMN)}, "
            "hh AS (SELECT DISTINCT household_key FROM txn), "
            f"pos AS (SELECT DISTINCT household_key, {O.norm_sql('commodity_desc')} AS commodity_desc, 1 AS purchased "
            f"FROM txp WHERE \"day\" BETWEEN DATE '{p.labels_start_day}' AND DATE '{p.labels_end_day}' "
            f"AND {O.norm_sql('commodity_desc')} = '{LABEL_COMMODITY}'), "
            f"lab AS (SELECT hh.household_key, '{LABEL_COMMODITY}' AS commodity_desc, "
            "CAST(COALESCE(pos.purchased, 0) AS INTEGER) AS purchased, "
            f"DATE '{p.features_end_day}' AS select_date FROM hh LEFT JOIN pos USING (household_key))")


@register("positive_labels", lambda: f"WITH {_labels_sql_ctes()} SELECT household_key, commodity_desc, purchased FROM pos")
def q_positive_labels(spark, sf_dir):
    """Households buying the commodity in the label period."""
    return positive_labels(_tx(spark, sf_dir), _products(spark, sf_dir, LABEL_COMMODITY_COLUMN),
                           _period(), LABEL_COMMODITY)


def _labels(spark, sf_dir):
    return labels(_tx(spark, sf_dir), _products(spark, sf_dir, LABEL_COMMODITY_COLUMN), _period(), LABEL_COMMODITY)


@register("labels", lambda: f"WITH {_labels_sql_ctes()} SELECT * FROM lab")
def q_labels(spark, sf_dir):
    """All households with a 0/1 purchase label."""
    return _labels(spark, sf_dir)


@register("class_balance", lambda: f"WITH {_labels_sql_ctes()} SELECT count(*) AS total, "
          "count(*) FILTER (WHERE purchased = 1) AS positives, "
          "CAST(count(*) AS DOUBLE) / NULLIF(CAST(count(*) FILTER (WHERE purchased = 1) AS DOUBLE), 0) "
          "AS pos_class_weight FROM lab")
def q_class_balance(spark, sf_dir):
    """Total, positives and the positive-class weight."""
    return class_balance(_labels(spark, sf_dir))


def _feature_tables(spark, sf_dir, select_date):
    inp = FT.prepare(_tx(spark, sf_dir), _products(spark, sf_dir, LABEL_COMMODITY_COLUMN), select_date)
    tables = FT.all_feature_tables(inp)
    return tables["household"], tables["commodity"], tables["household_commodity"]


def _lookup_sql(spine_cte: str, select_date: str, keep_keys: bool) -> str:
    """Oracle: the spine CTE ``sp`` left-joined to three feature tables."""
    cols = feature_columns()
    parts = [f"hf AS ({O.feature_table_sql('household', select_date, LABEL_COMMODITY_COLUMN)})",
             f"cf AS ({O.feature_table_sql('commodity', select_date, LABEL_COMMODITY_COLUMN)})",
             f"hcf AS ({O.feature_table_sql('household_commodity', select_date, LABEL_COMMODITY_COLUMN)})"]
    sel = ["sp.household_key", "sp.commodity_desc", "sp.select_date"] if keep_keys else []
    sel += [c for c in ["sp.purchased"] if "purchased" in spine_cte]
    for alias, prefix in (("hf", "household__"), ("cf", "commodity__"), ("hcf", "household_commodity__")):
        sel += [f'{alias}."{c}" AS "{prefix}{c}"' for c in cols]
    return (f"WITH {spine_cte}, {', '.join(parts)} SELECT {', '.join(sel)} FROM sp "
            "LEFT JOIN hf ON sp.household_key = hf.household_key AND sp.select_date = hf.select_date "
            "LEFT JOIN cf ON sp.commodity_desc = cf.commodity_desc AND sp.select_date = cf.select_date "
            "LEFT JOIN hcf ON sp.household_key = hcf.household_key AND sp.commodity_desc = hcf.commodity_desc "
            "AND sp.select_date = hcf.select_date")


@register("training_set", lambda: _lookup_sql(f"{_labels_sql_ctes()}, sp AS (SELECT * FROM lab)",
                                               str(_period().features_end_day), keep_keys=False))
def q_training_set(spark, sf_dir):
    """Labels + 1,128 looked-up features, keys excluded."""
    fed = _period().features_end_day
    hf, cf, hcf = _feature_tables(spark, sf_dir, fed)
    return training_set(_labels(spark, sf_dir), hf, cf, hcf, select_date=fed, commodity_desc=LABEL_COMMODITY)


@register("training_set_bucketed", lambda: _lookup_sql(f"{_labels_sql_ctes()}, sp AS (SELECT * FROM lab)",
                                                       str(_period().features_end_day), keep_keys=True))
def q_training_set_bucketed(spark, sf_dir):
    """Labels and feature tables published bucketed by household, then joined without an exchange; keys kept."""
    fed = _period().features_end_day
    return publish_lookups(_labels(spark, sf_dir), *_feature_tables(spark, sf_dir, fed), fed, LABEL_COMMODITY).looked_up(spark)


def _scoring_sql():
    spine = (f"{O.base_ctes(LABEL_COMMODITY_COLUMN)}, sp AS (SELECT DISTINCT household_key, "
             f"'{LABEL_COMMODITY}' AS commodity_desc, DATE '{LABEL_DATE}' AS select_date FROM txn)")
    return _lookup_sql(spine, LABEL_DATE, keep_keys=True)


@register("scoring_set", _scoring_sql)
def q_scoring_set(spark, sf_dir):
    """All households x commodity x date with the three lookups."""
    hf, cf, hcf = _feature_tables(spark, sf_dir, LABEL_DATE)
    return scoring_set(_tx(spark, sf_dir), LABEL_COMMODITY, LABEL_DATE, hf, cf, hcf)


# --------------------------------------------------------------------------
# split, ranking and confusion metrics, registry
# --------------------------------------------------------------------------

MODEL_NAME = "propensity_" + LABEL_COMMODITY
# Baseline scorers registered as successive model versions: each scores a
# household by one looked-up feature; their test AUCs drive the registry.
CANDIDATES = (
    (1, "household_commodity__amount_paid_90d"),
    (2, "household_commodity__baskets_30d"),
    (3, "household__baskets_90d"),
    (4, "household_commodity__days_1yr"),
    (5, "household_commodity__line_items_90d"),
)
BASELINE_SCORE = CANDIDATES[0][1]


def _evaluation_frame(spark, sf_dir) -> DataFrame:
    """Labels + the looked-up features the baselines use, with the split."""
    windows = [w for w in WINDOW_ORDER if any(c.endswith("_" + w) for _, c in CANDIDATES)]
    inp = FT.prepare(_tx(spark, sf_dir), _products(spark, sf_dir, LABEL_COMMODITY_COLUMN), _period().features_end_day, windows=windows)
    lab, one = _labels(spark, sf_dir), ("select_date", "commodity_desc")
    pairs = FT.household_commodity_features(inp).filter(F.col("commodity_desc") == LABEL_COMMODITY)
    ev = feature_lookup(feature_lookup(lab, FT.household_features(inp), "household", fixed=one), pairs, "household_commodity", fixed=one)
    return assign_split(ev.select("household_key", F.col("purchased").alias("label"),
                                  *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for _, c in CANDIDATES]))


def _evaluation_sql_ctes() -> str:
    fed = str(_period().features_end_day)
    cols = ", ".join(f"COALESCE({'hf' if c.startswith('household__') else 'hcf'}.\"{c.split('__', 1)[1]}\", 0.0) "
                     f"AS \"{c}\"" for _, c in CANDIDATES)
    return (f"{_labels_sql_ctes()}, "
            f"hf AS ({O.feature_table_sql('household', fed, LABEL_COMMODITY_COLUMN)}), "
            f"hcf AS ({O.feature_table_sql('household_commodity', fed, LABEL_COMMODITY_COLUMN)}), "
            f"ev0 AS (SELECT lab.household_key, lab.purchased AS label, {cols} FROM lab "
            "LEFT JOIN hf ON lab.household_key = hf.household_key AND lab.select_date = hf.select_date "
            "LEFT JOIN hcf ON lab.household_key = hcf.household_key AND lab.commodity_desc = hcf.commodity_desc "
            "AND lab.select_date = hcf.select_date), "
            f"ev AS (SELECT *, {split_bucket_sql('household_key')} AS bucket FROM ev0)")


def _split_case(bucket="bucket"):
    return f"CASE WHEN {bucket} < 70 THEN 'train' WHEN {bucket} < 85 THEN 'validate' ELSE 'test' END"


@register("split_assignment", lambda: f"WITH {_labels_sql_ctes()} SELECT household_key, purchased, "
          f"{split_bucket_sql('household_key')} AS bucket, {_split_case(split_bucket_sql('household_key'))} AS split FROM lab")
def q_split_assignment(spark, sf_dir):
    """M1: deterministic 70/15/15 split of the labelled households."""
    return assign_split(_labels(spark, sf_dir)).select("household_key", "purchased", "bucket", "split")


def _ranking_sql(metric: str) -> str:
    score = f'"{BASELINE_SCORE}"'
    g = (f"g AS (SELECT {score} AS score, count(*) FILTER (WHERE label = 1) AS pos, "
         f"count(*) FILTER (WHERE label <> 1) AS neg FROM ev GROUP BY {score}), "
         "c AS (SELECT score, pos, neg, "
         "sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp, "
         "sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp, "
         "sum(pos) OVER () AS p_total, sum(neg) OVER () AS n_total FROM g)")
    if metric == "ap":
        sel = ("round(sum(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) "
               "/ NULLIF(CAST(max(p_total) AS DOUBLE), 0), 12) AS average_precision")
    else:
        sel = ("CAST(sum(pos * (2 * (n_total - fp) + neg)) AS DOUBLE) "
               "/ NULLIF(CAST(2 * max(p_total) * max(n_total) AS DOUBLE), 0) AS roc_auc")
    return f"WITH {_evaluation_sql_ctes()}, {g} SELECT {sel} FROM c"


@register("metric_average_precision", lambda: _ranking_sql("ap"))
def q_metric_average_precision(spark, sf_dir):
    """M5: average precision of the baseline score against the labels."""
    ev = _evaluation_frame(spark, sf_dir)
    return average_precision(ev, "label", BASELINE_SCORE).select(F.round("average_precision", 12).alias("average_precision"))


@register("metric_roc_auc", lambda: _ranking_sql("auc"))
def q_metric_roc_auc(spark, sf_dir):
    """M6: ROC AUC (ties count half) of the baseline score."""
    ev = _evaluation_frame(spark, sf_dir)
    return roc_auc(ev, "label", BASELINE_SCORE)


@register("metric_confusion", lambda: (
    f"WITH {_evaluation_sql_ctes()}, k AS (SELECT "
    f"count(*) FILTER (WHERE label = 1 AND \"{BASELINE_SCORE}\" > 0) AS tp, "
    f"count(*) FILTER (WHERE label <> 1 AND \"{BASELINE_SCORE}\" > 0) AS fp, "
    f"count(*) FILTER (WHERE label <> 1 AND NOT (\"{BASELINE_SCORE}\" > 0)) AS tn, "
    f"count(*) FILTER (WHERE label = 1 AND NOT (\"{BASELINE_SCORE}\" > 0)) AS fn FROM ev) "
    "SELECT tp, fp, tn, fn, "
    "(COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(tp AS DOUBLE) + CAST(fn AS DOUBLE), 0), 0.0) + "
    "COALESCE(CAST(tn AS DOUBLE) / NULLIF(CAST(tn AS DOUBLE) + CAST(fp AS DOUBLE), 0), 0.0)) / 2.0 AS balanced_accuracy, "
    "CASE WHEN sqrt((CAST(tp AS DOUBLE) + CAST(fp AS DOUBLE)) * (CAST(tp AS DOUBLE) + CAST(fn AS DOUBLE)) * "
    "(CAST(tn AS DOUBLE) + CAST(fp AS DOUBLE)) * (CAST(tn AS DOUBLE) + CAST(fn AS DOUBLE))) = 0 THEN 0.0 ELSE "
    "(CAST(tp AS DOUBLE) * CAST(tn AS DOUBLE) - CAST(fp AS DOUBLE) * CAST(fn AS DOUBLE)) / "
    "sqrt((CAST(tp AS DOUBLE) + CAST(fp AS DOUBLE)) * (CAST(tp AS DOUBLE) + CAST(fn AS DOUBLE)) * "
    "(CAST(tn AS DOUBLE) + CAST(fp AS DOUBLE)) * (CAST(tn AS DOUBLE) + CAST(fn AS DOUBLE))) END AS matthews_corrcoef FROM k"))
def q_metric_confusion(spark, sf_dir):
    """M7: confusion counts, balanced accuracy and MCC of score > 0."""
    ev = _evaluation_frame(spark, sf_dir).withColumn(
        "prediction", (F.col(BASELINE_SCORE) > 0).cast("int"))
    return confusion_metrics(ev, "label", "prediction")


def _history(spark, sf_dir) -> DataFrame:
    """Test-split AUC of every candidate version, computed in one pass."""
    ev = _evaluation_frame(spark, sf_dir).filter(F.col("split") == "test")
    long = ev.select("label", F.explode(F.array(*[
        F.struct(F.lit(v).alias("version"), F.col(c).alias("score")) for v, c in CANDIDATES])).alias("s"))
    long = long.select("label", F.col("s.version").alias("version"), F.col("s.score").alias("score"))
    return (roc_auc(long, "label", "score", by=["version"])
            .select(F.lit(MODEL_NAME).alias("model_name"), "version", "roc_auc"))


def _history_sql() -> str:
    per = []
    for v, c in CANDIDATES:
        per.append(
            f"SELECT {v} AS version, CAST(sum(pos * (2 * (n_total - fp) + neg)) AS DOUBLE) "
            "/ NULLIF(CAST(2 * max(p_total) * max(n_total) AS DOUBLE), 0) AS roc_auc FROM ("
            "SELECT pos, neg, sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp, "
            "sum(pos) OVER () AS p_total, sum(neg) OVER () AS n_total FROM ("
            f"SELECT \"{c}\" AS score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg "
            f"FROM ev WHERE {_split_case()} = 'test' GROUP BY \"{c}\"))")
    return (f"{_evaluation_sql_ctes()}, hist AS (SELECT '{MODEL_NAME}' AS model_name, version, roc_auc FROM ("
            + " UNION ALL ".join(per) + "))")


#: Gate of the promotion queries: chance level, which the baselines' scores on these tables lie around.
QUERY_GATE = 0.5


def _promotion_sql() -> str:
    return (f"WITH {_history_sql()}, s AS (SELECT *, roc_auc >= {QUERY_GATE} AS passes, "
            f"max(CASE WHEN roc_auc >= {QUERY_GATE} THEN roc_auc END) OVER (PARTITION BY model_name ORDER BY version "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM hist), "
            "t AS (SELECT *, COALESCE(passes, false) AND (best_before IS NULL OR roc_auc >= best_before) AS champ FROM s), "
            "u AS (SELECT *, max(CASE WHEN champ THEN version END) OVER (PARTITION BY model_name) AS last_champion, "
            "max(CASE WHEN COALESCE(passes, false) THEN version END) OVER (PARTITION BY model_name) AS last_passing FROM t) "
            "SELECT model_name, version, roc_auc, CASE WHEN version = last_champion THEN 'Champion' "
            "WHEN version = last_passing AND NOT champ THEN 'Challenger' END AS alias FROM u")


@register("model_promotion", _promotion_sql)
def q_model_promotion(spark, sf_dir):
    """M8: champion/challenger aliases from the version history."""
    return promote(_history(spark, sf_dir), QUERY_GATE)


@register("latest_model_version", lambda: f"WITH {_history_sql()} SELECT model_name, "
          "greatest(max(version), 1) AS latest_version FROM hist GROUP BY model_name")
def q_latest_model_version(spark, sf_dir):
    """M9: latest version in the registry that the versions were registered in, one after the other."""
    return latest_version(R.history(_registered(spark, sf_dir), MODEL_NAME))


@register("champion_version", lambda: f"SELECT model_name, version, roc_auc FROM ({_promotion_sql()}) "
          "WHERE alias = 'Champion'")
def q_champion_version(spark, sf_dir):
    """The version that the alias log names as Champion."""
    store = _registered(spark, sf_dir)
    held = R.aliases(store, MODEL_NAME).filter(F.col("alias") == R.CHAMPION)
    return R.history(store, MODEL_NAME).join(held, ["model_name", "version"]).select("model_name", "version", "roc_auc")


def _registered(spark, sf_dir) -> FeatureStore:
    """A store in which the candidate scorers were registered as versions, by their measured AUC.

    All are measured on the same rows, so the Champion that a version meets has the best passing AUC before it.
    """
    store, versions, best = _fresh_store(spark), [], None
    for r in sorted(_history(spark, sf_dir).collect(), key=lambda r: r["version"]):
        versions.append((r["version"], r["roc_auc"], best))
        if r["roc_auc"] is not None and r["roc_auc"] >= max(QUERY_GATE, best or 0.0):
            best = r["roc_auc"]
    R.register(store, MODEL_NAME, versions, QUERY_GATE, QUERY_TIME)
    return store


# --------------------------------------------------------------------------
# model fit, tuning and batch scoring
#
# A model's scores are beyond SQL.  These queries return the rows that were
# scored, what they are stamped with, and whether score and class hold what
# they must, all of which DuckDB can state.
# --------------------------------------------------------------------------

#: The time that the scoring queries stamp their rows with.
QUERY_TIME = dt.datetime(2001, 8, 1, 6, tzinfo=dt.timezone.utc)


def _checked_scores(scored: DataFrame, *keys: str) -> DataFrame:
    """The key columns, and whether probability and class fit each other."""
    p, one = F.col("probability"), F.col("prediction") == 1
    return scored.select(
        *keys, F.coalesce(p.between(0, 1), F.lit(False)).alias("probability_valid"),
        F.coalesce(F.when(one, p >= 0.5).when(F.col("prediction") == 0, p <= 0.5), F.lit(False)).alias("prediction_consistent"))


_CHECKED_SQL = "TRUE AS probability_valid, TRUE AS prediction_consistent"

def _model_data(spark, sf_dir) -> DataFrame:
    """Training set with keys and split, checkpointed to the shared folder.

    Every boosting iteration and every tuning trial reads it again; the
    checkpoint cuts the feature-build lineage so they read stored rows.
    """
    fed = _period().features_end_day
    hf, cf, hcf = _feature_tables(spark, sf_dir, fed)
    ts = training_set(_labels(spark, sf_dir), hf, cf, hcf, keep_keys=True, select_date=fed, commodity_desc=LABEL_COMMODITY)
    return materialize(assign_split(ts), "training_set")


#: Boosting rounds of the fits in the checked queries.
QUERY_ROUNDS = M.MAX_ITER


#: Boosting rounds of the searched trials.
TUNING_ROUNDS = M.MAX_ITER


def _tuning_trials() -> int:
    """Candidates of the search in the running session; without one, the number that small clusters try."""
    spark = SparkSession.getActiveSession()
    return M.default_trials(spark) if spark is not None else M.MIN_TRIALS


def _search(data: DataFrame, feats: list[str]) -> M.TuningResult:
    """M4: the whole random search, fitted on train and scored on validate."""
    cands = M.sample_params(M.default_trials(data.sparkSession), class_balance(data).first()["pos_class_weight"], max_iter=TUNING_ROUNDS)
    train, validate = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "validate")
    return M.tune(train, validate, feats, cands)


def _best_params(data: DataFrame, feats: list[str]) -> M.Params:
    """The winner of the search, fitted with ``QUERY_ROUNDS``."""
    return replace(_search(data, feats).best, max_iter=QUERY_ROUNDS)


@register("train_model", lambda: f"WITH {_labels_sql_ctes()} SELECT household_key, purchased, {_CHECKED_SQL} "
          f"FROM lab WHERE {_split_case(split_bucket_sql('household_key'))} = 'test'")
def q_train_model(spark, sf_dir):
    """M3: GBT fit on the train split with the search's best parameters, test-split predictions."""
    data = _model_data(spark, sf_dir)
    feats = M.feature_names(data)
    model = M.fit(data.filter(F.col("split") == "train"), feats, _best_params(data, feats))
    return _checked_scores(M.predict(model, data.filter(F.col("split") == "test"), feats), "household_key", "purchased")


def _tuning_sql():
    split = _split_case(split_bucket_sql("household_key"))
    return (f"WITH {_labels_sql_ctes()} SELECT CAST(range AS INTEGER) AS trial, TRUE AS depth_valid, TRUE AS rate_valid, "
            "TRUE AS weight_valid, TRUE AS metrics_valid, "
            f"(SELECT count(*) FROM lab WHERE {split} = 'train') AS train_rows, "
            f"(SELECT count(*) FROM lab WHERE {split} = 'validate') AS validate_rows FROM range({_tuning_trials()})")


@register("tune_model", _tuning_sql)
def q_tune_model(spark, sf_dir):
    """M4: random search on train, scored by average precision on validate.

    One row per trial: whether its sampled parameters lie in the search space
    and its metrics in their ranges, and the rows it was fitted and scored on.
    """
    data = _model_data(spark, sf_dir)
    feats = M.feature_names(data)
    bal = class_balance(data).first()
    train, validate = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "validate")
    trials = M.trials_frame(spark, _search(data, feats))
    heaviest = 5 * max(1.0, bal["pos_class_weight"] or 1.0)
    in_unit = [F.col(c).isNull() | F.col(c).between(0, 1) for c in ("average_precision", "roc_auc", "balanced_accuracy")]
    return trials.select(
        "trial", F.col("max_depth").between(*M.MAX_DEPTH_RANGE).alias("depth_valid"),
        F.col("learning_rate").between(*M.LEARNING_RATE_RANGE).alias("rate_valid"),
        F.col("scale_pos_weight").between(M.SCALE_POS_WEIGHT_LOW, heaviest).alias("weight_valid"),
        reduce(lambda a, b: a & b, in_unit, F.col("matthews_corrcoef").isNull() | F.col("matthews_corrcoef").between(-1, 1)).alias("metrics_valid"),
        F.lit(train.count()).cast("long").alias("train_rows"), F.lit(validate.count()).cast("long").alias("validate_rows"))


def _champion_store(spark, sf_dir) -> FeatureStore:
    """Feature tables of the training and the scoring date, and a model that the training job searched, fitted and registered.

    The gate is open: on these tables, whose labels have no signal, the first
    version becomes the Champion whatever its AUC.
    """
    store = _fresh_store(spark)
    tx, products = _tx(spark, sf_dir), _products(spark, sf_dir, LABEL_COMMODITY_COLUMN)
    for day in (_period().features_end_day, LABEL_DATE):
        run_feature_job(tx, products, day, store)
    run_training_job(spark, tx, products, store, LABEL_DATE, LABEL_COMMODITY, MODEL_NAME, max_iter=TUNING_ROUNDS, gate=0.0)
    return store


def _checked_predictions(scored: DataFrame) -> DataFrame:
    return _checked_scores(scored.withColumn("inference_second", F.unix_timestamp("inference_timestamp")),
                           "household_key", "commodity_desc", "select_date", "model_version", "inference_second")


def _predictions_sql():
    return (f"WITH {O.base_ctes(LABEL_COMMODITY_COLUMN)} SELECT DISTINCT household_key, '{LABEL_COMMODITY}' AS commodity_desc, "
            f"DATE '{LABEL_DATE}' AS select_date, '1' AS model_version, "
            f"CAST({int(QUERY_TIME.timestamp())} AS BIGINT) AS inference_second, {_CHECKED_SQL} FROM txn")


@register("batch_score", _predictions_sql)
def q_batch_score(spark, sf_dir):
    """The registered Champion scores every household."""
    path = f"{checkpoint_root(spark).rstrip('/')}/predictions-{uuid.uuid4().hex}"
    return _checked_predictions(run_inference_job(spark, _tx(spark, sf_dir), _champion_store(spark, sf_dir), LABEL_DATE, LABEL_COMMODITY,
                                                  MODEL_NAME, path, QUERY_TIME))


# --------------------------------------------------------------------------
# feature store: read, key check, merge-upsert, predictions table
# --------------------------------------------------------------------------

UPSERT_DATES = ("2001-07-02", "2001-08-01")


def _fresh_store(spark) -> FeatureStore:
    return FeatureStore(spark, f"{checkpoint_root(spark).rstrip('/')}/query-store-{uuid.uuid4().hex}")


@register("feature_table_read", lambda: O.feature_table_sql("household", FEATURE_DATE, FEATURE_COMMODITY))
def q_feature_table_read(spark, sf_dir):
    """Household table created, merged and read back for one date."""
    store = _fresh_store(spark)
    run_feature_job(_tx(spark, sf_dir), _products(spark, sf_dir), FEATURE_DATE, store)
    return store.read_table(TABLE_NAMES["household"], FEATURE_DATE)


def _upserted_commodity_table(spark, sf_dir) -> tuple[FeatureStore, str]:
    """Write date A, then B, then A again: merge must replace, not duplicate.

    The facts meet their products once; what the commodity table reads of them
    is staged for all dates, and removed when the last date is written.
    """
    store = _fresh_store(spark)
    name = TABLE_NAMES["commodity"]
    used = list(dict.fromkeys([*GRAINS["commodity"], "day", "basket_id", "product_id", *MONEY, *DISCOUNTS]))
    path = stage_path(spark, "upsert_facts")
    try:
        facts = stage_facts(_tx(spark, sf_dir), _products(spark, sf_dir), used, path)
        with shuffles_removed(spark):
            for d in (UPSERT_DATES[0], UPSERT_DATES[1], UPSERT_DATES[0]):
                df = FT.commodity_features(FT.prepare(facts, None, d))
                store.create_table(name, ["commodity_desc", "select_date"], df.schema)
                store.write_table(name, df, mode="merge")
    finally:
        remove_path(spark, path)
    return store, name


def _upsert_union_sql() -> str:
    return " UNION ALL ".join(f"({O.feature_table_sql('commodity', d, FEATURE_COMMODITY)})" for d in UPSERT_DATES)


@register("feature_table_upsert", _upsert_union_sql)
def q_feature_table_upsert(spark, sf_dir):
    """The commodity table after merging two dates (one of them twice)."""
    store, name = _upserted_commodity_table(spark, sf_dir)
    return store.read_table(name)


@register("feature_table_key_check", lambda: (
    f"WITH u AS ({_upsert_union_sql()}), k AS (SELECT commodity_desc, select_date, count(*) AS n FROM u "
    "GROUP BY commodity_desc, select_date) SELECT CAST(sum(n) AS BIGINT) AS \"rows\", "
    "CAST(count(*) AS BIGINT) AS distinct_keys, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys FROM k"))
def q_feature_table_key_check(spark, sf_dir):
    """S3: primary-key uniqueness of the merged table."""
    store, name = _upserted_commodity_table(spark, sf_dir)
    return store.key_check(name)


@register("predictions_table", _predictions_sql)
def q_predictions_table(spark, sf_dir):
    """The Champion's stamped predictions overwrite a table of the catalog, which is read by name."""
    table = f"predictions_{uuid.uuid4().hex[:12]}"
    run_inference_job(spark, _tx(spark, sf_dir), _champion_store(spark, sf_dir), LABEL_DATE, LABEL_COMMODITY, MODEL_NAME, None, QUERY_TIME, table)
    return _checked_predictions(spark.table(table))


# --------------------------------------------------------------------------
# the pieces of get_features under their own keys
# --------------------------------------------------------------------------

RATIO_GROUPS = {
    "ratios_per_day": "days",
    "ratios_per_days_in_set": "days_in_window",
    "ratios_per_basket": "baskets",
    "ratios_per_product": "products",
    "ratios_per_line_item": "line_items",
    "ratios_to_amount_list": "amount_list",
}


def _household_30d(spark, sf_dir):
    return _q_get_features(spark, sf_dir, "household", "30d")


def _subset_sql(cols: list[str], where: str | None = None) -> str:
    inner = O.get_features_sql(["household_key"], "30d", FEATURE_DATE, FEATURE_COMMODITY)
    sel = ", ".join(f'"{c}"' for c in ["household_key"] + cols)
    return f"SELECT {sel} FROM ({inner})" + (f" WHERE {where}" if where else "")


_SUMMARY_COLS = [output_name(a, "30d") for a in AGGREGATES]
_SINCE_COLS = [output_name(n, "30d") for n, _ in DAYS_SINCE]


@register("summary_household_30d", lambda: _subset_sql(_SUMMARY_COLS, '"line_items_30d" IS NOT NULL'))
def q_summary_household_30d(spark, sf_dir):
    """The 26 aggregates for households with rows in the 30-day window."""
    return (_household_30d(spark, sf_dir).filter(F.col("line_items_30d").isNotNull())
            .select("household_key", *_SUMMARY_COLS))


@register("days_since_household_30d", lambda: _subset_sql(_SINCE_COLS))
def q_days_since_household_30d(spark, sf_dir):
    """The four days-since metrics (no lower date bound)."""
    return _household_30d(spark, sf_dir).select("household_key", *_SINCE_COLS)


def _ratio_cols(den: str) -> list[str]:
    return [output_name(n, "30d") for n, _, d in RATIOS if d == den]


for _key, _den in RATIO_GROUPS.items():
    register(_key, partial(lambda den: _subset_sql(_ratio_cols(den)), _den))(
        partial(lambda spark, sf_dir, den: _household_30d(spark, sf_dir).select("household_key", *_ratio_cols(den)),
                den=_den))


@register("project_keys", lambda: (
    f"WITH {O.base_ctes()} SELECT DISTINCT household_key, {O.norm_sql('commodity_desc')} AS commodity_desc "
    f"FROM txp WHERE \"day\" <= DATE '{FEATURE_DATE}'"))
def q_project_keys(spark, sf_dir):
    """The distinct grouping keys (anchor set) of the pair grain."""
    return _asof_normalized(spark, sf_dir).select("household_key", "commodity_desc").distinct()


# --------------------------------------------------------------------------
# file-arrival refresh (the daily rerun of the feature job, as a stream)
# --------------------------------------------------------------------------

@register("feature_refresh_stream", lambda: O.feature_table_sql("household", FEATURE_DATE, FEATURE_COMMODITY))
def q_feature_refresh_stream(spark, sf_dir):
    """The transactions arrive as files, in one batch; the stream absorbs them,
    builds the latest day's tables from the state and merges them; the household
    table is read back (the last day in the data is the feature date)."""
    from cartwise.streaming.refresh import start_feature_refresh

    root = f"{checkpoint_root(spark).rstrip('/')}/query-stream-{uuid.uuid4().hex}"
    tx = _tx(spark, sf_dir)
    tx.write.mode("overwrite").parquet(f"{root}/arrivals")
    store = FeatureStore(spark, f"{root}/store")
    q = start_feature_refresh(spark, f"{root}/arrivals", tx.schema, _products(spark, sf_dir), store,
                              checkpoint_location=f"{root}/stream-checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store.read_table(TABLE_NAMES["household"], FEATURE_DATE)


@register("lookup_coverage", lambda: (
    f"WITH {O.base_ctes(LABEL_COMMODITY_COLUMN)}, "
    f"hf AS ({O.feature_table_sql('household', LABEL_DATE, LABEL_COMMODITY_COLUMN)}), "
    f"cf AS ({O.feature_table_sql('commodity', LABEL_DATE, LABEL_COMMODITY_COLUMN)}), "
    f"hcf AS ({O.feature_table_sql('household_commodity', LABEL_DATE, LABEL_COMMODITY_COLUMN)}), "
    f"sp AS (SELECT DISTINCT household_key, '{LABEL_COMMODITY}' AS commodity_desc, DATE '{LABEL_DATE}' AS select_date FROM txn) "
    "SELECT count(*) AS \"rows\", count(hf.days_30d) AS household_hits, count(cf.days_30d) AS commodity_hits, "
    "count(hcf.days_30d) AS household_commodity_hits FROM sp "
    "LEFT JOIN hf ON sp.household_key = hf.household_key AND sp.select_date = hf.select_date "
    "LEFT JOIN cf ON sp.commodity_desc = cf.commodity_desc AND sp.select_date = cf.select_date "
    "LEFT JOIN hcf ON sp.household_key = hcf.household_key AND sp.commodity_desc = hcf.commodity_desc "
    "AND sp.select_date = hcf.select_date"))
def q_lookup_coverage(spark, sf_dir):
    """Scoring rows that found household, commodity and pair features."""
    return lookup_coverage(q_scoring_set(spark, sf_dir))
