"""Wide, dated feature tables for the three grains (operators G2-G4, P9).

Each table holds the grain's keys, ``select_date`` and 376 metric columns
(94 metrics x 4 windows), missing values filled with 0.0.  All four windows
come out of one set of three aggregates per grain, so there is no chain of four
left joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import as_date, resolve_windows
from cartwise.functions.metrics import DISCOUNTS, MONEY, WINDOW_ORDER, feature_columns
from cartwise.functions.text import normalize_commodity
from cartwise.operators.features import (
    additive_aggregate, entity_counts, history_aggregate, in_any_window, join_aggregates, latest_days, project_features,
    roll_up, roll_up_sums, stack_entities, window_features,
)
from cartwise.operators.spine import (
    TOP_N, distinct_households, household_commodity_spine, top_commodities_and_max_day,
)
from cartwise.session import materialize, stage_path
from cartwise.sources.tables import with_commodity

GRAIN_KEYS = {
    "household": ["household_key"],
    "commodity": ["commodity_desc"],
    "household_commodity": ["household_key", "commodity_desc"],
}


@dataclass
class FeatureInputs:
    """Everything the three grains share for one select date.

    ``max_day`` (latest day up to the select date) and the top commodity
    list are the only driver-side values; each is a one-row / n-row result
    fetched once per run rather than once per (grain, window).
    """

    tx_asof: DataFrame          # transactions with normalised commodity, day <= select_date
    select_date: object
    max_day: object
    top: list
    window_names: tuple = WINDOW_ORDER

    @property
    def windows(self):
        return resolve_windows(self.max_day, self.window_names) if self.max_day else []


def prepare(transactions: DataFrame, products: DataFrame | None, select_date, top_n: int = TOP_N,
            windows=WINDOW_ORDER, stage: str | None = None, staged: bool = True) -> FeatureInputs:
    """Build the shared inputs (decision D4: both sides normalised).

    The transactions meet their products once: the joined facts are parquet
    below the shared checkpoint folder (``stage``), which the ranking and every
    aggregate read.  ``staged=False`` leaves them a plan, for callers that need
    few of their columns.  Without ``products`` the transactions carry their
    commodity already (``sources.layout``).  The tables hold the metrics of ``windows``, by
    default of all four.
    """
    select_date = as_date(select_date)
    tx_all = transactions if products is None else with_commodity(transactions, products)
    if products is not None and staged:
        tx_all = materialize(tx_all, path=(stage or stage_path(tx_all.sparkSession, "feature_inputs")) + "/facts")
    top, max_day = top_commodities_and_max_day(tx_all, select_date, top_n)
    tx_asof = (tx_all.filter(F.col("day") <= F.lit(select_date))
               .withColumn("commodity_desc", normalize_commodity("commodity_desc")))
    return FeatureInputs(tx_asof, select_date, max_day, top, tuple(windows))


def _finish(df: DataFrame, keys: list[str], select_date, windows=WINDOW_ORDER) -> DataFrame:
    """Add the select date, order columns, fill missing metrics with 0.0.

    Same rule as ``fillna(0.0)`` on double columns (NULL and NaN become 0),
    written as one projection.
    """
    exprs = [f"`{k}`" for k in keys] + [f"DATE'{as_date(select_date).isoformat()}' AS select_date"]
    exprs += [f"coalesce(nanvl(`{c}`, 0.0D), 0.0D) AS `{c}`" for c in feature_columns(windows)]
    return df.selectExpr(*exprs)


def _empty_metrics(df: DataFrame, keys: list[str], windows=WINDOW_ORDER) -> DataFrame:
    return df.selectExpr(*[f"`{k}`" for k in keys], *[f"CAST(NULL AS DOUBLE) AS `{c}`" for c in feature_columns(windows)])


def household_features(inp: FeatureInputs) -> DataFrame:
    """Operator G2: every household with a transaction up to the date.

    The spine's households are exactly the keys the aggregates already see,
    so the aggregate output *is* the table; no spine join is needed.
    """
    keys = GRAIN_KEYS["household"]
    if not inp.max_day or not inp.top:
        return _finish(_empty_metrics(inp.tx_asof.limit(0), keys, inp.window_names), keys, inp.select_date, inp.window_names)
    wf = window_features(inp.tx_asof, keys, inp.windows)
    return _finish(wf, keys, inp.select_date, inp.window_names)


def commodity_features(inp: FeatureInputs) -> DataFrame:
    """Operator G3: the top commodities (at most n rows)."""
    keys = GRAIN_KEYS["commodity"]
    spark = inp.tx_asof.sparkSession
    spine = spark.createDataFrame([(c,) for c in inp.top], "commodity_desc string")
    if not inp.max_day or not inp.top:
        return _finish(_empty_metrics(spine, keys, inp.window_names), keys, inp.select_date, inp.window_names)
    tx = inp.tx_asof.filter(F.col("commodity_desc").isin(inp.top))
    wf = window_features(tx, keys, inp.windows)
    # both sides hold at most n rows (n = top list length)
    return _finish(F.broadcast(spine).join(wf, keys, "left"), keys, inp.select_date, inp.window_names)


def household_commodity_features(inp: FeatureInputs) -> DataFrame:
    """Operator G4: every household x top commodity pair."""
    keys = GRAIN_KEYS["household_commodity"]
    spine = household_commodity_spine(distinct_households(inp.tx_asof), inp.top)
    if not inp.max_day or not inp.top:
        return _finish(_empty_metrics(spine, keys, inp.window_names), keys, inp.select_date, inp.window_names)
    tx = inp.tx_asof.filter(F.col("commodity_desc").isin(inp.top))
    wf = window_features(tx, keys, inp.windows)
    return _finish(spine.join(wf, keys, "left"), keys, inp.select_date, inp.window_names)


PAIR = ["household_key", "commodity_desc"]


def all_feature_tables(inp: FeatureInputs, stage: str | None = None) -> dict[str, DataFrame]:
    """G2-G4 together, from two passes over the joined facts.

    Everything is aggregated once, at (household, commodity): the history
    parts over all rows, and from the rows inside any window, which are written
    once, narrow, the additive sums and the entity level of the distinct
    counts (the one ``stack`` of the build).  Maxima, sums and the entity level
    roll up to either key alone (``assemble``).

    The parts are parquet below the shared checkpoint folder (``stage``), which
    cuts the lineage.  Commodities outside the top list are blanked first, so
    their rows only feed the household grain; the commodity grains leave them
    out before they aggregate.  Each table is joined on its plain keys.
    """
    if not inp.max_day or not inp.top:
        return {g: build(inp) for g, build in BUILDERS.items()}
    wins = inp.windows
    stage = stage or stage_path(inp.tx_asof.sparkSession, "feature_aggregates")
    tx = inp.tx_asof.withColumn("commodity_desc", F.when(F.col("commodity_desc").isin(inp.top), F.col("commodity_desc")))
    hist = materialize(history_aggregate(tx, PAIR, wins), path=stage + "/history")
    used = list(dict.fromkeys([*PAIR, "day", "basket_id", "product_id", *MONEY, *DISCOUNTS]))
    in_window = materialize(tx.filter(F.expr(in_any_window(wins))).select(*used), path=stage + "/window")
    additive = materialize(additive_aggregate(in_window, PAIR, wins), path=stage + "/additive")
    entities = materialize(latest_days(stack_entities(in_window, PAIR), PAIR, wins), path=stage + "/entities")
    return assemble(inp, hist, additive, entities)


def assemble(inp: FeatureInputs, hist: DataFrame, additive: DataFrame, entities: DataFrame) -> dict[str, DataFrame]:
    """The three tables from (household, commodity) parts, whose commodity is null outside the top list.

    The coarser grains take the pair parts' maxima and sums.  An entity is
    counted once per grain, so ``entities`` rolls up before it is counted.
    """
    h, c = PAIR
    spark, wins = hist.sparkSession, inp.windows

    def grain(keys, spine=None):
        parts = [hist, additive, entities]
        if c in keys:
            parts = [p.filter(F.col(c).isNotNull()) for p in parts]
        old, sums, seen = parts
        if keys != PAIR:
            old, sums, seen = roll_up(old, keys), roll_up_sums(sums, keys), roll_up(seen, [*keys, "kind", "value"])
        joined = join_aggregates(old, sums, entity_counts(seen, keys, wins), keys)
        # the spine meets the narrow parts, so one projection makes the wide rows
        joined = joined if spine is None else spine.join(joined, keys, "left")
        return _finish(project_features(joined, keys, wins), keys, inp.select_date, inp.window_names)

    cm_spine = spark.createDataFrame([(x,) for x in inp.top], "commodity_desc string")
    hc_spine = household_commodity_spine(hist.select(h).distinct(), inp.top)
    return {"household": grain([h]), "commodity": grain([c], F.broadcast(cm_spine)), "household_commodity": grain(PAIR, hc_spine)}


BUILDERS = {
    "household": household_features,
    "commodity": commodity_features,
    "household_commodity": household_commodity_features,
}
