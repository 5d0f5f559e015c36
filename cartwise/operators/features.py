"""Feature metrics over look-back windows (operators G1-G4, A2-A8, A11, F3-F7).

The original pipeline computes each (grain, window) pair separately: an
eager min/max job, one aggregate with 14 ``count(distinct ...)`` expressions
(which Catalyst executes by expanding every row once per distinct
expression), a second full scan for the days-since metrics, two joins and
188 chained projections - twelve times per run.

Here one call computes every window of a grain with three aggregates:

``history``   one hash aggregate over the whole history up to the select
              date holding only the days-since components (latest day with
              each discount, whether any row lacks it) per window end; its
              groups are the anchor keys.

``additive``  one hash aggregate over in-window rows only: row counts,
              non-null counts, money sums and conditional counts per window
              (conditional aggregation, ``sum(CASE WHEN ...)``).  Map-side
              partial aggregation makes both insensitive to hot keys.

``distinct``  the 14 distinct counts per window through an *entity stack*:
              each in-window row is emitted once per entity kind (day,
              basket, product), aggregated by ``(keys, kind, value)`` keeping
              the latest day overall and per discount, then counted per key.
              The first level shuffles on ``(keys, kind, value)``, so even a
              key holding a third of all rows spreads over all reducers; the
              second level is partially aggregated before its shuffle.

All outputs are keyed by ``keys`` and hash partitioned by them, so within one
grain the final left joins reuse that partitioning.  Ratios are ``try_divide``
(NULL on a zero or NULL denominator), all metrics are cast to double and
named ``<metric>_<window>`` in one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import LookBack, check_windows, collect_max_day, resolve_windows
from cartwise.functions.metrics import (
    AGGREGATES, DAYS_IN_WINDOW, DAYS_SINCE, DISCOUNTS, MONEY, RATIOS, WINDOW_ORDER, output_name,
)
from cartwise.session import materialize

_KIND = {"days": 0, "baskets": 1, "products": 2}


def normalize_keys(grouping_keys) -> list[str]:
    """Decision D16: a single key given as a string becomes a one-item list."""
    if isinstance(grouping_keys, str):
        return [grouping_keys]
    keys = list(grouping_keys)
    if not keys:
        raise ValueError("grouping_keys must not be empty")
    return keys


def _tag(d) -> str:
    return d.strftime("%Y%m%d")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _d(d) -> str:
    return f"DATE'{d.isoformat()}'"


def _end_groups(wins: Sequence[LookBack]) -> dict:
    """window end -> earliest start among the windows ending there."""
    groups: dict = {}
    for w in wins:
        groups[w.end] = min(groups.get(w.end, w.start), w.start)
    return groups


# Expressions are generated as SQL text: one ``F.expr`` per aggregate and
# one ``selectExpr`` call for a whole projection keep plan construction to a
# few hundred JVM round trips instead of tens of thousands.

def in_any_window(wins: Sequence[LookBack]) -> str:
    """SQL predicate: the row lies in at least one window (pushed to the scan)."""
    return " OR ".join(f"(day BETWEEN {_d(lo)} AND {_d(end)})" for end, lo in _end_groups(wins).items())


def history_aggregate(tx: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """Days-since parts over the whole history up to each window end.

    The only metrics without a lower date bound.  Per distinct window end:
    whether any row exists, the latest day with each discount, and whether
    any row lacks it - nine cheap ``max`` aggregates, no sums.  Its groups
    are every key of ``tx`` (the anchor set).
    """
    aggs: list[str] = []
    for end in _end_groups(wins):
        upto = f"day <= {_d(end)}"
        t = _tag(end)
        aggs.append(f"max(CASE WHEN {upto} THEN 1 END) AS {_q('any__' + t)}")
        for d in DISCOUNTS:
            aggs.append(f"max(CASE WHEN {upto} AND {_q(d)} > 0 THEN day END) AS {_q('last_' + d + '__' + t)}")
            aggs.append(f"max(CASE WHEN {upto} AND NOT coalesce({_q(d)} > 0, false) THEN 1 END) "
                        f"AS {_q('rest_' + d + '__' + t)}")
    return tx.select(*keys, "day", *DISCOUNTS).groupBy(*keys).agg(*[F.expr(a) for a in aggs])


def additive_aggregate(tx: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """Row counts, non-null counts, sums and conditional counts per window.

    Reads only rows inside some window (the predicate reaches the scan).
    """
    aggs: list[str] = []
    for w in wins:
        inw = f"day BETWEEN {_d(w.start)} AND {_d(w.end)}"
        aggs.append(f"count(CASE WHEN {inw} THEN 1 END) AS {_q('line_items__' + w.name)}")
        aggs.append(f"count(CASE WHEN {inw} THEN product_id END) AS {_q('products__' + w.name)}")
        for m in MONEY:
            aggs.append(f"sum(CASE WHEN {inw} THEN {_q(m)} END) AS {_q(m + '__' + w.name)}")
        for d in DISCOUNTS:
            aggs.append(f"sum(CASE WHEN {inw} AND {_q(d)} > 0 THEN 1 END) "
                        f"AS {_q('line_items_with_' + d + '__' + w.name)}")
    return tx.filter(F.expr(in_any_window(wins))).groupBy(*keys).agg(*[F.expr(a) for a in aggs])


def stack_entities(tx: DataFrame, keys: list[str]) -> DataFrame:
    """Each row once per entity kind: (keys, day, pos_0.. per discount, kind, value)."""
    stack = (f"stack(3, {_KIND['days']}, CAST(unix_date(day) AS BIGINT), "
             f"{_KIND['baskets']}, CAST(basket_id AS BIGINT), "
             f"{_KIND['products']}, CAST(product_id AS BIGINT)) AS (kind, value)")
    return (tx.selectExpr(*[_q(k) for k in keys], "day", *[f"{_q(d)} > 0 AS pos_{i}" for i, d in enumerate(DISCOUNTS)], stack)
            .filter(F.col("value").isNotNull()))


def latest_days(stacked: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """First level of the entity stack: per (keys, kind, value) and window end
    the latest in-window day, overall and with each discount."""
    level1 = []
    for end, lo in _end_groups(wins).items():
        t = _tag(end)
        inr = f"day BETWEEN {_d(lo)} AND {_d(end)}"
        level1.append(f"max(CASE WHEN {inr} THEN day END) AS {_q('last__' + t)}")
        for i, _ in enumerate(DISCOUNTS):
            level1.append(f"max(CASE WHEN {inr} AND pos_{i} THEN day END) AS {_q(f'last_{i}__{t}')}")
    return stacked.groupBy(*keys, "kind", "value").agg(*[F.expr(a) for a in level1])


def entity_counts(per_entity: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """Second level: the 14 distinct counts per window from ``latest_days`` rows."""
    level2 = []
    for w in wins:
        t = _tag(w.end)
        start = _d(w.start)
        for entity in ("days", "baskets"):
            level2.append(f"count(CASE WHEN kind = {_KIND[entity]} AND {_q('last__' + t)} >= {start} THEN 1 END) "
                          f"AS {_q(entity + '__' + w.name)}")
        for entity in ("days", "baskets", "products"):
            for i, d in enumerate(DISCOUNTS):
                level2.append(f"count(CASE WHEN kind = {_KIND[entity]} AND {_q(f'last_{i}__{t}')} >= {start} "
                              f"THEN 1 END) AS {_q(entity + '_with_' + d + '__' + w.name)}")
    return per_entity.groupBy(*keys).agg(*[F.expr(a) for a in level2])


def distinct_aggregate(tx: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """The 14 distinct counts per window via the two-level entity stack."""
    stacked = stack_entities(tx.filter(F.expr(in_any_window(wins))), keys)
    return entity_counts(latest_days(stacked, keys, wins), keys, wins)


def _window_exprs(w: LookBack, keys_ok: str) -> list[str]:
    """The 94 metric expressions of one window, from the joined aggregates."""
    has = f"({keys_ok}) AND {_q('line_items__' + w.name)} > 0"
    m: dict[str, str] = {a: f"CAST(CASE WHEN {has} THEN {_q(a + '__' + w.name)} END AS DOUBLE)"
                         for a in AGGREGATES}
    m[DAYS_IN_WINDOW] = f"CAST({w.days_in_window} AS DOUBLE)"
    out = [f"{m[a]} AS {_q(output_name(a, w.name))}" for a in AGGREGATES]
    for name, num, den in RATIOS:
        out.append(f"try_divide({m[num]}, {m[den]}) AS {_q(output_name(name, w.name))}")
    t = _tag(w.end)
    span = (w.end - w.start).days
    for name, d in DAYS_SINCE:
        since = (f"least(datediff({_d(w.end)}, {_q('last_' + d + '__' + t)}), "
                 f"CASE WHEN {_q('rest_' + d + '__' + t)} = 1 THEN {span} END)")
        out.append(f"CAST(CASE WHEN ({keys_ok}) AND {_q('any__' + t)} IS NOT NULL THEN {since} END AS DOUBLE) "
                   f"AS {_q(output_name(name, w.name))}")
    return out


def join_aggregates(hist: DataFrame, additive: DataFrame, distinct: DataFrame, keys: list[str]) -> DataFrame:
    """History, window and distinct aggregates side by side, one row per key.

    The history aggregate holds every key (the anchor set); the other two
    only keys with in-window rows, so they are left-joined on the keys.
    """
    return hist.join(additive, keys, "left").join(distinct, keys, "left")


def _parts(df: DataFrame) -> list[str]:
    return [x for x in df.columns if "__" in x]


def roll_up(hist: DataFrame, subset: list[str]) -> DataFrame:
    """A history aggregate, or ``latest_days`` rows, at fewer keys: every component is a maximum."""
    return hist.groupBy(*subset).agg(*[F.max(_q(x)).alias(x) for x in _parts(hist)])


def roll_up_sums(additive: DataFrame, subset: list[str]) -> DataFrame:
    """An additive aggregate at fewer keys: every component is a count or a sum."""
    return additive.groupBy(*subset).agg(*[F.sum(_q(x)).alias(x) for x in _parts(additive)])


def project_features(joined: DataFrame, keys: list[str], wins: Sequence[LookBack]) -> DataFrame:
    """Keys plus 94 metrics per window from ``join_aggregates`` rows."""
    keys_ok = " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)
    exprs = [_q(k) for k in keys]
    for w in wins:
        exprs.extend(_window_exprs(w, keys_ok))
    return joined.selectExpr(*exprs)


def window_features(tx: DataFrame, grouping_keys, wins: Sequence[LookBack]) -> DataFrame:
    """Keys plus 94 metrics per window for every key present in ``tx``.

    Metrics are NULL exactly where the original per-window function leaves
    them NULL: no in-window row for the summary metrics, no row up to the
    window end for days-since, and any NULL key (it never matches the
    original's equi-join, decision D14).
    """
    keys = normalize_keys(grouping_keys)
    wins = list(wins)
    parts = history_aggregate(tx, keys, wins), additive_aggregate(tx, keys, wins), distinct_aggregate(tx, keys, wins)
    return project_features(join_aggregates(*parts, keys), keys, wins)


def get_features(df: DataFrame, grouping_keys, window: str | Sequence[str] = None,
                 max_day=None) -> DataFrame:
    """Operator G1: ``get_features(df, grouping_keys, window)``.

    ``window`` is one of '30d', '60d', '90d', '1yr' or a list of them (all
    returned side by side).  Windows are anchored on the latest ``day`` in
    ``df``; pass ``max_day`` to skip the one-row job that finds it.
    Returns one row per distinct key of ``df``.

    Without ``max_day`` the columns in use are staged as parquet below the
    shared checkpoint folder, which that job and the three aggregates read, so
    the plan behind ``df`` (the joins of the facts) runs once and not four times.
    """
    if window is None:
        raise ValueError("window is required: one of " + ", ".join(WINDOW_ORDER))
    windows = check_windows(window)
    keys = normalize_keys(grouping_keys)
    if max_day is None:
        used = dict.fromkeys([*keys, "day", "basket_id", "product_id", *MONEY, *DISCOUNTS])
        df = materialize(df.select(*used), "get_features")
        max_day = collect_max_day(df)
    if max_day is None:  # empty input: empty frame with the full schema
        max_day = "1970-01-01"
    return window_features(df, keys, resolve_windows(max_day, windows))
