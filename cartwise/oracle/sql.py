"""DuckDB oracle SQL for the deterministic operators.

It follows the original per-window recipe literally (anchor keys, a summary
aggregate with plain ``count(DISTINCT ...)``, a second days-since aggregate
with the min-of-CASE form, left joins, coalesce), so a bug in the
single-pass Spark plan shows up as a mismatch.  The catalogue's names, ratio
formulas and window offsets are shared (``functions.metrics``), so a mistake
in those would not; hand-worked values hold them.
"""

from __future__ import annotations

from cartwise.functions.metrics import (
    AGGREGATES, DAYS_IN_WINDOW, DAYS_SINCE, DISCOUNTS, MONEY, RATIOS, WINDOW_ORDER, WINDOWS, output_name,
)


def q(name: str) -> str:
    return '"' + name + '"'


def base_ctes(commodity_column: str = "p_name") -> str:
    """CTEs ``txn`` (line items as transactions), ``products``, ``txp``."""
    return f"""txn0 AS (
  SELECT l_partkey AS product_id, o_custkey AS household_key, l_orderkey AS basket_id,
         CAST(o_orderdate AS DATE) AS "day",
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_list,
         CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS instore_discount,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax ELSE 0 END AS DECIMAL(18,4)) AS campaign_coupon_discount,
         CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_tax ELSE 0 END AS DECIMAL(18,4)) AS manuf_coupon_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
txn AS (
  SELECT household_key, product_id, basket_id, "day", amount_list, instore_discount,
         campaign_coupon_discount, manuf_coupon_discount,
         campaign_coupon_discount + manuf_coupon_discount AS total_coupon_discount,
         amount_list - instore_discount - campaign_coupon_discount - manuf_coupon_discount AS amount_paid
  FROM txn0),
products AS (SELECT p_partkey AS product_id, {commodity_column} AS commodity_desc FROM part),
txp AS (SELECT t.*, p.commodity_desc FROM txn t JOIN products p USING (product_id))"""


def norm_sql(expr: str) -> str:
    """Commodity normalisation, the DuckDB way (global flag 'g')."""
    return f"replace(regexp_replace({expr}, '[-|/:;,.\"'']', '_', 'g'), ' ', '_')"


def _window_sql(src: str, keys: list[str], window: str, tag: str) -> str:
    """CTEs ``{tag}_w``, ``{tag}_s`` (summary) and ``{tag}_d`` (days-since)."""
    back_start, back_end = WINDOWS[window]
    k = ", ".join(q(x) for x in keys)
    aggs = [
        'count(DISTINCT "day") AS "days"',
        'count(DISTINCT basket_id) AS "baskets"',
        'count(product_id) AS "products"',
        'count(*) AS "line_items"',
    ]
    aggs += [f"CAST(sum({m}) AS DOUBLE) AS {q(m)}" for m in MONEY]
    for ent, col in (("days", '"day"'), ("baskets", "basket_id"), ("products", "product_id")):
        for d in DISCOUNTS:
            aggs.append(f"count(DISTINCT CASE WHEN {d} > 0 THEN {col} ELSE NULL END) AS {q(ent + '_with_' + d)}")
    for d in DISCOUNTS:
        aggs.append(f"sum(CASE WHEN {d} > 0 THEN 1 ELSE NULL END) AS {q('line_items_with_' + d)}")
    ds = []
    for name, d in DAYS_SINCE:
        ds.append(f"min(date_diff('day', CASE WHEN {d} > 0 THEN \"day\" ELSE w.wmin END, w.wmax)) AS {q(name)}")
    return f"""{tag}_w AS (
  SELECT CAST(max_day - {back_start} AS DATE) AS wmin, CAST(max_day - {back_end} AS DATE) AS wmax
  FROM (SELECT max("day") AS max_day FROM {src})),
{tag}_s AS (
  SELECT {k}, {", ".join(aggs)}
  FROM {src} CROSS JOIN {tag}_w w
  WHERE "day" BETWEEN w.wmin AND w.wmax
  GROUP BY {k}),
{tag}_d AS (
  SELECT {k}, {", ".join(ds)}
  FROM {src} CROSS JOIN {tag}_w w
  WHERE "day" <= w.wmax
  GROUP BY {k})"""


def _window_select(keys: list[str], window: str, tag: str, fill: bool) -> list[str]:
    """The 94 projected metric expressions of one window."""
    def wrap(e: str) -> str:
        return f"COALESCE({e}, 0.0)" if fill else e

    cols = []
    for a in AGGREGATES:
        cols.append(wrap(f"CAST({tag}_s.{q(a)} AS DOUBLE)") + " AS " + q(output_name(a, window)))
    den_days = f"CAST(date_diff('day', {tag}_w.wmin, {tag}_w.wmax) + 1 AS DOUBLE)"
    for name, num, den in RATIOS:
        n = f"CAST({tag}_s.{q(num)} AS DOUBLE)"
        dd = den_days if den == DAYS_IN_WINDOW else f"CAST({tag}_s.{q(den)} AS DOUBLE)"
        cols.append(wrap(f"({n} / NULLIF({dd}, 0))") + " AS " + q(output_name(name, window)))
    for name, _ in DAYS_SINCE:
        cols.append(wrap(f"CAST({tag}_d.{q(name)} AS DOUBLE)") + " AS " + q(output_name(name, window)))
    return cols


def _window_joins(anchor: str, keys: list[str], tag: str) -> str:
    on_s = " AND ".join(f"{anchor}.{q(x)} = {tag}_s.{q(x)}" for x in keys)
    on_d = " AND ".join(f"{anchor}.{q(x)} = {tag}_d.{q(x)}" for x in keys)
    return (f"LEFT JOIN {tag}_s ON {on_s}\nLEFT JOIN {tag}_d ON {on_d}\n"
            f"CROSS JOIN {tag}_w")


def get_features_sql(keys: list[str], window: str, select_date: str,
                     commodity_column: str = "p_name", normalize: bool = True) -> str:
    """Oracle for one ``get_features(transactions as of date, keys, window)``."""
    comm = norm_sql("commodity_desc") if normalize else "commodity_desc"
    src = f"""src AS (
  SELECT household_key, product_id, basket_id, "day", {", ".join(MONEY[:-1])}, amount_paid,
         {comm} AS commodity_desc
  FROM txp WHERE "day" <= DATE '{select_date}')"""
    k = ", ".join(q(x) for x in keys)
    tag = "w0"
    sel = [f"a.{q(x)}" for x in keys] + _window_select(keys, window, tag, fill=False)
    return f"""WITH {base_ctes(commodity_column)},
{src},
anchor AS (SELECT DISTINCT {k} FROM src),
{_window_sql("src", keys, window, tag)}
SELECT {", ".join(sel)}
FROM anchor a
{_window_joins("a", keys, tag)}"""


def feature_table_sql(grain: str, select_date: str, commodity_column: str = "p_name",
                      top_n: int = 10) -> str:
    """Oracle for the wide feature tables (G2-G4) of one select date."""
    keys = {"household": ["household_key"], "commodity": ["commodity_desc"],
            "household_commodity": ["household_key", "commodity_desc"]}[grain]
    src = f"""src AS (
  SELECT household_key, product_id, basket_id, "day", {", ".join(MONEY[:-1])}, amount_paid,
         {norm_sql("commodity_desc")} AS commodity_desc
  FROM txp WHERE "day" <= DATE '{select_date}')"""
    top = f"""top AS (
  SELECT {norm_sql("commodity_desc")} AS commodity_desc FROM (
    SELECT commodity_desc, count(DISTINCT basket_id) AS purchases FROM txp
    GROUP BY commodity_desc ORDER BY purchases DESC, commodity_desc ASC LIMIT {top_n}))"""
    spine = """spine AS (
  SELECT DISTINCT h.household_key, t.commodity_desc
  FROM (SELECT DISTINCT household_key FROM src) h CROSS JOIN top t)"""
    k = ", ".join(q(x) for x in keys)
    anchor = f"anchor AS (SELECT DISTINCT {k} FROM spine)"
    parts = [base_ctes(commodity_column), src, top, spine, anchor]
    sel = [f"a.{q(x)}" for x in keys] + [f"DATE '{select_date}' AS select_date"]
    joins = []
    for i, w in enumerate(WINDOW_ORDER):
        tag = f"w{i}"
        parts.append(_window_sql("src", keys, w, tag))
        sel += _window_select(keys, w, tag, fill=True)
        joins.append(_window_joins("a", keys, tag))
    return f"WITH {',\n'.join(parts)}\nSELECT {', '.join(sel)}\nFROM anchor a\n" + "\n".join(joins)
