"""Commodity ranking and the entity spine (operators T1, A9, A10, J4, G6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.text import normalize_commodity
from cartwise.sources.tables import pieces, spread

TOP_N = 10


def commodity_purchases(tx_with_commodity: DataFrame) -> DataFrame:
    """Operator A10: distinct baskets per (raw) commodity.

    A single ``count_distinct`` is planned as a two-level aggregate: the
    first level groups by (commodity, basket), so one very popular commodity
    is spread over all reducers by its basket ids.  Large input is dealt by
    basket to partitions in proportion to it before it is grouped, so no task
    holds more pairs as it grows.
    """
    return (_by_basket(tx_with_commodity.select("commodity_desc", "basket_id")).groupBy("commodity_desc")
            .agg(F.count_distinct("basket_id").alias("purchases")))


def _by_basket(rows: DataFrame) -> DataFrame:
    return spread(rows, pieces(rows), "basket_id")


def top_commodities(tx_with_commodity: DataFrame, n: int = TOP_N) -> DataFrame:
    """Operator T1: the ``n`` commodities with most baskets, normalised.

    Ranked over all transactions regardless of the select date (D6); ties
    broken by name (D5).  ``orderBy().limit()`` plans as
    TakeOrderedAndProject: each partition keeps its own top n, so at most
    n x partitions rows reach the final task.
    """
    return (commodity_purchases(tx_with_commodity)
            .orderBy(F.col("purchases").desc(), F.col("commodity_desc").asc())
            .limit(n)
            .select(normalize_commodity("commodity_desc").alias("commodity_desc"),
                    "purchases"))


def collect_top_commodities(tx_with_commodity: DataFrame, n: int = TOP_N) -> list[str]:
    """The ranked, normalised top-``n`` names on the driver (at most n rows)."""
    rows = top_commodities(tx_with_commodity, n).collect()
    out: list[str] = []
    for r in rows:  # keep rank order, drop names that normalise alike
        if r["commodity_desc"] not in out:
            out.append(r["commodity_desc"])
    return out


def top_commodities_and_max_day(tx_with_commodity: DataFrame, select_date, n: int = TOP_N):
    """The top-``n`` list and the latest day up to ``select_date``, one job.

    Both come from one per-commodity aggregate (distinct baskets, latest
    day up to the date).  The top-n branch and the max branch share that
    aggregate's shuffle (exchange reuse), so the transactions are scanned
    once; the driver receives n + 1 rows.
    """
    per = (_by_basket(tx_with_commodity.select("commodity_desc", "basket_id", "day")).groupBy("commodity_desc")
           .agg(F.count_distinct("basket_id").alias("purchases"),
                F.max(F.when(F.col("day") <= F.lit(select_date), F.col("day"))).alias("last_day")))
    top = (per.orderBy(F.col("purchases").desc(), F.col("commodity_desc").asc()).limit(n)
           .select(F.lit(0).alias("part"), normalize_commodity("commodity_desc").alias("commodity_desc"),
                   F.col("commodity_desc").alias("raw"), F.col("purchases"),
                   F.lit(None).cast("date").alias("last_day")))
    latest = per.agg(F.max("last_day").alias("last_day")).select(
        F.lit(1).alias("part"), F.lit(None).cast("string").alias("commodity_desc"),
        F.lit(None).cast("string").alias("raw"), F.lit(None).cast("long").alias("purchases"), "last_day")
    rows = top.unionByName(latest).collect()
    ranked = sorted((r for r in rows if r["part"] == 0), key=lambda r: (-r["purchases"], r["raw"] is not None, r["raw"] or ""))
    names: list[str] = []
    for r in ranked:
        if r["commodity_desc"] not in names:
            names.append(r["commodity_desc"])
    max_day = next((r["last_day"] for r in rows if r["part"] == 1), None)
    return names, max_day


def distinct_households(tx: DataFrame) -> DataFrame:
    """Operator A9: every household with at least one transaction."""
    return tx.select("household_key").distinct()


def household_commodity_spine(households: DataFrame, commodities: list[str]) -> DataFrame:
    """Operator J4/G6: every household paired with every top commodity.

    The commodity list is bounded (top n, at most n names), so the pairing
    is a narrow ``explode`` of a literal array on each household row: no
    join, no shuffle, output exactly households x n.
    """
    arr = F.array(*[F.lit(c) for c in commodities]) if commodities else F.array().cast("array<string>")
    return households.select("household_key", F.explode(arr).alias("commodity_desc"))
