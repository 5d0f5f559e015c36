"""Fact and dimension sources (operator S1).

The pipeline needs two relations:

``transactions``  one row per line item: household_key, product_id,
                  basket_id, day, amount_list, the four discounts, amount_paid
``products``      product_id -> commodity_desc

In production these are tables (``spark.table``).  The test data is a
TPC-H-like star schema, so ``load_transactions`` maps it: an order is a
basket, its customer the household, its order date the day, a part the
product.  Money is kept as fixed-point decimals so that sums are exact and
independent of summation order (the oracle does the same); every metric is
cast to double at the end, as the original pipeline does.

Only the columns the jobs read are projected, so Catalyst prunes the parquet
scans; date predicates written against ``day`` are pushed through the
projection to the ``o_orderdate`` scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import shuffles_removed
from cartwise.sources.files import Files

#: Bytes of input files (packed columns) that one partition of a spread frame stands for.
PIECE_BYTES = 8 << 20

#: Shares in which the joined facts of large input are staged, to bound the joins' shuffle files.
PASSES = 4

TABLES = ("lineitem", "orders", "part", "customer")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table of the given data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(df: DataFrame) -> int | None:
    """Partitions to deal the rows of ``df`` to, in proportion to its input files.

    None while that is no more than the cluster's cores: Spark's own number
    serves there, and AQE may join and merge as it sees fit.
    """
    n = math.ceil(Files(df.sparkSession).size(df.inputFiles()) / PIECE_BYTES)
    return n if n > df.sparkSession.sparkContext.defaultParallelism else None


def spread(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to ``n`` partitions, so that a task's share stays the same however large the input is."""
    return df if n is None else df.repartition(n, *keys)


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with household, basket, day and money columns.

    Inner join of line items to their order: both sides grow with the data,
    so the join is left to Catalyst/AQE (sort-merge on the order key, or a
    broadcast when AQE measures one side under the broadcast threshold).
    Beyond a few files both sides are dealt to partitions in proportion to the
    input, so that no task sorts or groups more as the tables grow.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    o = read_table(spark, sf_dir, "orders")
    price = F.col("l_extendedprice")
    tax = price * F.col("l_tax")
    n = pieces(li.join(o, li["l_orderkey"] == o["o_orderkey"]))
    li, o = spread(li, n, "l_orderkey"), spread(o, n, "o_orderkey")
    tx0 = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").select(
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("household_key"),
        F.col("l_orderkey").alias("basket_id"),
        F.to_date(F.col("o_orderdate")).alias("day"),
        price.cast("decimal(18,2)").alias("amount_list"),
        (price * F.col("l_discount")).cast("decimal(18,4)").alias("instore_discount"),
        F.when(F.col("l_returnflag") == "R", tax).otherwise(F.lit(0.0))
        .cast("decimal(18,4)").alias("campaign_coupon_discount"),
        F.when(F.col("l_returnflag") == "A", tax).otherwise(F.lit(0.0))
        .cast("decimal(18,4)").alias("manuf_coupon_discount"),
    )
    return tx0.select(
        "household_key", "product_id", "basket_id", "day",
        "amount_list", "instore_discount", "campaign_coupon_discount",
        "manuf_coupon_discount",
        (F.col("campaign_coupon_discount") + F.col("manuf_coupon_discount"))
        .alias("total_coupon_discount"),
        (F.col("amount_list") - F.col("instore_discount")
         - F.col("campaign_coupon_discount") - F.col("manuf_coupon_discount"))
        .alias("amount_paid"),
    )


def load_products(spark: SparkSession, sf_dir: str,
                  commodity_column: str = "p_name") -> DataFrame:
    """Product dimension: ``product_id`` and its ``commodity_desc``.

    ``commodity_column`` picks which part attribute plays the commodity:
    ``p_name`` (64 values, with spaces, exercises the name normalisation)
    or ``p_type`` (6 values, dense enough for purchase labels).
    """
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col(commodity_column).alias("commodity_desc"),
    )


def with_commodity(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Operator J1: attach ``commodity_desc`` by an inner join on product_id.

    The product dimension grows with the catalogue, so no broadcast hint:
    AQE broadcasts it when its measured size is under the threshold and
    falls back to a sort-merge join otherwise.  Both are dealt to partitions
    in proportion to the input first, if both are large (``pieces``).
    """
    large = Files(products.sparkSession).size(products.inputFiles()) > PIECE_BYTES
    n = pieces(transactions) if large else None
    return spread(transactions, n, "product_id").join(spread(products, n, "product_id"), "product_id", "inner")


def stage_facts(transactions: DataFrame, products: DataFrame, columns: list[str], path: str) -> DataFrame:
    """``columns`` of the joined facts as parquet at ``path``, large input in ``PASSES`` shares of its baskets.

    The joins move every line item twice.  A pass moves its share only, and its
    shuffle files go when it ends, so they never lie on disk all together; each
    pass scans the input again.
    """
    spark = transactions.sparkSession
    facts = with_commodity(transactions, products).select(*columns)
    passes = 1 if pieces(transactions) is None else PASSES
    with shuffles_removed(spark):
        for i in range(passes):
            share = transactions if passes == 1 else transactions.filter(F.pmod(F.xxhash64("basket_id"), F.lit(passes)) == i)
            with_commodity(share, products).select(*columns).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(facts.schema).parquet(path)


def transactions_asof(transactions: DataFrame, products: DataFrame,
                      select_date) -> DataFrame:
    """Operator G5 / P6: transactions with commodity, up to ``select_date``."""
    return with_commodity(transactions, products).filter(
        F.col("day") <= F.lit(select_date).cast("date"))
