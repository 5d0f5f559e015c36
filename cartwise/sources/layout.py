"""Physical layouts that let later reads skip days and joins skip exchanges.

* Facts by day: the joined transactions in one folder per day, so that a date
  range reads only its days' folders.
* Lookups by household: a date's feature tables as catalog tables that are
  bucketed and sorted by household.  The rows are shuffled once, when they are
  published; every training or scoring set then joins them, and the spine, where
  they lie.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.dates import as_date
from cartwise.functions.text import normalize_commodity_py
from cartwise.operators.labels import lookup_all
from cartwise.session import checkpoint_root, remove_path
from cartwise.sources.tables import with_commodity

HOUSEHOLD = "household_key"


def write_facts_by_day(transactions: DataFrame, products: DataFrame, path: str) -> None:
    """The transactions with their commodity below ``path``, one folder per day.

    Within a day rows are spread over a few tasks by household and sorted by
    it, so a day that holds very many rows is no single task's.
    """
    spark = transactions.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    facts = with_commodity(transactions, products)
    spread = facts.repartition(parts, "day", F.pmod(F.xxhash64(HOUSEHOLD), F.lit(max(1, parts // 64))))
    spread.sortWithinPartitions("day", HOUSEHOLD).write.mode("overwrite").partitionBy("day").parquet(path)


def read_facts_by_day(spark: SparkSession, path: str, schema) -> DataFrame:
    """The facts of ``write_facts_by_day``; predicates on ``day`` choose folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


@dataclass
class PublishedLookups:
    """Names of a date's and commodity's bucketed tables."""

    spine: str
    household: str
    commodity: str
    household_commodity: str
    select_date: str
    commodity_desc: str

    def looked_up(self, spark: SparkSession) -> DataFrame:
        """The spine with all three lookups; no row of it moves."""
        t = spark.table
        return lookup_all(t(self.spine), t(self.household), t(self.commodity), t(self.household_commodity), self.select_date, self.commodity_desc)

    def drop(self, spark: SparkSession) -> None:
        for name in (self.spine, self.household, self.commodity, self.household_commodity):
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
            spark.sql(f"DROP TABLE {name}")
            remove_path(spark, place)


def publish_lookups(spine: DataFrame, household: DataFrame, commodity: DataFrame, household_commodity: DataFrame, select_date,
                    commodity_desc: str, buckets: int | None = None, root: str | None = None) -> PublishedLookups:
    """Write a spine and what it looks up as tables bucketed by household, all with the same number of buckets.

    The commodity table holds at most top-n rows a date and is not bucketed.
    Each call makes tables of its own, so readers of earlier ones are not disturbed.
    """
    spark, day = spine.sparkSession, as_date(select_date)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    root = (root or checkpoint_root(spark).rstrip("/") + "/lookups").rstrip("/")
    tag = f"{day:%Y%m%d}_{uuid.uuid4().hex[:12]}"
    at = F.col("select_date") == F.lit(day)
    pairs = household_commodity.filter(at & (F.col("commodity_desc") == F.lit(normalize_commodity_py(commodity_desc))))
    names = {"spine": spine, "household": household.filter(at), "household_commodity": pairs}
    for name, df in names.items():
        # one task a bucket writes one file a bucket
        (df.repartition(buckets, HOUSEHOLD).write.format("parquet").bucketBy(buckets, HOUSEHOLD).sortBy(HOUSEHOLD)
         .option("path", f"{root}/{name}_{tag}").saveAsTable(f"{name}_{tag}"))
    commodity.filter(at).write.format("parquet").option("path", f"{root}/commodity_{tag}").saveAsTable(f"commodity_{tag}")
    return PublishedLookups(f"spine_{tag}", f"household_{tag}", f"commodity_{tag}", f"household_commodity_{tag}", day.isoformat(), commodity_desc)
