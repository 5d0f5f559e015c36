import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.types import (  # noqa: E402
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from cartwise.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4, app="cartwise-tests")
    yield s
    s.stop()


# The original unit test's input, 21 nullable fields and two line items.
FIXTURE_SCHEMA = StructType([
    StructField("product_id", IntegerType(), True),
    StructField("household_key", IntegerType(), True),
    StructField("basket_id", LongType(), True),
    StructField("week_no", IntegerType(), True),
    StructField("day", DateType(), True),
    StructField("trans_time", IntegerType(), True),
    StructField("store_id", IntegerType(), True),
    StructField("amount_list", DoubleType(), True),
    StructField("campaign_coupon_discount", DoubleType(), True),
    StructField("manuf_coupon_discount", DoubleType(), True),
    StructField("manuf_coupon_match_discount", DoubleType(), True),
    StructField("total_coupon_discount", DoubleType(), True),
    StructField("instore_discount", DoubleType(), True),
    StructField("amount_paid", DoubleType(), True),
    StructField("units", IntegerType(), True),
    StructField("MANUFACTURER", IntegerType(), True),
    StructField("DEPARTMENT", StringType(), True),
    StructField("BRAND", StringType(), True),
    StructField("COMMODITY_DESC", StringType(), True),
    StructField("SUB_COMMODITY_DESC", StringType(), True),
    StructField("CURR_SIZE_OF_PRODUCT", StringType(), True),
])

FIXTURE_ROWS = [
    (1, 1, 1, 1, dt.date(2023, 1, 1), 1200, 1, 10.0, 0.5, 0.0, 0.5, 0.5, 0.5, 9.5, 1, 1,
     "DEPARTMENT_A", "BRAND_A", "Commodity_A", "Sub_Commodity_A", "Size_A"),
    (2, 2, 2, 2, dt.date(2023, 1, 2), 1300, 2, 15.0, 0.0, 1.0, 0.0, 1.0, 1.0, 14.0, 2, 2,
     "DEPARTMENT_B", "BRAND_B", "Commodity_B", "Sub_Commodity_B", "Size_B"),
]


@pytest.fixture
def transactional_data(spark):
    return spark.createDataFrame(FIXTURE_ROWS, FIXTURE_SCHEMA)


TX_SCHEMA = ("household_key long, product_id long, basket_id long, day date, amount_list double, "
             "instore_discount double, campaign_coupon_discount double, manuf_coupon_discount double, "
             "total_coupon_discount double, amount_paid double, commodity_desc string")
