import datetime as dt

from pyspark.sql import functions as F

from cartwise.functions.dates import label_period
from cartwise.operators.labels import class_balance, labels, positive_labels, scoring_spine

TX = "household_key long, product_id long, day date"
PR = "product_id long, commodity_desc string"


def test_labels_single_aggregate_equals_join_recipe(spark):
    p = label_period("2001-08-01")
    tx = spark.createDataFrame([
        (1, 10, dt.date(2001, 7, 10)),   # buys target in period
        (2, 11, dt.date(2001, 7, 10)),   # other commodity
        (3, 10, dt.date(2001, 6, 1)),    # target before the period
        (4, 99, dt.date(2001, 7, 10)),   # product missing from the dimension
        (None, 10, dt.date(2001, 7, 10)),  # NULL household never matches
        (1, 12, dt.date(2001, 7, 20)),
    ], TX)
    pr = spark.createDataFrame([(10, "EGGS"), (11, "MILK"), (12, "EGGS")], PR)
    got = {r["household_key"]: r["purchased"] for r in labels(tx, pr, p, "EGGS").collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, None: 0}
    # same answer as positives left-joined to all households
    pos = positive_labels(tx, pr, p, "EGGS")
    hh = tx.select("household_key").distinct()
    ref = {r["household_key"]: r["purchased"] for r in
           hh.join(pos, "household_key", "left").select("household_key", F.coalesce("purchased", F.lit(0)).alias("purchased")).collect()}
    assert got == ref
    row = labels(tx, pr, p, "EGGS").first()
    assert row["select_date"] == dt.date(2001, 7, 2) and row["commodity_desc"] == "EGGS"
    cb = class_balance(labels(tx, pr, p, "EGGS")).first()
    assert (cb["total"], cb["positives"], cb["pos_class_weight"]) == (5, 1, 5.0)


def test_commodity_parameter_is_normalised(spark):
    p = label_period("2001-08-01")
    tx = spark.createDataFrame([(1, 10, dt.date(2001, 7, 10))], TX)
    pr = spark.createDataFrame([(10, "red bolt")], PR)
    r = labels(tx, pr, p, "red bolt").first()
    assert (r["purchased"], r["commodity_desc"]) == (1, "red_bolt")


def test_scoring_spine(spark):
    tx = spark.createDataFrame([(1, 10, dt.date(2001, 7, 10)), (1, 11, dt.date(2001, 7, 11)),
                                (2, 10, dt.date(2001, 7, 10))], TX)
    rows = scoring_spine(tx, "EGGS", "2001-08-01").orderBy("household_key").collect()
    assert [(r["household_key"], r["commodity_desc"], r["select_date"]) for r in rows] == [
        (1, "EGGS", dt.date(2001, 8, 1)), (2, "EGGS", dt.date(2001, 8, 1))]


def test_class_balance_no_positive(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "household_key long, purchased int")
    assert class_balance(df).first()["pos_class_weight"] is None
