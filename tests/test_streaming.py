import datetime as dt
import tempfile

from pyspark.sql import functions as F

from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions
from cartwise.streaming.refresh import start_feature_refresh

from .conftest import SF001


def test_refresh_runs_feature_job_per_arrival(spark):
    tx = load_transactions(spark, SF001)
    pr = load_products(spark, SF001, "p_type")
    src = tempfile.mkdtemp(prefix="cartwise-arrivals-")
    store = FeatureStore(spark, tempfile.mkdtemp(prefix="cartwise-stream-store-"))
    ckpt = tempfile.mkdtemp(prefix="cartwise-stream-ckpt-")
    cut = dt.date(2001, 7, 2)
    # first arrival: history up to the cut
    first = tx.filter(F.col("day") <= F.lit(cut))
    first_latest = first.agg(F.max("day")).first()[0]
    first.write.mode("append").parquet(src)
    q = start_feature_refresh(spark, src, tx.schema, pr, store, ckpt)
    q.awaitTermination(300)
    dates = sorted(r[0] for r in store.read_table("household_features").select("select_date").distinct().collect())
    assert dates == [first_latest]
    # second arrival: the remaining days
    tx.filter(F.col("day") > F.lit(cut)).write.mode("append").parquet(src)
    q = start_feature_refresh(spark, src, tx.schema, pr, store, ckpt)
    q.awaitTermination(300)
    dates = sorted(r[0] for r in store.read_table("household_features").select("select_date").distinct().collect())
    # each arrived day after the first load has its tables
    new = [r[0] for r in tx.select("day").filter(F.col("day") > F.lit(cut)).distinct().collect()]
    assert dates == sorted([first_latest, *new]) and dates[-1] == dt.date(2001, 8, 1)
    assert store.key_check("household_commodity_features").first()["duplicate_keys"] == 0
