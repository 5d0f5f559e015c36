"""End to end: feature job, training job, inference job on sf0.001."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwise.functions.dates import label_period
from cartwise.functions.metrics import feature_columns
from cartwise.plans.feature_job import TABLE_NAMES, run_feature_job
from cartwise.plans.inference_job import champion, run_inference_job
from cartwise.operators import registry as R
from cartwise.plans.training_job import run_training_job
from cartwise.sources.store import FeatureStore
from cartwise.sources.tables import load_products, load_transactions

from .conftest import SF001

SELECT = "2001-08-01"


@pytest.fixture(scope="module")
def setup(spark):
    tx = load_transactions(spark, SF001)
    pr = load_products(spark, SF001, "p_type")
    store = FeatureStore(spark, tempfile.mkdtemp(prefix="cartwise-jobs-"))
    fed = label_period(SELECT).features_end_day
    for d in (fed, SELECT):
        run_feature_job(tx, pr, d, store)
    return tx, pr, store


def test_feature_job_tables(spark, setup):
    tx, pr, store = setup
    for name, keys in (("household_features", 1), ("commodity_features", 1), ("household_commodity_features", 2)):
        df = store.read_table(name)
        assert df.columns[keys + 1:] == feature_columns()
        assert sorted(r[0] for r in df.select("select_date").distinct().collect()) == [
            dt.date(2001, 7, 2), dt.date(2001, 8, 1)]
        kc = store.key_check(name).first()
        assert kc["duplicate_keys"] == 0
        # every metric filled
        assert df.filter(F.col("amount_paid_30d").isNull()).count() == 0
    assert store.read_table(TABLE_NAMES["commodity"], SELECT).count() == 6  # six part types


def test_training_then_inference(spark, setup):
    tx, pr, store = setup
    res = run_training_job(spark, tx, pr, store, SELECT, "PROMO", "propensity_test",
                           num_trials=2, parallelism=2, max_iter=3)
    assert res.version == 1
    assert set(res.metrics) == {"average_precision", "roc_auc", "balanced_accuracy", "matthews_corrcoef"}
    assert len(res.registry) == 1
    if champion(store, "propensity_test") is None:
        with pytest.raises(LookupError):
            run_inference_job(spark, tx, store, SELECT, "PROMO", "propensity_test",
                              tempfile.mkdtemp() + "/p")
        # register the same model again as a version that passes the gate
        R.register(store, "propensity_test", [(1, 0.9, None)])
    assert champion(store, "propensity_test") == 1
    out = run_inference_job(spark, tx, store, SELECT, "PROMO", "propensity_test",
                            tempfile.mkdtemp() + "/predictions",
                            inference_timestamp=dt.datetime(2001, 8, 2, 11, 0))
    assert set(out.columns) == {"household_key", "commodity_desc", "select_date", "prediction",
                                "probability", "model_version", "inference_timestamp"}
    n_households = tx.select("household_key").distinct().count()
    assert out.count() == n_households
    assert out.filter(~F.col("prediction").isin(0, 1)).count() == 0
    assert out.filter((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def test_fused_build_equals_per_grain(spark):
    from cartwise.operators import feature_tables as FT
    tx = load_transactions(spark, SF001)
    pr = load_products(spark, SF001, "p_name")
    for d in ("2001-08-01", "2000-01-15"):
        inp = FT.prepare(tx, pr, d)
        fused = FT.all_feature_tables(inp)
        for grain, build in FT.BUILDERS.items():
            single = build(inp)
            assert fused[grain].columns == single.columns
            assert fused[grain].exceptAll(single).count() == 0
            assert single.exceptAll(fused[grain]).count() == 0
