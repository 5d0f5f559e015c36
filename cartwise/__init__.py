"""cartwise: retail purchase-propensity analytics as Spark DataFrame jobs.

Layout
------
sources/    reading the fact and dimension tables, the keyed feature store
functions/  metric catalogue, look-back windows, text normalisation
operators/  feature builds, spine, labels, lookups, ranking metrics, models
plans/      the three end-to-end jobs (features, training, inference)
streaming/  file-arrival driven refresh of the feature job
oracle/     DuckDB SQL used to check every deterministic operator
"""

from cartwise.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
