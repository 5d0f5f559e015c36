"""Model registry as two tables (operators M8, M9, M11).

The registry keeps one row per registered model version with its test ROC
AUC, and an append-only log of what each alias was set to.  The aliases follow
from the version history by the promotion rule, so a job that died between the
two writes is made good by the next ``sync_aliases``:

* a version passes the gate when ``roc_auc >= gate`` (0.75) and is then set
  as Challenger;
* a passing version becomes Champion when no Champion exists yet or its AUC
  is at least the current Champion's (the Challenger alias is then
  removed); otherwise it keeps the Challenger alias (D22, D23).

Both AUCs are measured on the same test rows: when a version is registered,
the training job scores its test rows with the current Champion too and keeps
that as ``champion_auc`` (NULL without a Champion).  A Champion that was once
lucky is thereby unseated.  A history without that column holds versions that
were all measured on one set of rows; the best AUC among earlier passing
versions is then the current Champion's.  The windows below are partitioned by
model name; a registry holds one row per version, so each partition is
small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The gate and the alias names.
AUC_GATE = 0.75
CHAMPION = "Champion"
CHALLENGER = "Challenger"

REGISTRY_TABLE, ALIAS_TABLE = "model_registry", "model_aliases"
REGISTRY_SCHEMA = "model_name string, version int, roc_auc double, champion_auc double"
ALIAS_SCHEMA = "model_name string, change int, alias string, version int, set_at timestamp"


def promote(history: DataFrame, gate: float = AUC_GATE) -> DataFrame:
    """Operator M8: (model_name, version, roc_auc[, champion_auc]) -> the first three plus ``alias``."""
    order = Window.partitionBy("model_name").orderBy("version")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("model_name")
    passes = F.col("roc_auc") >= F.lit(gate)
    best_before = F.col("champion_auc") if "champion_auc" in history.columns else F.max(F.when(passes, F.col("roc_auc"))).over(before)
    staged = (history
              .withColumn("passes", F.coalesce(passes, F.lit(False)))
              .withColumn("becomes_champion",
                          F.col("passes") & (best_before.isNull() | (F.col("roc_auc") >= best_before))))
    staged = (staged
              .withColumn("last_champion", F.max(F.when(F.col("becomes_champion"), F.col("version"))).over(whole))
              .withColumn("last_passing", F.max(F.when(F.col("passes"), F.col("version"))).over(whole)))
    alias = (F.when(F.col("version") == F.col("last_champion"), F.lit(CHAMPION))
             .when((F.col("version") == F.col("last_passing")) & ~F.col("becomes_champion"), F.lit(CHALLENGER)))
    return staged.select("model_name", "version", "roc_auc", alias.alias("alias"))


def latest_version(history: DataFrame) -> DataFrame:
    """Operator M9: highest registered version per model, at least 1."""
    return (history.groupBy("model_name")
            .agg(F.greatest(F.max("version"), F.lit(1)).alias("latest_version")))


def version_for_alias(registry: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """Operator M11: the version carrying an alias, per model."""
    return registry.filter(F.col("alias") == F.lit(alias)).select("model_name", "version", "roc_auc")


# -- stored versions and aliases ----------------------------------------------

def create_registry(store) -> None:
    """The two tables, if they are absent."""
    spark = store.spark
    empty = lambda schema: spark.createDataFrame([], schema).schema
    store.create_table(REGISTRY_TABLE, ["model_name", "version"], empty(REGISTRY_SCHEMA), "registered model versions")
    store.create_table(ALIAS_TABLE, ["model_name", "change"], empty(ALIAS_SCHEMA), "what each alias was set to, in order")


def history(store, model_name: str) -> DataFrame:
    """The registered versions of a model."""
    return store.read_table(REGISTRY_TABLE).filter(F.col("model_name") == model_name)


def next_version(store, model_name: str) -> int:
    return (history(store, model_name).agg(F.max("version")).first()[0] or 0) + 1


def register(store, model_name: str, versions: list[tuple], gate: float = AUC_GATE, at: dt.datetime | None = None) -> None:
    """Add versions, as (version, roc_auc, champion_auc), and log how the aliases change by them (M8)."""
    create_registry(store)
    store.write_table(REGISTRY_TABLE, store.spark.createDataFrame([(model_name, *v) for v in versions], REGISTRY_SCHEMA).coalesce(1))
    sync_aliases(store, model_name, gate, at)


def aliases(store, model_name: str) -> DataFrame:
    """(model_name, alias, version): the latest entry of each alias in the log; removed ones have none."""
    log = store.read_table(ALIAS_TABLE).filter(F.col("model_name") == model_name)
    last = log.groupBy("model_name", "alias").agg(F.max_by("version", "change").alias("version"))
    return last.filter(F.col("version").isNotNull())


def sync_aliases(store, model_name: str, gate: float = AUC_GATE, at: dt.datetime | None = None) -> None:
    """Append to the log what the promotion rule sets differently from it; nothing if they agree.

    A model has two aliases at most, which is all that comes to the driver.
    """
    due = {r["alias"]: r["version"] for r in promote(history(store, model_name), gate).filter(F.col("alias").isNotNull()).collect()}
    held = {r["alias"]: r["version"] for r in aliases(store, model_name).collect()}
    changed = [(a, due.get(a)) for a in (CHAMPION, CHALLENGER) if due.get(a) != held.get(a)]
    if not changed:
        return
    last = store.read_table(ALIAS_TABLE).filter(F.col("model_name") == model_name).agg(F.max("change")).first()[0] or 0
    at = at or dt.datetime.now()
    rows = [(model_name, last + 1 + i, a, v, at) for i, (a, v) in enumerate(changed)]
    store.write_table(ALIAS_TABLE, store.spark.createDataFrame(rows, ALIAS_SCHEMA).coalesce(1))


def alias_version(store, model_name: str, alias: str = CHAMPION) -> int | None:
    """Operator M11 on the log: the version that carries an alias now."""
    row = aliases(store, model_name).filter(F.col("alias") == alias).first()
    return None if row is None else int(row["version"])
