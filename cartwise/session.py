"""Session construction and the shared checkpoint folder.

On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
everything this package persists (checkpoints, staged feature-table writes)
goes below it.  Only when the setting is absent (local tests, laptops) do we
create a private folder ourselves.
"""

from __future__ import annotations

import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # plans of the wide feature tables are large; keep only recent ones
    "spark.sql.ui.retainedExecutions": "50",
    "spark.sql.maxPlanStringLength": "200000",
}
LOCAL_DRIVER_MEMORY = "8g"

_LOCAL_ROOTS: dict[int, str] = {}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "cartwise", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the configuration the jobs expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = LOCAL_DRIVER_MEMORY
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged writes.

    Reads ``spark.checkpoint.dir`` from the session, then the folder given to
    ``SparkContext.setCheckpointDir``.  If neither is set, a local master gets
    a private folder, created once per SparkContext and used as the RDD
    checkpoint directory too, so ``DataFrame.checkpoint()`` and Spark ML's
    ``checkpointInterval`` work; any other master is refused, as executors
    would not share the folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    root = root or _LOCAL_ROOTS.get(id(sc._jsc)) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_ROOTS[id(sc._jsc)] = tempfile.mkdtemp(prefix="cartwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root.rstrip("/") + "/rdd")
    return root


def stage_path(spark: SparkSession, name: str = "stage") -> str:
    """A fresh folder below the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_root(spark).rstrip('/')}/materialized/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "stage", path: str | None = None):
    """Write ``df`` as parquet below the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads files
    instead of recomputing the plan), but stores columnar, compressed data
    in one job.  Each call gets a fresh folder unless ``path`` is given;
    ``remove_path`` deletes it once every reader has finished.
    """
    spark = df.sparkSession
    path = path or stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging folder this package wrote (any Hadoop filesystem)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that are planned inside remove their shuffle files when they end, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the shared folder.

    Makes sure the SparkContext knows the folder first (sessions built
    elsewhere may not have set it), then cuts the lineage.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
