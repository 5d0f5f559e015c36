"""Small helpers shared by the operators: tables, staging, partition counts."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwise.session import materialize, remove_path, stage_path

__all__ = ["ship_package", "table", "stage", "drop_stage", "text_bytes", "pieces_for", "stage_path", "unused", "release_memory"]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"  # read by the driver, which serves it
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Spark opens the path, whatever store it names."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Lets Spark delete an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared checkpoint folder; returns (reread, path).

    Cuts the lineage: tasks of a lost executor reread files that every
    executor sees.  The shuffle files of the write are deleted at its end,
    as nothing reads them again, and the files are packed by zstd, as texts
    take half the disk so.  The caller hands the path to
    ``drop_stage`` when later results no longer read it.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    codec = spark.conf.get(_CODEC, "snappy")
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_CODEC, "zstd")
    try:
        return materialize(df, name, path), path
    finally:
        spark.conf.set(_CLEANUP, before)
        spark.conf.set(_CODEC, codec)


def drop_stage(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        remove_path(spark, p)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes in a text column (one aggregate over all rows)."""
    n = docs.agg(F.sum(F.octet_length(column))).first()[0]
    return int(n or 0)


def pieces_for(n_bytes: int, target: int, least: int = 1) -> int:
    """How many partitions of about ``target`` bytes hold ``n_bytes``."""
    return max(least, math.ceil(n_bytes / target))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column of ``df`` (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def release_memory() -> None:
    """Give a Python worker's freed memory back to the system, as workers outlive the stages that filled them."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass
