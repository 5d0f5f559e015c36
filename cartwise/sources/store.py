"""Keyed feature tables on shared storage (operators S2, S3, S4, S5).

A table is a folder of immutable writes and of numbered state records:

``<table>/data/write=<id>/select_date=<date>/``  the rows one write left for a date
``<table>/_state/<number>.json``                 keys, schema, and for every date the write that holds it

Readers take the highest state and read the folders that it names, so they see
a whole snapshot: a table's content changes when the next state appears, and
only then.  A merge (upsert on the primary key) writes each row once:

1. the update goes to a folder of its own and is checked for repeated keys;
2. rows of the touched dates that it does not replace (null-safe anti join on
   the key, over those dates' folders only) are appended to that folder;
3. the next state names the new folder for the touched dates.

A state is created without overwriting.  A writer that dies before step 3
leaves the old state as it was; one that finds its number taken lost a race and
raises ``ConcurrentWrite``, with the table as the other writer left it.  Tasks
commit atomically, so lost executors only rerun tasks.  Folders and states that
no state within ``retention_seconds`` names are removed after a write.

Tables without ``select_date`` (the model registry) are one part, replaced whole.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwise.session import checkpoint_root
from cartwise.sources.files import Files

PARTITION = "select_date"
#: How long replaced folders stay for readers that hold an older state.
RETENTION_SECONDS = 24 * 3600


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; the write may be tried again."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table; ``parts`` maps a partition folder's name (or "") to the write that holds it."""

    version: int
    primary_keys: list
    description: str
    partitioned: bool
    schema: dict
    parts: dict = field(default_factory=dict)

    def dates(self) -> list[str]:
        return sorted(p.split("=", 1)[1] for p in self.parts if p)


class FeatureStore:
    """Feature tables under ``root`` (default: below the shared checkpoint folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None, retention_seconds: float = RETENTION_SECONDS):
        self.spark = spark
        self.root = (root or checkpoint_root(spark).rstrip("/") + "/feature_store").rstrip("/")
        self.retention_seconds = retention_seconds
        self.files = Files(spark)

    # -- layout and state -------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _data(self, name: str) -> str:
        return f"{self.path(name)}/data"

    def _state(self, name: str, version: int) -> str:
        return f"{self.path(name)}/_state/{version:08d}.json"

    def _versions(self, name: str) -> dict[int, float]:
        found = self.files.children(f"{self.path(name)}/_state")
        return {int(f[:-5]): t for f, t in sorted(found.items()) if f.endswith(".json") and not f.startswith(".")}

    def snapshot(self, name: str, version: int | None = None) -> Snapshot:
        """A state of the table, by default the latest."""
        versions = self._versions(name)
        if not versions:
            raise ValueError(f"feature table {name!r} does not exist; create it first")
        return Snapshot(**json.loads(self.files.read(self._state(name, max(versions) if version is None else version))))

    def _commit(self, name: str, snapshot: Snapshot) -> None:
        if not self.files.create(self._state(name, snapshot.version), json.dumps(asdict(snapshot))):
            raise ConcurrentWrite(f"state {snapshot.version} of {name!r} was written by someone else")

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self.snapshot(name).schema)

    def exists(self, name: str) -> bool:
        """Explicit existence check (D24), no try/except around a lookup."""
        return bool(self._versions(name))

    def primary_keys(self, name: str) -> list[str]:
        return list(self.snapshot(name).primary_keys)

    def partitioned(self, name: str) -> bool:
        return self.snapshot(name).partitioned

    # -- S3: create -------------------------------------------------------
    def create_table(self, name: str, primary_keys: list[str], schema, description: str = "") -> None:
        if self.exists(name):
            return
        first = Snapshot(0, list(primary_keys), description, PARTITION in schema.fieldNames(), json.loads(schema.json()))
        try:
            self._commit(name, first)
        except ConcurrentWrite:  # someone else created it meanwhile
            pass

    # -- S2: read ---------------------------------------------------------
    def read_table(self, name: str, select_date=None, version: int | None = None) -> DataFrame:
        """The table, or one date of it, as the latest (or the given) state names it."""
        if select_date is not None:
            return self.read_dates(name, [select_date], version)
        snap = self.snapshot(name, version)
        return self._read(name, snap, snap.parts)

    def read_dates(self, name: str, dates, version: int | None = None) -> DataFrame:
        """Some dates of the table; the folders of others are not listed."""
        snap = self.snapshot(name, version)
        wanted = {f"{PARTITION}={str(d)[:10]}" for d in dates}
        return self._read(name, snap, {p: w for p, w in snap.parts.items() if p in wanted})

    def _read(self, name: str, snap: Snapshot, parts: dict) -> DataFrame:
        schema = StructType.fromJson(snap.schema)
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = self._data(name)
        by_write: dict[str, set] = {}
        for p, w in parts.items():
            by_write.setdefault(w, set()).add(p)
        paths = []
        for w, wanted in sorted(by_write.items()):
            folder = f"{base}/write={w}"
            # a write that is wanted whole is one path to list, not one for each date
            whole = len(wanted) > 1 and wanted == {c for c in self.files.children(folder) if c.startswith(f"{PARTITION}=")}
            paths += [folder] if whole else sorted(f"{folder}/{p}".rstrip("/") for p in wanted)
        found = self.spark.read.schema(StructType([*schema.fields]).add("write", "string")).option("basePath", base).parquet(*paths)
        return found.select(*schema.fieldNames())

    # -- S4: merge --------------------------------------------------------
    def write_table(self, name: str, df: DataFrame, mode: str = "merge") -> None:
        """Write ``df`` into the table: ``merge`` (upsert on the primary key,
        the default) or ``overwrite`` (replace the whole table)."""
        if mode not in ("merge", "overwrite"):
            raise ValueError(f"unknown mode {mode!r}")
        snap = self.snapshot(name)
        write = uuid.uuid4().hex
        folder = f"{self._data(name)}/write={write}"

        def append(rows: DataFrame) -> None:
            w = rows.select(*[f["name"] for f in snap.schema["fields"]]).write.mode("append")
            (w.partitionBy(PARTITION) if snap.partitioned else w).parquet(folder)

        try:
            append(df)
            touched = {p: write for p in self.files.children(folder) if p.startswith(f"{PARTITION}=")} if snap.partitioned else {"": write}
            update = self._read(name, snap, touched)
            twice = repeated_keys(update, snap.primary_keys)
            if twice:
                raise ValueError(f"{twice} primary keys of {name!r} occur more than once in the rows to write")
            old = {p: w for p, w in snap.parts.items() if p in touched}
            if mode == "merge" and old:
                target = self._read(name, snap, old)
                keys = update.select(*[F.col(k).alias("__k_" + k) for k in snap.primary_keys])
                same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(keys["__k_" + k]) for k in snap.primary_keys])
                append(target.join(keys, same, "left_anti"))
            if mode == "overwrite" or touched:
                self._commit(name, replace(snap, version=snap.version + 1, parts={**snap.parts, **touched} if mode == "merge" else touched))
        except Exception:
            self.files.remove(folder)  # no state names it
            raise
        self.vacuum(name)

    def vacuum(self, name: str, older_than_seconds: float | None = None) -> None:
        """Remove states that were replaced so long ago, and folders that only such states, or none, name.

        A writer at work has a folder that no state names yet, so the age must
        exceed the longest write and the longest read.
        """
        limit = time.time() - (self.retention_seconds if older_than_seconds is None else older_than_seconds)
        versions = sorted(self._versions(name).items())
        replaced = [v for (v, _), (_, replaced_at) in zip(versions, versions[1:], strict=False) if replaced_at < limit]
        kept = [self.snapshot(name, v) for v, _ in versions if v not in replaced]
        named = {(w, p) for s in kept for p, w in s.parts.items()}
        for folder, changed in self.files.children(self._data(name)).items():
            write, path = folder.split("=", 1)[1], f"{self._data(name)}/{folder}"
            if changed >= limit:
                continue
            if not any(w == write for w, _ in named):
                self.files.remove(path)
                continue
            for part in self.files.children(path):
                if part.startswith(f"{PARTITION}=") and (write, part) not in named:
                    self.files.remove(f"{path}/{part}")
        for v in replaced:
            self.files.remove(self._state(name, v))

    # -- S3: key check ----------------------------------------------------
    def key_check(self, name: str) -> DataFrame:
        """Rows, distinct primary keys and keys seen more than once."""
        return key_check(self.read_table(name), self.primary_keys(name))


def key_check(df: DataFrame, primary_keys: list[str]) -> DataFrame:
    """One row: ``rows``, ``distinct_keys``, ``duplicate_keys`` (keys with >1 row)."""
    per_key = df.groupBy(*primary_keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.count(F.when(F.col("n") > 1, F.lit(1))).alias("duplicate_keys"))


def repeated_keys(df: DataFrame, primary_keys: list[str]) -> int:
    """How many keys occur more than once, as ``key_check`` counts them.

    Keys are counted by a 64-bit hash first, which moves instead of them; the
    rows whose hash comes again are then compared by the keys themselves.
    """
    hashed = df.select(F.xxhash64(*primary_keys).alias("__hash"))
    again = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("__hash")
    if not again.take(1):
        return 0
    rows = df.withColumn("__hash", F.xxhash64(*primary_keys)).join(again, "__hash", "left_semi")
    return key_check(rows, primary_keys).first()["duplicate_keys"]


def write_predictions(df: DataFrame, path: str) -> None:
    """Operator S5 by path: overwrite the predictions folder (parquet; no Delta here)."""
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, root: str | None = None, retention_seconds: float = RETENTION_SECONDS) -> DataFrame:
    """Operator S5: overwrite the table ``name`` of the session catalog; returns ``spark.table(name)``.

    The rows go to a new folder below ``root``; the catalog then points the
    table at it.  Queries that resolved the table before still read the old
    folder, which is removed once it is older than ``retention_seconds`` and
    another write succeeds.  A failed write leaves the table as it was.
    """
    spark, now = df.sparkSession, time.time()
    base = f"{(root or checkpoint_root(spark).rstrip('/') + '/tables').rstrip('/')}/{name}"
    write = uuid.uuid4().hex
    folder, files = f"{base}/write={write}", Files(spark)
    df.write.parquet(folder)
    place = folder.replace("'", "\\'")
    if spark.catalog.tableExists(name):
        have = [(f.name, f.dataType) for f in spark.table(name).schema]
        if have == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        else:  # the files of an external table stay when it is dropped
            spark.sql(f"DROP TABLE {name}")
            spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    for old, changed in files.children(base).items():
        if old != f"write={write}" and changed < now - retention_seconds:
            files.remove(f"{base}/{old}")
    return spark.table(name)
