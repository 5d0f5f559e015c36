"""File-arrival driven feature refresh.

The original pipeline has no streaming operator: new transactions are
picked up by rerunning the batch feature job on a daily schedule.  This
module expresses that cadence with Structured Streaming: a file source
watches the transactions folder, and each micro-batch of newly arrived
files triggers the feature job (``foreachBatch``) for

* every day that it contains after the first-load date,
* every stored date from its earliest day on, so that late rows reach the
  tables they belong to, and
* its latest day.

The first-load date ends the history that was there before the daily runs:
the days up to it get no tables of their own.  It is a parameter; by default
it is the earliest stored date, which is the latest day of the first batch if
the store was empty.  A first load of several batches (files come in any
order) needs it given.

A batch's rows are absorbed into mergeable state (``operators.feature_state``)
and every table is built from that state, so a run reads the arrived rows, the
months that its windows touch and the newest months of history, however long
the history is; a late row costs its month and one build per stored date after
it.  Rows are absorbed under the stream's batch number, so a batch that is
tried again replaces what it left.  The state belongs to the checkpoint
location: a stream with a new one starts over with all files.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cartwise.operators.feature_state import absorb
from cartwise.plans.feature_job import TABLE_NAMES, run_incremental_feature_jobs
from cartwise.session import checkpoint_root
from cartwise.sources.store import FeatureStore


def start_feature_refresh(spark: SparkSession, transactions_dir: str, schema: StructType,
                          products: DataFrame, store: FeatureStore, checkpoint_location: str | None = None,
                          available_now: bool = True, processing_time: str | None = None,
                          max_files_per_trigger: int | None = None,
                          first_load_date: dt.date | None = None) -> StreamingQuery:
    """Start the refresh stream; returns the running query.

    ``available_now`` processes everything that has arrived and stops (the
    scheduled-job style); otherwise ``processing_time`` (e.g. '1 day')
    keeps it running.  Arrived days after ``first_load_date`` (by default the
    earliest stored date) each get their tables.
    """
    ckpt = checkpoint_location or f"{checkpoint_root(spark).rstrip('/')}/streams/feature_refresh"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrivals = reader.parquet(transactions_dir)
    state = FeatureStore(spark, f"{store.root}/_refresh_state/{hashlib.sha256(ckpt.encode()).hexdigest()[:16]}")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = {r["day"]: r["count"] for r in batch.groupBy("day").count().collect()}
        absorb(batch, products, state, str(epoch_id), sum(rows.values()))
        arrived = set(rows) - {None}
        if not arrived:
            return
        first, latest = min(arrived), max(arrived)
        stored = set()
        if store.exists(TABLE_NAMES["household"]):
            stored = {dt.date.fromisoformat(d) for d in store.snapshot(TABLE_NAMES["household"]).dates()}
        loaded = first_load_date or min(stored, default=latest)
        days = {d for d in stored if d >= first} | {d for d in arrived if d > loaded} | {latest}
        run_incremental_feature_jobs(state, sorted(days), store)

    w = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
