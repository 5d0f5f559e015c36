"""Token ids in ORC files (operator 2).

``write_tokens`` encodes documents and writes one ORC file per range of
document ids, rows in ascending id order.  The ids are an array of integers,
which ORC stores with integer run-length encoding; every file carries row
indexes and a Bloom filter on the id.  ``read_tokens`` reads stripes in
parallel and adds each document's start in the whole id stream;
``read_documents`` uses the min/max indexes and Bloom filters to open only
the stripes that may hold the ids asked for.

Defined cases: a null or empty text has only the end id; rows with a null id
come first; repeated ids keep one row each, next to each other; an empty
table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .tokens import WordIds, coder

STRIPE_BYTES = 64 << 20
INDEX_ROWS = 10_000
BLOOM_FPP = 0.01
#: Ids that leave a task in one Arrow batch.
BATCH_IDS = 1_000_000

_SCHEMA = StructType([
    StructField("doc_id", LongType()),
    StructField("part", IntegerType()),
    StructField("part_start", LongType()),
    StructField("n_tokens", LongType()),
    StructField("ids", ArrayType(IntegerType(), False)),
])


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Documents' ids in ascending id order within and across partitions."""
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = coder(WordIds, tokenizer).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids, at = batch.column(0), 0
            ids: list[bytes] = []
            held = 0
            for row, text in enumerate(batch.column(1).to_pylist(), 1):
                ids.append(encode(text) + end)
                held += len(ids[-1])
                if row == batch.num_rows or held >= 4 * BATCH_IDS:
                    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                    offsets = np.concatenate(([0], np.cumsum(sizes)))
                    flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                    yield pa.RecordBatch.from_arrays([
                        doc_ids.slice(at, len(ids)), pa.array(np.full(len(ids), part, np.int32)), pa.array(start + offsets[:-1]), pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    ], names=_SCHEMA.names)
                    at, start, ids, held = row, start + int(offsets[-1]), [], 0

    return ordered.mapInArrow(run, _SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ORC files; ``part`` and ``part_start`` place a row in the id stream."""
    (
        encoded(docs, tokenizer, end_id, id_col, text_col)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files.

    A file's place in the stream comes from the two small integer columns of
    all files, not from the ids.  One row of two numbers per file remains, so
    the places are sent to all readers and the ids stay where they are read.
    """
    rows = spark.read.schema(_SCHEMA).orc(path)
    ends = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of the given ids; the filter reaches the ORC reader."""
    return spark.read.schema(_SCHEMA).orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def with_crc32(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): unsigned CRC-32 of a row's ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            data, ends = memoryview(np.asarray(lists.values, "<i4")).cast("B"), lists.offsets.to_numpy()
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
