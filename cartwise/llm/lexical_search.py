"""Ranked lexical search over bit-sliced Bloom signatures (operator 11).

Documents lie in blocks.  A block's index is a bit matrix: a row for each
position of a Bloom signature, a column for each document.  A term sets the
bits of (term, level) for each level of ``LEVELS`` that its occurrences reach.
The bitmap of (term, level) is the conjunction of its ``HASHES`` rows; it may
show a document too many, never one too few, so the levels shown from the
first on overestimate the term's occurrences.

A ranking has these steps, each a pass of Spark jobs over all documents:

1. Index: blocks of signatures are written below the shared folder, with the
   number of documents and terms and the document frequencies of the queries'
   terms, all exact and over all documents.
2. Bound: per block, the bitmaps' weighted sums, slice by slice (a level adds
   what it raises the score by), give every document's upper bound for every
   query.  Each query's ``k`` documents of the highest bounds are scored
   exactly, from their texts; the k-th score is a cutoff.
3. Resolve: every document whose bound reaches the cutoff is scored exactly.
   Only documents that are provably below are left out: those under the cutoff,
   and of equal texts (which score equally) all but the ``k`` smallest ids.

Signatures are as wide as a block's longest documents need, and blocks hold
documents of like size and ``BLOCK_BITS`` at most (or one document).  Queries
are taken in groups of about ``QUERY_BYTES`` of text, which is what a broadcast
and the driver hold of them.

Defined cases: a document of null text, or without a term, is in no result and
not counted; its other columns don't matter.  A null id ranks after ids of the
same score; repeated rows are documents of their own.  A query without terms,
or whose terms no document holds, has no result; repeated query rows each get
their result.  Texts are taken whole, whatever their length.  Without documents
or queries the result is empty.  Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import drop_stage, pieces_for, stage, text_bytes

K = 10
#: Occurrences from which a level's bits are set.
LEVELS = (1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 22, 30, 40, 55, 80, 120, 200, 400, 1000, 4000)
HASHES = 3
BITS_PER_KEY = 12
BLOCK_DOCS, BLOCK_BITS = 2048, 1 << 24
QUERY_BYTES = 4 << 20
#: Queries whose bounds a task holds at a time.
QUERIES_AT_ONCE = 256
_INDEX = "ids array<long>, h1 array<long>, h2 array<long>, sizes array<long>, bits binary, terms array<int>, counts array<long>"
#: A-Z to lower case, all ASCII but letters and digits to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def saturated(tf, m):
    """What ``tf`` occurrences in a document of length factor ``m`` count for (integers)."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factor(n, n_docs: int, n_terms: int):
    return 25 + (75 * n * n_docs) // n_terms


class Queries:
    """A group of queries: terms, and per query its terms' numbers and how often it holds them."""

    def __init__(self, texts: list[str | None]):
        self.number: dict[bytes, int] = {}
        self.held = []
        for text in texts:
            held = Counter(terms_of((text or "").encode("utf-8", "replace")))
            self.held.append([(self.number.setdefault(t, len(self.number)), n) for t, n in held.items()])

    def weigh(self, n_docs: int, n_terms: int, frequency: dict[int, int]) -> None:
        """Sets the terms' weights; terms that no document holds weigh nothing."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.zeros(len(self.number), np.int64)
        for t, df in frequency.items():
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        self.held = [[(t, n) for t, n in held if self.weight[t]] for held in self.held]

    def score(self, query: int, counts: dict[int, int], m: int) -> int:
        return sum(n * int(self.weight[t]) * saturated(counts[t], m) for t, n in self.held[query] if t in counts)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   query_id_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``k`` documents of the highest score above 0."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    texts = docs.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    asked = queries.select(F.col(query_id_col).alias("item_id"), F.col(query_col).cast("string").alias("q"))
    groups = pieces_for(text_bytes(asked, "q"), QUERY_BYTES)
    out = []
    for g in range(groups):  # usually one; equal queries of a group rank alike
        rows = asked.where(F.pmod(F.xxhash64("q"), F.lit(groups)) == g).collect()
        ranked = _rank_group(texts, [r.q for r in rows], k)
        items = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {queries.schema[query_id_col].dataType.simpleString()}")
        out.append(ranked.join(F.broadcast(items), "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    whole = out[0]
    for more in out[1:]:
        whole = whole.union(more)
    return whole


def _rank_group(texts: DataFrame, asked: list[str | None], k: int) -> DataFrame:
    spark = texts.sparkSession
    queries = Queries(asked)
    index, index_path = stage(texts.mapInArrow(_build(queries.number), _INDEX), "search-index")
    n_docs, n_terms = index.agg(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    found = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df")).collect()
    queries.weigh(int(n_docs or 0), int(n_terms or 0), {r.terms: r.df for r in found})

    bounds = index.where(F.size("ids") > 0).select("ids", "h1", "h2", "sizes", "bits")
    shape = "query int, id long, h1 long, h2 long, bound long"
    high = bounds.mapInPandas(_bounded(queries, k, None), shape)
    first = Window.partitionBy("query").orderBy(F.desc("bound"))
    high = high.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k)
    scored = _score(texts, high, queries)
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    kth = scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k).select("query", "score").collect()
    cutoff = np.ones(len(asked), np.int64)
    for r in kth:
        cutoff[r.query] = max(1, r.score)

    open_pairs = bounds.mapInPandas(_bounded(queries, k, cutoff), shape)
    alike = Window.partitionBy("query", "h1", "h2").orderBy(F.col("id").asc_nulls_last())
    open_pairs = open_pairs.withColumn("r", F.row_number().over(alike)).where(F.col("r") <= k)
    ranked = _score(texts, open_pairs, queries).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    out, _ = stage(ranked.select("query", "rank", "id", "score"), "search-ranks")
    drop_stage(spark, index_path)
    return out


def _hashes(terms: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, terms), np.uint64, len(terms))


def _positions(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """The ``HASHES`` signature positions of each (term, level); ``width`` is a power of two."""
    h = (hashes + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((a + steps * b) & np.uint64(width - 1)).astype(np.int64)


def _build(vocabulary: dict[bytes, int]):
    """Index rows of a task's documents; the queries' terms are counted in a row of their own for each batch."""
    levels = np.array(LEVELS)
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("bits", pa.binary()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def record(ids, h1, h2, sizes, bits, terms, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((ids, h1, h2, sizes, bits, terms, counts), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = frozenset(vocabulary)
        for batch in batches:
            ids, h1, h2 = (batch.column(i).to_pylist() for i in range(3))
            column = batch.column(3).cast(pa.binary())
            keys, rows, sizes, frequency = [], [], [], Counter()
            for i in range(len(batch)):
                terms = terms_of(column[i].as_py())
                if not terms:
                    continue
                held = Counter(terms)
                frequency.update(words.intersection(held))
                tf = np.fromiter(held.values(), np.int64, len(held))
                reached = np.searchsorted(levels, tf, "right")
                h = np.repeat(_hashes(list(held)), reached)
                level = np.arange(len(h)) - np.repeat(np.cumsum(reached) - reached, reached)
                keys.append((h, level.astype(np.uint8)))
                rows.append(i)
                sizes.append(len(terms))
            if frequency:
                yield record([], [], [], [], b"", [vocabulary[t] for t in frequency], list(frequency.values()))
            order = sorted(range(len(rows)), key=lambda j: len(keys[j][0]))
            at = 0
            while at < len(order):
                end, width = at, 64
                while end < len(order) and end - at < BLOCK_DOCS:  # sizes rise, so the last one sets the width
                    wider = max(64, 1 << (BITS_PER_KEY * len(keys[order[end]][0]) - 1).bit_length())
                    if end > at and wider * (end - at + 1) > BLOCK_BITS:
                        break
                    end, width = end + 1, wider
                block = order[at:end]
                bits = np.zeros((width, len(block)), np.uint8)
                for column_no, j in enumerate(block):
                    bits[_positions(*keys[j], width), column_no] = 1
                yield record(*([x[rows[j]] for j in block] for x in (ids, h1, h2)), [sizes[j] for j in block], np.packbits(bits, axis=1).tobytes(), [], [])
                at = end

    return run


def _bounded(queries: Queries, k: int, cutoff: np.ndarray | None):
    """(query, id, h1, h2, bound): per block and query the ``k`` highest bounds, or all that reach the cutoff."""
    names = sorted(queries.number, key=queries.number.get)

    def upper(row, hashes: np.ndarray, chosen: range) -> np.ndarray:
        n = len(row.ids)
        packed = np.frombuffer(row.bits, np.uint8).reshape(-1, (n + 7) // 8)
        m = length_factor(np.asarray(row.sizes, np.int64), queries.n_docs, queries.n_terms)
        total = np.zeros((len(chosen), n))
        wanted = sorted({t for q in chosen for t, _ in queries.held[q]})
        if not wanted:
            return total
        place = {t: i for i, t in enumerate(wanted)}
        held = [(np.array([place[t] for t, _ in queries.held[q]], int), np.array([times * queries.weight[t] for t, times in queries.held[q]], float)) for q in chosen]
        shown, before = np.full((len(wanted), packed.shape[1]), 255, np.uint8), np.zeros(n, np.int64)
        for level, _ in enumerate(LEVELS):
            rows = packed[_positions(hashes[wanted], level, len(packed))]
            shown &= np.bitwise_and.reduce(rows, axis=0)
            alive = shown.any(axis=1)
            if not alive.any():
                break
            most = np.asarray(row.sizes, np.int64)
            if level + 1 < len(LEVELS):
                most = np.minimum(most, LEVELS[level + 1] - 1)
            now = saturated(most, m)
            step, before = now - before, now
            slices = np.unpackbits(shown, axis=1, count=n)
            for i, (terms, weights) in enumerate(held):
                live = alive[terms]
                if live.any():
                    total[i] += step * (weights[live] @ slices[terms[live]])
        return total

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _hashes(names)
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, h1, h2 = pd.array(row.ids, "Int64"), np.asarray(row.h1, np.int64), np.asarray(row.h2, np.int64)
                for at in range(0, len(queries.held), QUERIES_AT_ONCE):
                    chosen = range(at, min(at + QUERIES_AT_ONCE, len(queries.held)))
                    bound = upper(row, hashes, chosen).astype(np.int64)
                    if cutoff is None:
                        take = min(k, bound.shape[1])
                        best = np.argpartition(bound, -take, axis=1)[:, -take:]
                        q, d = np.repeat(np.arange(len(chosen)), take), best.ravel()
                        positive = bound[q, d] > 0
                        q, d = q[positive], d[positive]
                    else:
                        q, d = np.nonzero(bound >= cutoff[at:at + len(chosen), None])
                    yield pd.DataFrame({"query": (q + at).astype(np.int32), "id": ids[d], "h1": h1[d], "h2": h2[d], "bound": bound[q, d]})

    return run


def _score(texts: DataFrame, pairs: DataFrame, queries: Queries) -> DataFrame:
    """(query, id, score) of the pairs' documents by their texts; scores of 0 are left out."""
    wanted = pairs.groupBy("id", "h1", "h2").agg(F.collect_set("query").alias("queries")).toDF("i", "a", "b", "queries")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    held = texts.join(wanted, same).select("id", "text", "queries")
    schema = pa.schema([("query", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column, asked = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()
            out = []
            for i, chosen in enumerate(asked):
                terms = terms_of(column[i].as_py())
                m = length_factor(len(terms), queries.n_docs, queries.n_terms)
                counts = {queries.number[t]: n for t, n in Counter(terms).items() if t in queries.number}
                out += [(q, ids[i], score) for q in chosen if (score := queries.score(q, counts, m)) > 0]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or ([], [], []), schema, strict=True)], schema=schema)

    return held.mapInArrow(run, "query int, id long, score long")
