"""Exact top-k inner products by a three-phase uniform threshold (operator 12).

The components of a vector are cut into ``PARTS`` parts.  A score is the sum
of its parts' products, and each part has its own score list: per query, the
products of that part over all vectors.  Vectors lie in blocks, and a task
holds one block of queries and one block of candidates, with all their parts.

1. Gather: of each part's list the block's ``k`` best entries.  These few
   pairs are scored whole; the k-th best of a query over all blocks, ``T``,
   is a safe cutoff, as at least ``k`` rows score as much.
2. Collect: ``T`` goes to every block.  A score of at least ``T`` needs a part
   of at least ``T / PARTS``, so the entries of each list from that uniform
   threshold on are sufficient.
3. Resolve: the collected pairs are scored whole, and those of at least ``T``
   leave the block.  The best ``k`` by score, then by id, are the answer.

Equal vectors are one class, scored once.  Only the class's ``k`` smallest ids
(and one more, as a query is not its own answer) can be in a result, since
equal scores go to smaller ids, so larger ids of a class are provably out.

Every query block meets every candidate block, as exact search by inner
products must; the blocks are joined on their numbers, no pair of rows is
formed in Spark, and a block's rows hold about ``k`` pairs a query.

Arithmetic is exact: products are taken in 32-bit or 64-bit floats only while
no partial sum can pass their integer range, in 64-bit integers beyond.

Defined cases: a vector that is null, or holds a null or non-finite component,
takes no part.  Missing components of a shorter vector count as zero (an empty
vector scores zero with all).  A row with a null id answers queries (after
equal scores with ids) but is no query.  All rows with a query's id are its own
and none answers it.  Rows with equal id and vector are one entry, and one
query; an id with several vectors is several entries and several queries, each
with its own answer.  Fewer than ``k`` other rows: all of them.  An empty table
gives an empty result.  Components of 2^28 or more after scaling are refused
with a ValueError, as their scores may not fit 64 bits.  Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import drop_stage, pieces_for, stage

SCALE = 64
K = 20
PARTS = 2
QUERY_EVERY = 20
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
#: Query rows scored at a time within a task: 256 x 8192 scores.
ROWS_AT_ONCE = 256
LARGEST = 1 << 28


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null if a component is null or non-finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    inf = float("inf")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (v != inf) & (v != -inf))
    return F.when(vector.isNotNull() & usable, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def top_products(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, scale: int = SCALE,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows by integer inner product.

    Queries are the rows whose id is divisible by ``every``.
    """
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"))
            .where(F.col("v").isNotNull()).distinct())
    entries, entries_path = stage(rows, "topk-entries")
    size = F.array_max(F.transform("v", lambda x: F.abs(x)))
    widest, largest = entries.agg(F.max(F.size("v")), F.max(size)).first()
    if largest is not None and largest >= LARGEST:
        raise ValueError(f"components of {largest} are beyond exact 64-bit scores")
    repeats = entries.where(F.col("id").isNotNull()).groupBy("id").count().agg(F.max("count")).first()[0] or 1
    need = k + repeats  # what a class must hand over: some of it may be the query's own

    by_id = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    ids = (entries.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= need)
           .groupBy("v").agg(F.collect_list(F.struct("id")).alias("ids")))
    asked = F.col("id") % every == 0
    questions = entries.where(asked).select("v").distinct().withColumn("asked", F.lit(True))
    numbered = ids.join(questions, "v", "left").withColumn("class", F.monotonically_increasing_id())
    classes, classes_path = stage(numbered, "topk-classes")

    best = _search(classes, need, int(widest or 1), int(largest or 0))
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    answers = (best.join(classes.select(F.col("class").alias("c"), F.explode("ids").alias("e")), "c")
               .select("q", F.col("e.id").alias("id"), "score")
               .withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= need)
               .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("found")))
    queries = entries.where(asked).join(classes.select("v", F.col("class").alias("q")), "v").select("q", F.col("id").alias("query_id"))
    others = F.filter("found", lambda e: e["id"].isNull() | (e["id"] != F.col("query_id")))
    out, out_path = stage(queries.join(answers, "q").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("p", "e"))
                          .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), "e.score"), "topk")
    drop_stage(spark, entries_path, classes_path)
    return out


def _search(classes: DataFrame, need: int, width: int, largest: int) -> DataFrame:
    """(q, c, score): every pair of a query class and a candidate class that can be among ``need`` entries."""
    kind = _kind(width, largest)
    n_classes, n_queries = classes.agg(F.count("*"), F.count("asked")).first()
    n_cand, n_query = pieces_for(n_classes, CANDIDATE_BLOCK), pieces_for(n_queries, QUERY_BLOCK)
    tasks = max(1, min(n_cand * n_query, 4 * classes.sparkSession.sparkContext.defaultParallelism + n_cand * n_query // 8))

    cands = _blocks(classes.select("class", "v", F.size("ids").alias("n")), n_cand, "c", width)
    cands = cands.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    asked = classes.where("asked").select("class", "v")

    def paired(queries: DataFrame) -> DataFrame:
        spread = queries.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1))))
        keys = ["q_block", "c_block"]
        return spread.repartition(tasks, *keys).join(cands.repartition(tasks, *keys), keys)

    gathered = paired(_blocks(asked.withColumn("n", F.lit(0)), n_query, "q", width)).mapInPandas(_gather(need, width, kind), "q long, score long, n int")
    down = Window.partitionBy("q").orderBy(F.desc("score"))
    limited = gathered.withColumn("r", F.row_number().over(down)).where(F.col("r") <= need)
    enough = F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)) >= need
    cutoffs = limited.withColumn("enough", enough).where("enough").groupBy("q").agg(F.max("score").alias("cutoff"))
    held = asked.join(cutoffs, F.col("class") == F.col("q"), "left").select("class", "v", F.col("cutoff").alias("n"))
    return paired(_blocks(held, n_query, "q", width)).mapInPandas(_collect(width, kind), "q long, c long, score long")


def _kind(width: int, largest: int) -> str:
    """The cheapest type in which sums of ``width`` products are exact integers."""
    bound = width * largest * largest
    return "f4" if bound < 1 << 24 else "f8" if bound < 1 << 53 else "i8"


def _blocks(rows: DataFrame, n: int, side: str, width: int) -> DataFrame:
    """``n`` packed blocks of (class, v, n), dealt by a hash; a block has the mean number of rows, or little more."""
    grouped = rows.groupBy(F.pmod(F.xxhash64("class"), F.lit(n)).cast("int").alias(f"{side}_block")).agg(F.collect_list(F.struct("class", "v", "n")).alias("rows"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, members in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True):
                m = np.zeros((len(members), width), "<i4")
                for i, r in enumerate(members):
                    m[i, :len(r["v"])] = r["v"]
                ids = np.array([r["class"] for r in members], "<i8").tobytes()
                # a query without a cutoff takes whatever there is
                extra = np.array([-(1 << 62) if r["n"] is None else r["n"] for r in members], "<i8").tobytes()
                yield pd.DataFrame({f"{side}_block": [block], f"{side}_ids": [ids], f"{side}_extra": [extra], f"{side}_m": [m.tobytes()]})

    return grouped.mapInPandas(pack, f"{side}_block int, {side}_ids binary, {side}_extra binary, {side}_m binary")


def _pairs(batches: Iterator[pd.DataFrame], width: int, kind: str) -> Iterator[tuple]:
    """Pieces of (query ids, extra, vectors) with (candidate ids, extra, vectors) of the joined blocks."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            c = np.frombuffer(row.c_ids, "<i8"), np.frombuffer(row.c_extra, "<i8"), np.frombuffer(row.c_m, "<i4").reshape(-1, width).astype(kind)
            q = np.frombuffer(row.q_ids, "<i8"), np.frombuffer(row.q_extra, "<i8"), np.frombuffer(row.q_m, "<i4").reshape(-1, width).astype(kind)
            for at in range(0, len(q[0]), ROWS_AT_ONCE):
                yield tuple(x[at:at + ROWS_AT_ONCE] for x in q), c


def _cuts(width: int) -> list[slice]:
    edges = np.linspace(0, width, PARTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _gather(need: int, width: int, kind: str):
    """Phase 1: (q, score, members) of each part's best pairs, scored whole."""
    def run(batches):
        for (q_ids, _, q), (_, members, c) in _pairs(batches, width, kind):
            parts = [q[:, s] @ c[:, s].T for s in _cuts(width)]
            whole, take = sum(parts), min(need, len(c))
            picked = np.zeros(whole.shape, bool)
            for p in parts:
                np.put_along_axis(picked, np.argpartition(p, -take, axis=1)[:, -take:], True, axis=1)
            best = np.argpartition(np.where(picked, whole, np.array(-(1 << 62), kind)), -take, axis=1)[:, -take:]
            yield pd.DataFrame({"q": np.repeat(q_ids, take), "score": np.take_along_axis(whole, best, axis=1).ravel().astype("i8"), "n": members[best.ravel()].astype("i4")})

    return run


def _collect(width: int, kind: str):
    """Phases 2 and 3: the pairs with a part from the uniform threshold on, whole scores of those, and which reach the cutoff."""
    def run(batches):
        for (q_ids, cutoff, q), (c_ids, _, c) in _pairs(batches, width, kind):
            least = -(-cutoff // PARTS)  # parts are integers, so the threshold rounds up
            sent = np.zeros((len(q), len(c)), bool)
            for s in _cuts(width):
                sent |= q[:, s] @ c[:, s].T >= least[:, None]
            qi, ci = np.nonzero(sent)
            for at in range(0, len(qi), 1 << 18):
                a, b = qi[at:at + (1 << 18)], ci[at:at + (1 << 18)]
                score = np.einsum("ij,ij->i", q[a], c[b]).astype("i8")
                keep = score >= cutoff[a]
                yield pd.DataFrame({"q": q_ids[a[keep]], "c": c_ids[b[keep]], "score": score[keep]})

    return run
