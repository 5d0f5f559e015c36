"""SimHash near-duplicates by a byte-position inverted index (operator 4).

A 64-bit fingerprint has eight byte positions.  Two fingerprints that differ
in at most two bits differ in at most two bytes, so they share the byte at
six or more positions: six is the guaranteed minimum of the count filter.  A
posting for one position and byte would hold a 256th of all fingerprints, and
tallying pairs over such postings grows with the square of the input.  The
postings here are therefore keyed by six positions and their bytes (28 keys
for each distinct fingerprint): a pair meets in a posting exactly if its tally
of shared positional bytes reaches the minimum.

Members of a posting differ only in the two bytes left over, so a posting has
65,536 distinct members at most.  Each is verified on those 16 bits against
the members with one or two bits flipped, and the posting returns links to
the smallest member of each linked part instead of all its pairs.  Equal
fingerprints were folded before, so copies never meet as pairs.

Defined cases: a null or empty text has fingerprint zero and links like any
other; a null id is never a component's smallest id (its component has the
smallest other id, or null); repeated rows get one result each.  Of every
component one row stays, also of one with null ids only: the row with the
smallest id (null ids last) and, among rows of that id, the smallest text hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from .common import drop_stage, release_memory, stage, unused
from .components import connected_components

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of a text; words are split at ASCII white space."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(shingle_words, len(words))
    hash64 = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    hashes = np.array([hash64(line[a:b], HASH_SEED) for a, b in zip(starts[:n].tolist(), ends[width - 1:].tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def simhash_column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([simhash(t) for t in texts], dtype="int64")
    release_memory()


#: Bits flipped in the 16 left-over bits: none of them, one or two.
_FLIPS = np.array([1 << i for i in range(16)] + [1 << i | 1 << j for i, j in combinations(range(16), 2)], np.int64)


def _linked(rest: np.ndarray) -> np.ndarray:
    """For each distinct 16-bit value the position of the smallest-position member of its linked part."""
    n = len(rest)
    root = np.arange(n)
    if n <= 64:
        gap = np.bitwise_count(rest[:, None] ^ rest[None, :])
        a, b = np.nonzero(np.triu(gap <= MAX_BITS, 1))
    else:
        at = np.full(1 << 16, -1, np.int64)
        at[rest] = np.arange(n)
        pairs = []
        for flip in _FLIPS:
            other = at[rest ^ flip]
            here = np.flatnonzero(other > np.arange(n))
            pairs.append(np.stack((here, other[here])))
        a, b = np.concatenate(pairs, axis=1)
    while True:  # smallest label over links, with pointer jumping
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``fp``) that connect all pairs within two bits.

    Every returned link is itself a pair's connection inside one posting;
    its ends may be joined through other members of that posting.
    """
    keys = []
    for k, (i, j) in enumerate(combinations(range(8), 2)):
        left_over = (0xFF << 8 * i) | (0xFF << 8 * j)
        mask = ~left_over & 0xFFFFFFFFFFFFFFFF
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(k).alias("positions"), F.col("fp").bitwiseAND(F.lit(signed)).alias("shared")))
    postings = (
        fingerprints.select("fp", F.explode(F.array(*keys)).alias("key"))
        .groupBy("key.positions", "key.shared").agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("positions", "members")
    )
    pairs = list(combinations(range(8), 2))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for positions, members in zip(batch["positions"], batch["members"], strict=True):
                fp = np.sort(np.asarray(members, np.int64))
                i, j = pairs[positions]
                rest = (fp >> 8 * i & 0xFF) | (fp >> 8 * j & 0xFF) << 8
                root = _linked(rest)
                linked = root != np.arange(len(fp))
                a.append(fp[linked])
                b.append(fp[root[linked]])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}) if a else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return postings.mapInPandas(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash_column(F.col(text_col).cast("string")).alias("fp"))
    rows, _ = stage(slim, "simhash")
    distinct, distinct_path = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    rooted = _rooted(distinct)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(distinct: DataFrame) -> DataFrame:
    """The staged rows of distinct fingerprints (column ``fp``) with the ``root`` of their component."""
    edges, edges_path = stage(links(distinct.select("fp")), "simhash-links")
    roots, _ = connected_components(edges)
    drop_stage(distinct.sparkSession, edges_path)
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each component the row with the smallest (id, text hash), null ids last.

    The row's key is its id with the 64-bit hash of its text.  Only rows whose
    key occurs more than once are compared by text; all others pass the join
    with the kept keys as they are.
    """
    row = F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("id"), _text_hash().alias("hash")
    keys = docs.select(simhash_column(F.col("text").cast("string")).alias("fp"), *row).groupBy("fp", "no_id", "id", "hash").agg(F.count("*").alias("copies"))
    least = F.min(F.struct("no_id", "id", "hash", "copies")).alias("least")
    distinct, _ = stage(keys.groupBy("fp").agg(least), "simhash-distinct")
    kept, _ = stage(_rooted(distinct).groupBy("root").agg(F.min("least").alias("least")).select("least.id", "least.hash", "least.copies"), "simhash-kept")
    (hash_col,) = unused(docs, "kept_hash")
    keyed = docs.withColumn(hash_col, _text_hash())
    same = keyed["doc_id"].cast("long").eqNullSafe(kept["id"]) & (keyed[hash_col] == kept["hash"])
    once = keyed.join(kept.where("copies = 1"), same, "left_semi")
    repeated = keyed.join(kept.where("copies > 1"), same, "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"])).drop(hash_col)
