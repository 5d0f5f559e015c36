"""I-Match document fingerprints with randomised lexicons (operator 7).

A text's terms are its lower-cased runs of letters and digits.  The lexicon
keeps the terms whose inverse document frequency lies in a band, that is,
which occur in at least ``LEAST_SHARE`` and at most ``MOST_SHARE`` of all
documents; as a document holds a bounded number of terms on average, there
are at most that number divided by ``LEAST_SHARE`` such terms, however many
documents there are, so the lexicon is sent to all tasks.

Each randomised lexicon of ``SUBSETS`` keeps every term with the probability
``2 ** -exponent`` given there, by the term's hash.  A text's
fingerprint has one hash per subset, taken over its sorted distinct terms in
that subset.  The sparse subsets survive edits, the dense ones tell near
copies apart.  ``likeness`` is the share of subsets, among those in which
either text has a term, whose hashes agree.

Defined cases: a null text is empty; a text without a term from the lexicon
uses all its terms; the fingerprint of a text without terms is all zeros, and
two such fingerprints have likeness 1; equal texts have equal fingerprints;
rows with a null id come first in the order of ids; repeated ids follow each
other ordered by text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import drop_stage, stage

#: One full lexicon, two dense ones, and three of each sparser rate, so that texts of any length find rates that leave them few terms.
SUBSETS = (0, 2, 4) + (5, 6, 7, 8, 9, 10, 11) * 3
LEAST_SHARE, MOST_SHARE = 0.001, 0.25
_TERM = re.compile(r"[^\W_]+")
#: Distinct terms a task counts before it hands the counts on.
COUNTED_TERMS = 500_000


def terms_of(text: str | None) -> set[str]:
    return set(_TERM.findall(text.lower())) if text else set()


def _term_hash(term: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(term.encode("utf-8", "replace"))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): in how many rows' ``text`` each term occurs, over all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            for text in batch["text"]:
                for t in terms_of(text):
                    seen[t] = seen.get(t, 0) + 1
                if len(seen) >= COUNTED_TERMS:
                    yield pd.DataFrame({"term": list(seen), "n": list(seen.values())})
                    seen = {}
        yield pd.DataFrame({"term": pd.Series(list(seen), dtype=object), "n": list(seen.values())})

    return docs.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> set[str]:
    """Terms in the band of document frequency, out of all documents' terms."""
    total = docs.count()
    band, path = stage(document_frequencies(docs).where((F.col("n") >= least * total) & (F.col("n") <= most * total)).select("term"), "imatch-lexicon")
    terms = {r[0] for r in band.toLocalIterator()}
    drop_stage(docs.sparkSession, path)
    return terms


class Fingerprinter:
    """Fingerprints by one lexicon; remembers the terms' hashes."""

    def __init__(self, terms: set[str]):
        self.known = {t: _term_hash(t) for t in terms}
        self.salts = np.array([int.from_bytes(hashlib.blake2b(b"subset %d" % k, digest_size=8).digest(), "little") | 1 for k in range(len(SUBSETS))], np.uint64)
        self.rates = np.array([(1 << 32) >> e for e in SUBSETS], np.uint64)  # of 32 bits per term and subset

    def __call__(self, terms: set[str]) -> bytes:
        """32 bits per subset; zero where the text has no term."""
        import xxhash

        known = self.known
        ids = [known[t] for t in terms if t in known] or [_term_hash(t) for t in terms]
        if not ids:
            return bytes(4 * len(SUBSETS))
        h = np.unique(np.array(ids, np.uint64))
        keep = (h[None, :] * self.salts[:, None]) >> np.uint64(32) < self.rates[:, None]
        out = [(xxhash.xxh32_intdigest(h[row].tobytes()) or 1) if row.any() else 0 for row in keep]
        return np.array(out, ">u4").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, ">u4"), np.frombuffer(b, ">u4")
    either = (x != 0) | (y != 0)
    return float((x == y)[either].mean()) if either.any() else 1.0


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ROW = "doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """One row per document, with its next document in ascending id order taken for the edit.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shared = spark.sparkContext.broadcast(lexicon(slim, least, most))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def judged(doc_id, text: str, own: bytes, following: str, other: bytes, prints: Fingerprinter) -> tuple:
        edited = edit(text, following)
        edited_print = prints(terms_of(edited))
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own, edited_print, likeness(own, edited_print), likeness(own, other))

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order; the first and the last of a partition are handed on with their texts."""
        prints, part = Fingerprinter(shared.value), TaskContext.get().partitionId()
        held = None
        columns = ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next", "part", "first", "last"]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                own = prints(terms_of(text))
                out.append((*judged(*held, text, own, prints), part, None, None) if held else (None,) * 7 + (part, text, None))
                held = (doc_id, text, own)
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "n_chars": "Int64"})
        if held:
            yield pd.DataFrame([(held[0], None, None, None, None, None, None, part, None, held[1])], columns=columns).astype({"doc_id": "Int64", "n_chars": "Int64"})

    swept, _ = stage(ordered.mapInPandas(sweep, f"{_ROW}, part int, first string, last string"), "imatch")
    # one first and one last row per partition: each last one's next document is the first one of the partition after it
    parts = swept.where("first IS NOT NULL").select("part")
    following = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("after"))
    start = parts.agg(F.min("part")).first()[0]
    after = following.select("part", F.coalesce("after", F.lit(start)).alias("after"))
    firsts = swept.where("first IS NOT NULL").select(F.col("part").alias("after"), F.col("first"))
    open_rows = swept.where("last IS NOT NULL").select("part", "doc_id", "last").join(after, "part").join(firsts, "after")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prints = Fingerprinter(shared.value)
        for batch in batches:
            rows = []
            for doc_id, last, first in zip(batch["doc_id"], batch["last"], batch["first"], strict=True):
                own, other = prints(terms_of(last)), prints(terms_of(first))
                rows.append(judged(None if pd.isna(doc_id) else int(doc_id), last, own, first, other, prints))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _ROW.split(", ")]).astype({"doc_id": "Int64"})

    closed = open_rows.select("doc_id", "last", "first").mapInPandas(close, _ROW)
    whole = swept.where("n_chars IS NOT NULL").select(closed.columns).union(closed)
    hexed = lambda c: F.lower(F.hex(c))
    return whole.select("doc_id", "n_chars", "edited_sha256", hexed("print").alias("fingerprint"), hexed("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")
