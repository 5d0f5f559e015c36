"""Benchmark decontamination by winnowing (operator 5, DataFrame functions only).

Every text becomes lower-cased words.  Of each run of ``GRAM_WORDS``-word
grams the smallest hash per sliding window of ``GRAMS`` grams is kept, with
its place (the leftmost on ties).  A span of
``GRAM_WORDS + GRAMS - 1 = WINDOW`` words that a document shares with an item
is one such window in both, so both keep the same gram of it: joining the
fingerprints misses no shared window.  Items shorter than ``WINDOW`` words
have one fingerprint, the hash of all their words, which is joined with the
documents' grams of that length; only lengths that occur are computed.

A joined fingerprint fixes how item and document lie against each other.  The
hit is then extended over the whole item in that position by comparing the
words themselves, so hash collisions never count.

Defined cases: a null text has no words; an item without words matches
nothing; an item with a null id hits words but is not counted or listed;
repeated documents or items change nothing for the others; extra columns are
kept by ``annotate`` and ignored by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stage, unused

WINDOW = 10
GRAM_WORDS = 5
GRAMS = WINDOW - GRAM_WORDS + 1
#: Fingerprint rows of the items up to which they are sent to all executors (24 bytes each).
BROADCAST_ROWS = 500_000
#: A kept gram is one long: hash bits above, place below.
PLACE_BITS = 30
_PLACE = (1 << PLACE_BITS) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at ASCII other than letters and digits."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _BETWEEN), ""), F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _steps(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gram(words: Column, i: Column, length: int) -> Column:
    """Hash and place of the gram of ``length`` words at ``i`` in one long."""
    h = F.xxhash64(*[words[i + t] for t in range(length)])
    return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long"))


def winnowed(words: Column) -> Column:
    """Kept grams of a text's words (none below ``WINDOW`` words)."""

    def pick(grams: Column) -> Column:
        least = F.transform(_steps(F.size(grams) - GRAMS + 1), lambda i: F.least(*[grams[i + t] for t in range(GRAMS)]))
        return F.array_distinct(least)

    return _let(words, lambda w: _let(F.transform(_steps(F.size(w) - GRAM_WORDS + 1), lambda i: _gram(w, i, GRAM_WORDS)), pick))


def _all_grams(words: Column, length: int) -> Column:
    return _let(words, lambda w: F.transform(_steps(F.size(w) - length + 1), lambda i: _gram(w, i, length)))


def _fingerprints(rows: DataFrame, key: str, words: str, whole: bool, lengths: list[int]) -> DataFrame:
    """(key, length, hash, place); length is WINDOW for winnowed grams, else that of a short item."""

    def sized(grams: Column, n: int) -> Column:
        return F.transform(grams, lambda g: F.struct(F.lit(n).alias("length"), g.alias("gram")))

    kinds = [sized(winnowed(F.col(words)), WINDOW)]
    for n in lengths:
        grams = sized(_all_grams(F.col(words), n), n)
        kinds.append(F.when(F.size(words) == n, grams) if whole else grams)
    every = F.concat(*[F.coalesce(k, F.array().cast("array<struct<length:int,gram:bigint>>")) for k in kinds]) if len(kinds) > 1 else kinds[0]
    found = rows.select(key, F.explode(every).alias("g"))
    gram = F.col("g.gram")
    return found.select(key, F.col("g.length").alias("length"), F.shiftright(gram, PLACE_BITS).alias("hash"), gram.bitwiseAND(F.lit(_PLACE)).cast("int").alias("place"))


def _spans(words: Column, candidate: Column) -> Column:
    """Document places where a window of the candidate's item begins, as (place, length)."""
    item, shift = candidate["words"], candidate["shift"]
    length = F.least(F.lit(WINDOW), F.size(item))
    first = F.greatest(F.lit(0), -shift)
    last = F.least(F.size(item) - length, F.size(words) - length - shift)
    tries = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    same = F.filter(tries, lambda j: F.slice(words, shift + j + 1, length) == F.slice(item, j + 1, length))
    return F.transform(same, lambda j: F.struct((shift + j).alias("place"), length.alias("length")))


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id", into: str = "_contamination") -> DataFrame:
    """All rows and columns of ``docs`` and a struct column ``into``:
    n_words, n_hit, n_items, items_sha256, contaminated.

    ``into`` must be no column of ``docs``; names used on the way give way to its columns.
    """
    text = F.col(text_col).cast("string")
    row, candidate_col = unused(docs, "_row", "_candidates")
    keyed = docs.withColumn(row, F.xxhash64(F.col(id_col).cast("string"), text))
    items, _ = stage(
        benchmark.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(item_text).cast("string")).alias("words"))
        .where(F.size("words") > 0).distinct().withColumn("item", F.xxhash64("item_id", "words")),
        "benchmark-items",
    )
    short = [r[0] for r in items.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().collect()]  # nine values at most
    prints, _ = stage(_fingerprints(items, "item", "words", True, sorted(short)).withColumnRenamed("place", "item_place").distinct(), "benchmark-fingerprints")
    small = prints.count() <= BROADCAST_ROWS
    found = _fingerprints(keyed.select(row, words_of(text).alias("words")), row, "words", False, sorted(short))
    joined = found.join(F.broadcast(prints) if small else prints, ["length", "hash"])
    placed = joined.select(row, "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    candidates = placed.join(items, "item").groupBy(row).agg(F.collect_list(F.struct("item_id", "words", "shift")).alias(candidate_col))

    def judge(words: Column) -> Column:
        per_item = F.transform(F.col(candidate_col), lambda c: F.struct(c["item_id"].alias("item_id"), _spans(words, c).alias("spans")))
        hits = F.filter(F.coalesce(per_item, F.array().cast("array<struct<item_id:string,spans:array<struct<place:int,length:int>>>>")), lambda h: F.size(h["spans"]) > 0)

        def sums(hit: Column) -> Column:
            places = F.flatten(F.transform(hit, lambda h: F.flatten(F.transform(h["spans"], lambda s: F.sequence(s["place"], s["place"] + s["length"] - 1)))))
            ids = F.array_sort(F.array_distinct(F.filter(F.transform(hit, lambda h: h["item_id"]), lambda x: x.isNotNull())))
            n_hit = F.size(F.array_distinct(places)).cast("long")
            return F.struct(
                F.size(words).cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
            )

        return _let(hits, sums)

    judged = keyed.join(candidates, row, "left").withColumn(into, _let(words_of(text), judge))
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns], into)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(slim, benchmark).select("doc_id", "_contamination.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    (into,) = unused(docs, "_contamination")
    return annotate(docs, benchmark, into=into).where(~F.col(f"{into}.contaminated")).drop(into)
