"""Removal of repeated byte strings by the order of their first ``LENGTH`` bytes (operator 10).

A byte goes if some ``LENGTH``-byte string that covers it also starts in a
document with a smaller id.  A suffix array of the whole corpus would pass
everything through every task, so suffixes are dealt out such that equal
``LENGTH``-byte beginnings meet, and only those that may have an equal:

1. ``_shared_anchors``.  Each string of ``LENGTH`` bytes has an anchor, the
   ``ANCHOR``-byte gram in it with the smallest hash; equal strings have equal
   anchors.  Every shard of documents hands on each of its anchor hashes once,
   packed and dealt by hash range; the ranges answer each shard with those of
   its anchors that occur in more than one document.
2. ``_suffixes``.  Strings with such an anchor are cut into stretches of
   neighbours with one routing gram (``ROUTE`` bytes, smallest hash) and dealt
   by it.  A stretch that a smaller document of the same shard holds too is
   settled there, so a text with very many copies sends one per shard.
3. ``_earlier``.  Each task sorts its suffixes by their first ``LENGTH`` bytes
   (stable, after sorting by document; ``PASS`` at a time, equal beginnings
   together): in this suffix order the previous
   smaller document with a factor of ``LENGTH`` or more, where there is one,
   heads the run of equal beginnings.  A suffix that has one is a later copy.
4. ``_settled``.  Each shard joins the stretches of its documents and removes
   the bytes they cover.

Anchors only choose candidates; steps 2 and 3 compare bytes.  Tasks hold a
shard (about ``SHARD_BYTES`` of text, or one longer text), a hash range of
bounded size, or all stretches of one routing gram, which have no bound.

Defined cases: a null or empty text has no bytes; texts shorter than
``LENGTH`` lose nothing; a document with a null id neither removes nor loses
anything; rows with one id do not remove from each other; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import drop_stage, pieces_for, release_memory, stage, text_bytes, unused

LENGTH = 50
ANCHOR = 32
ROUTE = 12
SHARD_BYTES = 4 << 20
#: Text bytes whose anchors, or whose suffixes if all were candidates, make up one hash range.
RANGE_BYTES = 32 << 20
BLOCK = 1 << 19
#: Suffixes that a task of step 3 sorts at a time.
PASS = 1 << 18
#: A stretch never covers more starts than this.
STRETCH = 4096
_HASH_BITS = 48

_BYTES = np.random.Generator(np.random.PCG64(50)).integers(0, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15


def _rolling(x: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of all grams of ``width`` values, by doubling."""
    n, have, out = len(x) - width + 1, 0, None
    power, part, size = _STEP, x, 1
    while True:
        if width & size:
            if out is None:
                out, have = part, size
            else:  # the part of `size` values goes before what is there
                out = part[:len(out) - size] * np.uint64(pow(_STEP, have, 1 << 64)) + out[size:] if len(out) > size else out[:0]
                have += size
        if size * 2 > width:
            break
        part = part[:-size] * np.uint64(power) + part[size:] if len(part) > size else part[:0]
        power = power * power % (1 << 64)
        size *= 2
    out = out[:max(0, n)]
    out = (out ^ out >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(29)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, size = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size:width - size + n])


class _Shard:
    """Texts of a shard end to end, read in overlapping blocks."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(begin, document of each start, whether LENGTH bytes follow, hashed bytes)."""
        for begin in range(0, len(self.buffer) - LENGTH + 1, BLOCK):
            values = _BYTES[self.buffer[begin:begin + BLOCK + LENGTH - 1]]
            at = np.arange(begin, begin + len(values) - LENGTH + 1)
            doc = np.searchsorted(self.ends, at, side="right")
            yield begin, doc, at + LENGTH <= self.ends[doc], values


def _spread(least: np.ndarray) -> np.ndarray:
    """Smallest hashes crowd near zero; this spreads them evenly again."""
    out = least * np.uint64(0x94D049BB133111EB)
    return (out ^ out >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)


def _anchors(values: np.ndarray) -> np.ndarray:
    return _spread(_sliding_min(_rolling(values, ANCHOR), LENGTH - ANCHOR + 1)) >> np.uint64(64 - _HASH_BITS)


def _packed(sorted_hashes: np.ndarray) -> bytes:
    """Sorted 48-bit integers as differences, their bytes grouped by place."""
    return np.diff(sorted_hashes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[:6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def _sharded(docs: DataFrame, shards: int) -> DataFrame:
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    return docs.withColumn("shard", shard).repartition(shards, "shard")


def _texts(frame: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    """Rows in a settled order: ids and texts (an id's rows by text)."""
    texts = [t.encode("utf-8", "replace") for t in frame["text"]]
    order = sorted(range(len(texts)), key=lambda i: (frame["doc_id"].iat[i], texts[i]))
    return frame["doc_id"].to_numpy(np.int64)[order], [texts[i] for i in order]


def _shared_anchors(sharded: DataFrame, ranges: int) -> DataFrame:
    """(shard, hashes): a shard's anchors that occur in more than one document."""

    def collect(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        release_memory()  # of the shard before, and of earlier stages
        ids, texts = _texts(frame)
        shard, hashes, docs = _Shard(texts), [], []
        for _, doc, whole, values in shard.blocks():
            anchor = _anchors(values)
            new = whole.copy()
            new[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]
            hashes.append(anchor[new])
            docs.append(ids[doc[new]])
        if not hashes:
            return pd.DataFrame(columns=["range", "shard", "hashes", "several"])
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(h)
        h, d = h[order], d[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))[: len(h)]
        if not len(h):
            return pd.DataFrame(columns=["range", "shard", "hashes", "several"])
        several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
        h = h[first]
        bound = np.searchsorted(h, [(r << _HASH_BITS) // ranges for r in range(ranges + 1)])
        rows = [(r, int(key[0]), _packed(h[a:b]), np.packbits(several[a:b]).tobytes()) for r, (a, b) in enumerate(zip(bound[:-1], bound[1:], strict=True)) if b > a]
        return pd.DataFrame(rows, columns=["range", "shard", "hashes", "several"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        parts = [_unpacked(x) for x in frame["hashes"]]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8))[:len(p)].astype(bool) for x, p in zip(frame["several"], parts, strict=True)]
        h = np.concatenate(parts)
        order = np.argsort(h, kind="stable")
        s = h[order]
        near = np.zeros(len(s), bool)
        near[1:] = s[1:] == s[:-1]
        near[:-1] |= near[1:].copy()
        shared = np.concatenate(flags)
        shared[order[near]] = True
        # an anchor that one shard alone has in several documents is flagged there already
        out, at = [], 0
        for shard, p in zip(frame["shard"], parts, strict=True):
            mine = p[shared[at:at + len(p)]]
            at += len(p)
            if len(mine):
                out.append((int(shard), _packed(mine)))
        return pd.DataFrame(out, columns=["shard", "hashes"])

    packed = sharded.groupBy("shard").applyInPandas(collect, "range int, shard int, hashes binary, several binary")
    return packed.groupBy("range").applyInPandas(meet, "shard int, hashes binary")


def _stretches(shard: _Shard, shared: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first start, number of starts, routing hash) of candidate stretches, block by block."""
    for begin, doc, whole, values in shard.blocks():
        anchor = _anchors(values)
        at = np.minimum(np.searchsorted(shared, anchor), max(0, len(shared) - 1))
        wanted = whole & (shared[at] == anchor) if len(shared) else np.zeros(len(whole), bool)
        if not wanted.any():
            continue
        route = _spread(_sliding_min(_rolling(values, ROUTE), LENGTH - ROUTE + 1))
        here = np.flatnonzero(wanted)
        new = np.ones(len(here), bool)
        new[1:] = (np.diff(here) != 1) | (route[here[1:]] != route[here[:-1]]) | (doc[here[1:]] != doc[here[:-1]])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(here)))
        if (count > STRETCH).any():
            first = np.concatenate([np.arange(f, f + c, STRETCH) for f, c in zip(first, count, strict=True)])
            count = np.diff(np.append(first, len(here)))
        lead = here[first]
        yield doc[lead], lead + begin, count, route[lead]


def _joined(spans: np.ndarray) -> np.ndarray:
    """Sorted spans (start, end), touching ones joined."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack((spans[first, 0], reach[np.append(first[1:] - 1, len(spans) - 1)]), axis=1)


_STEP2 = "kind int, shard int, bucket int, doc_id long, copy int, text binary, docs binary, copies binary, starts binary, counts binary, spans binary"
_STEP2_COLUMNS = [x.split()[0] for x in _STEP2.split(", ")]
_DONE, _OPEN, _SEND = 0, 1, 2


def _suffixes(sharded: DataFrame, anchors: DataFrame, ranges: int) -> DataFrame:
    """Per shard: finished documents, documents with candidates (text, settled spans), and stretches to compare."""

    def cut(key: tuple, docs: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=_STEP2_COLUMNS)
        release_memory()
        number = int(key[0])
        ids, texts = _texts(docs)
        copy = np.zeros(len(ids), np.int64)
        for i in range(1, len(ids)):
            copy[i] = copy[i - 1] + 1 if ids[i] == ids[i - 1] else 0
        shard = _Shard(texts)
        shared = np.unique(np.concatenate([_unpacked(x) for x in reply["hashes"]])) if len(reply) else np.zeros(0, np.uint64)
        found = [np.concatenate(x) for x in zip(*_stretches(shard, shared), strict=True)] if len(shared) else []
        settled: dict[int, list] = {}
        rows, touched = [], np.zeros(len(ids), bool)
        if found:
            doc, start, count, route = found
            touched[doc] = True
            data = shard.buffer.tobytes()
            least: dict[bytes, int] = {}
            pieces = [data[a:a + n + LENGTH - 1] for a, n in zip(start.tolist(), count.tolist(), strict=True)]
            owner = ids[doc].tolist()
            for piece, i in zip(pieces, owner, strict=True):
                if least.setdefault(piece, i) > i:
                    least[piece] = i
            send = np.array([least[p] == i for p, i in zip(pieces, owner, strict=True)])
            local = np.flatnonzero(~send)
            for d, a, n in zip(doc[local].tolist(), (start - shard.starts[doc])[local].tolist(), count[local].tolist(), strict=True):
                settled.setdefault(d, []).append((a, a + n + LENGTH - 1))
            bucket = (route >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            kept = np.flatnonzero(send)
            kept = kept[np.argsort(bucket[kept], kind="stable")]
            bound = np.searchsorted(bucket[kept], np.arange(ranges + 1))
            for b in np.flatnonzero(np.diff(bound)):
                mine = kept[bound[b]:bound[b + 1]]
                rows.append((
                    _SEND, number, int(b), None, None, b"".join([pieces[i] for i in mine]), ids[doc[mine]].astype("<i8").tobytes(), copy[doc[mine]].astype("<i4").tobytes(),
                    (start - shard.starts[doc])[mine].astype("<i8").tobytes(), count[mine].astype("<i4").tobytes(), None,
                ))
        for i, text in enumerate(texts):
            spans = _joined(np.array(settled[i], np.int64)).astype("<i8").tobytes() if i in settled else b""
            kind = _OPEN if touched[i] else _DONE
            rows.append((kind, number, None, int(ids[i]), int(copy[i]), text if kind == _OPEN else hashlib.sha256(text).digest(), None, None, None, len(text).to_bytes(8, "big"), spans))
        frame = pd.DataFrame(rows, columns=_STEP2_COLUMNS)
        return frame.astype({"bucket": "Int32", "doc_id": "Int64", "copy": "Int32"})

    return sharded.groupBy("shard").cogroup(anchors.groupBy("shard")).applyInPandas(cut, _STEP2)


def _passes(text: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The suffixes at ``at`` in ascending groups of about ``PASS``; equal beginnings share a group."""
    groups = -(-len(at) // PASS)
    key = np.zeros(len(at), np.uint32)
    for place in range(0, LENGTH, 7):
        key = (key ^ text[at + place]) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
    key %= np.uint32(max(1, groups))
    for g in range(groups):
        yield np.flatnonzero(key == g)


def _earlier(stretches: DataFrame) -> DataFrame:
    """(shard, docs, copies, starts, ends): spans covered by strings that start in a smaller document."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        joined = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in frame[name]])
        docs, copies, starts, counts = joined("docs", "<i8"), joined("copies", "<i4"), joined("starts", "<i8"), joined("counts", "<i4").astype(np.int64)
        text = np.frombuffer(b"".join(frame["text"]), np.uint8)
        begin = np.cumsum(counts + LENGTH - 1) - (counts + LENGTH - 1)
        shard = np.repeat(frame["shard"].to_numpy(), [len(x) // 8 for x in frame["docs"]])
        by_doc = np.argsort(docs, kind="stable")
        n = counts[by_doc]
        stretch = np.repeat(by_doc, n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = begin[stretch] + inside
        heads = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
        later = np.zeros(len(at), bool)
        for mine in _passes(text, at):
            suffix = np.ascontiguousarray(heads[at[mine]]).view(f"S{LENGTH}").ravel()
            order = np.argsort(suffix, kind="stable")
            ordered = suffix[order]
            new = np.ones(len(order), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            order = mine[order]
            head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the previous smaller document of each run
            later[order] = docs[stretch[order]] > docs[stretch[head]]
        del at
        hit = np.flatnonzero(later)
        if not len(hit):
            return pd.DataFrame(columns=["shard", "docs", "copies", "starts", "ends"])
        edge = np.ones(len(hit), bool)
        edge[1:] = (np.diff(hit) != 1) | (stretch[hit[1:]] != stretch[hit[:-1]])
        first = hit[np.flatnonzero(edge)]
        last = hit[np.append(np.flatnonzero(edge)[1:] - 1, len(hit) - 1)]
        owner = stretch[first]
        out = []
        for s in np.unique(shard[owner]):
            mine = shard[owner] == s
            o = owner[mine]
            out.append((int(s), docs[o].tobytes(), copies[o].tobytes(), (starts[o] + inside[first[mine]]).astype("<i8").tobytes(), (starts[o] + inside[last[mine]] + LENGTH).astype("<i8").tobytes()))
        return pd.DataFrame(out, columns=["shard", "docs", "copies", "starts", "ends"])

    return stretches.groupBy("bucket").applyInPandas(compare, "shard int, docs binary, copies binary, starts binary, ends binary")


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text_sha256 string, kept binary"
_RESULT_COLUMNS = [x.split()[0] for x in _RESULT.split(", ")]


def _settled(open_docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Results of the documents with candidates."""

    def remove(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=_RESULT_COLUMNS)
        parts = []
        for row in found.itertuples():
            parts.append(np.stack([np.frombuffer(row.docs, "<i8"), np.frombuffer(row.copies, "<i4").astype(np.int64), np.frombuffer(row.starts, "<i8"), np.frombuffer(row.ends, "<i8")], axis=1))
        table = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        rows = []
        for doc_id, copy, text, local in zip(docs["doc_id"], docs["copy"], docs["text"], docs["spans"], strict=True):
            a, b = np.searchsorted(table[:, 0], [doc_id, doc_id + 1])
            mine = table[a:b]
            mine = np.concatenate((mine[mine[:, 1] == copy][:, 2:], np.frombuffer(local, "<i8").reshape(-1, 2)))
            kept, removed = text, 0
            if len(mine):
                mine = _joined(mine)
                removed = int((mine[:, 1] - mine[:, 0]).sum())
                edges = [0, *mine.ravel().tolist(), len(text)]
                kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
            rows.append((int(doc_id), len(text), removed, len(mine), hashlib.sha256(kept).hexdigest(), hashlib.sha256(text).hexdigest(), kept if removed else None))
        return pd.DataFrame(rows, columns=_RESULT_COLUMNS)

    return open_docs.groupBy("shard").cogroup(spans.groupBy("shard")).applyInPandas(remove, _RESULT)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    text_sha256 (of the input), kept (the remaining bytes, null if all remain)."""
    spark = docs.sparkSession
    all_docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    slim = all_docs.where("doc_id IS NOT NULL")
    size = text_bytes(slim)
    shards, ranges = pieces_for(size, SHARD_BYTES), pieces_for(size, RANGE_BYTES)
    sharded = _sharded(slim, shards)
    anchors, anchors_path = stage(_shared_anchors(sharded, ranges), "repeat-anchors")
    # as many suffix ranges as if every string were a candidate, at a tenth of the bytes each
    split, _ = stage(_suffixes(sharded, anchors, pieces_for(size, RANGE_BYTES // 8)), "repeat-suffixes")
    drop_stage(spark, anchors_path)
    spans, _ = stage(_earlier(split.where(F.col("kind") == _SEND).select("bucket", "shard", "text", "docs", "copies", "starts", "counts")), "repeat-spans")
    done = split.where(F.col("kind") == _DONE)
    n_bytes = F.conv(F.hex("counts"), 16, 10).cast("long")
    sha = F.lower(F.hex("text"))
    whole = done.select("doc_id", n_bytes.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), sha.alias("kept_sha256"), sha.alias("text_sha256"), F.lit(None).cast("binary").alias("kept"))
    nameless = all_docs.where("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.lit(None).cast("binary").alias("kept"),
    )
    open_docs = split.where(F.col("kind") == _OPEN).select("shard", "doc_id", "copy", "text", "spans")
    return whole.union(_settled(open_docs, spans)).union(nameless)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings removed from ``text`` (``n_chars``, if there is one, follows).

    A cut inside a character drops what is left of it; documents of which
    nothing but white space remains are dropped.  Other columns, whatever
    their names, pass through; an empty table stays empty.
    """
    id_col, sha_col, kept_col = unused(docs, "_id", "_sha", "kept")
    changed = repeats(docs).where("n_removed > 0").select(F.col("doc_id").alias(id_col), F.col("text_sha256").alias(sha_col), F.col("kept").alias(kept_col)).dropDuplicates([id_col, sha_col])  # dealt by the join's keys, so the texts move once
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    joined = docs.join(changed, (F.col(id_col) == F.col("doc_id")) & (F.col(sha_col) == sha), "left")

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode("utf-8", "ignore") if b is not None else None)

    cut = F.col(kept_col).isNotNull()
    out = joined.withColumn("text", F.when(cut, decoded(kept_col)).otherwise(F.col("text"))).where(~cut | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
