"""Vector bin packing of documents into training sequences (operator 9).

A sequence is limited in tokens, in segments and in loss-bearing tokens.
Within a block of documents, ``pack_block`` fills one sequence at a time
and always takes the piece whose demand vector has the largest dot product
with the sequence's remaining room (both as shares of the limits), among the
pieces that fit.  Whole sequences are cut off first; the rest is packed by
that heuristic, which fills the last gap of a sequence with a cut
from the longest waiting piece.  A sequence that still can't be filled is cut
back to the largest power of two, where no padding is due.

Blocks are consecutive documents of an input partition with a bounded number
of rows and tokens, so tasks hold a bounded block, nothing is shuffled, and a
task that is run again gives the same sequences.

Defined cases: a null or empty text is its end id; rows with equal ids are
packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .tokens import WordIds, coder

SEQUENCE_TOKENS = 2048
SEQUENCE_SEGMENTS = 256
BLOCK_ROWS = 1024
BLOCK_TOKENS = 4_000_000
#: Room for sequences of one input partition in ``sequence_id``.
SEQUENCES_PER_PARTITION = 1 << 33


def pack_block(sizes: np.ndarray, loss: np.ndarray, tokens: int, segments: int, loss_tokens: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of one block; a piece is (row, start, length).

    ``loss`` is each document's share of loss-bearing tokens (0 to 1), taken
    as spread evenly over its tokens.
    """
    whole = np.array([min(tokens, int(loss_tokens // x)) if x > 0 else tokens for x in loss], np.int64)
    done: list[list[tuple[int, int, int]]] = []
    rest: list[list[int]] = []  # row, start, length of what waits
    for row, (n, most) in enumerate(zip(sizes, whole, strict=True)):
        cut = n // most * most
        if most == tokens:
            done += [[(row, at, tokens)] for at in range(0, cut, tokens)]
        else:
            rest += [[row, at, int(most)] for at in range(0, cut, most)]
        if n > cut:
            rest.append([row, int(cut), int(n - cut)])
    limits = np.array([tokens, segments, loss_tokens], float)
    while rest:
        row = np.array([r[0] for r in rest])
        demand = np.array([[r[2], 1, r[2] * loss[r[0]]] for r in rest])
        waiting = np.ones(len(rest), bool)
        share, over = demand / limits, []
        while waiting.any():
            room, group = limits.copy(), []
            alive = np.flatnonzero(waiting)
            while True:
                alive = alive[(demand[alive] <= room + 1e-9).all(axis=1)]
                if not len(alive):
                    break
                pick = int(alive[np.argmax(share[alive] @ (room / limits))])
                group.append((int(row[pick]), rest[pick][1], rest[pick][2]))
                room -= demand[pick]
                waiting[pick] = False
                alive = alive[alive != pick]
            left = np.flatnonzero(waiting)
            if len(left) and room[0] >= 1 and room[1] >= 1:  # fill the gap from the longest waiting piece
                k = int(left[np.argmax(demand[left, 0])])
                x = loss[row[k]]
                take = int(min(room[0], rest[k][2] - 1, (room[2] + 1e-9) // x if x > 0 else room[0]))
                if take > 0:
                    group.append((int(row[k]), rest[k][1], take))
                    rest[k] = [rest[k][0], rest[k][1] + take, rest[k][2] - take]
                    demand[k] = [rest[k][2], 1, rest[k][2] * x]
                    share[k] = demand[k] / limits
            held = sum(p[2] for p in group)
            spare = held - (1 << held.bit_length() - 1) if held < tokens else 0
            while spare:  # cut back to a power of two; the end waits again
                r, at, n = group.pop()
                back = min(spare, n)
                over.append([r, at + n - back, back])
                if n > back:
                    group.append((r, at, n - back))
                spare -= back
            done.append(group)
        rest = over
    return done


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, tokens: int = SEQUENCE_TOKENS, segments: int = SEQUENCE_SEGMENTS,
    loss_tokens: int | None = None, loss_col: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
    task_words: int | None = None,
) -> DataFrame:
    """One row per piece of a document in a sequence.

    ``loss_col`` names a column with a document's share of loss-bearing
    tokens (null: 1); without it every token bears loss.  ``with_ids`` adds
    the piece's ids.  By default a Python worker remembers words' ids between
    tasks; with ``task_words`` each task remembers about twice that many and
    forgets them at its end, for executors that serve other stages too.
    """
    loss = F.coalesce(F.col(loss_col).cast("double"), F.lit(1.0)) if loss_col else F.lit(1.0)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), loss.alias("loss"))
    fields = [StructField(n, LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = StructType(fields + [StructField("ids", ArrayType(IntegerType(), False))] * with_ids)
    end, most_loss = np.array([end_id], "<u4").tobytes(), loss_tokens or tokens

    def packed(block: list[tuple], first: int) -> tuple[pd.DataFrame, int]:
        sizes = np.array([len(ids) // 4 for _, ids, _ in block])
        sequences = pack_block(sizes, np.array([x for *_, x in block]), tokens, segments, most_loss)
        rows = []
        for k, pieces in enumerate(sequences):
            offset = 0
            for row, start, length in pieces:
                doc_id, ids, _ = block[row]
                ids = ids[4 * start:4 * (start + length)]
                out = (doc_id, start, length, zlib.crc32(ids), int(sizes[row]), first + k, offset)
                rows.append(out + (np.frombuffer(ids, "<i4"),) * with_ids)
                offset += length
        frame = pd.DataFrame(rows, columns=schema.names)
        return frame.assign(doc_id=frame["doc_id"].astype("Int64")), first + len(sequences)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = coder(WordIds, tokenizer) if task_words is None else WordIds(tokenizer, task_words)
        encode = words.encode
        following = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        block, held = [], 0
        for batch in batches:
            for doc_id, text, x in zip(batch["doc_id"], batch["text"], batch["loss"], strict=True):
                ids = encode(text) + end
                block.append((None if pd.isna(doc_id) else int(doc_id), ids, min(1.0, max(0.0, x))))
                held += len(ids) // 4
                if len(block) >= BLOCK_ROWS or held >= BLOCK_TOKENS:
                    frame, following = packed(block, following)
                    yield frame
                    block, held = [], 0
        if block:
            yield packed(block, following)[0]

    return slim.mapInPandas(run, schema)
