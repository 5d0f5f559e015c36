"""Exact token counts of every prefix, by prefix dynamic programming (operator 3).

``prefix_counts`` adds, per text, a table of the token count of each of its
prefixes.  Truncation and budget questions are then lookups:

* ``count_at(table, i)``: tokens of the first ``i`` code points (a SQL expression);
* ``total(table)``: tokens of the whole text (a SQL expression);
* ``longest_prefix(budget)``: most code points whose tokens stay within a budget.

The table is a binary column of big-endian 32-bit counts, one for every code
point and one for the empty prefix, so JVM expressions read it directly.

Defined cases: a null or empty text has the table ``[0]``; other columns of
the input, nulls in them, ties and repeated rows pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .tokens import PrefixCounts, coder

#: Code points whose tables leave a task in one Arrow batch.
BATCH_CHARS = 2_000_000


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, prefix_tokens) for every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file that each executor has.
    """
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = StructType([slim.schema[0], StructField(text_col, StringType()), StructField("prefix_tokens", BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = coder(PrefixCounts, tokenizer).counts
        for batch in batches:
            texts = batch.iloc[:, 1]
            sizes = texts.str.len().fillna(0).to_numpy(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_CHARS)) + 1
            for rows in np.split(np.arange(len(batch)), cuts):
                part = batch.iloc[rows].copy()
                part["prefix_tokens"] = [counts(t).astype(">u4").tobytes() for t in part.iloc[:, 1]]
                yield part

    return slim.mapInPandas(run, schema)


def count_at(prefix_tokens: Column, i: Column | int) -> Column:
    """Tokens of the first ``i`` code points; null beyond the text's end."""
    at = F.lit(i) if isinstance(i, int) else i
    cell = F.substring(prefix_tokens, at.cast("int") * 4 + 1, 4)
    return F.when(F.octet_length(cell) == 4, F.conv(F.hex(cell), 16, 10).cast("long"))


def total(prefix_tokens: Column) -> Column:
    """Tokens of the whole text."""
    return F.conv(F.hex(F.substring(prefix_tokens, -4, 4)), 16, 10).cast("long")


def longest_prefix(budget: int):
    """A column function: the most code points whose tokens number ``budget`` at most."""

    @F.pandas_udf(LongType())
    def longest(tables: pd.Series) -> pd.Series:
        fits = (np.flatnonzero(np.frombuffer(t, ">u4") <= budget) for t in tables)
        return pd.Series([int(f[-1]) if len(f) else 0 for f in fits], dtype="int64")

    return longest
