"""Commodity name normalisation (operators F1, F2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the punctuation class replaced by '_' in commodity names
# (hyphen, bar, slash, colon, semicolon, comma, period, double quote,
# apostrophe); spaces are replaced by '_' afterwards.
PUNCTUATION_CLASS = "[-|/:;,.\"']"


def normalize_commodity(c: Column | str) -> Column:
    """Map a commodity name to its feature-table key.

    The pattern is passed as a Column literal, so no SQL string parsing
    rules (escapes, quote doubling) can change it.
    """
    col = F.col(c) if isinstance(c, str) else c
    replaced = F.regexp_replace(col, F.lit(PUNCTUATION_CLASS), F.lit("_"))
    return F.replace(replaced, F.lit(" "), F.lit("_"))


def normalize_commodity_py(name: str | None) -> str | None:
    """Same rule for a driver-side parameter (a single commodity name)."""
    if name is None:
        return None
    out = []
    for ch in name:
        out.append("_" if ch in "-|/:;,.\"' " else ch)
    return "".join(out)
