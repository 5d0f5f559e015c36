"""Look-back windows (operator W1) and label periods (operator G7)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.metrics import WINDOW_ORDER, WINDOWS


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


@dataclass(frozen=True)
class LookBack:
    """One resolved look-back window."""

    name: str
    start: dt.date
    end: dt.date

    @property
    def days_in_window(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def suffix(self) -> str:
        return "_" + self.name


def check_windows(windows) -> tuple[str, ...]:
    """Validate window names before any Spark job runs (decision D15)."""
    if isinstance(windows, str):
        windows = (windows,)
    windows = tuple(windows)
    for w in windows:
        if w not in WINDOWS:
            raise ValueError(f"unknown window definition: {w!r}; expected one of {WINDOW_ORDER}")
    return windows


def resolve_windows(max_day, windows=WINDOW_ORDER) -> list[LookBack]:
    """Windows anchored on the latest day present in the data."""
    max_day = as_date(max_day)
    out = []
    for w in check_windows(windows):
        back_start, back_end = WINDOWS[w]
        out.append(LookBack(w, max_day - dt.timedelta(days=back_start),
                            max_day - dt.timedelta(days=back_end)))
    return out


def day_bounds(transactions: DataFrame) -> DataFrame:
    """Operator A1: one-row frame with the first and last day."""
    return transactions.agg(F.min("day").alias("min_day"), F.max("day").alias("max_day"))


def collect_max_day(transactions: DataFrame):
    """The latest day, fetched once per run (a one-row aggregate)."""
    row = transactions.agg(F.max("day").alias("max_day")).first()
    return None if row is None else row["max_day"]


def window_bounds_frame(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """Operator W1 as a lazy frame: one row per window from ``day_bounds``.

    The four window offsets are a fixed 4-row table; joining it to the
    one-row bounds frame is expressed as an explode so no join is needed.
    """
    offs = F.array(*[
        F.struct(F.lit(i).alias("window_order"), F.lit(w).alias("window"),
                 F.lit(WINDOWS[w][0]).alias("back_start"), F.lit(WINDOWS[w][1]).alias("back_end"))
        for i, w in enumerate(WINDOW_ORDER)
    ])
    return (bounds.select("max_day", F.explode(offs).alias("w"))
            .select(F.col("w.window_order").alias("window_order"),
                    F.col("w.window").alias("window"),
                    F.date_sub("max_day", F.col("w.back_start")).alias("min_day"),
                    F.date_sub("max_day", F.col("w.back_end")).alias("max_day"))
            .withColumn("days_in_window", F.datediff("max_day", "min_day") + 1))


@dataclass(frozen=True)
class LabelPeriod:
    """Operator G7: features end 30 days before the select date; labels
    cover the 30 days after that (features_end + 1 .. select_date)."""

    select_date: dt.date

    @property
    def features_end_day(self) -> dt.date:
        return self.select_date - dt.timedelta(days=30)

    @property
    def labels_start_day(self) -> dt.date:
        return self.features_end_day + dt.timedelta(days=1)

    @property
    def labels_end_day(self) -> dt.date:
        return self.select_date

    @property
    def label_days(self) -> int:
        return (self.labels_end_day - self.labels_start_day).days + 1


def label_period(select_date) -> LabelPeriod:
    return LabelPeriod(as_date(select_date))
