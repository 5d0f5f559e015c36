"""Feature tables from stored, mergeable state instead of the whole history.

New transactions are absorbed into one keyed table of the feature store,
partitioned by month (``select_date`` holds the first day of the month):

``state_items``  per household, commodity, day, basket and product: line items,
                 products, the money sums, line items with each discount

Sums add up over its rows, and the entities of the distinct counts (the day, a
basket, a product) are columns of it, so both levels are read from one table
and a line item is shuffled and written once.

Rows carry the batch that brought them, which is part of their key.  A batch
reads only its own transactions; a batch that is tried again replaces its own
rows, and late rows rewrite only their months' partitions.

A feature table of any date needs of these

* the top commodities: distinct baskets per commodity, over two columns;
* the in-window months, for sums and distinct counts;
* for days-since, per window end, the latest day with each discount and
  whether a row lacks it.  That is kept as of the first day of a month in a
  folder named after the month and the state it was made from, built from the
  nearest earlier folder and the months between, so a run merges the newest
  months only.  Late rows change the state of their month, hence the names of
  the folders from there on; those are then built again from the last one
  before, not from the facts.

The products' commodities are looked up when rows are absorbed; a product that
moves to another commodity keeps its absorbed history where it was.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import as_date, resolve_windows
from cartwise.functions.metrics import DISCOUNTS, MONEY, WINDOW_ORDER
from cartwise.functions.text import normalize_commodity
from cartwise.operators.feature_tables import PAIR, FeatureInputs, assemble
from cartwise.operators.features import in_any_window, latest_days, stack_entities
from cartwise.operators.spine import TOP_N, commodity_purchases
from cartwise.session import materialize, stage_path
from cartwise.sources.store import PARTITION, FeatureStore
from cartwise.sources.tables import pieces, with_commodity

ITEMS, HISTORY = "state_items", "state_history"
DAILY = ENTITIES = ITEMS  # the levels that the table serves
#: Absorbed rows that one partition of the state's shuffle stands for.
PIECE_ROWS = 500_000
#: Dates that are built side by side share the folders of ``history_before``.
_HISTORY_WRITES = threading.Lock()


def absorb(transactions: DataFrame, products: DataFrame, store: FeatureStore, batch: str, n_rows: int = 0) -> None:
    """Merge new (or late, or repeated) transactions into the state; reads nothing but them and the months they touch.

    ``n_rows`` is their number, for transactions that do not come from files by themselves.
    """
    spark = transactions.sparkSession
    tx = with_commodity(transactions, products)
    # a month's rows go to a few tasks by household, to one on a small cluster with few rows
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), pieces(tx) or 0, n_rows // PIECE_ROWS)
    share = F.pmod(F.xxhash64(PAIR[0]), F.lit(max(1, parts // 64)))
    dealt = tx.withColumn(PARTITION, F.trunc("day", "MM")).withColumn("share", share).repartition(parts, PARTITION, "share")
    with_discount = [F.sum(F.when(F.col(d) > 0, 1)).cast("long").alias(f"with_{i}") for i, d in enumerate(DISCOUNTS)]
    # the keys hold what the rows were dealt by, so they are grouped where they are
    rows = (dealt.groupBy(PARTITION, "share", *PAIR, "day", "basket_id", "product_id")
            .agg(F.count(F.lit(1)).alias("line_items"), F.count("product_id").alias("products"), *[F.sum(m).alias(m) for m in MONEY], *with_discount)
            .drop("share").withColumn("batch", F.lit(batch)))
    store.create_table(ITEMS, [*PAIR, "day", "basket_id", "product_id", "batch", PARTITION], rows.schema, "state of the feature tables")
    store.write_table(ITEMS, rows)


def _months(store: FeatureStore) -> list[dt.date]:
    return [dt.date.fromisoformat(m) for m in store.snapshot(DAILY).dates() if m[:1].isdigit()]


def _in_months(store: FeatureStore, name: str, months: list[dt.date]) -> DataFrame:
    """Rows of these months; other months' folders are not listed."""
    return store.read_dates(name, months).withColumn("commodity_desc", normalize_commodity("commodity_desc"))


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def latest_day(store: FeatureStore, select_date: dt.date) -> dt.date | None:
    """The last stored day up to a date; looks at one month, or at earlier ones while it holds none."""
    for m in sorted((m for m in _months(store) if m <= select_date), reverse=True):
        found = store.read_table(DAILY, m).filter(F.col("day") <= F.lit(select_date)).agg(F.max("day")).first()[0]
        if found is not None:
            return found
    return None


def top_commodities(store: FeatureStore, n: int = TOP_N) -> list[str]:
    """The commodities with most baskets over all days, by name among equals, normalised."""
    per = commodity_purchases(store.read_table(ENTITIES))
    ranked = per.orderBy(F.desc("purchases"), F.asc("commodity_desc")).limit(n).select(normalize_commodity("commodity_desc").alias("name"), "purchases", "commodity_desc").collect()
    ranked.sort(key=lambda r: (-r["purchases"], r["commodity_desc"] is not None, r["commodity_desc"] or ""))
    return list(dict.fromkeys(r["name"] for r in ranked))


def _since_parts(daily: DataFrame) -> DataFrame:
    """(household, commodity, last_i, rest_i): latest day with each discount, whether a row lacks it."""
    parts = []
    for i, _ in enumerate(DISCOUNTS):
        n = F.coalesce(F.col(f"with_{i}"), F.lit(0))
        parts += [F.max(F.when(n > 0, F.col("day"))).alias(f"last_{i}"), F.max(F.when(F.col("line_items") > n, 1)).alias(f"rest_{i}")]
    return daily.groupBy(*PAIR).agg(*parts)


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*PAIR).agg(*[F.max(c).alias(c) for c in parts.columns if c not in PAIR])


def _basis(store: FeatureStore, month: dt.date) -> str:
    """A name for the stored rows before a month: it changes exactly if they may have."""
    before = sorted((p, w) for p, w in store.snapshot(DAILY).parts.items() if p.split("=", 1)[1] < month.isoformat())
    return hashlib.sha256(repr(before).encode()).hexdigest()[:16]


def history_before(store: FeatureStore, month: dt.date) -> DataFrame | None:
    """Days-since parts over all days before a month, from the nearest stored ones; None without such days."""
    months = [m for m in _months(store) if m < month]
    if not months:
        return None
    root = f"{store.root}/{HISTORY}"
    folder = lambda m: f"{m.isoformat()}-{_basis(store, m)}"
    path = f"{root}/{folder(month)}"
    with _HISTORY_WRITES:
        if not store.files.exists(path + "/_SUCCESS"):
            there = store.files.children(root)
            base = next((m for m in sorted(months, reverse=True) if folder(m) in there and store.files.exists(f"{root}/{folder(m)}/_SUCCESS")), None)
            new = _since_parts(_in_months(store, DAILY, [m for m in months if base is None or m >= base]))
            rows = new if base is None else _merged(store.spark.read.parquet(f"{root}/{folder(base)}").unionByName(new))
            rows.write.mode("overwrite").parquet(path)
    return store.spark.read.parquet(path)


def _history(store: FeatureStore, ends: list[dt.date], keep) -> DataFrame:
    """The columns of ``features.history_aggregate`` for these window ends, from state.

    ``keep`` blanks the commodities that get no rows of their own, before anything is merged.
    """
    shape = [f"any__{e:%Y%m%d}" for e in ends] + [f"{k}_{d}__{e:%Y%m%d}" for e in ends for d in DISCOUNTS for k in ("last", "rest")]
    out = None
    for e in ends:
        t = f"{e:%Y%m%d}"
        within = _in_months(store, DAILY, [_month(e)]).filter(F.col("day") <= F.lit(e))
        parts, old = _since_parts(within), history_before(store, _month(e))
        parts = keep(parts if old is None else parts.unionByName(old))
        named = {f"any__{t}": F.lit(1)} | {f"{k}_{d}__{t}": F.col(f"{k}_{i}") for i, d in enumerate(DISCOUNTS) for k in ("last", "rest")}
        kind = lambda c: "date" if c.startswith("last_") else "int"
        rows = parts.select(*PAIR, *[(named[c] if c in named else F.lit(None)).cast(kind(c)).alias(c) for c in shape])
        out = rows if out is None else out.unionByName(rows)
    return _merged(out)


def _additive(daily: DataFrame, wins) -> DataFrame:
    """The columns of ``features.additive_aggregate``, from daily sums."""
    aggs = []
    for w in wins:
        within = F.col("day").between(F.lit(w.start), F.lit(w.end))
        total = lambda c, name: F.sum(F.when(within, F.col(c))).alias(f"{name}__{w.name}")  # noqa: B023, E731
        aggs += [total(c, c) for c in ("line_items", "products", *MONEY)]
        aggs += [total(f"with_{i}", f"line_items_with_{d}") for i, d in enumerate(DISCOUNTS)]
    return daily.groupBy(*PAIR).agg(*aggs)


def feature_tables_from_state(store: FeatureStore, select_date, top_n: int = TOP_N, windows=WINDOW_ORDER,
                              stage: str | None = None) -> dict[str, DataFrame]:
    """G2-G4 for a date, equal to ``feature_tables.all_feature_tables`` over all absorbed transactions."""
    spark, select_date = store.spark, as_date(select_date)
    max_day, top = latest_day(store, select_date), top_commodities(store, top_n)
    if max_day is None or not top:
        raise LookupError(f"the state holds no transactions up to {select_date}")
    wins = resolve_windows(max_day, windows)
    stage = stage or stage_path(spark, "state_aggregates")
    listed = F.when(F.col("commodity_desc").isin(top), F.col("commodity_desc"))
    keep = lambda df: df.withColumn("commodity_desc", listed)
    hist = materialize(_history(store, sorted({w.end for w in wins}), keep), path=stage + "/history")

    months = sorted({m for w in wins for m in _months(store) if _month(w.start) <= m <= w.end})
    near = lambda name: _in_months(store, name, months).filter(F.expr(in_any_window(wins)))
    additive = materialize(_additive(keep(near(DAILY)), wins), path=stage + "/additive")
    seen = near(ENTITIES).select(*PAIR, "day", "basket_id", "product_id", *[F.col(f"with_{i}").alias(d) for i, d in enumerate(DISCOUNTS)])
    entities = materialize(latest_days(stack_entities(keep(seen), PAIR), PAIR, wins), path=stage + "/entities")
    return assemble(FeatureInputs(hist, select_date, max_day, top, tuple(windows)), hist, additive, entities)

