"""URL filters by a sorted sweep over reversed hosts (operator 8, DataFrame functions only).

A host's labels, reversed and closed by dots (``com.example.www.``), turn "a
host and all its subdomains" into an interval of keys.  Rule hosts give two
boundaries per interval; between two boundaries the stack of active nested
rules does not change.  URLs and boundaries are sorted together and every URL
takes the stack left by the boundary before it; of the rules on the stack
whose path begins the URL's path the longest wins.

The sort is a range partitioning that may split the rows of a common host;
rows are written once with their partition's number, each partition is swept
by a window of its own, and what the partitions before left open is taken
from one row per partition.  Stacks are as deep as hosts are nested.

A rule's length is that of its text, host and path together; on ties the
longer host wins, then the smaller text.  No rule: ``DEFAULT``.

Defined cases: a null url, or one without ``://``, has an empty host and path
and so no rule; rules with a null host or path or verdict are ignored; of
several rules for one host and path the smallest verdict holds (allow before
block); repeated rows get a result each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stage

DEFAULT = "allow"
#: Sorts after every key that a host can begin.
_BEYOND = "\U0010FFFF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as (verdict, host, path) rows."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit((1 << 31) - 1))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def host_key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): from this key on, these rules are active (until the next boundary)."""
    clean = (
        rules.where("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
        .select("verdict", F.translate("host", _UPPER, _LOWER).alias("host"), "path")
        .where("host != ''")
        .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    )
    per_host = clean.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("own"))
    keyed = per_host.select(host_key(F.col("host")).alias("key"), "own")
    # a host's enclosing hosts are the beginnings of its key that end a label
    labels = F.split(F.regexp_replace("key", r"\.$", ""), r"\.")
    begins = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    outer = keyed.select("key", F.explode(begins).alias("begin")).join(keyed.select(F.col("key").alias("begin"), "own"), "begin")
    stacks = outer.groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("opened"),
        F.coalesce(F.flatten(F.collect_list(F.when(F.col("begin") != F.col("key"), F.col("own")))), F.array().cast("array<struct<host:string,path:string,verdict:string>>")).alias("closed"),
    )
    return stacks.select("key", F.col("opened").alias("stack")).union(stacks.select(F.concat("key", F.lit(_BEYOND)), "closed"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    no_stack = F.lit(None).cast("array<struct<host:string,path:string,verdict:string>>")
    rows = urls.select(F.lit(1).alias("kind"), host_key(F.col("host")).alias("key"), F.hash("path", "page_id").alias("spread"), "page_id", "host", "path", no_stack.alias("stack"))
    marks = _boundaries(rules).select(
        F.lit(0).alias("kind"), "key", F.lit(0).alias("spread"), F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack",
    )
    sorted_rows, _ = stage(
        rows.union(marks).repartitionByRange("key", "kind", "spread").sortWithinPartitions("key", "kind", "spread").withColumn("part", F.spark_partition_id()),
        "url-sweep",
    )
    left_open = sorted_rows.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("left"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = left_open.select("part", F.last("left", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = sorted_rows.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1").join(carried, "part")
    stack = F.coalesce("active", "carried", F.array().cast("array<struct<host:string,path:string,verdict:string>>"))
    fitting = F.filter(stack, lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(fitting, lambda r: F.struct(
        (-F.length(r["host"]) - F.length(r["path"])).alias("size"), (-F.length(r["host"])).alias("host_size"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"),
    ))
    best = F.array_min(ranked)
    return swept.select(
        "page_id", "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
    )
