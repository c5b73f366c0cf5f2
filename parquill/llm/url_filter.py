"""URL rules by a sort-merge range join: DataFrame functions only.

The key of a rule is its host's labels from right to left, a slash and its path; the keys it
matches are one interval, and intervals are nested or apart. Rules open and close at the ends of
their intervals; both, and the keys of the urls (one for each end of a host that a rule could name),
are sorted and dealt out by range. The sweep keeps a stack: its height is the number of rules opened
and not closed, and the rule on top of it is the last one that opened at that height. A rule that is
open where a range begins opens again there. A key that many urls share is split over ranges.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parquill.llm._common import named, written

RULES = T.StructType([T.StructField(c, T.StringType(), False) for c in ("host", "path", "verdict")])


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and where there is no ``://``."""
    after = F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))), F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substr(after, F.length(host) + F.lit(1)), "^[^?#]*", 0)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _end(key: Column) -> Column:
    """Behind all keys that begin with this one: no UTF-8 text holds the byte FF."""
    return F.concat(key, F.lit(b"\xff"))


def url_filter(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """The rule that decides on each url: of those whose host is the url's or above it and whose path
    begins the url's path, the one with the longest host and path together (then the longer host).

    Result: page_id, host, path, rule (host and path; null if none fits), verdict (the rule's, or
    `default`). A null or malformed url has an empty host and path and fits no rule. Of rules with
    equal host and path, blocking wins. A very long url is judged whole. Repeated rows are kept, null
    page_ids too; extra columns are ignored; an empty table of pages or rules is fine.
    """
    spark = pages.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rules = named(rules, "host", "path", "verdict").select(ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
    rules = rules.where("r_host is not null and verdict is not null").groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
    labels = _reversed(F.col("r_host"))
    key = F.concat_ws("/", F.array_join(labels, "."), F.col("r_path")).cast("binary")
    one = F.struct(F.length(F.concat("r_host", "r_path")).alias("size"), F.length("r_host").alias("host_size"), F.concat("r_host", "r_path").alias("rule"), "verdict")
    rules = written(rules.select(key.alias("r_key"), one.alias("one"), F.size(labels).alias("depth")))
    depth = rules.agg(F.max("depth")).first()[0] or 1

    host, path = url_parts(F.col("url"))
    urls = named(pages, "page_id", "url").select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    asked = F.least(F.lit(depth), F.size(_reversed(F.col("host"))))
    urls = written(urls)
    key = F.concat_ws("/", F.array_join(F.slice(_reversed(F.col("host")), F.lit(1), F.col("n")), "."), F.col("path")).cast("binary")
    probes = urls.select("row", "host", "path", F.explode(F.sequence(F.lit(1), asked)).alias("n")).select(key.alias("key"), F.lit(1).alias("kind"), F.xxhash64("row", "n").alias("salt"), "row")
    opened = rules.select(F.col("r_key").alias("key"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"), "r_key", "one")
    closed = rules.select(_end(F.col("r_key")).alias("key"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("salt"), "r_key")
    order = ["key", "kind", "salt"]
    events = opened.unionByName(closed, allowMissingColumns=True).unionByName(probes, allowMissingColumns=True)
    events = written(events.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))

    # rules that are open where a range begins
    ends = events.where("kind = 2").select("r_key", F.col("range").alias("last"))
    across = events.where("kind = 0").join(ends, "r_key").where("last > range")
    across = across.withColumn("range", F.explode(F.sequence(F.col("range") + 1, F.col("last")))).drop("last")
    swept = events.unionByName(across)
    change = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    so_far = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumn("height", F.sum(change).over(so_far))
    there = Window.partitionBy("range", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = F.when(F.col("height") > 0, F.last(F.when(F.col("kind") == 0, F.col("one")), ignorenulls=True).over(there))
    best = swept.select("row", "kind", top.alias("top")).where("kind = 1 and top is not null").groupBy("row").agg(F.max("top").alias("best"))
    out = urls.join(best, "row", "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
