"""Connected components by alternating stars, as DataFrame joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parquill.llm._common import discard, written

#: A key of more rows is dealt into salted parts.
LARGE, SALTS = 512, 64


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the given links and the least node each one reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        apart = root[x] != root[y]
        if not apart.any():
            break
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _sum(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def by_key(rows: DataFrame, table: DataFrame, key: str, each: str) -> DataFrame:
    """rows.join(table, key) for a table with one row a key and, as `size`, the key's number of rows at least.

    Rows of a key that has many are dealt into parts by column `each`, so that none is a hot one.
    """
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(each), F.lit(SALTS)).cast("int"))
    large = table.where(F.col("size") > LARGE).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    small = rows.join(large.select(key, "salt"), [key, "salt"], "left_anti").join(table.where(F.col("size") <= LARGE), key)
    return small.unionByName(rows.join(large, [key, "salt"])).drop("salt", "size")


def components(links: DataFrame) -> DataFrame:
    """From links (a long, b long): v and root, the least node that v reaches, for all v but the roots themselves.

    Large star: every node hands its larger neighbours the least node it knows; small star: its
    smaller ones. Nothing but two counts comes to the driver in a round, rounds are logarithmic,
    and the links of a node with very many are dealt into parts.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _sum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")).select("u", F.least("u", "m").alias("m"), "size")
        large = by_key(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
        small = by_key(large, least, "u", "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(large)
        discard(last)
        now = _sum(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))


def least_in(roots: DataFrame, nodes: DataFrame, value: str, name: str) -> DataFrame:
    """From roots as components() gives them: node and the least `value` of its component, for components of several nodes."""
    every = roots.select("v", "root").unionByName(roots.select(F.col("root").alias("v"), "root").distinct())
    every = every.join(nodes.select(F.col("node").alias("v"), value), "v")
    least = written(every.groupBy("root").agg(F.min(value).alias(name), F.count("*").alias("size")))
    return by_key(every, least, "root", "v").select(F.col("v").alias("node"), name, "root")
