"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

A unit vector x is s*q + e with q of whole numbers up to 127 in size. For two of them
|x.y - s.t*(q.r)| <= |e| + |s*q| * |f|, so only pairs whose quantised product comes within that
of the threshold are computed again in double precision. Products of int8 tiles run as float32
matrix products, which are exact below 2**24. Equal vectors of a label are one class, known by a
number of its own, so a vec_id may stand on several rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parquill.llm._common import named, written
from parquill.llm.components import components, least_in, local_roots

#: Vectors in a block; a tile compares two blocks.
BLOCK = 1536
SLACK = 1e-9


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers as int8, scales, sizes of s*q and bounds of the errors, for unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, np.linalg.norm(near, axis=1) * (1 + 1e-12), np.linalg.norm(x - near, axis=1) * (1 + 1e-9) + 1e-15


def levelled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither vanish nor overflow; no digit is lost."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    half = exponent // 2  # in two steps: the whole factor may be no double
    return np.ldexp(np.ldexp(x, -half[:, None]), (half - exponent)[:, None])


def links_of_tile(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with cosine >= threshold; of a block with itself each pair once."""
    x, y = levelled(x), levelled(y)
    size_x, size_y = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    q, s, m, e = quantised(x / size_x[:, None])
    r, t, _, f = quantised(y / size_y[:, None])
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    about = (q.astype(kind) @ r.astype(kind).T).astype(np.float64) * s[:, None] * t[None, :]
    about += e[:, None] + m[:, None] * f[None, :] + SLACK
    i, j = np.nonzero(about >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    keep = []
    for a in range(0, len(i), 1 << 16):
        u, v = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        keep.append((x[u] * y[v]).sum(axis=1) / (size_x[u] * size_y[v]) >= threshold)
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def _tile(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool((pdf["i"] == pdf["j"]).iloc[0])
        one = pdf[pdf["block"] == pdf["i"]]
        two = one if same else pdf[pdf["block"] == pdf["j"]]
        if not len(one) or not len(two):
            return pd.DataFrame({"v": [], "n_links": [], "root": []}, dtype=np.int64)
        x = np.stack(one["e"].to_list())
        y = x if same else np.stack(two["e"].to_list())
        a, b = links_of_tile(x, y, threshold, same)
        ids, other = one["node"].to_numpy(), two["node"].to_numpy()
        nodes, roots = local_roots(ids[a], other[b])
        count = np.zeros(len(nodes), np.int64)
        np.add.at(count, np.searchsorted(nodes, ids[a]), two["copies"].to_numpy()[b])
        np.add.at(count, np.searchsorted(nodes, other[b]), one["copies"].to_numpy()[a])
        return pd.DataFrame({"v": nodes, "n_links": count, "root": roots})

    return run


def embedding_dedup(vectors: DataFrame, *, threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """All vectors of equal label with a cosine of at least `threshold`, and their components.

    Result, one row per row: vec_id, n_links (other rows linked directly, copies included),
    component_id (least vec_id reachable, its own included), kept (vec_id = component_id). Null, empty
    and zero vectors, those with null or non-finite components, and rows with a null label or vec_id
    link with nothing; vectors of different length neither. A null vec_id has a null component_id and
    is kept. Rows that repeat a vec_id are rows of their own, each with the links of its vector.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = named(vectors, "vec_id", "embedding", "label").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    usable = F.expr("vec_id is not null and label is not null and size(e) > 0 and forall(e, x -> coalesce(abs(x) < double('Infinity'), false)) and exists(e, x -> x <> 0)")
    rows = written(rows.select("vec_id", "label", F.when(usable, F.expr("transform(e, x -> x + 0.0D)")).alias("e")))  # no -0.0
    distinct = rows.where("e is not null").groupBy("label", "e").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("width", F.size("e")))
    blocks = distinct.groupBy("label", "width").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("blocks"))
    dealt = distinct.join(blocks, ["label", "width"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", "width", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "e")
    found = written(dealt.groupBy("label", "width", "i", "j").applyInPandas(_tile(threshold), "v long, n_links long, root long"))
    roots = written(components(found.select(F.col("v").alias("a"), F.col("root").alias("b"))))
    members = least_in(roots, distinct, "least", "component_id").drop("root")
    counted = found.groupBy("v").agg(F.sum("n_links").alias("n_links")).withColumnRenamed("v", "node")
    classes = distinct.join(counted, "node", "left").join(members, "node", "left")
    classes = classes.select("label", "e", F.coalesce("component_id", "least").alias("component_id"), (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(classes, ["label", "e"], "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
