"""N-gram Jaccard join by chosen paths.

1. Equal shingle sets are one class, known by the number of one of its rows. In each run a random order of all shingles samples a path for
   every class: its first, second and third shingle in that order. Classes are split by the first;
   buckets over BUCKET are split by the next one, and so on.
2. Buckets are searched by brute force over 128-byte sketches, with a margin, and give a spanning
   forest. A path is drawn without replacement, so a pair with I common shingles of U meets in a run
   with probability I(I-1)(I-2) / U(U-1)(U-2), less than s**3 and least for small sets; the number
   of runs follows from the target recall for the worst sets at the threshold and the full depth. A bucket still too large after the last
   split is compared in tiles, so none is left out.
3. Each component of the forest is gathered once with its whole shingle sets, and all its pairs are
   decided exactly, larger ones in tiles; only counts and a forest leave a task, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parquill.llm import _common as C
from parquill.llm.components import by_key, components, least_in, local_roots

SHINGLE = 5
RECALL = 0.9998
DEPTH = 3
BUCKET = 512
SKETCH = 128
#: Sketch similarity under the threshold at which a pair still is a candidate: five standard errors.
MARGIN = 0.18
#: Rows that a task takes at a time: of sketches, and of whole sets.
BUNDLE, SETS = 20_000, 2_000
#: Stands for a null doc_id where rows meet by it and by their set.
NO_ID = -(1 << 63)


def meets(threshold: float, depth: int = DEPTH) -> float:
    """Least probability that two different sets at the threshold, with `depth` common shingles or more, meet in a run."""
    least = threshold**depth  # of very large sets
    for union in range(depth + 1, 1000):
        common = max(depth, math.ceil(threshold * union - 1e-9))
        if common < union:
            least = min(least, math.comb(common, depth) / math.comb(union, depth))
    return least


def runs_for(threshold: float, recall: float = RECALL, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meets(threshold, depth)))


def shingle_sets(texts: list, cache: C.WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and their offsets. A text of fewer words is one shingle."""
    h, offsets = C.hashed([C.words_of(t) for t in texts], cache)
    x = C.rolled(h, size)
    at = np.flatnonzero(C.starts_of(offsets, size, len(x)))
    doc = np.searchsorted(offsets, at, "right") - 1
    x = x[at]
    short = [i for i in range(len(texts)) if 0 < offsets[i + 1] - offsets[i] < size]
    if short:
        own = [C.rolled(h[offsets[i] : offsets[i + 1]], int(offsets[i + 1] - offsets[i]), 1)[0] for i in short]
        x, doc = np.concatenate([x, np.array(own, np.uint64)]), np.concatenate([doc, np.array(short, np.int64)])
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    return x[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def class_keys(x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each non-empty set, whatever the order."""
    return tuple(np.add.reduceat(C.mix(x ^ np.uint64(b)), offsets) for b in C.BASES)


def paths_of(x: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, runs: int, depth: int) -> np.ndarray:
    """For each non-empty set and run the hashes of its path's beginnings, one for each depth."""
    out = np.empty((len(offsets), runs * depth), np.int64)
    for r in range(runs):
        y = C.mix(x + np.uint64((C.BASES[1] * (2 * r + 1)) & C.MASK))
        path = np.full(len(offsets), r, np.uint64)
        for d in range(depth):
            least = np.minimum.reduceat(y, offsets)
            path = C.mix(path * np.uint64(C.BASES[0]) + least)
            out[:, r * depth + d] = path.view(np.int64)
            if d + 1 < depth:
                y[y == np.repeat(least, sizes)] = C.TOP
    return out


def sketches_of(x: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each set and each of 128 parts of the hash space one byte of its least hash there; 0: none."""
    doc = np.repeat(np.arange(len(offsets)), sizes)
    part = (x >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(x), bool)
    first[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
    out = np.zeros((len(offsets), SKETCH), np.uint8)
    out[doc[first], part[first]] = 1 + (C.mix(x[first]) % np.uint64(255)).astype(np.uint8)
    return out


def _first_pass(runs: int, size: int):
    def run(batches):
        cache = C.WordHashes()
        for pdf in batches:
            ids, texts = pdf["doc_id"], pdf["text"].tolist()
            for a, b in C.chunks(texts):
                x, offsets = shingle_sets(texts[a:b], cache, size)
                sizes = np.diff(offsets)
                some = np.flatnonzero(sizes)
                out = pd.DataFrame({"doc_id": ids.iloc[a:b].astype("Int64").to_numpy(), "body": pdf["body"].iloc[a:b].to_numpy(), "k1": 0, "k2": 0, "n": sizes})
                paths, sketches = np.zeros((b - a, 0), np.int64), [None] * (b - a)
                if len(some):
                    starts, n = offsets[:-1][some], sizes[some]
                    k1, k2 = class_keys(x, starts)
                    out.loc[some, "k1"], out.loc[some, "k2"] = k1.view(np.int64), k2.view(np.int64)
                    paths = np.zeros((b - a, runs * DEPTH), np.int64)
                    paths[some] = paths_of(x, starts, n, runs, DEPTH)
                    for i, s in zip(some.tolist(), sketches_of(x, starts, n), strict=True):
                        sketches[i] = s.tobytes()
                out["paths"], out["sketch"] = list(paths), sketches
                yield out

    return run


def _alike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity of one sketch with many."""
    both = ((one == many) & (one > 0)).sum(axis=1)
    return both / np.maximum(((one > 0) | (many > 0)).sum(axis=1), 1)


def _bundled(decide, each: int):
    """For rows sorted by leaf: `decide` on many leaves at a time, each leaf whole."""

    def run(batches):
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= each:
                rows = pd.concat(held, ignore_index=True)
                cut = int((rows["leaf"] == rows["leaf"].iloc[-1]).to_numpy().argmax())
                held, size = [rows.iloc[cut:]], len(rows) - cut
                if cut:
                    yield decide(rows.iloc[:cut])
        if size:
            yield decide(pd.concat(held, ignore_index=True))

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in ranges of leaves with about equal numbers of rows; a leaf is in one range."""
    return rows.repartitionByRange("leaf").sortWithinPartitions("leaf")


def _forest(least: float):
    """For whole buckets (column leaf): links to the least class found alike, directly or over others."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["leaf", "node"]).sort_values(["leaf", "node"])
        leaf, node, n = pdf["leaf"].to_numpy(), pdf["node"].to_numpy(), pdf["n"].to_numpy()
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, SKETCH)
        cuts = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1], [True]]))
        a, b = [], []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            left = np.arange(lo, hi)
            while len(left) > 1:
                root, queue, left = int(left[0]), [int(left[0])], left[1:]
                while queue and len(left):
                    x = queue.pop()
                    sizes = np.minimum(n[x], n[left]) / np.maximum(n[x], n[left])
                    near = (sizes >= least) & (_alike(sketch[x], sketch[left]) >= least)
                    found = left[near].tolist()
                    a += [node[y] for y in found]
                    b += [node[root]] * len(found)
                    queue += found
                    left = left[~near]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}).drop_duplicates()

    return run


def exact_links(x: list[np.ndarray], y: list[np.ndarray], num: int, den: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with |x & y| / |x | y| >= num / den, by counting over an inverted list of y."""
    every, at = np.unique(np.concatenate(y), return_inverse=True)
    size_y = np.array([len(s) for s in y])
    owner = np.repeat(np.arange(len(y)), size_y)[np.argsort(at, kind="stable")]
    first = np.searchsorted(np.sort(at), np.arange(len(every) + 1))
    a, b = [], []
    for i, s in enumerate(x):
        p = np.minimum(np.searchsorted(every, s), len(every) - 1)
        p = p[every[p] == s]
        lo, n = first[p], first[p + 1] - first[p]
        if not len(p):
            continue
        hits = owner[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        shared = np.bincount(hits, minlength=len(y))
        ok = shared * (den + num) >= num * (len(s) + size_y)
        ok &= shared > 0
        if same:
            ok[: i + 1] = False
        j = np.flatnonzero(ok)
        a.append(np.full(len(j), i))
        b.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _decided(num: int, den: int):
    """For whole tiles (column leaf): exact links as counts, and the least class they reach."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, tile in pdf.drop_duplicates(["leaf", "node"]).sort_values(["leaf", "node"]).groupby("leaf", sort=False):
            one = tile[tile["block"] == tile["i"]]
            same = bool((tile["i"] == tile["j"]).iloc[0])
            two = one if same else tile[tile["block"] == tile["j"]]
            if not len(one) or not len(two):
                continue
            x = [np.frombuffer(s, np.uint64) for s in one["shingles"]]
            y = x if same else [np.frombuffer(s, np.uint64) for s in two["shingles"]]
            i, j = exact_links(x, y, num, den, same)
            ids, other = one["node"].to_numpy(), two["node"].to_numpy()
            nodes, roots = local_roots(ids[i], other[j])
            count = np.zeros(len(nodes), np.int64)
            np.add.at(count, np.searchsorted(nodes, ids[i]), two["copies"].to_numpy()[j])
            np.add.at(count, np.searchsorted(nodes, other[j]), one["copies"].to_numpy()[i])
            out.append(pd.DataFrame({"v": nodes, "root": roots, "n_links": count, "whole": bool(tile["blocks"].iloc[0] == 1)}))
        return pd.concat(out) if out else pd.DataFrame({"v": [], "root": [], "n_links": [], "whole": []}).astype({"v": int, "root": int, "n_links": int, "whole": bool})

    return run


def _sets(wanted, size: int):
    """Shingle sets of the documents in the filter, and of those without an id; equal ones once a chunk."""

    def run(batches):
        cache = C.WordHashes()
        for pdf in batches:
            known = pdf["doc_id"].notna().to_numpy()
            ids = np.full(len(pdf), NO_ID)
            ids[known] = pdf["doc_id"][known].to_numpy().astype(np.int64)
            keep = ~known | C.in_filter(wanted.value, C.mix(ids.view(np.uint64)))
            texts, ids = pdf["text"][keep].tolist(), ids[keep]
            for a, b in C.chunks(texts):
                x, offsets = shingle_sets(texts[a:b], cache, size)
                some = np.flatnonzero(np.diff(offsets))
                if len(some):
                    k1, k2 = class_keys(x, offsets[:-1][some])
                    sets = [x[offsets[i] : offsets[i + 1]].tobytes() for i in some.tolist()]
                    yield pd.DataFrame({"id": ids[a:b][some], "k1": k1.view(np.int64), "k2": k2.view(np.int64), "shingles": sets}).drop_duplicates(["id", "k1", "k2"])

    return run


def _mixed_ids(batches):
    for pdf in batches:
        yield pd.DataFrame({"h": C.mix(pdf["v"].to_numpy().astype(np.int64).view(np.uint64)).view(np.int64)})


def jaccard_join(docs: DataFrame, *, threshold: tuple[int, int] = (4, 5), shingle: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of at least 4/5, as classes.

    Words: [^\\x20\\x09-\\x0D]+, unchanged; a text of one to four words is one shingle. Result, one row
    per row: doc_id, body (hash of the text), group_id (the same number for all rows of a class, null
    without words), class_id (least doc_id reachable over links), n_links (other rows linked directly,
    copies included), n_shingles, kept (doc_id = class_id). Texts without words, null ones included,
    link with nothing and are kept; a very long text is one whole set. A null doc_id takes the class of
    its text, but is kept; a class of null ones has a null class_id. Repeated rows count as rows, and
    rows of one doc_id with different texts are different documents. Extra columns are ignored; an
    empty table is fine. Pairs that meet in no run are missed, with a probability of at most
    1 - recall each.
    """
    spark = docs.sparkSession
    num, den = threshold
    least = num / den - MARGIN
    runs = runs_for(num / den, recall)
    docs = C.named(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with C.small_batches(spark):
        step = docs.select("doc_id", "text", F.xxhash64("text").alias("body")).mapInPandas(C.frugal(_first_pass(runs, shingle)), "doc_id long, body long, k1 long, k2 long, n long, paths array<long>, sketch binary")
        step = C.written(step.withColumn("row", F.monotonically_increasing_id()))
    classes = C.written(step.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.min("row").alias("node"), F.count("*").alias("copies")))

    # chosen paths: split by sampled shingles until buckets are small
    own = step.where("n > 0").withColumnRenamed("row", "node").join(classes.select("node"), "node", "left_semi").select("node", "n", "paths", "sketch")
    each = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    rows = own.select("node", "paths", each).select("node", *[F.expr(f"get(paths, run * {DEPTH} + {d})").alias(f"p{d}") for d in range(DEPTH)])
    leaves = None
    for d in range(DEPTH):
        size = C.written(rows.groupBy(f"p{d}").agg(F.count("*").alias("size")).where("size > 1").withColumn("of", F.col("size")))
        met = C.written(by_key(rows, size, f"p{d}", "node").withColumnRenamed("of", "size"))
        last = d == DEPTH - 1
        some = (met if last else met.where(F.col("size") <= BUCKET)).select("node", F.col(f"p{d}").alias("leaf"), "size")
        leaves = some if leaves is None else leaves.unionByName(some)
        rows = met.where(F.col("size") > BUCKET).drop(f"p{d}", "size")
    blocks = F.ceil(F.col("size") / F.lit(float(BUCKET))).cast("int")
    leaves = leaves.withColumn("blocks", F.when(F.col("size") > BUCKET, blocks).otherwise(F.lit(1)))
    leaves = leaves.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    leaves = leaves.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    leaf = F.when(F.col("blocks") == 1, F.col("leaf")).otherwise(F.xxhash64("leaf", F.least("block", "other"), F.greatest("block", "other")))
    leaves = C.written(leaves.select("node", leaf.alias("leaf")).join(own.drop("paths"), "node"))
    forest = C.written(_dealt(leaves).mapInPandas(C.frugal(_bundled(_forest(least), BUNDLE)), "a long, b long"))
    C.discard(leaves)
    near = C.written(components(forest))

    # every component once more, with whole sets
    members = near.select(F.col("v").alias("node"), F.col("root").alias("leaf")).unionByName(near.select(F.col("root").alias("node"), F.col("root").alias("leaf")).distinct())
    sizes = members.groupBy("leaf").agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / F.lit(float(BUCKET))).cast("int"))
    members = by_key(members, C.written(sizes), "leaf", "node").join(classes.withColumn("id", F.coalesce("rep", F.lit(NO_ID))), "node")
    members = C.written(members.select("node", "leaf", "blocks", "id", "k1", "k2", "copies"))
    wanted = spark.sparkContext.broadcast(C.bit_filter(members.select(F.col("id").alias("v")).mapInPandas(_mixed_ids, "h long"), "h", members.count()))
    with C.small_batches(spark):
        sets = docs.mapInPandas(C.frugal(_sets(wanted, shingle)), "id long, k1 long, k2 long, shingles binary")
        # repeated rows bring one set several times
        sets = members.join(sets, ["id", "k1", "k2"]).groupBy("id", "k1", "k2", "node", "leaf", "blocks", "copies").agg(F.first("shingles").alias("shingles"))
        tiles = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tiles = tiles.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        leaf = F.when(F.col("blocks") == 1, F.col("leaf")).otherwise(F.xxhash64("leaf", "i", "j"))
        tiles = C.written(tiles.select("node", leaf.alias("leaf"), "copies", "blocks", "block", "i", "j", "shingles"))
        found = C.written(_dealt(tiles).mapInPandas(C.frugal(_bundled(_decided(num, den), SETS)), "v long, root long, n_links long, whole boolean"))
    C.discard(tiles)
    large = components(found.where("not whole").select(F.col("v").alias("a"), F.col("root").alias("b")))
    roots = C.written(found.where("whole and v <> root").select("v", "root").unionByName(large))
    counted = found.groupBy("v").agg(F.sum("n_links").alias("n_links")).withColumnRenamed("v", "node")
    done = classes.join(counted, "node", "left").join(least_in(roots, classes, "rep", "least"), "node", "left")
    group, class_id = F.coalesce("root", "node").alias("group_id"), F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("least")).alias("class_id")
    done = done.select("k1", "k2", "n", group, class_id, (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = step.select("doc_id", "body", "k1", "k2", "n").join(done, ["k1", "k2", "n"], "left")
    class_id = F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == class_id, F.lit(True))
    return out.select("doc_id", "body", "group_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("n").alias("n_shingles"), kept.alias("kept"))
