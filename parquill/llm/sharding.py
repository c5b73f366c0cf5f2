"""Shards of equal document counts by balanced label propagation.

Documents with equal texts are linked. Groups of more than a quarter of a shard are placed first,
the largest first: each whole in the fullest shard that has room for it; one that fits nowhere fills
as few shards as it can. Of the others each document starts in the shard its hash gives, in
proportion to the room left; in each round every group's members want to the shard where most of
their neighbours are; moves that opposite moves make up for are allowed, and as many more as a
shard's quota of rows has room for. A cell, the members of a group that began in one shard, moves as
one. What exceeds a quota in the end, and documents without links, fill the free places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parquill.llm._common import named, written

SHARDS = 40
ROUNDS = 6
#: Rows that are numbered together within a shard.
RANKED = 20_000


def _lookup(values: dict[int, float], key: Column) -> Column:
    """A value for each shard number."""
    return F.get(F.array(*[F.lit(float(values.get(s, 0.0))) for s in range(max(values, default=0) + 1)]), key)


def _numbered(df: DataFrame, by: str, n: int, shards: int) -> DataFrame:
    """With rank: from 0 and gapless in each value of `by`, without sorting a whole shard in one task."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // max(1, shards) + 1, n // (shards * RANKED) + 1)
    df = df.withColumn("part", F.pmod(F.xxhash64("row", F.lit(9)), F.lit(parts)).cast("int"))
    sizes = df.groupBy(by, "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    within = Window.partitionBy(by, "part").orderBy("row")
    df = df.withColumn("nr", F.row_number().over(within) - 1).join(sizes, [by, "part"])
    return df.withColumn("rank", (F.col("nr") + F.col("start")).cast("long")).drop("nr", "start", "part")


def _placed_first(sizes: list[int], room: dict[int, int]) -> list[list[tuple[int, int, int]]]:
    """For each group, largest first: (shard, rows, first slot) of its parts. Takes the places from `room`."""
    quota, out = dict(room), []
    for left in sizes:
        parts = []
        while left:
            fits = [s for s in room if room[s] >= left]
            s = min(fits, key=lambda s: (room[s], s)) if fits else max(room, key=lambda s: (room[s], -s))
            n = min(left, room[s])
            parts.append((s, n, quota[s] - room[s]))
            room[s] -= n
            left -= n
        out.append(parts)
    return out


def sharding(docs: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """All documents in shards whose row counts differ by one at most, equal texts together.

    Result: doc_id, size (UTF-8 bytes of the text plus 16; null: 16), text_crc32 (0 for null), law
    (`rows`), shard, slot (gapless from 0 in its shard), grown_shard (null under this law). Null
    texts and single texts have no links; empty texts are equal texts. Null doc_ids and repeated
    rows are rows like others; of a text only length and hashes are used, however long it is. Shards
    that hold equally many of a group are told apart by a hash, groups of equal size by their text's
    hash. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    base = named(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("g1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("g2"),
    )
    base = written(base)
    n = base.count()
    quota = {s: n // shards + (s < n % shards) for s in range(shards)}
    # groups over a quarter of a shard: at most 4 * shards of them
    large = base.where("g1 is not null").groupBy("g1", "g2").agg(F.count("*").alias("members")).where(F.col("members") > max(1, n // shards // 4)).collect()
    large.sort(key=lambda r: (-r["members"], r["g1"], r["g2"]))
    room = dict(quota)
    parts = [(k, *part) for k, found in enumerate(_placed_first([r["members"] for r in large], room)) for part in found]
    first = {s: quota[s] - room[s] for s in range(shards)}
    numbers = F.broadcast(spark.createDataFrame([(r["g1"], r["g2"], k) for k, r in enumerate(large)], "g1 long, g2 long, k int"))
    linkable = base.select("row", "g1", "g2").where("g1 is not null")
    ranked = _numbered(linkable.join(numbers, ["g1", "g2"]).select("row", "k"), "k", sum(r["members"] for r in large), max(1, len(large)))
    cuts, before = [], {}
    for k, s, size, slot in parts:
        cuts.append((k, before.get(k, 0), before.get(k, 0) + size, s, slot))
        before[k] = before.get(k, 0) + size
    cuts = F.broadcast(spark.createDataFrame(cuts, "k int, low long, high long, shard int, slot long"))
    whole = ranked.join(cuts, "k").where("rank >= low and rank < high").select("row", "shard", (F.col("slot") + F.col("rank") - F.col("low")).alias("slot"))
    whole = written(whole)
    # the others begin in proportion to the room left
    ends = [sum(room[t] for t in range(s + 1)) for s in range(shards)]
    u = F.pmod(F.xxhash64("row"), F.lit(max(1, ends[-1])))
    began = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends[:-1]]), lambda e: e <= u)) if shards > 1 else F.lit(0)
    rows = linkable.join(numbers, ["g1", "g2"], "left_anti").select("row", "g1", "g2", began.cast("int").alias("began"))
    own = ["g1", "g2"]
    cells = rows.groupBy(*own, "began").agg(F.count("*").alias("n"))
    linked = cells.groupBy(*own).agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    cells = written(cells.join(linked, own).withColumn("shard", F.col("began")))
    for turn in range(rounds):
        there = cells.groupBy(*own, "shard").agg(F.sum("n").alias("n"))
        wanted = there.groupBy(*own).agg(F.max(F.struct("n", F.xxhash64(*own, "shard"), "shard")).getField("shard").alias("to"))
        asked = cells.join(wanted, own)
        flow = asked.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()  # at most shards * shards rows
        load, moves = dict.fromkeys(range(shards), 0), {}
        for f in flow:
            load[f["shard"]] += f["n"]
            if f["shard"] != f["to"]:
                moves[f["shard"], f["to"]] = f["n"]
        # moves that others make up for, and as many more as fit into free places
        swapped = {(a, b): min(n, moves.get((b, a), 0)) for (a, b), n in moves.items()}
        more = dict.fromkeys(range(shards), 0)
        for (a, b), n in moves.items():
            more[b] += n - swapped[a, b]
        free = {s: min(1.0, max(0, room[s] - load[s]) / more[s]) if more[s] else 0.0 for s in range(shards)}
        share = {a * shards + b: (swapped[a, b] + free[b] * (n - swapped[a, b])) / n for (a, b), n in moves.items()}
        if not any(share.values()):
            break
        dice = F.pmod(F.xxhash64(*own, "began", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        goes = (F.col("shard") != F.col("to")) & (dice < F.coalesce(_lookup(share, F.col("shard") * shards + F.col("to")), F.lit(0.0)))
        cells = written(asked.withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("to"))
    placed = rows.join(cells.select(*own, "began", "shard"), [*own, "began"]).select("row", "shard")
    placed = _numbered(placed, "shard", n, shards)
    placed = placed.where(F.col("rank") < _lookup(room, F.col("shard"))).select("row", "shard", (F.col("rank") + _lookup(first, F.col("shard")).cast("long")).alias("slot"))
    placed = written(placed.unionByName(whole))
    used = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    rest = base.select("row").join(placed.select("row"), "row", "left_anti").withColumn("all", F.lit(0))
    rest = _numbered(rest, "all", n, 1)
    start, shard, slot = 0, F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in range(shards):
        free = quota[s] - used.get(s, 0)
        here = (F.col("rank") >= start) & (F.col("rank") < start + free)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("rank") - start + used.get(s, 0)).otherwise(slot)
        start += free
    filled = placed.unionByName(rest.select("row", shard.alias("shard"), slot.alias("slot")))
    return base.join(filled, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
