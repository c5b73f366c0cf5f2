"""Line deduplication by a log-template tree: DataFrame functions only.

A line's tokens with digits are variable fields. Its leaf in the tree is its number of tokens and
its first tokens. In a leaf with different lines, the prevailing token of each position makes the
leaf's template (a position without one is variable), and lines that agree with it in most
positions are instances of it; any other line is its own template. A template is shared if enough
different texts hold it. What stays of a text without its shared lines, and without lines that
differ from a shared one in their first tokens only, is its body: copies have equal bodies, or none.
A shared template recurs if enough different bodies hold it, not counting the share of the largest.
All lines of recurring templates are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parquill.llm._common import discard, named, written

LEADING = 3
MIN_DOCS = 5
#: Share of texts outside the largest family, of a token that prevails, of positions that agree.
OUTSIDE, PREVAILS, AGREES = 0.2, 0.5, 0.7
#: Leaves that are broadcast at most.
BROADCAST_LEAVES = 500_000


def masked(line: Column) -> Column:
    """The line with one space between tokens and <*> for tokens with a digit."""
    spaced = F.contains(line, F.lit("  ")) | F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r"))
    plain = F.when(spaced, F.trim(F.regexp_replace(line, r"\s+", " "))).otherwise(F.trim(line))
    return F.when(line.rlike("[0-9]"), F.regexp_replace(plain, r"[^ 0-9]*[0-9][^ ]*", "<*>")).otherwise(plain)


def _tree(docs: DataFrame) -> DataFrame:
    """Per line: doc_id, hash of the whole text, line hash h, template t0, leaf, hash of the last tokens, mask."""
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("copy"), F.explode(F.split("text", "\n", -1)).alias("line"))
    rows = rows.withColumn("mask", masked(F.col("line")))
    count = F.length("mask") - F.length(F.replace("mask", F.lit(" "), F.lit(""))) + 1
    # blank lines are marked, not filtered: Spark would compute the mask again for a filter below
    rows = rows.withColumn("n", count)
    leaf = F.when(F.col("line").rlike(r"(?U)\S"), F.xxhash64("n", F.substring_index("mask", " ", LEADING))).otherwise(F.lit(0).cast("long"))
    # shorter lines have no last tokens beside the leading ones
    last = F.when(F.col("n") >= 2 * LEADING, F.xxhash64("n", F.substring_index("mask", " ", -LEADING)))
    return rows.select("doc_id", "copy", F.xxhash64("line").alias("h"), F.xxhash64("mask").alias("t0"), leaf.alias("leaf"), last.alias("last"), "mask")


def line_dedup(docs: DataFrame, *, min_docs: int = MIN_DOCS, keep: tuple[str, ...] = (), broadcast_leaves: int = BROADCAST_LEAVES) -> DataFrame:
    """Texts without the lines whose template recurs across documents.

    Lines end at \\n. Result: doc_id, text (kept lines, joined again), n_lines, n_dropped. Blank lines
    are kept; a line of one or two tokens is a leaf of its own. A template is dropped if at least
    `min_docs` different bodies hold it, and a fifth of the different texts that do are outside the
    largest family of one body. Texts without a body are one family. Of tokens with equal counts the
    last in order prevails. A null text stays null and has no lines; an empty one has one; a very long
    one is cut into all of its lines. A doc_id counts once, however many rows it has, and null ones
    together as one; a line is judged by its own template on each row, whatever the doc_id. Extra
    columns are ignored but for those named in `keep`, which come along; an empty table is fine.
    """
    docs = named(docs, "doc_id", "text", *keep)
    tree = written(_tree(docs))
    rows = written(tree.drop("mask").distinct()).where("leaf <> 0")

    # templates of leaves that hold different lines
    leaves = rows.groupBy("leaf").agg(F.count("*").alias("c"), F.min("t0").alias("a"), F.max("t0").alias("b")).where((F.col("c") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf")
    leaves = written(leaves)
    small = leaves.count() <= broadcast_leaves
    several = tree.select("leaf", "t0", "mask").join(F.broadcast(leaves) if small else leaves, "leaf")
    several = written(several.groupBy("leaf", "t0").agg(F.min("mask").alias("mask"), F.count("*").alias("c")))
    discard(tree)
    tokens = several.select("leaf", "c", F.posexplode(F.split("mask", " ")).alias("at", "token"))
    votes = tokens.groupBy("leaf", "at", "token").agg(F.sum("c").alias("c"))
    best = votes.groupBy("leaf", "at").agg(F.max(F.struct("c", "token")).alias("best"), F.sum("c").alias("all"))
    token = F.when(F.col("best.c") >= PREVAILS * F.col("all"), F.col("best.token"))
    # one row for each leaf, written, so that Spark can split a leaf with many masks
    template = written(best.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", token.alias("token")))), lambda x: x["token"]).alias("template")))
    same = F.expr("size(filter(zip_with(split(mask, ' '), template, (a, b) -> a = b), x -> x))")
    general = several.join(template, "leaf").where(same >= AGREES * F.size("template")).select("t0", F.xxhash64(F.lit("leaf"), "leaf").alias("t1"))

    rows = rows.join(general, "t0", "left").withColumn("t", F.coalesce("t1", "t0")).select("doc_id", "copy", "h", "t", "last")
    rows = written(rows)
    # a doc_id counts once for a template, and equal texts count once
    held = rows.groupBy("t", "doc_id").agg(F.min("copy").alias("copy")).select("t", "copy").distinct()
    shared = written(held.groupBy("t").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs).select("t"))
    held = written(held.join(shared, "t"))
    # sides with one row for each key are written, so that Spark can split a frequent key of the other side
    lasts = written(rows.where("last is not null").join(shared, "t", "left_semi").select("last").distinct())
    own = rows.join(shared, "t", "left_anti").join(lasts, "last", "left_anti").select("copy", "h").distinct()
    bodies = own.groupBy("copy").agg(F.expr("bit_xor(xxhash64(h))").alias("body"))
    families = held.join(bodies, "copy", "left").groupBy("t", F.coalesce("body", F.lit(0)).alias("body")).agg(F.count("*").alias("c"))
    recurring = families.groupBy("t").agg(F.sum("c").alias("texts"), F.max("c").alias("top"), F.count("*").alias("bodies"))
    recurring = recurring.where((F.col("bodies") >= min_docs) & (F.col("texts") - F.col("top") >= OUTSIDE * F.col("texts"))).select("t")
    recurring = written(recurring)
    dropped = rows.join(recurring, "t").groupBy(F.col("doc_id").alias("d_id")).agg(F.collect_set("h").alias("drop"))

    out = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("d_id")), "left")
    parts = F.split("text", "\n", -1)
    kept = F.when(F.col("drop").isNull(), parts).otherwise(F.filter(parts, lambda x: ~F.array_contains(F.col("drop"), F.xxhash64(x))))
    out = out.select("doc_id", *keep, F.size(F.coalesce(parts, F.array().cast("array<string>"))).cast("long").alias("n_lines"), kept.alias("kept"))
    return out.select("doc_id", *keep, F.array_join("kept", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size(F.coalesce("kept", F.array().cast("array<string>")))).cast("long").alias("n_dropped"))
