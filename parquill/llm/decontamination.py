"""Benchmark decontamination by winnowing: DataFrame functions only.

A window of n words is known by the least hash of its k-word grams, k = min(GRAM, n); successive
windows with the same one are a run, known once. The hashes of the documents' runs are looked up
among those of the benchmark; equal windows have equal ones, so none is missed, and each hit is
extended by comparing the words of the run's windows. Words are cut once and written.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parquill.llm._common import named, written

WINDOW = 10
GRAM = 5
#: Windows that one hash stands for at most.
RUN = 8
#: Most benchmark windows that are broadcast. Beyond that only hashes are shuffled, and the words of hits fetched.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; none for null."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def _places(array: str, n: int) -> str:
    return f"if(size({array}) >= {n}, sequence(0, size({array}) - {n}), cast(array() as array<int>))"


def _grams(df: DataFrame, n: int) -> DataFrame:
    """With mins: for each window of n words (column words) its least gram hash."""
    k = min(GRAM, n)
    gram = "xxhash64(" + ", ".join(f"get(words, i + {j})" for j in range(k)) + ")"
    df = df.withColumn("grams", F.expr(f"transform({_places('words', k)}, i -> {gram})"))
    least = "least(" + ", ".join(f"get(grams, i + {j})" for j in range(n - k + 1)) + ")" if n > k else "get(grams, i)"
    return df.withColumn("mins", F.expr(f"transform({_places('words', n)}, i -> {least})")).drop("grams")


def _runs(mins: str) -> str:
    """(hash, first window) of successive windows with one hash, RUN of them at most."""
    new = f"filter(sequence(0, size({mins}) - 1), i -> i % {RUN} = 0 or get({mins}, i) <> get({mins}, i - 1))"
    return f"if(size({mins}) = 0, null, transform({new}, i -> struct(get({mins}, i) as h, i as at)))"


def decontamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Document words inside an occurrence of `window` successive words of a benchmark item.

    An item of fewer words, but not none, is one window. Result: doc_id, body (hash of the text),
    n_words, n_hit (words inside any occurrence), items (ids, as strings and sorted, of items with an
    occurring window), contaminated (n_hit > 0). Null texts have no words; very long ones are searched
    whole. Null item_ids count for n_hit but are not listed; null doc_ids and repeated rows are kept.
    Extra columns of both tables are ignored; empty tables are fine.
    """
    own = written(named(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("body"), words(F.col("text")).alias("words")))
    items = named(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    items = written(items.where("size(words) > 0").withColumn("n", F.least(F.size("words"), F.lit(window))))
    sizes = [r[0] for r in items.select("n").distinct().orderBy("n").collect()]  # at most `window` numbers
    spans = None
    for n in sizes:
        known = _grams(items.where(F.col("n") == n), n).select("item", "words", F.posexplode_outer("mins").alias("at", "h"))
        known = known.select("item", "h", F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("span")).distinct()
        known = written(known)
        small = known.count() <= broadcast_windows
        hint = F.broadcast if small else (lambda x: x)
        hashes, some = known.select("h").distinct(), ["words"] * small
        # the outer forms: for inner ones Spark infers filters on the arrays and computes them once more below
        found = _grams(own.where(F.size("words") >= n), n).withColumn("runs", F.expr(_runs("mins")))
        found = found.select("doc_id", "body", *some, F.explode_outer("runs").alias("run")).select("doc_id", "body", *some, "run.*")
        found = found.join(hint(hashes), "h", "left_semi")
        if not small:
            met = found.groupBy("doc_id", "body").agg(F.collect_set("at").alias("runs")).withColumnsRenamed({"doc_id": "m_id", "body": "m_body"})
            texts = own.join(met, F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("body").eqNullSafe(F.col("m_body")))
            found = texts.dropDuplicates(["doc_id", "body"]).select("doc_id", "body", "words", F.explode("runs").alias("at"))
        found = found.withColumn("at", F.explode(F.expr(f"sequence(at, least(at + {RUN - 1}, size(words) - {n}))")))
        found = found.select("doc_id", "body", "at", F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("span"))
        found = found.join(hint(known.select("item", "span").distinct()), "span").select("doc_id", "body", "at", (F.col("at") + n).alias("to"), "item")
        spans = found if spans is None else spans.unionByName(found)
    listed = own.select("doc_id", "body", F.size("words").cast("long").alias("n_words"))
    empty = F.array().cast("array<string>")
    if spans is None:
        return listed.select("doc_id", "body", "n_words", F.lit(0).cast("long").alias("n_hit"), empty.alias("items"), F.lit(False).alias("contaminated"))
    spans = spans.groupBy("doc_id", "body", "at", "to").agg(F.collect_set("item").alias("own"))
    so_far = Window.partitionBy("doc_id", "body").orderBy("at", "to").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("to") - F.greatest(F.col("at"), F.coalesce(F.max("to").over(so_far), F.lit(0))))
    hits = spans.withColumn("new", new).groupBy("doc_id", "body").agg(F.sum("new").cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("own")))).alias("items"))
    hits = written(hits.select(F.col("doc_id").alias("h_id"), F.col("body").alias("h_body"), "n_hit", "items"))
    out = listed.join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("body") == F.col("h_body")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "body", "n_words", n_hit.alias("n_hit"), F.coalesce("items", empty).alias("items"), (n_hit > 0).alias("contaminated"))
