"""Removal of passages that an earlier document holds: repeated-phrase automata.

1. Winnowing picks a phrase of 16 words in any 50 successive words, the same one in equal 50 words.
   A shuffle confirms the phrases that recur, with their words as 16-bit codes.
2. The confirmed phrases are dealt into shards, and each shard compiles its own into an Aho-Corasick
   automaton. All documents are streamed: a run of windows that pick one phrase goes to that phrase's
   shard (a filter holds back runs that surely have none), so no document passes through shards that
   cannot hold its phrases. Only windows around an occurrence that the automaton locates can recur.
3. Equal windows pick equal phrases and so meet in one shard, which compares them (96-bit hashes, one
   entry a lot of documents, so a passage that a third of all documents hold is no hot key) and
   answers with one bit a window: whether a smaller doc_id has it. Then the lots cut their texts.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parquill.llm import _common as C

WINDOW = 50
PHRASE = 16
#: Characters that stand for word codes begin here, past the surrogates; the next one after all codes parts runs.
FIRST_CHAR, BREAK = 0x10000, 0x20000

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
STEP = "kind int, shard long, seg int, nr int, doc_id long, n_words long, kept_sha256 string, text string, data binary"
#: Kinds of rows on the way: documents that are done, runs of windows and the answers to them, documents to cut, phrases.
DONE, RUNS, CUT, WORDS = range(4)


def _phrases(h: np.ndarray, offsets: np.ndarray, window: int, phrase: int):
    """Phrase hashes at all positions, and the window starts with the phrase each window picks."""
    x = C.rolled(h, phrase)
    x[~C.starts_of(offsets, phrase, len(x))] = C.TOP
    least = C.sliding_min(x, window - phrase + 1)
    starts = np.flatnonzero(C.starts_of(offsets, window, len(least)))
    return x, starts, least[starts]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then from starts[1], and so on."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _runs(starts: np.ndarray, least: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run: successive ones of a document that pick one phrase."""
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(starts)))


def _codes(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFF)).astype(np.uint16)


def _picked(window: int, phrase: int):
    def run(batches):
        cache = C.WordHashes()
        for pdf in batches:
            ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
            for a, b in C.chunks(texts):
                h, offsets = C.hashed([C.words_of(t) for t in texts[a:b]], cache)
                x, starts, least = _phrases(h, offsets, window, phrase)
                if not len(starts):
                    continue
                doc = np.searchsorted(offsets, starts, "right") - 1
                first, _ = _runs(starts, least, doc)
                at = starts[first]
                at = at + (x[at[:, None] + np.arange(window - phrase + 1)] == least[first][:, None]).argmax(axis=1)
                words = _codes(h)[at[:, None] + np.arange(phrase)].view(np.int64)
                out = {"h": least[first].view(np.int64), "doc_id": ids[a:b][doc[first]]}
                yield pd.DataFrame(out | {f"c{i}": words[:, i] for i in range(phrase // 4)})

    return run


def _streamed(recurring, n_segments: int, phrase: int):
    """Runs of windows that may hold a confirmed phrase, equal ones once a lot, packed for the phrases' shards."""

    def run(batches):
        cache, n, part = C.WordHashes(), 0, TaskContext.get().partitionId()
        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            known = pdf["doc_id"].notna().to_numpy()
            for a, b in C.chunks(texts):
                rows = []
                lists = [C.words_of(t) for t in texts[a:b]]
                h, offsets = C.hashed(lists, cache)
                _, starts, least = _phrases(h, offsets, WINDOW, phrase)
                doc = np.searchsorted(offsets, starts, "right") - 1
                first, size = _runs(starts, least, doc)
                hit = C.in_filter(recurring.value, least[first]) & known[a:b][doc[first]]
                first, size = first[hit], size[hit]
                key, doc, starts = least[first], doc[first], starts[first]
                some = np.zeros(b - a, bool)
                some[doc] = True
                for i in np.flatnonzero(~some).tolist():
                    rows.append((DONE, None, None, None, ids[a + i], len(lists[i]), hashlib.sha256(b" ".join(lists[i])).hexdigest(), texts[a + i], None))
                if len(first):
                    shard = (part << 32) + n
                    n += 1
                    own = np.array([int(ids[a + i]) for i in doc.tolist()], np.int64)
                    windows = _ranges(starts, size)
                    one, two = C.rolled(h, WINDOW)[windows], C.rolled(h, WINDOW, 1)[windows]
                    # equal runs: equal windows at equal places
                    at, place = np.cumsum(size) - size, (2 * _ranges(np.zeros_like(size), size) + 1).astype(np.uint64)
                    k1, k2 = (np.add.reduceat(C.mix(x) * place, at) for x in (one, two))
                    seg = (key & np.uint64(n_segments - 1)).astype(np.int64)
                    order = np.lexsort((size, k2, k1, seg))
                    new = np.ones(len(order), bool)
                    new[1:] = (np.diff(k1[order]) != 0) | (np.diff(k2[order]) != 0) | (np.diff(size[order]) != 0) | (np.diff(seg[order]) != 0)
                    lead = np.flatnonzero(new)
                    chosen, smallest = order[lead], np.minimum.reduceat(own[order], lead)
                    entry = np.empty(len(order), np.int64)
                    entry[order] = np.cumsum(new) - 1
                    seg, sizes = seg[chosen], size[chosen]
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    windows = _ranges(at[chosen], sizes)
                    one, two = one[windows], (two[windows] >> np.uint64(32)).astype(np.uint32)
                    codes = _codes(h)[_ranges(starts[chosen], sizes + WINDOW - 1)]
                    for s in np.unique(seg).tolist():
                        c, d = np.searchsorted(seg, [s, s + 1]).tolist()
                        w, v = ends[c], ends[d]
                        words = codes[w + (WINDOW - 1) * c : v + (WINDOW - 1) * d]
                        data = (smallest[c:d], one[w:v], sizes[c:d].astype(np.int32), two[w:v], words)
                        rows.append((RUNS, shard, s, d - c, None, None, None, None, b"".join(x.tobytes() for x in data)))
                    # start, windows, where their bits will stand, and whether a smaller doc_id of this lot has the whole run
                    plan = np.stack([starts - offsets[doc], size, ends[entry], own > smallest[entry]], axis=1).astype(np.int32)
                    cuts = np.searchsorted(doc, np.arange(b - a + 1))
                    for j, i in enumerate(np.flatnonzero(some).tolist()):
                        rows.append((CUT, shard, None, j, ids[a + i], len(lists[i]), None, texts[a + i], plan[cuts[i] : cuts[i + 1]].tobytes()))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in STEP.split(", ")])
                for c in ("shard", "seg", "nr", "doc_id", "n_words"):
                    out[c] = out[c].astype("Int64")
                yield out

    return run


def _automaton(phrases: np.ndarray):
    """Of phrases, one a row, as 16-bit codes of words; a word is one character."""
    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word((p.astype(np.uint32) + FIRST_CHAR).tobytes().decode("utf-32-le"), 0)
    automaton.make_automaton()
    return automaton


def _unpacked(data: bytes, n: int):
    """Smallest doc_id and number of windows of n runs, the hashes of the windows, and the words' codes."""
    sizes_at = (len(data) - (12 + 2 * (WINDOW - 1)) * n) // 14  # windows
    smallest, one = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.uint64, sizes_at, 8 * n)
    sizes, two = np.frombuffer(data, np.int32, n, 8 * (n + sizes_at)), np.frombuffer(data, np.uint32, sizes_at, 12 * n + 8 * sizes_at)
    return smallest, sizes.astype(np.int64), one, two, np.frombuffer(data, np.uint16, offset=12 * (n + sizes_at))


def _located(automaton, sizes: np.ndarray, codes: np.ndarray, phrase: int) -> np.ndarray:
    """For each window of the runs, whether the automaton locates a phrase in it."""
    lengths = sizes + WINDOW  # with a break after each run
    begins = np.cumsum(lengths) - lengths
    stream = np.full(int(lengths.sum()), BREAK, np.uint32)
    stream[_ranges(begins, lengths - 1)] = codes.astype(np.uint32) + FIRST_CHAR
    ends = np.fromiter((end for end, _ in automaton.iter(stream.tobytes().decode("utf-32-le"))), np.int64)
    at = ends - phrase + 1
    near = np.zeros(len(stream) + 1, np.int64)
    np.add.at(near, np.maximum(at - (WINDOW - phrase), 0), 1)
    np.add.at(near, at + 1, -1)
    return np.cumsum(near)[_ranges(begins, sizes)] > 0


def _compared(phrase: int):
    """For one shard: its phrases' automaton over all runs; a bit for each window, set where a smaller doc_id has it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words, pdf = pdf.loc[pdf["kind"] == WORDS, "words"], pdf[pdf["kind"] == RUNS]
        lots = [_unpacked(x, int(n)) for x, n in zip(pdf["data"], pdf["nr"], strict=True)]
        totals = [len(x[2]) for x in lots]
        bits = np.zeros(sum(totals), bool)
        if len(words) and lots:
            automaton = _automaton(np.concatenate(words.tolist()).astype(np.int64).view(np.uint16).reshape(-1, phrase))
            found = np.flatnonzero(np.concatenate([_located(automaton, sizes, codes, phrase) for _, sizes, _, _, codes in lots]))
            ids = np.concatenate([np.repeat(x[0], x[1]) for x in lots])[found]
            one, two = np.concatenate([x[2] for x in lots])[found], np.concatenate([x[3] for x in lots])[found]
            if len(found):
                order = np.lexsort((two, one))
                new = np.ones(len(order), bool)
                new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
                least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
                bits[found[order]] = ids[order] > least[np.cumsum(new) - 1]
        data = [np.packbits(x).tobytes() for x in np.split(bits, np.cumsum(totals)[:-1])] if lots else []
        return pd.DataFrame({"kind": RUNS, "shard": pdf["shard"], "seg": pdf["seg"], "nr": pd.Series(totals, index=pdf.index, dtype="int64"), "doc_id": None, "text": None, "data": pd.Series(data, index=pdf.index, dtype=object)})

    return run


def _cut(pdf: pd.DataFrame) -> pd.DataFrame:
    """A lot's documents without the words that windows of earlier documents cover."""
    answers = pdf[pdf["kind"] == RUNS].sort_values("seg")
    docs = pdf[pdf["kind"] == CUT].sort_values("nr")
    bits = np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(np.frombuffer(x, np.uint8), count=int(n)) for x, n in zip(answers["data"], answers["nr"], strict=True)]]) == 1
    lists = [C.words_of(t) for t in docs["text"]]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    plans = [np.frombuffer(x, np.int32).reshape(-1, 4).astype(np.int64) for x in docs["data"]]
    start, size, at, whole = np.concatenate(plans).T
    start = start + np.repeat(offsets[:-1], [len(x) for x in plans])
    late = _ranges(start, size)[np.repeat(whole == 1, size) | bits[_ranges(at, size)]]
    cover = np.zeros(int(offsets[-1]) + 1, np.int64)
    np.add.at(cover, late, 1)
    np.add.at(cover, late + WINDOW, -1)
    keep = np.cumsum(cover)[:-1] == 0
    kept = [b" ".join([w for w, k in zip(ws, keep[a:b].tolist(), strict=True) if k]) for ws, a, b in zip(lists, offsets[:-1], offsets[1:], strict=True)]
    return pd.DataFrame({
        "doc_id": docs["doc_id"].astype("int64").to_numpy(), "n_words": [len(x) for x in lists],
        "n_removed": [len(x) - int(keep[a:b].sum()) for x, a, b in zip(lists, offsets[:-1], offsets[1:], strict=True)],
        "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "kept": [x.decode("utf-8", "surrogatepass") for x in kept],
    })


def substring_dedup(docs: DataFrame, *, phrase: int = PHRASE) -> DataFrame:
    """Words of each text without those in a 50-word window that starts in a smaller doc_id too.

    Result: doc_id, n_words, n_removed, kept_sha256, kept (kept words joined by one space; where
    nothing was removed, the text as it was). A null or empty text has no words. A null doc_id is
    neither smaller nor larger: such a row keeps all its words. Rows with one doc_id do not affect
    each other, but count as separate rows. Windows are judged on the input. A very long text is a
    lot of its own, whole. Extra columns are ignored; an empty table gives an empty result. `phrase`
    is a multiple of four, less than the window.
    """
    spark = docs.sparkSession
    docs = C.named(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_segments = C.segments(C.text_bytes(docs))
    codes = [f"c{i}" for i in range(phrase // 4)]
    recurring = C.written(
        docs.where("doc_id is not null and text is not null")
        .mapInPandas(C.frugal(_picked(WINDOW, phrase)), ", ".join(f"{c} long" for c in ["h", "doc_id", *codes]))
        .groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), *[F.min(c).alias(c) for c in codes]).where("a < b").select("h", *codes)
    )
    bits = spark.sparkContext.broadcast(C.bit_filter(recurring, "h", recurring.count()))
    step = C.written(docs.mapInPandas(C.frugal(_streamed(bits, n_segments, phrase)), STEP))
    done = step.where(F.col("kind") == DONE).selectExpr("doc_id", "n_words", "0L as n_removed", "kept_sha256", "text as kept")
    runs = step.where(F.col("kind") == RUNS).select("kind", "shard", "seg", "nr", "data")
    seg = F.col("h").bitwiseAND(F.lit(n_segments - 1)).cast("int").alias("seg")
    words = recurring.select(F.lit(WORDS).alias("kind"), seg, F.array(*codes).alias("words"))
    columns = "kind int, shard long, seg int, nr int, doc_id long, text string, data binary"
    answers = runs.unionByName(words, allowMissingColumns=True).groupBy("seg").applyInPandas(_compared(phrase), columns)
    cut = step.where(F.col("kind") == CUT).select(*[c.split()[0] for c in columns.split(", ")])
    return done.unionByName(cut.unionByName(answers).groupBy("shard").applyInPandas(_cut, RESULT))
