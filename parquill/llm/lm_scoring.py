"""Bigram scores from a log-frequency Bloom filter.

Counts: every task counts the words and word pairs of its documents and deals them to at most FAN
parts of the hash space, so that what it sends stays in few pieces however large the input is; where
more parts are needed, further rounds merge a part's pieces and deal them on. Each part is summed on
its own. A part also builds its piece of the filter: a pair with count c enters with the levels
1 .. 1 + floor(log_B c); a lookup probes the levels in turn until one misses, so an answer is never
too low, and rarely one level too high.

The filter grows with what was counted: ITEM_BITS for each item, nothing is left out. Up to
`filter_bytes` it is broadcast. The base scores then use exact counts: those of the most frequent
words (at most HEAD, broadcast) in the scoring pass, those of the others by a join.

A larger filter never leaves its parts. The distinct words and pairs of each chunk of documents go
to the parts once, with their counts if the chunk is learned from. A part sums them, builds its
pieces of the filter, looks each distinct word or pair up once and answers all chunks: a level a
byte, and for words the exact count. A chunk meets its answers by its number and is scored from
them alone. Both ways give the same scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parquill.llm import _common as C

#: Most words whose exact counts are broadcast: 16 bytes each.
HEAD = 1 << 18
#: The largest filter that is broadcast.
FILTER_BYTES = 128 << 20
#: Texts of more than so many times the filter that may be broadcast are not counted for one.
TEXT_SHARE = 8
LEVEL_BASE = 1.5
LEVELS = 64
ITEM_BITS = 8
PROBES = 4
#: Weight of the word's own frequency against the pair's, in counts.
PRIOR = 4.0
#: Tokens that a task counts at a time, and bytes of text that it takes in and scores at a time.
TOKENS = 1_000_000
BYTES = 2 << 20
#: Bytes of text whose words and pairs are asked for at a time.
CHUNK_BYTES = 4 << 20
#: Parts that a task deals to at once, bytes of text for each part in the end, and bytes of counts merged at a time.
FAN = 1024
PART_BYTES = 4 << 20
MERGED = 8 << 20
#: Not words, as words hold no space.
END, START = b" end", b" start"
WORD, PAIR = 0, 1
#: The largest count that a piece holds for a hash.
MOST = (1 << 32) - 1

COUNTED = "kind int, seg int, data binary"
PART = "kind int, seg int, total long, kinds long, levels array<long>, counts binary, bits long, filter binary"
CHUNK = "chunk long, learned boolean, ids array<string>, sizes array<int>, texts binary"
ASKED = "chunk long, kind int, seg int, data binary"
#: chunk is -1 in the row that sums up a part.
ANSWER = "chunk long, kind int, seg int, data binary, total long, kinds long"
SUMS = "doc_id long, n_tokens long, head_known long, head_sum double, score double"
SCORED = f"row long, {SUMS}, tail array<long>"


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _tokens(texts: list[bytes], cache: C.WordHashes):
    """Token hashes of the documents, each with its end, the hashes before them, and offsets."""
    lists = []
    for t in texts:
        lists.append(t.lower().split())
        lists[-1].append(END)
    h, offsets = C.hashed(lists, cache)
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[offsets[:-1]] = cache[START]
    return h, before, offsets


def _pairs(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    return C.mix(before * np.uint64(C.BASES[0]) + h)


def _packed(h: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes, byte by byte so that they compress, then counts."""
    return h.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(np.uint32).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    h = np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T).view(np.uint64).reshape(n)
    return h, np.frombuffer(data, np.uint32, n, 8 * n)


def _shift(n_parts: int) -> np.uint64:
    """By how much hashes are shifted for their part; n_parts is a power of two."""
    return np.uint64(64 - n_parts.bit_length() + 1)


def _dealt(h: np.ndarray, n_parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of sorted hashes, for parts that hold some."""
    if n_parts == 1 or not len(h):
        return [(0, 0, len(h))] * (len(h) > 0)
    part = (h >> _shift(n_parts)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    return list(zip(part[first].tolist(), first.tolist(), [*first[1:].tolist(), len(h)], strict=True))


def _counted(n_parts: int):
    def emit(held):
        for kind in (WORD, PAIR):
            h, counts = np.unique(np.concatenate([x[kind] for x in held]), return_counts=True)
            rows = [(kind, s, _packed(h[a:b], counts[a:b])) for s, a, b in _dealt(h, n_parts)]
            yield pd.DataFrame(rows, columns=["kind", "seg", "data"])

    def run(batches):
        cache, held, size = C.WordHashes(), [], 0
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in C.chunks(texts, BYTES):
                h, before, _ = _tokens([_utf8(t) for t in texts[a:b]], cache)
                held.append((C.mix(h), _pairs(before, h)))
                size += len(h)
                if size >= TOKENS:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    return run


def _merged(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted hashes of several pieces, with their summed counts."""
    both = [_unpacked(x) for x in pieces]
    h, c = np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(c, first)


def _dealt_on(n_parts: int):
    """Pieces of few parts merged and cut for more parts; counts beyond 32 bits go in several pieces."""

    def emit(held):
        for kind, pieces in held.items():
            h, c = _merged(pieces)
            while len(h):
                now = np.minimum(c, MOST)
                rows = [(kind, s, _packed(h[a:b], now[a:b])) for s, a, b in _dealt(h, n_parts)]
                yield pd.DataFrame(rows, columns=["kind", "seg", "data"])
                more = c > MOST
                h, c = h[more], c[more] - MOST

    def run(batches):
        held, size = {}, 0
        for pdf in batches:
            for kind, data in zip(pdf["kind"].tolist(), pdf["data"], strict=True):
                held.setdefault(kind, []).append(data)
                size += len(data)
                if size >= MERGED:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    return run


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(counts) / np.log(LEVEL_BASE) + 1e-9).astype(np.int64), LEVELS - 1)


def count_of_level() -> np.ndarray:
    """For each level the middle of the whole counts that have it; 0 for level 0."""
    edges = np.ceil(LEVEL_BASE ** np.arange(LEVELS) - 1e-6)
    return np.concatenate([[0.0], (edges[:-1] + np.maximum(edges[1:] - 1, edges[:-1])) / 2])


def _places(h: np.ndarray, level, bits) -> list[np.ndarray]:
    x = C.mix(h + np.uint64(C.BASES[1]) * np.asarray(level, np.uint64))
    a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [(a + np.uint64(j) * b) % bits for j in range(PROBES)]


def _piece(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, int, bytes]:
    """Counted hashes of one part: how many have each level, and the part's piece of the filter with its bits."""
    level = level_of(c)
    hist = np.bincount(level, minlength=LEVELS)
    bits = max(64, -(-int((hist * np.arange(LEVELS)).sum()) * ITEM_BITS // 64) * 64)
    held = np.zeros(bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        for p in _places(h[level >= j], j, np.uint64(bits)):
            held[p.astype(np.int64)] = True
    return hist, bits, np.packbits(held).tobytes()


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and filter of one part."""
    try:
        h, c = _merged(list(pdf["data"]))
        hist, bits, held = _piece(h, c)
        kind = int(pdf["kind"].iloc[0])
        return pd.DataFrame({
            "kind": [kind], "seg": [int(pdf["seg"].iloc[0])], "total": [int(c.sum())], "kinds": [len(h)], "levels": [hist.tolist()],
            "counts": [h.tobytes() + c.tobytes() if kind == WORD else None], "bits": [bits], "filter": [held],
        })
    finally:
        C.release()


class Filter:
    """All parts of the filter of one kind, for lookups."""

    def __init__(self, parts: list[tuple[int, int, bytes]], n_segments: int):
        self.shift = _shift(n_segments) if n_segments > 1 else None
        self.bits, self.start = np.ones(n_segments, np.uint64), np.zeros(n_segments, np.uint64)
        size, data = 1, [b"\0"]
        for seg, bits, held in parts:
            self.bits[seg], self.start[seg] = bits, size * 8
            size += len(held)
            data.append(held)
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Highest level up to which all probes hit."""
        seg = (h >> self.shift).astype(np.int64) if self.shift is not None else np.zeros(len(h), np.int64)
        bits, start = self.bits[seg], self.start[seg]
        out, left = np.zeros(len(h), np.int64), np.arange(len(h))
        for j in range(1, LEVELS):
            alive = np.ones(len(left), bool)
            for p in _places(h[left], j, bits[left]):
                p = p + start[left]
                alive &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & 1 == 1
            left = left[alive]
            out[left] = j
            if not len(left):
                break
        return out


def _sums(tokens, ids, words, pairs, exact, total: int, kinds: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Per document: sums over its tokens. Also the words of all tokens, and which of them `exact` knows.

    `words` and `pairs` give the levels of sorted distinct hashes, `exact` the counts of words, or 0.
    """
    counts, size = count_of_level(), total + kinds + 1
    h, before, offsets = tokens
    one, inverse = np.unique(C.mix(h), return_inverse=True)
    own = counts[words(one)]
    end = own[inverse[offsets[1] - 1]]
    p_word = ((own + 1) / size)[inverse]
    past = np.empty(len(h))
    past[1:] = own[inverse[:-1]]
    past[offsets[:-1]] = end
    two, where = np.unique(_pairs(before, h), return_inverse=True)
    both = np.minimum(counts[pairs(two)][where], past)
    p = np.minimum((both + PRIOR * p_word) / (past + PRIOR), 1.0)
    times = exact(one)
    logs, known = np.log10(times + 1.0)[inverse], (times > 0)[inverse]
    out = pd.DataFrame({
        "doc_id": pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64"), "n_tokens": np.diff(offsets),
        "head_known": np.add.reduceat(known.astype(np.int64), offsets[:-1]), "head_sum": np.add.reduceat(logs, offsets[:-1]), "score": np.add.reduceat(np.log10(p), offsets[:-1]),
    })
    return out, one.view(np.int64)[inverse], known


def _in_head(head: np.ndarray, head_counts: np.ndarray):
    """Counts of sorted words, 0 of those outside the head."""

    def exact(one: np.ndarray) -> np.ndarray:
        if not len(head):
            return np.zeros(len(one), np.int64)
        at = np.minimum(np.searchsorted(head, one), len(head) - 1)
        return np.where(head[at] == one, head_counts[at], 0)

    return exact


def _scored(words_, pairs_, head_, total: int, kinds: int):
    """Scores with the whole filter at hand, and the words outside the head."""

    def run(batches):
        cache, row = C.WordHashes(), TaskContext.get().partitionId() << 32
        exact = _in_head(*head_.value)
        for pdf in batches:
            ids, texts = pdf["id"].tolist(), pdf["text"].tolist()
            for a, b in C.chunks(texts, BYTES):
                tokens = _tokens([_utf8(t) for t in texts[a:b]], cache)
                out, words, known = _sums(tokens, ids[a:b], words_.value.levels, pairs_.value.levels, exact, total, kinds)
                out.insert(0, "row", row + np.arange(b - a))
                out["tail"] = [words[x:y][~known[x:y]] for x, y in zip(tokens[2][:-1], tokens[2][1:], strict=True)]
                yield out
                row += b - a

    return run


def _chunked(batches):
    """Documents in chunks of one row each, those to learn from apart from the others."""
    number = TaskContext.get().partitionId() << 32
    held, size = {True: [], False: []}, {True: 0, False: 0}

    def row(learned):
        some, held[learned], size[learned] = held[learned], [], 0
        texts = pa.compress(b"".join(t for _, t in some), codec="zstd", asbytes=True)
        return pd.DataFrame({"chunk": [number], "learned": [learned], "ids": [[i for i, _ in some]], "sizes": [[len(t) for _, t in some]], "texts": [texts]})

    for pdf in batches:
        for i, text, learned in zip(pdf["id"].tolist(), pdf["text"].tolist(), pdf["learned"].tolist(), strict=True):
            text = _utf8(text)
            held[learned].append((None if pd.isna(i) else i, text))
            size[learned] += len(text) + 1
            if size[learned] >= CHUNK_BYTES:
                yield row(learned)
                number += 1
    for learned in held:
        if held[learned]:
            yield row(learned)
            number += 1


def _tokens_of_chunk(sizes, data: bytes):
    """As _tokens, for the texts of one chunk."""
    ends = np.cumsum(sizes).tolist()
    text = pa.decompress(data, decompressed_size=ends[-1], codec="zstd", asbytes=True) if ends[-1] else b""
    texts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    cache = C.WordHashes()
    lots = [_tokens(texts[a:b], cache) for a, b in C.chunks(texts, BYTES)]
    starts = np.cumsum([0, *[len(x[0]) for x in lots]])
    return np.concatenate([x[0] for x in lots]), np.concatenate([x[1] for x in lots]), np.concatenate([[0], *[x[2][1:] + n for x, n in zip(lots, starts, strict=False)]])


def _asked(n_parts: int):
    """The distinct words and pairs of each chunk, with counts if it is learned from, cut for the parts."""

    def run(batches):
        for pdf in batches:
            for chunk, learned, sizes, data in zip(pdf["chunk"].tolist(), pdf["learned"].tolist(), pdf["sizes"], pdf["texts"], strict=True):
                h, before, _ = _tokens_of_chunk(sizes, data)
                for kind, every in ((WORD, C.mix(h)), (PAIR, _pairs(before, h))):
                    x, c = np.unique(every, return_counts=True)
                    c *= learned
                    rows = [(chunk, kind, s, _packed(x[a:b], c[a:b])) for s, a, b in _dealt(x, n_parts)]
                    yield pd.DataFrame(rows, columns=["chunk", "kind", "seg", "data"])

    return run


def _answer(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of asked hashes with the counts that came with them: levels, whole counts, and the number of distinct ones that were counted."""
    order = np.argsort(h)
    h = h[order]
    first = np.concatenate([[True], h[1:] != h[:-1]])
    at = np.flatnonzero(first)
    one, counts = h[at], np.add.reduceat(c[order].astype(np.int64), at)
    seen = counts > 0
    _, bits, held = _piece(one[seen], counts[seen])
    levels = Filter([(0, bits, held)], 1).levels(one).astype(np.uint8)
    where = np.empty(len(h), np.int64)
    where[order] = np.cumsum(first) - 1
    return levels[where], counts[where], int(seen.sum())


def _answered(n_segments: int, n_parts: int):
    """All answers of one part, which may stand for several pieces of the filter, and its sums."""
    within = range(1, n_segments // n_parts)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            kind, part = int(pdf["kind"].iloc[0]), int(pdf["seg"].iloc[0])
            asked = [_unpacked(x) for x in pdf["data"]]
            edges = np.array([(part * (len(within) + 1) + i) << int(_shift(n_segments)) for i in within], np.uint64)
            cuts = np.array([[0, *np.searchsorted(h, edges), len(h)] for h, _ in asked])
            levels, counts = [np.empty(len(h), np.uint8) for h, _ in asked], [np.empty(len(h), np.int64) for h, _ in asked]
            total = kinds = 0
            for i in range(len(within) + 1):
                a, b = cuts[:, i].tolist(), cuts[:, i + 1].tolist()
                if sum(b) == sum(a):
                    continue
                found, times, n = _answer(*(np.concatenate([x[j][s:e] for x, s, e in zip(asked, a, b, strict=True)]) for j in (0, 1)))
                total, kinds = total + sum(int(x[1][s:e].sum(dtype=np.int64)) for x, s, e in zip(asked, a, b, strict=True)), kinds + n
                at = 0
                for k, (s, e) in enumerate(zip(a, b, strict=True)):
                    levels[k][s:e], counts[k][s:e] = found[at : at + e - s], times[at : at + e - s]
                    at += e - s
            data = [x.tobytes() + (y.view(np.uint8).reshape(-1, 8).T.tobytes() if kind == WORD else b"") for x, y in zip(levels, counts, strict=True)]
            rows = pd.DataFrame({"chunk": pdf["chunk"], "kind": kind, "seg": part, "data": data, "total": 0, "kinds": 0})
            return pd.concat([rows, pd.DataFrame({"chunk": [-1], "kind": [kind], "seg": [part], "data": [None], "total": [total], "kinds": [kinds]})])
        finally:
            C.release()

    return run


def _scored_chunk(total: int, kinds: int):
    """Scores of one chunk from its answers."""

    def run(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        try:
            # sorted hashes lie in the order of their parts
            answers = answers.sort_values("seg")
            own = [x for x in answers["data"][answers["kind"] == WORD]]
            ns = [len(x) // 9 for x in own]
            words = np.concatenate([np.frombuffer(x, np.uint8, n) for x, n in zip(own, ns, strict=True)])
            times = np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8, 8 * n, n).reshape(8, n).T).view(np.int64).reshape(n) for x, n in zip(own, ns, strict=True)])
            pairs = np.frombuffer(b"".join(answers["data"][answers["kind"] == PAIR]), np.uint8)
            tokens = _tokens_of_chunk(chunk["sizes"].iloc[0], chunk["texts"].iloc[0])
            return _sums(tokens, list(chunk["ids"].iloc[0]), lambda _: words, lambda _: pairs, lambda _: times, total, kinds)[0]
        finally:
            C.release()

    return run


def _asked_by_chunks(docs: DataFrame, is_held, n_segments: int, n_parts: int) -> tuple[DataFrame, int, int]:
    """Sums over the tokens of each document without a filter in one place; tokens learned from, and how many are distinct."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), "text", F.coalesce(~is_held, F.lit(False)).alias("learned"))
    with C.small_batches(spark):
        chunks = C.written(texts.mapInPandas(C.frugal(_chunked), CHUNK))
        asked = chunks.select("chunk", "learned", "sizes", "texts").mapInPandas(C.frugal(_asked(n_parts)), ASKED)
        answers = C.written(asked.groupBy("kind", "seg").applyInPandas(_answered(n_segments, n_parts), ANSWER))
    total, kinds = answers.where(f"chunk = -1 and kind = {WORD}").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    own = answers.where("chunk >= 0").select("chunk", "kind", "seg", "data")
    step = chunks.select("chunk", "ids", "sizes", "texts").groupBy("chunk").cogroup(own.groupBy("chunk")).applyInPandas(_scored_chunk(total, kinds), SUMS)
    return step, total, kinds


def _words_of_parts(batches):
    for pdf in batches:
        for data in pdf["counts"]:
            n = len(data) // 16
            yield pd.DataFrame({"w": np.frombuffer(data, np.int64, n), "c": np.frombuffer(data, np.int64, n, 8 * n)})


def lm_scoring(docs: DataFrame, *, fold: int = 7, held_out: int = 2, filter_bytes: int = FILTER_BYTES, fan: int = FAN) -> DataFrame:
    """Log10 probabilities of all texts under a bigram model of the documents not held out.

    Tokens: words [^\\x20\\x09-\\x0D]+ with A-Z in lower case, then one end. Held out: crc32 of the
    doc_id as text, modulo `fold`, is `held_out`. Result: doc_id, held_out, n_tokens, n_known
    (tokens seen in training), train_tokens, base_score (add-one word model, exact counts), score
    (pair counts from the filter, with PRIOR counts spread by word frequency). A filter of more than
    `filter_bytes` is asked by a shuffle instead of a broadcast, with the same scores; texts of more
    than TEXT_SHARE times that are taken to need one. `fan`, a power of two, is the most parts dealt to at once.

    A null or empty text is a document of one token, the end. A very long text is scored whole, by the
    task that holds its row. A null doc_id is scored, with null
    held_out, and not learned from. Repeated rows count each. With nothing to learn from, scores
    are those of unseen words. Extra columns are ignored; an empty table gives an empty result.
    """
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    docs = C.named(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_held = F.expr(f"crc32(cast(doc_id as string)) % {fold} = {held_out}")
    n_bytes = C.text_bytes(docs)
    n_segments = C.segments(n_bytes, each=PART_BYTES)
    n_parts = min(n_segments, fan)

    def result(step: DataFrame, total: int, kinds: int, tail_known, tail_sum) -> DataFrame:
        return step.select(
            "doc_id", "held_out", "n_tokens",
            (F.col("head_known") + tail_known).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("head_sum") + tail_sum - F.col("n_tokens") * F.lit(float(np.log10(total + kinds + 1)))).alias("base_score"),
            "score",
        )

    def asked() -> DataFrame:
        step, total, kinds = _asked_by_chunks(docs, is_held, n_segments, n_parts)
        return result(step.withColumn("held_out", is_held), total, kinds, F.lit(0), F.lit(0.0))

    if n_bytes > TEXT_SHARE * filter_bytes:
        return asked()
    with C.small_batches(spark):
        blobs = docs.where(~is_held).select("text").mapInPandas(C.frugal(_counted(n_parts)), COUNTED)
        dealt = n_parts
        while dealt < n_segments:
            dealt = min(n_segments, dealt * fan)
            blobs = blobs.repartition("kind", "seg").mapInPandas(C.frugal(_dealt_on(dealt)), COUNTED)
        parts = C.written(blobs.groupBy("kind", "seg").applyInPandas(_summed, PART))
    n_bits = parts.agg(F.sum("bits")).first()[0] or 0
    # each part of a broadcast filter costs 16 bytes more for each kind
    if n_bits // 8 + 32 * n_segments > filter_bytes:
        C.discard(parts)
        return asked()
    totals = parts.where(f"kind = {WORD}").agg(F.sum("total"), F.sum("kinds"), *[F.sum(F.col("levels")[j]) for j in range(LEVELS)]).first()
    total, kinds, hist = totals[0] or 0, totals[1] or 0, np.array([x or 0 for x in totals[2:]])
    fits = np.flatnonzero(np.cumsum(hist[::-1])[::-1] <= HEAD)
    least = int(fits[0])
    words = parts.where(f"kind = {WORD}").select("counts").mapInPandas(_words_of_parts, "w long, c long")
    is_head = F.floor(F.log(F.col("c").cast("double")) / float(np.log(LEVEL_BASE)) + 1e-9) + 1 >= least
    top = words.where(is_head).toArrow()
    w, c = top["w"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(w)
    head = sc.broadcast((w[order], c[order]))
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    made = {}
    for kind in (WORD, PAIR):
        made[kind] = Filter([(r[0], r[1], bytes(r[2])) for r in parts.where(f"kind = {kind}").select("seg", "bits", "filter").toLocalIterator()], n_segments)
    step = texts.mapInPandas(C.frugal(_scored(sc.broadcast(made[WORD]), sc.broadcast(made[PAIR]), head, total, kinds)), SCORED)
    with C.small_batches(spark):
        step = C.written(step.withColumn("held_out", is_held))
    tail = step.select("row", F.explode("tail").alias("w")).join(words.where(~is_head), "w").groupBy("row")
    tail = tail.agg(F.count("*").alias("tail_known"), F.sum(F.log10(F.col("c") + F.lit(1.0))).alias("tail_sum"))
    return result(step.join(tail, "row", "left"), total, kinds, F.coalesce("tail_known", F.lit(0)), F.coalesce("tail_sum", F.lit(0.0)))
