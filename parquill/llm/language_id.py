"""Language of texts by a bidirectional gated recurrent network over bytes, in numpy.

Trained by backpropagation through time on a bounded sample: every position of a piece carries the
document's language as its label. Prediction labels every byte of the whole text, in pieces of
PIECE bytes that run side by side, and averages the probabilities over the document.
Gates are piecewise linear (clipped), so no exponentials are taken inside the recurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parquill.llm import _common as C

HIDDEN = 12
PIECE = 256
#: Default bounds of the training sample: documents a language, and languages (the most frequent ones).
SAMPLE = 300
LANGUAGES = 256
STEPS, BATCH, SPAN = 220, 96, 48
#: Pieces that run side by side.
ROWS = 4096
NONE = "und"

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _cell(table, u, h, x):
    """One step for all rows; what the way back needs comes along."""
    n = h.shape[1]
    own, gates = table[x], h @ u
    zr = np.clip((own[:, : 2 * n] + gates[:, : 2 * n]) * np.float32(0.25) + np.float32(0.5), 0, 1)
    z, r, c = zr[:, :n], zr[:, n:], gates[:, 2 * n :]
    new = np.clip(own[:, 2 * n :] + r * c, -1, 1)
    return new + z * (h - new), (h, z, r, c, new)


class Network:
    """Byte tables and recurrent weights of both directions, and the output layer."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, k = languages, len(languages)
        self.p = {}
        for d in ("f", "b"):
            self.p["t" + d] = (rng.normal(size=(256, 3 * HIDDEN)) * 0.3).astype(np.float32)
            self.p["u" + d] = (rng.normal(size=(HIDDEN, 3 * HIDDEN)) * 0.3).astype(np.float32)
            self.p["v" + d] = (rng.normal(size=(HIDDEN, k)) * 0.3).astype(np.float32)
        self.p["o"] = np.zeros(k, np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss over positions of byte rows x with languages y, and its gradients."""
        rows, span = x.shape
        states, kept = {}, {}
        for d, order in (("f", range(span)), ("b", range(span - 1, -1, -1))):
            h = np.zeros((rows, HIDDEN), np.float32)
            states[d], kept[d] = np.empty((span, rows, HIDDEN), np.float32), [None] * span
            for t in order:
                h, kept[d][t] = _cell(self.p["t" + d], self.p["u" + d], h, x[:, t])
                states[d][t] = h
        logits = states["f"] @ self.p["vf"] + states["b"] @ self.p["vb"] + self.p["o"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        at = np.arange(rows)
        loss = float(-np.log(prob[:, at, y] + 1e-12).mean())
        prob[:, at, y] -= 1
        prob /= rows * span
        g = {"o": prob.sum(axis=(0, 1))}
        n = HIDDEN
        for d, order in (("f", range(span - 1, -1, -1)), ("b", range(span))):
            g["v" + d] = np.einsum("trh,trk->hk", states[d], prob)
            outer = prob @ self.p["v" + d].T
            table, u = np.zeros_like(self.p["t" + d]), np.zeros_like(self.p["u" + d])
            dh = np.zeros((rows, n), np.float32)
            for t in order:
                h, z, r, c, new = kept[d][t]
                dh = dh + outer[t]
                da = np.empty((rows, 3 * n), np.float32)
                dnew = dh * (1 - z) * (np.abs(new) < 1)
                da[:, :n] = dh * (h - new) * ((z > 0) & (z < 1)) * np.float32(0.25)
                da[:, n : 2 * n] = dnew * c * ((r > 0) & (r < 1)) * np.float32(0.25)
                da[:, 2 * n :] = dnew
                np.add.at(table, x[:, t], da)
                da[:, 2 * n :] = dnew * r
                u += h.T @ da
                dh = dh * z + da @ self.p["u" + d].T
            g["t" + d], g["u" + d] = table, u
        return loss, g

    def train(self, texts: list[bytes], y: np.ndarray, seed: int = 11) -> list[float]:
        """Adam over random spans of the texts, languages drawn alike."""
        rng, losses = np.random.default_rng(seed), []
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        of = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        for step in range(1, STEPS + 1):
            pick = [int(rng.choice(of[int(rng.integers(len(of)))])) for _ in range(BATCH)]
            x = np.full((BATCH, SPAN), 32, np.uint8)
            for i, p in enumerate(pick):
                t = texts[p]
                at = int(rng.integers(max(1, len(t) - SPAN + 1)))
                piece = np.frombuffer(t[at : at + SPAN], np.uint8)
                x[i, : len(piece)] = piece
            loss, g = self.gradients(x, y[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            rate = 0.02 * (1 if step < STEPS * 0.7 else 0.3)
            for k, v in g.items():
                v = v * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses

    def positions(self, pieces: list[np.ndarray]) -> np.ndarray:
        """For pieces sorted by falling length: the sum of their positions' probabilities."""
        sizes = np.array([len(p) for p in pieces])
        span, k = int(sizes[0]), len(self.languages)
        x = np.zeros((span, len(pieces)), np.uint8)
        if (sizes == span).all():
            x[:] = np.stack(pieces).T
        else:
            for i, p in enumerate(pieces):
                x[: len(p), i] = p
        live = len(pieces) - np.searchsorted(sizes[::-1], np.arange(span), "right")
        logits = np.empty((span, len(pieces), k), np.float32)
        for d, order in (("f", range(span)), ("b", range(span - 1, -1, -1))):
            h = np.zeros((len(pieces), HIDDEN), np.float32)
            table, u, v = self.p["t" + d], self.p["u" + d], self.p["v" + d]
            for t in order:
                n = int(live[t])
                h[:n], _ = _cell(table, u, h[:n], x[t, :n])
                if d == "f":
                    logits[t, :n] = h[:n] @ v + self.p["o"]
                else:
                    logits[t, :n] += h[:n] @ v
        out = np.zeros((len(pieces), k))
        for t in range(span):
            e = logits[t, : int(live[t])]
            e = np.exp(e - e.max(axis=1, keepdims=True))
            out[: len(e)] += e / e.sum(axis=1, keepdims=True)
        return out

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each non-empty text."""
        pieces, of = [], []
        for i, t in enumerate(texts):
            b = np.frombuffer(t, np.uint8)
            for a in range(0, len(b), PIECE):
                pieces.append(b[a : a + PIECE])
                of.append(i)
        order = sorted(range(len(pieces)), key=lambda j: -len(pieces[j]))
        out = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(order), ROWS):
            some = order[a : a + ROWS]
            np.add.at(out, [of[j] for j in some], self.positions([pieces[j] for j in some]))
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-12)


def training_rows(docs: DataFrame, fold: int = 5) -> DataFrame:
    """What may be learned from: documents whose crc32 of the doc_id as text is not 0 modulo `fold`."""
    return C.named(docs, "doc_id", "text", "lang").where(F.expr(f"crc32(cast(doc_id as string)) % {fold} <> 0"))


def fit(docs: DataFrame, *, sample: int = SAMPLE, languages: int = LANGUAGES) -> Network | None:
    """A network from a bounded sample of labelled rows: `sample` documents of each of the `languages`
    most frequent languages (the first in order of equally frequent ones), picked by a hash of the
    doc_id, 2000 characters of each from a place that the hash gives too."""
    docs = docs.where("lang is not null and text is not null and doc_id is not null and length(text) > 0")
    counts = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    rates = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, (2.0 * sample + 50) / r["count"]))) for r in counts], F.lit(0.0))
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    at = F.floor(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / F.lit(float(1 << 20)) * F.greatest(F.lit(1), F.length("text") - 2000)).cast("int")
    rows = docs.where(part < rates).select("lang", part.alias("part"), F.substr("text", at + F.lit(1), F.lit(2000)).alias("text")).collect()
    rows.sort(key=lambda r: (r["part"], r["lang"], r["text"]))
    texts, y, seen = [], [], dict.fromkeys(sorted(r["lang"] for r in counts), 0)
    for r in rows:
        if seen[r["lang"]] < sample and has_letter(r["text"]):
            seen[r["lang"]] += 1
            texts.append(r["text"].encode("utf-8", "surrogatepass"))
            y.append(r["lang"])
    learned = [x for x in seen if seen[x]]
    if not learned:
        return None
    network = Network(learned)
    network.train(texts, np.array([learned.index(x) for x in y]))
    return network


def predictor(spark: SparkSession, network: Network | None):
    """A function of a text column that gives a struct of lang_pred and score."""
    model = spark.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from C.frugal(found)(batches)

    def found(batches):
        net = model.value
        for series in batches:
            texts = series.tolist()
            langs, scores = [NONE] * len(texts), [0.0] * len(texts)
            for a, b in C.chunks(texts):
                some = [i for i in range(a, b) if net is not None and has_letter(texts[i])]
                if some:
                    prob = net.probabilities([texts[i].encode("utf-8", "surrogatepass") for i in some])
                    for i, k, p in zip(some, prob.argmax(axis=1), prob.max(axis=1), strict=True):
                        langs[i], scores[i] = net.languages[k], min(1.0, float(p))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return run


def language_id(docs: DataFrame, *, fold: int = 5, sample: int = SAMPLE, languages: int = LANGUAGES, network: Network | None = None) -> DataFrame:
    """The language of every whole text, by a network that learns from documents not held out.

    Held out: crc32 of the doc_id as text is 0 modulo `fold`. Result: doc_id, held_out, lang_pred,
    score (mean probability of that language over all bytes). Texts that are null or have no letter
    are `und` with score 0, and so is everything if there is nothing to learn from. Only the text is
    an input of a prediction, so repeated rows agree; a null doc_id has a null held_out and is not
    learned from. Every byte of a very long text counts; of equally probable languages the first in
    order is given. Extra columns are ignored; an empty table gives an empty result.
    """
    held = F.expr(f"crc32(cast(doc_id as string)) % {fold} = 0")
    if network is None:
        network = fit(training_rows(docs, fold), sample=sample, languages=languages)
    out = C.named(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), predictor(docs.sparkSession, network)("text").alias("found"))
    return out.select("doc_id", held.alias("held_out"), "found.lang_pred", "found.score")
