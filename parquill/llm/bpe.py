"""Byte-pair encoding with word ends: speculate and verify.

A greedy longest match proposes the tokens of each new word. A sequence of tokens is what merging
gives just when each token is what its own characters merge to and each two neighbours stay
apart; whether neighbours stay apart is tested for all pairs of a batch at once, by undoing the
later of their last merges step by step and looking for an earlier merge across the border. Only
words that fail are merged exactly.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from parquill.llm import _common as C

#: Words whose tokens a worker keeps while it works on one partition.
CACHE_WORDS = 200_000
NEVER = np.int64(1) << 40
_NONE = (1 << 40, -1)

#: The printable stand-ins of bytes in byte-level vocabularies (33-126, 161-172,
#: 174-255 stand for themselves; the others follow from 256 on).
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _SELF} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SELF)}
_TABLE = {b: BYTE_CHARS[b] for b in range(256)}

#: Texts of these characters only are split here; others by the tokenizer's own normaliser and splitter.
_PLAIN = re.compile(r"[\t-\r -~\xa0-\xff]*")
_L = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t-\r \xa0{_L}{_N}]+")
#: The pattern that the fast splitter stands for; another one leaves all texts to the library.
_KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordBpe:
    """Encoder from the contents of a tokenizer file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        data = json.loads(content)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        self.special_at = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.names = [""] * size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.names[i] = t
        #: Longest token, with its word end, for each beginning of up to three characters.
        self.longest: dict[str, int] = {}
        for t in self.vocab:
            body = t[: -len(self.end)] if self.end and t.endswith(self.end) and t != self.end else t
            for k in (1, 2, 3):
                if len(body) >= k:
                    self.longest[body[:k]] = max(len(body), self.longest.get(body[:k], 0))
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if (x, y) not in self.merges:
                self.merges[x, y] = (r, z)
                if self.rank[z] < 0:
                    self.rank[z], self.left[z], self.right[z] = r, x, y
        keys = np.array([(x << 32) | y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], NEVER << 20)
        self.pair_ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], NEVER)
        self.sound: dict[int, bool] = {}
        pattern = str(data.get("pre_tokenizer"))
        self.fast = repr(_KNOWN)[1:-1] in pattern or _KNOWN in pattern
        #: What is known of plain texts' words, and of what stands between white space there (a word or
        #: several: no word is parted again, so one table serves both); of words in byte characters.
        self.plain: dict[str, tuple[bytes, str]] = {}
        self.mapped: dict[str, tuple[bytes, str]] = {}

    def symbols(self, word: str) -> list[int]:
        pieces = [*word[:-1], word[-1] + self.end] if word else []
        return [self.vocab[p] for p in pieces if p in self.vocab]

    def merged(self, ids: list[int]) -> list[int]:
        """Exact merging: always the lowest rank, leftmost first."""
        n, find = len(ids), self.merges.get
        if n <= 48:
            ids = ids[:]
            ranks = [find(p, _NONE) for p in zip(ids, ids[1:], strict=False)]
            while ranks and (least := min(ranks)) is not _NONE:
                i = ranks.index(least)
                ids[i] = z = least[1]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = find((ids[i - 1], z), _NONE)
                if i < len(ranks):
                    ranks[i] = find((z, ids[i + 1]), _NONE)
            return ids
        ids, after, before, live = list(ids), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heap = [(r, i, z, x, y) for r, z, i, x, y in heap]
        heapq.heapify(heap)
        while heap:
            _, i, z, x, y = heapq.heappop(heap)
            if not live[i] or ids[i] != x or (j := after[i]) >= n or ids[j] != y:
                continue
            ids[i], live[j], after[i] = z, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := self.merges.get((z, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, m[1], z, ids[after[i]]))
            if (h := before[i]) >= 0 and (m := self.merges.get((ids[h], z))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], z))
        return [t for t, x in zip(ids, live, strict=True) if x]

    def proposed(self, word: str) -> list[int] | None:
        find, longest, n, i, out = self.vocab.get, self.longest.get, len(word), 0, []
        whole = word + self.end
        while i < n:
            most = longest(word[i : i + 3]) or longest(word[i : i + 2]) or 1
            j = i + most
            if j >= n:
                j = n
                if (t := find(whole[i:])) is not None:
                    out.append(t)
                    break
                j -= 1
            while j > i and (t := find(word[i:j])) is None:
                j -= 1
            if j == i:
                return None
            out.append(t)
            i = j
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which neighbours a, b no merge joins when their characters are merged together."""
        x, y, limit = a.copy(), b.copy(), np.full(len(a), NEVER)
        ok, left = np.ones(len(a), bool), np.arange(len(a))
        while len(left):
            u, v = x[left], y[left]
            key = (u << 32) | v
            at = np.searchsorted(self.pair_keys, key)
            bad = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit[left])
            ok[left[bad]] = False
            ru, rv = self.rank[u], self.rank[v]
            go = ~bad & ((ru >= 0) | (rv >= 0))
            one = go & (ru > rv)
            two = go & ~one
            x[left[one]], limit[left[one]] = self.right[u[one]], ru[one]
            y[left[two]], limit[left[two]] = self.left[v[two]], rv[two] + 1
            left = left[go]
        return ok

    def is_sound(self, t: int) -> bool:
        if t not in self.sound:
            name = self.names[t]
            whole = self.end and name.endswith(self.end) and len(name) > len(self.end)
            body = name[: -len(self.end)] if whole else name
            ids = [self.vocab.get(c) for c in body]
            if whole:
                ids[-1] = self.vocab.get(body[-1] + self.end)
            self.sound[t] = None not in ids and self.merged(ids) == [t]
        return self.sound[t]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of words in byte characters."""
        proposals = [self.proposed(w) for w in words]
        size = np.array([len(p) if p else 0 for p in proposals])
        flat = np.fromiter((t for p in proposals if p for t in p), np.int64, int(size.sum()))
        of = np.repeat(np.arange(len(words)), size)
        good = size > 0
        inner = np.flatnonzero(of[1:] == of[:-1])
        if len(inner):
            keys, inverse = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
            good[of[inner[~self.apart(keys >> 32, keys & 0xFFFFFFFF)[inverse]]]] = False
        tokens, inverse = np.unique(flat, return_inverse=True)
        good[of[~np.fromiter(map(self.is_sound, tokens.tolist()), bool, len(tokens))[inverse]]] = False
        return [p if g else self.merged(self.symbols(w)) for w, p, g in zip(words, proposals, good.tolist(), strict=True)]

    def learn(self, words: list[str], known: dict[str, tuple[bytes, str]], plain: bool) -> None:
        new = [w for w in dict.fromkeys(words) if w not in known]
        shown = [w if w.isascii() or not plain else "".join(map(_TABLE.__getitem__, w.encode())) for w in new]
        for w, ids in zip(new, self.encode_words(shown) if new else [], strict=True):
            known[w] = (array("I", ids).tobytes(), " ".join([self.names[i] for i in ids]))

    def plain_parts(self, texts: list[str]) -> list[list[str]]:
        """Words between white space of lower-cased plain texts; all of them known afterwards."""
        parts = [t.lower().split() for t in texts]
        new = [w for w in {w for p in parts for w in p} if w not in self.plain]
        inner = [_WORDS.findall(w) for w in new]
        self.learn([x for ws in inner for x in ws], self.plain, True)
        for w, ws in zip(new, inner, strict=True):
            got = [self.plain[x] for x in ws]
            self.plain[w] = got[0] if len(got) == 1 else (b"".join([x[0] for x in got]), " ".join([x[1] for x in got]))
        return parts

    def byte_words(self, text: str) -> list[str]:
        """Words of any text in byte characters, by the tokenizer's own normaliser and splitter."""
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def forget(self) -> None:
        self.plain.clear()
        self.mapped.clear()

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each text the tokens as little-endian 32-bit numbers, and the text decoded from them."""
        if len(self.plain) + len(self.mapped) > CACHE_WORDS:
            self.forget()
        split = self.special_at.split if self.special_at else lambda t: [t]
        pieces = [[p for p in split(t) if p] for t in texts]
        flat = [p for ps in pieces for p in ps]
        kinds = [0 if p in self.special else 1 if self.fast and _PLAIN.fullmatch(p) else 2 for p in flat]
        plain = iter(self.plain_parts([p for p, k in zip(flat, kinds, strict=True) if k == 1]))
        other = [self.byte_words(p) for p, k in zip(flat, kinds, strict=True) if k == 2]
        self.learn([w for ws in other for w in ws], self.mapped, False)
        rest, kind, out = iter(other), iter(kinds), []
        for ps in pieces:
            got: list[tuple[bytes, str]] = []
            for p in ps:
                if not (k := next(kind)):
                    got.append((self.special[p].to_bytes(4, "little"), p))
                else:
                    got += map((self.plain if k == 1 else self.mapped).__getitem__, next(plain if k == 1 else rest))
            out.append((b"".join([x[0] for x in got]), " ".join([x[1] for x in got if x[0]])))
        return out

    def decode(self, ids: bytes) -> str:
        """Token names joined by one space, as a tokenizer without a decoder gives them."""
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


#: The last encoder of this worker, by the hash of its file's contents.
_loaded: dict[str, WordBpe] = {}


def bpe(docs: DataFrame, path: str, *, tokens: bool = True) -> DataFrame:
    """Each text encoded by the tokenizer file at `path` (read by the driver), and decoded again.

    Result: doc_id, n_tokens, ids_sha256, decoded_sha256, and with `tokens` also ids (array of
    int) and decoded. Special tokens in a text are recognised, none are added. A null or empty
    text has no tokens and decodes to the empty text. Rows are independent of each other, so
    repeated rows and null doc_ids stay; extra columns are ignored.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * tokens
    content, key = docs.sparkSession.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = WordBpe(content.value)
            gc.freeze()
            gc.set_threshold(200_000, 50, 1000)  # the caches hold no cycles
        tool = _loaded[key]
        try:
            for batch in batches:
                text = batch.column("text")
                for a, b in C.spans(pc.fill_null(pc.binary_length(text), 0).to_pylist()):
                    made = tool.encode([t or "" for t in text.slice(a, b - a).to_pylist()])
                    sizes = np.array([len(x) // 4 for x, _ in made], np.int64)
                    columns = [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(sizes),
                        pa.array([hashlib.sha256(x).hexdigest() for x, _ in made], pa.string()),
                        pa.array([hashlib.sha256(y.encode()).hexdigest() for _, y in made], pa.string()),
                    ]
                    if tokens:
                        ids = np.frombuffer(b"".join([x for x, _ in made]), "<i4")
                        columns += [pa.ListArray.from_arrays(np.append(0, sizes.cumsum()).astype(np.int32), pa.array(ids)), pa.array([y for _, y in made], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            tool.forget()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * tokens
    return C.named(docs, "doc_id", "text").selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(C.frugal(run), schema)
