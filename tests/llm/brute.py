"""Plain versions of the operators, straight from their definitions."""

import collections
import functools
import hashlib
import math
import re
import zlib

import numpy as np

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").encode()) if w]


def lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")


def substring(rows, window=50):
    first = {}
    for i, t in rows:
        ws = words(t)
        for s in range(len(ws) - window + 1):
            if i is not None:
                k = tuple(ws[s : s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        ws = words(t)
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out.append((i, len(ws), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(ws, gone, strict=True) if not g)).hexdigest()))
    return out


def base_scores(rows):
    tokens = [words(lower(t)) + [None] for _, t in rows]
    counts = collections.Counter()
    for (i, _), ts in zip(rows, tokens, strict=True):
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(ts)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(ts), sum(counts[w] > 0 for w in ts), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ts)) for (i, _), ts in zip(rows, tokens, strict=True)]


def bigram_score(rows, level_of, count_of, prior):
    """Scores with quantised counts kept exactly in a dictionary."""
    one, two = collections.Counter(), collections.Counter()
    tokens = [words(lower(t)) + ["end"] for _, t in rows]
    for (i, _), ts in zip(rows, tokens, strict=True):
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            one.update(ts)
            two.update(zip(["start", *ts], ts, strict=False))
    n, v = sum(one.values()), len(one)
    q = lambda c: count_of[level_of(c)] if c else 0.0
    out = []
    for ts in tokens:
        s = 0.0
        for a, b in zip(["start", *ts], ts, strict=False):
            past = q(one["end"]) if a == "start" else q(one[a])
            s += math.log10(min(1.0, (min(q(two[a, b]), past) + prior * (q(one[b]) + 1) / (n + v + 1)) / (past + prior)))
        out.append(s)
    return out


def components(nodes, links):
    root = {i: i for i in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def shingles(text, n=5):
    ws = words(text)
    return frozenset(tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)) if len(ws) >= n else frozenset([tuple(ws)] if ws else [])


def jaccard(rows):
    """(doc_id, class, links) with documents by row number as nodes."""
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    root, n = components(range(len(sets)), pairs), collections.Counter(x for p in pairs for x in p)
    least = {}
    for k, r in root.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return [(i, least.get(root[k]) if sets[k] else i, n[k]) for k, (i, _) in enumerate(rows)]


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items, window=10):
    known = collections.defaultdict(set)
    for i, t in items:
        ws = ITEM.findall(lower(t))
        n = min(window, len(ws))
        for s in range(len(ws) - n + 1 if n else 0):
            known[tuple(ws[s : s + n])].add(i)
    out = []
    for i, t in rows:
        ws = ITEM.findall(lower(t))
        hit, own = [False] * len(ws), set()
        for n in {len(k) for k in known}:
            for s in range(len(ws) - n + 1):
                if (k := tuple(ws[s : s + n])) in known:
                    own |= known[k]
                    hit[s : s + n] = [True] * n
        out.append((i, len(ws), sum(hit), sorted(str(x) for x in own if x is not None), any(hit)))
    return out


WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def mask(line):
    uneven = "  " in line or "\t" in line or "\r" in line
    plain = (re.sub(r"[ \t\n\x0b\f\r]+", " ", line) if uneven else line).strip(" ")
    return re.sub(r"[^ 0-9]*[0-9][^ ]*", "<*>", plain) if re.search("[0-9]", line) else plain


def lines(rows, min_docs=5):
    """(doc_id, text, lines, dropped lines) by the tree of templates, with texts in place of hashes."""
    every = []
    for i, t in rows:
        for line in t.split("\n") if t is not None else ():
            if line.strip(WHITE):
                m = mask(line).split(" ")
                every.append((i, t, line, tuple(m), (len(m), *m[:3]), (len(m), *m[-3:]) if len(m) >= 6 else None))
    masks, size = collections.defaultdict(set), collections.Counter()
    for _, _, _, m, leaf, _ in set(every):
        masks[leaf].add(m)
        size[leaf] += 1
    votes = collections.defaultdict(collections.Counter)
    for _, _, _, m, leaf, _ in every:
        for at, token in enumerate(m):
            votes[leaf, at][token] += 1
    template = {}
    for leaf, some in masks.items():
        general = []
        for at in range(leaf[0]):
            token, n = max(votes[leaf, at].items(), key=lambda x: (x[1], x[0].encode()))
            general.append(token if n >= 0.5 * sum(votes[leaf, at].values()) else None)
        for m in some:
            fits = sum(a == b for a, b in zip(m, general, strict=True)) >= 0.7 * leaf[0]
            template[m] = ("leaf", leaf) if fits and len(some) > 1 and size[leaf] >= min_docs else ("mask", m)
    least = {}
    for i, t, _, m, _, _ in every:
        k = template[m], i
        least[k] = min(least.get(k, t), t)
    held = collections.defaultdict(set)
    for (k, _), t in least.items():
        held[k].add(t)
    shared = {k for k, texts in held.items() if len(texts) >= min_docs}
    lasts = {last for *_, m, _, last in every if template[m] in shared}
    body = collections.defaultdict(set)
    for _, t, line, m, _, last in every:
        if template[m] not in shared and (last is None or last not in lasts):
            body[t].add(line)
    recurring = set()
    for k in shared:
        families = collections.Counter(frozenset(body[t]) for t in held[k])
        if len(families) >= min_docs and len(held[k]) - max(families.values()) >= 0.2 * len(held[k]):
            recurring.add(k)
    gone = {(i, line) for i, _, line, m, _, _ in every if template[m] in recurring}
    out = []
    for i, t in rows:
        parts = t.split("\n") if t is not None else []
        kept = [x for x in parts if (i, x) not in gone]
        out.append((i, None if t is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def languages(network, text, piece=256):
    """Mean probabilities of a text's bytes, one byte after the other."""
    p, n, total = {k: v.astype(float) for k, v in network.p.items()}, len(network.p["uf"]), 0
    data = text.encode("utf-8", "surrogatepass")
    for a in range(0, len(data), piece):
        part, states = data[a : a + piece], {}
        for d, order in (("f", part), ("b", part[::-1])):
            h, states[d] = np.zeros(n), []
            for byte in order:
                own, gates = p["t" + d][byte], h @ p["u" + d]
                z, r = (np.clip((own[k : k + n] + gates[k : k + n]) / 4 + 0.5, 0, 1) for k in (0, n))
                h = (1 - z) * np.clip(own[2 * n :] + r * gates[2 * n :], -1, 1) + z * h
                states[d].append(h)
        e = np.exp(np.array(states["f"]) @ p["vf"] + np.array(states["b"][::-1]) @ p["vb"] + p["o"])
        total = total + (e / e.sum(axis=1, keepdims=True)).sum(axis=0)
    return total / len(data)


def most_links(sizes, room):
    """Links kept by the best placement of groups of these sizes into shards with this room."""

    @functools.cache
    def best(k, room):
        return max((kept + best(k + 1, left) for kept, left in parts(sizes[k], room)), default=-math.inf) if k < len(sizes) else 0

    def parts(n, room):
        if not room:
            return [(0, ())] if n == 0 else []
        return {(x * (x - 1) // 2 + kept, tuple(sorted((room[0] - x, *left)))) for x in range(min(n, room[0]) + 1) for kept, left in parts(n - x, room[1:])}

    return best(0, tuple(sorted(room)))


def judged(url, rules, default="allow"):
    host = path = ""
    parts = (url or "").split("://", 1)
    if len(parts) == 2:
        host = re.match(r"[^/?#]*", parts[1])[0]
        path = re.match(r"[^?#]*", parts[1][len(host) :])[0]
        host = lower(host)
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[2] if best else default
