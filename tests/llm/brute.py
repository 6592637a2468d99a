"""Plain Python versions of the training-data operators, for comparison on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def line_dedup(docs, min_chars=20, min_docs=3):
    """[(id, text)] -> [(id, n_lines, kept text)]; null ids keep all."""
    holders = defaultdict(set)
    key = lambda x: lower(x.strip(SPACE))
    for i, t in docs:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)])]
        out.append((i, len(lines), "\n".join(kept)))
    return out


def fingerprint(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    votes = Counter()
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(sh))


def simhash(docs, shingle=4, bits=4):
    """[(id, text)] -> [(id, fingerprint, component)], ids may be null."""
    fp = [fingerprint(t, shingle) for _, t in docs]
    n = range(len(docs))
    comp = components(n, [(a, b) for a in n for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= bits])
    least = defaultdict(list)
    for k in n:
        if docs[k][0] is not None:
            least[comp[k]].append(docs[k][0])
    return [(docs[k][0], fp[k], min(least[comp[k]], default=None)) for k in n]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(docs, items, window=10):
    """[(id, text)], [(item, text)] -> [(id, n_words, hit word set, item set)]"""
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        if i is not None and m:
            for k in range(len(w) - m + 1):
                grams[tuple(w[k:k + m])].add(i)
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if got := grams.get(tuple(w[k:k + m])):
                    hit.update(range(k, k + m))
                    found |= got
        out.append((d, len(w), hit, found))
    return out


def kneser_ney(texts, alphabet=510, base=512):
    """log p(c | a b) of coded trigrams, and the coding, of an interpolated modified Kneser-Ney model."""
    chars = Counter(c for t in texts for c in t)
    top = sorted(chars, key=lambda c: (-chars[c], c))[:alphabet]
    code = {c: k + 2 for k, c in enumerate(top)}
    enc = lambda t: [0, 0, *[code.get(c, 1) for c in t]]
    c3 = Counter()
    for t in texts:
        x = enc(t)
        c3.update(zip(x, x[1:], x[2:]))
    c2 = Counter((b, c) for _, b, c in c3)
    c1 = Counter((c,) for _, c in c2)

    def level(counts):
        n = Counter(counts.values())
        d = [0.5, 1.0, 1.5]
        if all(n[k] for k in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            e = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
            if all(0 < v <= k for k, v in enumerate(e, 1)):
                d = e
        tot, free = Counter(), Counter()
        for g, v in counts.items():
            tot[g[:-1]] += v
            free[g[:-1]] += d[min(v, 3) - 1]
        return counts, d, tot, free
    levels = [level(c) for c in (c1, c2, c3)]

    def p(g):
        if not g:
            return 1 / base
        counts, d, tot, free = levels[len(g) - 1]
        if g[:-1] not in tot:
            return p(g[1:])
        v = counts.get(g, 0)
        return (max(v - d[min(v, 3) - 1], 0) if v else 0) / tot[g[:-1]] + free[g[:-1]] / tot[g[:-1]] * p(g[1:])

    def log_prob(text):
        x = enc(text)
        return sum(math.log(p(g)) for g in zip(x, x[1:], x[2:]))
    return log_prob


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower(text or "")), None]
