"""Plain versions of the operators, on lists, for tests."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    words = WORD.findall(lower(text).encode())
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def near(rows, n=2, threshold=80):
    """rows (doc_id, text) with distinct ids: {doc_id: (n_shingles, component)}."""
    sets = {d: shingles(t, n) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            index[x].add(d)
    for d, s in sets.items():
        seen = set().union(*(index[x] for x in s)) if s else set()
        for e in seen:
            if e < d:
                t = sets[e]
                both = len(s & t)
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    a, b = root(d), root(e)
                    parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeats(texts, length):
    """Per text (n_bytes, n_removed, n_spans, sha of what is kept)."""
    raw = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] += 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_words(texts, n):
    """Per text the number of words in strings of n words that start elsewhere too."""
    words = [WORD.findall(lower(t).encode()) for t in texts]
    seen = defaultdict(int)
    for w in words:
        for i in range(len(w) - n + 1):
            seen[tuple(w[i : i + n])] += 1
    out = []
    for w in words:
        held = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                held.update(range(i, i + n))
        out.append(len(held))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def ngram_buckets(text, bits, sizes, pad=2):
    """Hashed n-grams of a text between spaces, each where it ends, the first `pad` places left out."""
    points = [32] * pad + [ord(c) if c.isalpha() else 32 for c in text.lower()] + [32] * pad
    out = []
    for end in range(pad, len(points)):
        for n in sizes:
            h = 0
            for c in points[end - n + 1 : end + 1]:
                h = (h * 0x01000193 + c * 0x9E3779B1) % 2**32
            out.append((((h ^ (h >> 15)) * 0x85EBCA6B) % 2**32) >> (32 - bits))
    return out


def naive_bayes(train, texts, bits, sizes, smoothing, evidence):
    """train: (lang, text). Per text (lang, probability), or ("und", 0)."""
    import math

    langs = sorted({x for x, _ in train})
    counts = {x: [smoothing] * (1 << bits) for x in langs}
    docs = {x: 0 for x in langs}
    for lang, text in train:
        docs[lang] += 1
        for b in ngram_buckets(text, bits, sizes):
            counts[lang][b] += 1
    blank = set(ngram_buckets("", bits, sizes))
    sums = {x: sum(c) for x, c in counts.items()}
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        grams = ngram_buckets(text, bits, sizes)
        n = len(grams) // len(sizes)
        z = {x: sum(0 if b in blank else math.log(counts[x][b] / sums[x]) for b in grams) / n * min(n, evidence) + math.log(docs[x] / len(train)) for x in langs}
        top = max(z.values())
        p = {x: math.exp(v - top) for x, v in z.items()}
        best = max(langs, key=lambda x: z[x])
        out.append((best, p[best] / sum(p.values())))
    return out


def best_fit(pieces, capacity):
    """Bins as lists of pieces (length, source, cluster, ...), largest first: of all bins without the
    piece's source and cluster the one with the least room that holds it, the first one on ties."""
    bins = []
    for p in pieces:
        fits = [(capacity - sum(x[0] for x in b), i) for i, b in enumerate(bins) if all((p[1] is None or x[1] != p[1]) and (p[2] is None or x[2] != p[2]) for x in b)]
        fits = [f for f in fits if f[0] >= p[0]]
        if fits:
            bins[min(fits)[1]].append(p)
        else:
            bins.append([p])
    return bins
