"""Plain evaluations of the document operators, for small inputs."""

import collections
import math
import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    words = WORDS.findall((text or "").encode().translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def groups(texts, width, num, den):
    """{key: (size of its set, smallest key that links reach)} over all pairs."""
    sets = {k: shingle_set(t, width) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def bm25(texts, queries, k, k1=1.2, b=0.75):
    """{query: [(key, score)]} with queries as {query: {term: weight}} of byte terms."""
    words = re.compile(rb"[a-z0-9\x80-\xff]+")
    docs = {key: collections.Counter(words.findall((t or "").encode().translate(LOWER))) for key, t in texts.items()}
    mean = sum(sum(c.values()) for c in docs.values()) / len(docs)
    out = {}
    for query, terms in queries.items():
        scores = {}
        for key, counts in docs.items():
            length = sum(counts.values())
            score = sum(w * counts[t] * (k1 + 1) / (counts[t] + k1 * (1 - b + b * length / mean)) for t, w in terms.items() if t in counts)
            if score:
                scores[key] = score
        out[query] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def idf(n, df):
    return math.log(1 + (n - df + 0.5) / (df + 0.5))


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in collections.Counter(window).values())
