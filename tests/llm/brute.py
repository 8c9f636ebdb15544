"""Plain definitions of the operators, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    w = WORD.findall(lower_ascii(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def near_duplicates(rows, k, percent):
    """{id: (size, component)} of (id, text) rows with ids, by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    every = [(i, s) for i, many in sets.items() for s in many if s]
    post = collections.defaultdict(list)
    for n, (i, s) in enumerate(every):
        both = collections.Counter(m for x in s for m in post[x])
        for m, c in both.items():
            j, t = every[m]
            if 100 * c >= percent * (len(s) + len(t) - c):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for x in s:
            post[x].append(n)
    return {i: (sorted(map(len, many)), find(i)) for i, many in sets.items()}


def cut_repeats(texts, length):
    """(bytes, removed, runs, kept bytes) of each text."""
    docs = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in docs for i in range(len(d) - length + 1))
    out = []
    for d in docs:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), runs, bytes(x for x, g in zip(d, gone) if not g)))
    return out


def item_words(text):
    low = "".join(c.lower() if c < "\x7f" else c for c in text or "")
    return re.findall(r"[^\x01-\x20!-/:-@\[-`{-\x7f]+", low)


def contaminated(docs, items, percent=80, k=5):
    """{(doc, item): similarity}: the best item-sized window, by its multiset of shingles."""
    def grams(w):
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    out = {}
    for item, t in items:
        words = item_words(t)
        own = collections.Counter(grams(words))
        for doc, x in docs:
            found = item_words(x)
            if words and len(words) < k:
                if any(found[i:i + len(words)] == words for i in range(len(found) - len(words) + 1)):
                    out[doc, item] = 1.0
                continue
            g, m = grams(found), sum(own.values())
            size = min(m, len(g))
            for a in range(len(g) - size + 1 if size else 0):
                both = sum((collections.Counter(g[a:a + size]) & own).values())
                if both and 100 * both >= percent * (size + m - both):
                    out[doc, item] = max(out.get((doc, item), 0), both / (size + m - both))
    return out


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen, hit = collections.Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            hit.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def sha(data):
    return hashlib.sha256(data).hexdigest()
