"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def decontaminate(documents, items, window=10):
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of lists of (id, text)."""
    windows = {}
    for i, text in items:
        w = words(text)
        size = min(len(w), window)
        for a in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add(i)
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, text in documents:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if (key := tuple(w[a : a + size])) in windows:
                    hit.update(range(a, a + size))
                    found |= windows[key]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def remove_bytes(documents, size=50):
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256); a missing id is larger than all others."""
    key = lambda d: (d is None, d or 0)
    first = {}
    for d, text in documents:
        b = (text or "").encode()
        for a in range(len(b) - size + 1):
            w = b[a : a + size]
            if w not in first or key(d) < first[w]:
                first[w] = key(d)
    out = []
    for d, text in documents:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - size + 1):
            if first[b[a : a + size]] < key(d):
                gone[a : a + size] = b"\x01" * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def remove_words(documents, size=35):
    """Rows (doc_id, n_words, n_removed, kept_sha256)."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for d, text in documents]
    seen = {}
    for _, w in split:
        for a in range(len(w) - size + 1):
            k = tuple(w[a : a + size])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            if seen[tuple(w[a : a + size])] > 1:
                gone[a : a + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near_duplicates(documents, size=5, least=0.8):
    """Smallest id of each document's class, by all pairs (ids are given and different)."""
    sets = {}
    for d, text in documents:
        w = words(text)
        sets[d] = {tuple(w[a : a + size]) for a in range(max(1, len(w) - size + 1))} if w else set()
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= least:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}
