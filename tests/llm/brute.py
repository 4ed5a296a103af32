"""Plain versions of the operators, one document at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import permutations

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring(rows, window):
    words = [(i, WORD.findall(x or "")) for i, x in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def lines(rows, min_docs):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    split = [(i, (x or "").split("\n")) for i, x in rows]
    n = Counter(k for _, own in split for k in {key(x) for x in own})
    often = {k for k, c in n.items() if k and c >= min_docs}
    return [(i, len(own), sum(key(x) in often for x in own), "\n".join(x for x in own if key(x) not in often)) for i, own in split]


def fingerprint(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(rows, size, bits):
    prints = [(i, fingerprint(x, size)) for i, x in rows]
    values = sorted({f for _, f in prints})
    parent = {f: f for f in values}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for k, f in enumerate(values):
        for g in values[:k]:
            if (f ^ g).bit_count() <= bits:
                parent[root(f)] = root(g)
    least = {}
    for i, f in prints:
        r = root(f)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f, least[root(f)]) for i, f in prints]


def similar(rows, size=5, similarity=0.8):
    """(doc_id, component) by the exact Jaccard similarity of word shingle sets, found through an inverted index."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    have, empty = {}, None
    for j, x in enumerate(sets):
        shared = Counter(k for s in x for k in have.get(s, ()))
        for k, n in shared.items():
            if n >= similarity * (len(x) + len(sets[k]) - n):
                group[root(j)] = root(k)
        for s in x:
            have.setdefault(s, []).append(j)
        if not x:
            empty = j if empty is None else empty
            group[root(j)] = root(empty)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return [(i, least[root(k)]) for k, (i, _) in enumerate(rows)]


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    at = {}
    for k in range(len(w) - 4):
        at.setdefault(tuple(w[k : k + 5]), []).append(k)
    again = {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + 5)}
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


def best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return sorted(room)


def runs(words, least=12):
    """(start, length, period) of each run, lag by lag, word by word."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, own):
    gone = {k for s, length, q in own for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, window):
    """(doc_id, n_words, hit words, item ids) of each document."""
    own = {}
    for i, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        k = min(window, len(w))
        if w and i is not None:
            own.setdefault(k, {})
            for j in range(len(w) - k + 1):
                own[k].setdefault(tuple(w[j : j + k]), set()).add(str(i))
    out = []
    for d, text in docs:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for k, windows in own.items():
            for j in range(len(w) - k + 1):
                if got := windows.get(tuple(w[j : j + k])):
                    hit |= set(range(j, j + k))
                    ids |= got
        out.append((d, len(w), sorted(hit), sorted(ids)))
    return out


def audit(docs, labels):
    """docs: (doc_id, text, lang). Rows of the five filters' interactions."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    rows = []
    for i, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > least[t]]
        rows.append((lang or "", {x for x, f in zip("ABCDE", fails, strict=True) if f}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, lost = [r for r in rows if r[0] == part], Counter()
        counts = {}
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                failed = sum(x in r[1] for r in own)
                left = [r for r in left if x not in r[1]]
                lost[x] += len(gone)
                counts["".join(order), step] = len(left), len(gone), failed - len(gone), sum(r[1] == {x} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), x
        out += [(part, order, step, *c[:6], lost[c[6]]) for (order, step), c in counts.items()]
    return sorted(out)
