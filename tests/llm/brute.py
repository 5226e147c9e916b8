"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import re
from collections import Counter

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def windows(items, window=13):
    out = {}
    for item, text in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            out.setdefault(n, {}).setdefault(tuple(w[k : k + n]), set()).add(str(item))
    return out


def decontaminate(docs, items):
    wins, out = windows(items), []
    for doc, text in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
        hit, found = set(), set()
        for n, known in wins.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit.update(range(k, k + n))
                    found |= known[tuple(w[k : k + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def word_sets(docs, n):
    out = {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
        out[doc] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


def near_duplicates(docs, n=2, percent=80):
    sets = word_sets(docs, n)
    g, ids = Groups(sets), sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                g.join(a, b)
    return [(d, len(sets[d]), g.find(d), g.find(d) == d) for d in ids]


def repeats(docs, length=200):
    raw = [(d, (t or "").encode()) for d, t in docs]
    count = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def dedup_lines(docs, percent=80):
    occ = []
    for d, t in sorted(docs):
        for i, line in enumerate((t or "").split("\n")):
            if n := re.sub(r"[ \t\n\x0b\x0c\r]+", " ", line).strip(" ").lower():
                occ.append((d, i, n))
    grams = {n: {n[k : k + 5] for k in range(len(n) - 4)} if len(n) >= 5 else {n} for _, _, n in occ}
    g, lines = Groups(grams), sorted(grams)
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            both = len(grams[a] & grams[b])
            if 100 * both >= percent * (len(grams[a]) + len(grams[b]) - both):
                g.join(a, b)
    stays, gone = {}, {}
    for d, i, n in occ:
        if stays.setdefault(g.find(n), (d, i)) != (d, i):
            gone.setdefault(d, set()).add(i)
    return {d: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in docs}
