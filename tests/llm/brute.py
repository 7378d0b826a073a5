"""Plain Python versions of what the operators compute."""

import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def contamination(docs, items, k=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(fold(text))
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(x) for x in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = ALNUM.findall(fold(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if items_of := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= {x for x in items_of if x is not None}
        out[doc] = (len(w), len(hit), sorted(map(str, found)))
    return out


def shingles(text, k):
    w = SPACED.findall(fold(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(docs, k, num, den):
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def base_counts(text):
    text = text or ""
    w = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(SPACED.search(line))
        seen.add(line)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), dup, len(hit)


def fill(sizes, weights, share, cap):
    """Targets by repeated capping."""
    total = share * sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = {}
    while True:
        left = [s for s in order if s not in full]
        rest = total - sum(full.values())
        level = rest / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if level * weight[s] > cap * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in left}
        full |= {s: cap * sizes[s] for s in over}
