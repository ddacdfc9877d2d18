"""Plain-Python statements of the operators' results."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words(lower(text))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near_duplicates(docs, size):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def statistics(text):
    w = words(text)
    lines = [s for s in (text or "").split("\n") if WORD.search(s)]
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), n < 50 or 100 * len(covered) > 50 * n)


def repeats(docs, window):
    """{doc_id: (n_words, n_removed, sha256)}."""
    starts, split = {}, {i: words(t) for i, t in docs}
    for i, w in split.items():
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            starts[key] = min(starts.get(key, i), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if starts[tuple(w[j:j + window])] < i:
                gone.update(range(j, j + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def contamination(docs, items, window=10):
    """{doc_id: (n_words, n_hit, item ids)}."""
    windows = {}
    for i, t in items:
        w = ITEM_WORD.findall(lower(t))
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j:j + k]), set()).add("" if i is None else str(i))
    out = {}
    for i, t in docs:
        w, hit, found = ITEM_WORD.findall(lower(t)), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit.update(range(j, j + k))
                    found |= windows[tuple(w[j:j + k])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


def base_scores(docs):
    """{doc_id: (held out, tokens, known, N, base score)}."""
    split = {i: words(lower(t)) + [None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in split}
    c = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(ws), sum(w in c for w in ws), n,
                sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in split.items()}


def luhn(digits):
    return sum(d if i % 2 == 0 else d // 5 + 2 * d % 10 for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def runs(w, exponent=4, least=6):
    """[(start, length, period)] of a list of words: every lag, every stretch."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            smaller = any(all(w[k] == w[k + d] for k in range(s, e - d)) for d in range(1, q))
            if e - s >= max(least, exponent * q) and not smaller:
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def echoed(doc_id, text):
    """The words of a text with the planted periods of op13's contract."""
    w = words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def water_targets(sizes, weights, share, epochs):
    """{source: target} by clamping and sharing again; weights go round in order."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = budget - sum(epochs * sizes[s] for s in full)
        total = sum(weight[s] for s in free)
        out = {s: epochs * sizes[s] if s in full else left * weight[s] / total for s in order}
        over = {s for s in free if out[s] >= epochs * sizes[s]}
        if not over:
            return out
        full |= over


def whitening(vectors, components=8, scale=1024, shift=100_000):
    """{place: (deviation, whitened)}, explained, by numpy's own eigenvectors."""
    import numpy as np
    x = {k: [math.floor(scale * c) + shift for c in v] for k, v in enumerate(vectors)
         if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    n, dims = len(x), len(next(iter(x.values())))
    s = [sum(v[i] for v in x.values()) for i in range(dims)]
    d = {k: [n * c - t for c, t in zip(v, s)] for k, v in x.items()}
    c = np.array(list(d.values()), float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return ({k: (sum(a * a for a in v), np.array(v, float) / n @ u / np.sqrt(e)) for k, v in d.items()},
            e / np.trace(c.T @ c / n), n)


def hinge_optimum(x, y, c):
    """Least value of |w|^2 / 2 + sum(c * hinge) with the intercept as a feature, by
    accelerated projected gradient steps on the dual."""
    import numpy as np
    z = np.column_stack([x, np.ones(len(x))]) * y[:, None]
    q = z @ z.T
    step, a, b, t = 1 / np.linalg.eigvalsh(q)[-1], np.zeros(len(x)), np.zeros(len(x)), 1.0
    for _ in range(100_000):
        new = np.clip(b - step * (q @ b - 1), 0, c)
        again = (1 + math.sqrt(1 + 4 * t * t)) / 2
        b = new + (t - 1) / again * (new - a)
        if ((b - new) @ (new - a)) < 0:
            b, again = new, 1.0
        a, t = new, again
    w = z.T @ a
    return 0.5 * w @ w + (c * np.maximum(0, 1 - z @ w)).sum()
