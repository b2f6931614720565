"""Plain versions of the operators, row by row, against which the tests hold the real ones."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def jaccard_components(rows):
    """rows: (doc_id, text) -> {(doc_id, n, component)} as a counter."""
    by_set = defaultdict(list)
    for i, text in rows:
        by_set[shingles(text)].append(i)
    sets = [s for s in by_set if s]
    parent = {s: s for s in sets}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    index = defaultdict(list)
    for k, s in enumerate(sets):
        seen = Counter(j for t in s for j in index[t])
        for j, both in seen.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[find(s)] = find(sets[j])
        for t in s:
            index[t].append(k)
    least = defaultdict(list)
    for s in sets:
        least[find(s)] += [i for i in by_set[s] if i is not None]
    return Counter((i, len(s), (i if not s else min(least[find(s)], default=None))) for s, ids in by_set.items() for i in ids)


def rule_stats(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def line_dedup(rows, width=3):
    """rows: (doc_id, text), ids distinct -> {doc_id: (text, n_lines, n_removed)}."""
    first = {}
    for i, text in sorted((r for r in rows if r[1] is not None)):
        lines = text.split("\n")
        for p in range(len(lines) - width + 1):
            first.setdefault(tuple(lines[p : p + width]), (i, p))
    out = {}
    for i, text in rows:
        if text is None:
            out[i] = (None, 0, 0)
            continue
        lines = text.split("\n")
        gone = set()
        for p in range(len(lines) - width + 1):
            key = tuple(lines[p : p + width])
            if first[key] != (i, p) and any(x.strip(" ") for x in key):
                gone |= set(range(p, p + width))
        out[i] = ("\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone))
    return out


def warc(rows):
    """rows: (page_id, html) -> counter of (page_id, bytes, digest, type, refers_to)."""
    least = {}
    for i, html in rows:
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    out = Counter()
    for i, html in rows:
        data = (html or "").encode()
        refers = None if i is None or least[html or ""] == i else least[html or ""]
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers] += 1
    return out


MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def shingle_hashes(text, width=5):
    odd = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    grams = [w] if 0 < len(w) < width else [w[i : i + width] for i in range(len(w) - width + 1)]
    return {mixed((sum(xxhash.xxh3_64_intdigest(x.encode()) * c for x, c in zip(g, odd, strict=False)) + len(g)) & MASK) for g in grams}


def fingerprint(text, bins=512, bits=4, tries=4096):
    """One hash a shingle, the least of each bin, empty bins filled from the first full bin of their own sequence, low bits as hexadecimal digits."""
    least = {}
    for h in shingle_hashes(text):
        k = h * bins >> 64
        least[k] = min(least.get(k, h), h)
    if not least:
        return ""
    out = ""
    for k in range(bins):
        probes = chain((mixed(k * tries + t + 0x5851F42D4C957F2D & MASK) % bins for t in range(tries)), ((k + d) % bins for d in range(bins)))  # at last round the circle
        at = k if k in least else next(p for p in probes if p in least)
        out += f"{least[at] % (1 << bits):x}"
    return out


def likeness(a, b, bits=4):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    agree, chance = sum(x == y for x, y in zip(a, b, strict=True)) / len(a), 2**-bits
    return max(0.0, (agree - chance) / (1 - chance))


def isolation_scores(x, rows, seed, trees, sample, widen):
    """Anomaly scores of x by a forest of nested tuples grown on rows, with its random numbers drawn in the order: sample, then node, right subtree, left subtree."""
    rnd = np.random.default_rng(seed)
    mean = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    m = min(sample, len(rows))
    depth = math.ceil(math.log2(max(2, m)))
    spread = [max(max(c) - min(c), 1e-3) * widen for c in zip(*rows, strict=True)]

    def grow(own, d):
        if d == depth or len(own) <= 1:
            return d + mean(len(own))
        f = int(rnd.integers(len(spread)))
        values = [r[f] for r in own]
        low = min(values) - spread[f] * rnd.random()
        high = max(values) + spread[f] * rnd.random()
        at = rnd.uniform(low, high)
        right = grow([r for r in own if not r[f] < at], d + 1)
        return f, at, grow([r for r in own if r[f] < at], d + 1), right

    def length(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
        return tree

    forest = [grow([rows[i] for i in rnd.choice(len(rows), m, replace=False)], 0) for _ in range(trees)]
    return [2 ** (-sum(length(t, row) for t in forest) / trees / mean(m)) for row in x]


def gam_scores(x, rows, y, bins, rounds, rate, pairs, coarse, ridge):
    """Scores of x by cyclic boosting row by row: trees of three leaves on each feature in turn, then of one cut a side on the best pairs."""
    logistic = lambda v: 1 / (1 + math.exp(-min(max(v, -30), 30)))
    columns = [list(c) for c in zip(*rows, strict=True)]

    def edges(values, most):
        found = sorted(set(values))
        if len(found) > most:  # quantiles
            ranked = sorted(values)
            return sorted({ranked[max(0, math.ceil(q * len(ranked)) - 1)] for q in np.linspace(0, 1, most + 1)[1:-1].tolist()})
        return [(a + b) / 2 for a, b in zip(found, found[1:], strict=False)]

    code = lambda e, v: sum(v > cut for cut in e)
    worth = lambda g, h: g * g / (h + ridge)
    fine, rough = [edges(c, bins) for c in columns], [edges(c, coarse) for c in columns]
    codes, grid = ([[code(e, v) for v in c] for e, c in zip(cuts, columns, strict=True)] for cuts in (fine, rough))
    base = math.log(sum(y) / (len(y) - sum(y)))
    f = [base] * len(y)
    tables = [[0.0] * (len(e) + 1) for e in fine]
    for _ in range(rounds):
        for j, own in enumerate(codes):
            g, h = [0.0] * len(tables[j]), [0.0] * len(tables[j])
            for i, c in enumerate(own):
                p = logistic(f[i])
                g[c] += y[i] - p
                h[c] += p * (1 - p)
            parts = [(0, len(g))]
            while len(parts) < 3:
                best = (1e-9, None)
                for a, b in parts:
                    for at in range(a + 1, b):
                        gain = worth(sum(g[a:at]), sum(h[a:at])) + worth(sum(g[at:b]), sum(h[at:b])) - worth(sum(g[a:b]), sum(h[a:b]))
                        if gain > best[0] + 1e-12:
                            best = (gain, (a, at, b))
                if best[1] is None:
                    break
                a, at, b = best[1]
                k = parts.index((a, b))
                parts[k : k + 1] = [(a, at), (at, b)]
            for a, b in parts:
                for c in range(a, b):
                    tables[j][c] += rate * sum(g[a:b]) / (sum(h[a:b]) + ridge)
                    for i in (i for i, o in enumerate(own) if o == c):
                        f[i] += rate * sum(g[a:b]) / (sum(h[a:b]) + ridge)

    def quadrants(a, b):
        """gain, cut on a, cut on b, values of the four quadrants."""
        best = (0.0, 0, 0, {})
        for p in range(len(rough[a])):
            for q in range(len(rough[b])):
                g, h = defaultdict(float), defaultdict(float)
                for i in range(len(y)):
                    k = (grid[a][i] > p, grid[b][i] > q)
                    s = logistic(f[i])
                    g[k] += y[i] - s
                    h[k] += s * (1 - s)
                gain = sum(worth(g[k], h[k]) for k in g) - worth(sum(g.values()), sum(h.values()))
                if gain > best[0] + 1e-12:
                    best = (gain, p, q, {(u, v): g[u, v] / (h[u, v] + ridge) for u in (False, True) for v in (False, True)})
        return best

    chosen = sorted(((quadrants(a, b)[0], a, b) for a in range(len(columns)) for b in range(a)), reverse=True)[:pairs]
    chosen = [(a, b) for gain, a, b in chosen if gain > 0]
    steps = defaultdict(list)
    for _ in range(rounds // 3):
        for a, b in chosen:
            _, p, q, values = quadrants(a, b)
            steps[a, b].append((p, q, values))
            for i in range(len(y) if values else 0):
                f[i] += rate * values[grid[a][i] > p, grid[b][i] > q]
    out = []
    for row in x:
        v = base + sum(t[code(e, row[j])] for j, (e, t) in enumerate(zip(fine, tables, strict=True)))
        for (a, b), own in steps.items():
            ca, cb = code(rough[a], row[a]), code(rough[b], row[b])
            v += sum(rate * values[ca > p, cb > q] for p, q, values in own if values)
        out.append(logistic(v))
    return out
