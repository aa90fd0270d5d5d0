"""Plain versions of the operators, for small tables."""

import hashlib
import os
import re
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import numpy as np
import xxhash

SMALL_DIR = "/root/testdata/sf0.001"
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
LAST = 1 << 62


@lru_cache
def SMALL():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


def counted(rows):
    return Counter(map(repr, rows))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def windows(rows, size=20):
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - size + 1):
            key, place = tuple(w[i : i + size]), (LAST if d is None else d, i)
            first[key] = min(first.get(key, place), place)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (LAST if d is None else d, i):
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return out


def byte_strings(rows, size=200):
    texts = [(d, (t or "").encode()) for d, t in rows]
    n = Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - size + 1):
            if n[t[i : i + size]] > 1:
                gone[i : i + size] = True
        gone = gone[:-1]
        begins = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), begins, sha(bytes(np.frombuffer(t, np.uint8)[~gone]))))
    return out


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = lower.encode().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def united(n, pairs):
    up = list(range(n))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(a) for a in range(n)]


def simhash(rows):
    prints = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    label = united(len(rows), pairs)
    least = defaultdict(list)
    for (d, _), c in zip(rows, label, strict=True):
        if d is not None:
            least[c].append(d)
    return [(d, f"{p:016x}", min(least[c]) if c in least else None) for (d, _), p, c in zip(rows, prints, label, strict=True)]


def vectors(rows, least=0.93):
    """(vec_id, n_links, component_id) of (vec_id, vector, label)."""
    units = []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least
    ]
    n = Counter(x for p in pairs for x in p)
    label = united(len(rows), pairs)
    ids = defaultdict(list)
    for (d, *_), c in zip(rows, label, strict=True):
        ids[c].append(d)
    return [(d, n[i], min(ids[c])) for i, ((d, *_), c) in enumerate(zip(rows, label, strict=True))]


def benchmark_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def leaked(docs, items):
    """(row number, item) of every document and item along every alignment that shares three words in a row."""
    index, due = defaultdict(set), set()
    by_item = {i: benchmark_words(t) for i, t in items}
    for i, w in by_item.items():
        for p in range(len(w) - 2):
            index[tuple(w[p : p + 3])].add((i, p))
    for n, (_, text) in enumerate(docs):
        w = benchmark_words(text)
        for i, s in {(i, q - p) for q in range(len(w) - 2) for i, p in index.get(tuple(w[q : q + 3]), ())}:
            item = by_item[i]
            low, high = max(0, -s), min(len(item), len(w) - s)
            same = [w[k + s] == item[k] for k in range(low, high)]
            need = max(5, min(25, -(-4 * len(item) // 5)))
            if any(5 * sum(same[a:b]) >= 4 * (b - a) and same[a] and same[b - 1] for a in range(len(same)) for b in range(a + need, len(same) + 1)):
                due.add((n, i))
    return due


def mix(rows):
    """(doc_id, taken words) of (doc_id, text, source), by weights 1, 2, 3 up to three times the source."""
    sizes = [len((t or "").encode().split()) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(sizes, rows, strict=True) if r[2] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    full = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        unit = left / sum(weight[s] for s in sources if s not in full) if len(full) < len(sources) else 0
        more = {s for s in sources if s not in full and unit * weight[s] >= 3 * total[s]}
        if not more:
            break
        full |= more
    out = []
    for s in sources:
        budget = 3 * total[s] if s in full else int(np.floor(unit * weight[s] + 0.5))
        own = sorted((hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[0] or 0, n, r[1] or "") for n, r in zip(sizes, rows, strict=True) if r[2] == s)
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, d, n, t in own:
            part = min(n, rest)
            rest -= part
            out.append((d, t, epochs * n + part))
    return out
