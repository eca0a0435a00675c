"""Plain one-process versions of the operators, straight from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def op1(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(_LOWER))
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        n = min(10, len(w))
        for k in range(len(w) - n + 1):
            grams[tuple(w[k : k + n])].add(str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                got = grams.get(tuple(w[k : k + n]))
                if got:
                    hit.update(range(k, k + n))
                    found |= got
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(_LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op2(docs):
    fps = [fingerprint(t) for _, t in docs]
    nodes = sorted({f for f, (d, _) in zip(fps, docs) if d is not None})
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = {}
    for f, (d, _) in zip(fps, docs):
        if d is not None:
            low[find(f)] = min(low.get(find(f), d), d)
    return [(d, f"{f:016x}", low[find(f)] if f in root else None) for f, (d, _) in zip(fps, docs)]


def op3(docs, length=50):
    first = {}
    for d, t in sorted((d, (t or "").encode()) for d, t in docs if d is not None):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    out = []
    for d, t in docs:
        t = (t or "").encode()
        gone = bytearray(len(t))
        if d is not None:
            for i in range(len(t) - length + 1):
                if first[t[i : i + length]] < d:
                    gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def op6_base(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
            seen.add(line)
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed))
    return out


def op7(docs, encoding):
    out = []
    for d, t in docs:
        ids = encoding.encode_ordinary(t or "")
        out.append((d, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(t or "")))
    return out


def line_drops(docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(_LOWER)
    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    lost = {k: max((d for d in ds if d is not None), default=None) for k, ds in held.items() if len(ds) >= 3}
    return [[x for x in (t or "").split("\n") if key(x) not in lost or (d is not None and lost[key(x)] == d)] for d, t in docs]


def op9(docs):
    return [(d, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), sha("\n".join(kept))) for (d, t), kept in zip(docs, line_drops(docs))]
