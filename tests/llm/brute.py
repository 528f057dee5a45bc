"""Plain single-machine versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return SPACE.findall(text or "")


def order(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


def substrings(rows, length=20):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=order):
        ws = words(text)
        off = [False] * len(ws)
        for i in range(len(ws) - length + 1):
            key = tuple(ws[i:i + length])
            if key in seen:
                off[i:i + length] = [True] * length
            seen.add(key)
        out.append((doc_id, len(ws), sum(off), sha(" ".join(w for w, x in zip(ws, off) if not x))))
    return out


def contamination(rows, items, window=13):
    wanted = defaultdict(set)
    for item, text in items:
        ws = ALNUM.findall((text or "").translate(LOWER))
        if item is None or not ws:
            continue
        for i in range(max(1, len(ws) - window + 1)):
            wanted[tuple(ws[i:i + window])].add(str(item))
    lengths = {len(k) for k in wanted}
    out = []
    for doc_id, text in rows:
        ws = ALNUM.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if (key := tuple(ws[i:i + n])) in wanted:
                    hit.update(range(i, i + n))
                    names |= wanted[key]
        out.append((doc_id, len(ws), len(hit), len(names), sha(",".join(sorted(names))), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return out


def is_held_out(doc_id, modulus):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == 2


def lm(rows, order_=2, trust=0.2):
    docs = [(d, is_held_out(d, 7), words((t or "").translate(LOWER)) + [None]) for d, t in rows]
    counts, states = Counter(), Counter()
    for _, held, tokens in docs:
        if held:
            continue
        for i, w in enumerate(tokens):
            for n in range(1, order_ + 1):
                context = tuple((["<s>"] * n + tokens)[n + i - n + 1:n + i])
                counts[context, w] += 1
                states[context] += n > 1
    n_all = sum(c for (k, _), c in counts.items() if not k)
    types = sum(1 for k, _ in counts if not k)
    out = []
    for d, held, tokens in docs:
        base = score = 0.0
        for i, w in enumerate(tokens):
            p = (counts[(), w] + 1) / (n_all + types + 1)
            base += math.log10(p)
            for n in range(2, order_ + 1):
                context = tuple((["<s>"] * n + tokens)[n + i - n + 1:n + i])
                c = states[context]
                a = trust * c / (c + 1)
                p = (a * counts[context, w] / c if c else 0) + (1 - a) * p
            score += math.log10(p)
        out.append((d, held, len(tokens), sum(counts[(), w] > 0 for w in tokens), n_all, base, score))
    return out


def quality(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        ws = words(text)
        windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        n = Counter(windows)
        repeat = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if words(x)]
        out.append((
            doc_id, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat),
            len(ws) < 50 or 100 * len(repeat) > 50 * len(ws),
        ))
    return out


def fingerprint(text):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return 0
    k = min(3, len(ws))
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + k]).encode(), 42) for i in range(len(ws) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_duplicates(rows):
    fps = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for (d, _), f in zip(rows, fps)]
