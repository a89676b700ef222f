"""Plain Python versions of the operators, for a few rows."""

import hashlib
import re
from collections import Counter, defaultdict
from math import log

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    found, text = words(text), text or ""
    lines = [line for line in text.split("\n") if words(line)]
    starts = defaultdict(list)
    for i in range(len(found) - 7):
        starts[tuple(found[i : i + 8])].append(i)
    covered = {p for places in starts.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    n = len(found)
    return {"n_words": n, "word_chars": sum(map(len, found)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 20 or 100 * len(covered) > 30 * n}


def shingles(text):
    found = words((text or "").translate(ASCII))
    return {tuple(found[i : i + 4]) for i in range(max(1, len(found) - 3))} if found else set()


def components(rows):
    """[(doc_id, text)] -> [(doc_id, set size, component)]; an id given twice has several texts."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        root = find(i)
        least[root] = min(least.get(root, 2**63), 2**63 - 1 if doc_id is None else doc_id)
    return [(doc_id, len(s), None if least[find(i)] == 2**63 - 1 else least[find(i)]) for i, (doc_id, s) in enumerate(sets)]


def substrings(rows):
    """[(doc_id, text)] -> [(doc_id, words, removed, digest)]"""
    order = {i: 2**63 - 1 if doc_id is None else doc_id for i, (doc_id, _) in enumerate(rows)}
    first = {}
    cut = [words(text) for _, text in rows]
    for i, found in enumerate(cut):
        for k in range(len(found) - 12):
            key = tuple(found[k : k + 13])
            first[key] = min(first.get(key, 2**63), order[i])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        found, gone = cut[i], set()
        for k in range(len(found) - 12):
            if first[tuple(found[k : k + 13])] < order[i]:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(found) if k not in gone)
        out.append((doc_id, len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def contamination(rows, items, window=13):
    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))

    windows = defaultdict(set)
    for item_id, text in items:
        found = cut(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1) if found else []:
            windows[tuple(found[i : i + size])].add("null" if item_id is None else str(item_id))
    out = []
    for doc_id, text in rows:
        found, hit, ids = cut(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                key = tuple(found[i : i + size])
                if key in windows:
                    hit.update(range(i, i + size))
                    ids |= windows[key]
        out.append((doc_id, len(found), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(found)))
    return out


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def backoff_scores(rows, order=3, alpha=0.4):
    cut = [words((text or "").translate(ASCII)) for _, text in rows]
    counts = Counter(tuple(w[i : i + n]) for w in cut for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, cut))
    out = []
    for (doc_id, _), w in zip(rows, cut, strict=True):
        own = Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
        score = 0.0
        for i in range(len(w)):
            s = max(counts[w[i],] - own[w[i],], 1) / max(total - len(w), 1)
            for n in range(2, min(order, i + 1) + 1):
                gram = tuple(w[i - n + 1 : i + 1])
                c = counts[gram] - own[gram]
                s = c / (counts[gram[:-1]] - own[gram[:-1]]) if c > 0 else alpha * s
            score += log(s)
        out.append((doc_id, len(w), round(score, 6)))
    return out
