"""Plain Python versions of the operators, written from their definitions."""

import collections
import hashlib
import math
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def suffix_dedup(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, seen, duplicates = len(words), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    counts, repeated = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            repeated.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, duplicates, len(repeated), n < 10 or 100 * len(repeated) > 20 * n


def licenses(rows, notices):
    """``notices``: license, text and the phrases that must be there."""
    grams_of = lambda words: [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    templates, short = [], []
    for name, text, must in notices:
        words = WORD.findall(text.translate(UPPER))
        if len(words) < 5:
            short.append((name, words))
            continue
        size = max(8, 1 << (len(words) - 1).bit_length())
        templates.append((name, size, set(grams_of(words)), {g for m in must or [] for g in grams_of(WORD.findall(m.translate(UPPER)))}))
    out = {}
    for doc, text in rows:
        words, best = WORD.findall((text or "").translate(UPPER)), {}
        grams = grams_of(words)
        for name, size, shingles, must in templates:
            for at in range(0, len(grams), size // 2):
                window = set(grams[at : at + size * 3 // 2 - 4])
                share = len(shingles & window) / len(shingles)
                if share >= 0.8 and must <= window:
                    best[name] = max(best.get(name, 0), share)
        for name, run in short:
            if any(words[i : i + len(run)] == run for i in range(len(words))):
                best[name] = 1.0
        best = {name: share for name, share in best.items() if "Reserved" not in name}
        out[doc] = (",".join(sorted(best)), len(best), round(max(best.values()), 6) if best else None)
    return out


def line_dedup(rows):
    count, last, parts = collections.Counter(), {}, []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r").translate(UPPER) for line in lines]
        for k in set(keys):
            if len(k) >= 40:
                count[k] += 1
                last[k] = max(last.get(k, -1), doc)
        parts.append((doc, lines, keys))
    out = {}
    for doc, lines, keys in parts:
        kept = [x for x, k in zip(lines, keys) if not (len(k) >= 40 and count[k] >= 5 and last[k] != doc)]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def near_duplicates(rows):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        n = min(4, len(words))
        sets[doc] = frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for doc, s in sets.items():
        for x in s:
            holders[x].add(doc)
    for doc, s in sets.items():
        for other in set().union(*(holders[x] for x in s)) if s else ():
            both = len(s & sets[other])
            if other < doc and 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                parent[max(find(doc), find(other))] = min(find(doc), find(other))
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def contamination(rows, items):
    windows, sizes = collections.defaultdict(set), set()
    for item, text in items:
        words = WORD.findall((text or "").translate(UPPER))
        n = min(10, len(words))
        if n:
            sizes.add(n)
            for j in range(len(words) - n + 1):
                windows[tuple(words[j : j + n])].add(str(item))
    out = {}
    for doc, text in rows:
        words, hit, found = WORD.findall((text or "").translate(UPPER)), set(), set()
        for n in sizes:
            for j in range(len(words) - n + 1):
                if tuple(words[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(words[j : j + n])]
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def top_k(rows, k=5, every=50):
    """Highest inner products of floor(256 * x) as whole numbers; shorter vectors are filled up with zeros."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            scores = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, x)))), j) for j, x in good if j != i]
            out += [(i, rank + 1, j, s) for rank, (s, j) in enumerate(sorted(scores, key=lambda r: (-r[0], r[1]))[:k])]
    return sorted(out)


def word_runs(words):
    """Runs (start, length, smallest period) of at least 6 words and 4 periods, by extending every period from every place."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(words[t] == words[t + r] for t in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))
