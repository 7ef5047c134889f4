"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

UP = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def visible_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def hits(docs, items, window=10):
    """{doc_id: (n_words, n_hit, items)}."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, covered, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    covered |= set(range(k, k + n))
        out.append((doc, len(w), len(covered), sorted(found)))
    return out


def shingle_set(text, size):
    w = visible_words((text or "").translate(UP))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near_components(docs, size=4, percent=85):
    """[(doc_id, n_shingles, component_id)] for rows with distinct ids."""
    sets = [(d, shingle_set(t, size)) for d, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if both and 100 * both >= percent * len(x | y):
                root[find(a)] = find(b)
    smallest: dict[int, int] = {}
    for k, (d, _) in enumerate(sets):
        smallest[find(k)] = min(d, smallest.get(find(k), d))
    return sorted((d, len(s), smallest[find(k)]) for k, (d, s) in enumerate(sets))


def removed(docs, length=50):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)]; ids may repeat."""
    first: dict[bytes, int] = {}
    for d, t in docs:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < d:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return sorted(out)


def quality_counts(text):
    t = text or ""
    w = visible_words(t)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    inside = {k + i for k, g in enumerate(grams) if grams.count(g) > 1 for i in range(3)}
    lines, dup = [], 0
    for line in t.split("\n"):
        if visible_words(line):
            dup += line in lines
            lines.append(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def sharded(docs, weights, added=1.0):
    """[(doc_id, size, crc, shard, slot, grown)]; the numbers are drawn anew from the key's hashes."""
    rows = []
    for d, t in docs:
        raw, key = (t or "").encode(), "" if d is None else str(d)
        draws = [(int(sha(f"{key}/{j // 4}")[13 * (j % 4) :][:13], 16) + 0.5) / 16**13 for j in range(len(weights) + 1)]
        times = [-math.log(u) / w if w else math.inf for u, w in zip(draws, [*weights, added], strict=True)]
        rows.append((d, len(raw) + 1, zlib.crc32(raw), times[:-1].index(min(times[:-1])), times.index(min(times))))
    rows.sort(key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    slots: dict[int, int] = {}
    out = []
    for d, size, crc, shard, grown in rows:
        slots[shard] = slots.get(shard, -1) + 1
        out.append((d, size, crc, shard, slots[shard], grown))
    return out


def ranked(docs, items, best=20):
    """[(item_id, rank, doc_id, score)]."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")
    texts = [(d, [w.translate(UP) for w in words(t)]) for d, t in docs]
    n, total = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df: dict[str, int] = {}
    for _, w in texts:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        found = []
        for d, w in texts:
            if not w:
                continue
            m = 100 - 25 + (25 * len(w) * n) // total
            score = 0
            for term in words(text):
                term = term.translate(UP)
                tf = w.count(term)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(term, 0) + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, k, f[3], -f[0]) for k, f in enumerate(sorted(found)[:best], 1)]
    return out


def aligned(docs, a, b):
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha) and {(a, b): (documents, links)}; `a` and `b` give
    the (id, bytes) of each token of a whole text."""
    texts, pairs = [], {}
    for d, t in docs:
        groups = []
        if t:
            ta, tb, want = a(t), b(t), (" " + t).encode()
            if b"".join(x for _, x in ta) == want == b"".join(x for _, x in tb):
                ends = []
                for tokens in (ta, tb):
                    at = 0
                    ends.append([at := at + len(x) for _, x in tokens])
                cuts = sorted(set(ends[0]) & set(ends[1]))
                sides = []
                for tokens, es in zip((ta, tb), ends, strict=True):
                    side, k = [[] for _ in cuts], 0
                    for (i, _), e in zip(tokens, es, strict=True):
                        k += e > cuts[k]
                        side[k].append(i)
                    sides.append(side)
                groups = list(map(list, zip(*sides, strict=True)))
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        for p in links:
            docs_, n = pairs.get(p, (0, 0))
            pairs[p] = docs_, n + 1
        for p in set(links):
            pairs[p] = pairs[p][0] + 1, pairs[p][1]
        texts.append((d, groups, links))
    most: dict[int, int] = {}
    for (x, _), (n, _) in pairs.items():
        most[x] = max(n, most.get(x, 0))
    rows = []
    for d, groups, links in texts:
        told = ";".join("|".join(",".join(map(str, g)) for g in pair) for pair in groups)
        counts = [pairs[p][0] for p in links]
        n_best = sum(pairs[p][0] == most[p[0]] for p in links)
        rows.append((d, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), n_best, sum(counts), sha(told) if groups else ""))
    return rows, pairs
