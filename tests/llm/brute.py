"""Plain single-machine versions of the operators' results, for small tables."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\f\r"


def words(text):
    out, now = [], []
    for c in text or "":
        if c in SPACE:
            if now:
                out.append("".join(now))
            now = []
        else:
            now.append(c)
    return out + ["".join(now)] * bool(now)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Least node reachable, for each node."""
    label = {}
    for n in sorted(nodes):
        if n in label:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = n
                todo += linked[x]
    return label


def simhash_classes(docs):
    """doc_id -> (fingerprint, component_id)."""
    prints = {d: simhash(t) for d, t in docs}
    linked = defaultdict(list)
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            linked[a].append(b)
            linked[b].append(a)
    label = components(prints, linked)
    return {d: (f"{prints[d]:016x}", label[d]) for d in prints}


def jump(key, buckets):
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def window_dedup(docs):
    """doc_id -> (n_words, n_removed, sha256 of the kept words)."""
    texts = {d: words(t) for d, t in docs}
    first = {}
    for d in sorted(texts):
        w = texts[d]
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i:i + 20]), (d, i))
    out = {}
    for d, w in texts.items():
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] < (d, i):
                gone.update(range(i, i + 20))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def quality_counts(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def crc(text):
    return zlib.crc32((text or "").encode())


def line_dedup(docs, rare=None, min_words=5):
    """doc_id -> (n_lines, n_deleted, sha256 of the kept text); docs are (doc_id, text) with distinct ids.

    Every two documents with a common line are aligned; with ``rare``, those of more common lines only with the first.
    """
    split = {d: [x.strip(SPACE) for x in t.split("\n")] if t else [] for d, t in docs}
    first = {}
    for d in sorted(split):
        first.setdefault(tuple(split[d]), d)
    holders = defaultdict(list)
    for d in sorted(first.values()):
        for x in set(split[d]) - {""}:
            holders[x].append(d)
    pairs = {(h[0], d) for h in holders.values() for d in h[1:]}
    pairs |= {(a, b) for h in holders.values() if rare is None or len(h) <= rare for a, b in itertools.combinations(h, 2)}
    gone = defaultdict(set)
    for d, lines in split.items():
        if first[tuple(lines)] != d and sum(len(words(x)) for x in lines) >= min_words:
            gone[d] = set(range(len(lines)))
    for a, b in pairs:
        match = patience(split[a], split[b], 0, 0)
        while match:
            n = 1
            while n < len(match) and match[n] == (match[n - 1][0] + 1, match[n - 1][1] + 1):
                n += 1
            if sum(len(words(split[b][j])) for _, j in match[:n]) >= min_words:
                gone[b].update(j for _, j in match[:n])
            match = match[n:]
    out = {}
    for d, t in docs:
        raw = t.split("\n") if t else []
        out[d] = (len(raw), len(gone[d]), sha("\n".join(x for i, x in enumerate(raw) if i not in gone[d])))
    return out


def patience(a, b, at, bt):
    """Aligned places, recursively."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = [(at + i, bt + i) for i in range(head)]
    end = [(at + len(a) - i, bt + len(b) - i) for i in range(tail, 0, -1)]
    a, b, at, bt = a[head:len(a) - tail], b[head:len(b) - tail], at + head, bt + head
    both = [(a.index(x), b.index(x)) for x in a if x and a.count(x) == 1 and b.count(x) == 1]
    if both:
        best = [1] * len(both)
        back = [-1] * len(both)
        # The longest increasing run; among equals the one whose places in b come earliest, from the end.
        from bisect import bisect_left
        tops, who = [], []
        for n, (_, j) in enumerate(both):
            k = bisect_left(tops, j)
            tops[k:k + 1], who[k:k + 1] = [j], [n]
            best[n], back[n] = k + 1, who[k - 1] if k else -1
        n, run = who[-1], []
        while n >= 0:
            run.append(both[n])
            n = back[n]
        i = j = 0
        for p, q in [*run[::-1], (len(a), len(b))]:
            out += patience(a[i:p], b[j:q], at + i, bt + j)
            if p < len(a):
                out.append((at + p, bt + q))
            i, j = p + 1, q + 1
    return out + end
