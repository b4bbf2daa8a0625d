"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(rows, min_words=50, max_repeat=50, max_docs=20, per_mille=0, min_left=50):
    """rows: (doc_id, text, host). A list of result tuples in the order of the rows."""
    def form(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()

    def key(line):
        f = form(line)
        digits = sum(c in "0123456789" for c in f)
        return re.sub("[0-9]", "0", f) if len(f.replace(" ", "")) - digits >= 4 * digits else f

    forms, docs_of, host_docs = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t, h in rows:
        host_docs[h].add(i)
        for line in (t or "").split("\n"):
            if words(line):
                forms[h, key(line), i].add(form(line))
    for (h, k, i), f in forms.items():
        if len(f) == 1:
            docs_of[h, k].add(i)
    out = []
    for i, t, h in rows:
        w = words(t)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + d for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        gone = [x for x in lines if len(docs_of[h, key(x)] - {None}) > max_docs and len(docs_of[h, key(x)] - {None}) * 1000 > len(host_docs[h] - {None}) * per_mille]
        lost = sum(len(words(x)) for x in gone)
        failed = len(w) < min_words or 100 * len(covered) > max_repeat * len(w)
        depleted = (len(w) - lost) * 100 < len(w) * min_left
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        out.append((i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed, not failed and not depleted, len(gone), lost))
    return out


def shingles(text, n=5):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def near(rows, percent=85):
    """rows: (doc_id, text) with distinct ids. doc_id -> (size of the set, component)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def crc(ids):
    return zlib.crc32(b"".join(int(x).to_bytes(4, "little") for x in ids))


def shards(rows, n):
    """rows: (doc_id, text). (doc_id, size, crc, law, shard, slot), sorted by representation."""
    key = sorted((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16, i) for i, t in rows)
    total, before, out, slots = sum(k[3] for k in key), 0, [], {}
    for _, _, crc, size, i in key:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((i, size, crc, "bytes", shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


def line_dedup(rows, min_chars=20, min_docs=3):
    """rows: (doc_id, text). A list of (doc_id, lines, dropped, text left) in the order of the rows."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def runs(w, least=12):
    """All (start, length, period) of a list of words, found lag by lag without any short cut."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def hard_negatives(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """rows: (id, vector, label). Sorted result tuples; ``anchor`` tells from an id whether the row is one."""
    ok = [
        (i, [math.floor(scale * float(x)) for x in v], label)
        for i, v, label in rows
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = 1 << 63

    def order(r):
        return -r[1], last if r[0] is None else r[0]

    out = []
    for i, a, label in ok:
        if not anchor(i):
            continue
        scored = [(j, sum(x * y for x, y in zip(a, v)), other == label) for j, v, other in ok]
        near = sorted(((j, s) for j, s, same in scored if same and j != i), key=order)[:positives]
        for j, p in near:
            hard = sorted(((k, s) for k, s, same in scored if not same and low * p <= 100 * s <= high * p), key=order)[:negatives]
            out += [(i, j, n + 1, k, p, s) for n, (k, s) in enumerate(hard)]
    return sorted(out, key=repr)
