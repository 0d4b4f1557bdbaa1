"""Plain versions of the operators, over lists of (doc_id, text), for comparison."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingle_set(t):
    w = WORD.findall(lower_ascii(t))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_components(docs):
    """[(doc_id, n, component)] in order, all pairs compared through an inverted index."""
    sets = [shingle_set(t) for _, t in docs]
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    both = Counter()
    for rows in inverted.values():
        for a, i in enumerate(rows):
            for j in rows[a + 1:]:
                both[i, j] += 1
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (i, j), n in both.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def repeats(docs, length=50):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}"""
    big = float("inf")
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            g = b[p:p + length]
            first[g] = min(first.get(g, big), big if d is None else d)
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (big if d is None else d):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d, t] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def secrets(t):
    """Base spans, by the letter of the patterns."""
    t = t or ""
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 16:
            spans.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m[0]) >= 32:
            spans.append((m.start(), 2, "hex", m.end()))
    return [(k, a, b) for a, _, k, b in sorted(spans)]


def quality(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] >= 2 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def edit_distance_in(item, text):
    """Least word edits from `item` to any stretch of `text`."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 3 == 1
