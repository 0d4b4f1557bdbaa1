"""Benchmark decontamination by embedding windows for edit distance.

A document leaks an item when some stretch of its words is within
`floor(0.2 * n)` word edits (insert, delete, replace; ASCII case ignored) of
the item's n words.  Items are cut into pieces of at most `PIECE_WORDS` words
and windows of a piece's size are mapped by the CGK random walk, which turns
few edits into few differing positions; bit sampling over repeated walks keeps
a window when all sampled positions agree in at least one repetition; an exact
edit distance of the whole item decides wherever a window of any piece is kept.

Which windows are embedded: by the q-gram lemma a stretch within e edits of n
words keeps at least n - 2 - 3e of the item's 3-word grams, each shifted by
at most e words.  Only windows on diagonals with that many shared grams can
match, so leaving out the others loses nothing.

Why pieces: the share of embedded positions that a given share of edits makes
differ grows with the length of the walk, so walks over whole long items would
miss leaks.  The edits of a leak cannot exceed the allowed share in every
piece, so at least one piece is within it, and its kept grams are on diagonals
that are embedded.

Repetitions: with a share `WORST_DIFFERENCE` of a piece's embedded positions
differing, two sampled positions agree with probability p = (1 - share)^2, and
`log(1 - TARGET_RECALL) / log(1 - p)` repetitions reach the target recall per
window; further pieces within the allowance raise it (recall is measured in
the tests, for items of 20 to 1,600 words at the full allowance).

Short items.  Below `MIN_ITEM_WORDS` words a leak may share no 3-word gram
with its item, and nothing is gained by an embedding.  Items of up to four words
allow no edit: they leak where all their words stand in a row.  Items of five
to seven allow one, which leaves one half of the item as it is; wherever a half
stands in a text and all but one word of the other half stand around it, the
exact edit distance decides.

Defined cases: items without a word and null items are
never searched; null or empty texts leak nothing; repeated rows get equal
results; repeated items are reported once per item_id; without items, or
without documents, there are no leaks; texts of any length are searched
whole; other columns are ignored, or returned unchanged by `drop_leaks`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapkeep.llm.frames import base_docs
from snapkeep.llm.wordhash import U64, Words, mix, run_hash, slices

MIN_ITEM_WORDS = 8
EDIT_SHARE = 0.2
GRAM = 3
TARGET_RECALL = 0.999
WORST_DIFFERENCE = 0.6
#: Items are embedded in pieces of at most this many words.
PIECE_WORDS = 50
SAMPLED = 2
REPETITIONS = math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - (1 - WORST_DIFFERENCE) ** SAMPLED))
#: Items are searched in blocks of at most this many words, so what a task
#: holds of the benchmark is bounded whatever its size.
BLOCK_WORDS = 500_000
#: Symbols of walks held at once (8 bytes each).
WALK_SYMBOLS = 6_000_000
#: Pairs of equal grams of texts and items held at once; one text and one item
#: that share more are held whole.
SHARED_GRAMS = 2_000_000

OUT = "doc_id long, item_id long, distance long, start_word long, end_word long"


def edits_allowed(n: int) -> int:
    return int(EDIT_SHARE * n + 1e-9)


def walk_symbols(windows: np.ndarray, lengths: np.ndarray, steps: int) -> np.ndarray:
    """CGK walks of padded rows of word hashes: (repetition, row, step).

    At each step a walk emits the word it stands on (0 past the end) and
    moves on if a random bit of that word, repetition and step says so.
    """
    rows = np.arange(len(windows))
    at = np.zeros((REPETITIONS, len(windows)), dtype=np.int64)
    out = np.zeros((REPETITIONS, len(windows), steps), dtype=U64)
    seeds = mix(np.arange(1, REPETITIONS + 1, dtype=U64)[:, None] * U64(0x9E3779B97F4A7C15))
    padded = np.concatenate([windows, np.zeros((len(windows), 1), dtype=U64)], axis=1)
    for j in range(steps):
        symbol = padded[rows[None, :], np.minimum(at, lengths[None, :])]
        symbol = np.where(at < lengths[None, :], symbol, U64(0))
        out[:, :, j] = symbol
        at += (mix(symbol ^ (seeds + U64(j))) >> U64(63)).astype(np.int64)
    return out


def sampled_steps(n: int) -> np.ndarray:
    """The positions sampled in each repetition for pieces of up to n words.

    A walk advances on every second step on average, so the first 2n of its
    3n steps cover the window.
    """
    r = np.arange(REPETITIONS * SAMPLED, dtype=U64) + U64(n << 20)
    return (mix(r * U64(0xD6E8FEB86659FD93)) % U64(2 * n)).astype(np.int64).reshape(REPETITIONS, SAMPLED)


def pieces(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and lengths of the pieces of an item of n words."""
    k = -(-n // PIECE_WORDS)
    edge = np.arange(k + 1) * n // k
    return edge[:-1], np.diff(edge)


def piece_symbols(hashes: np.ndarray, start: np.ndarray, length: np.ndarray, m: int) -> np.ndarray:
    """Sampled symbols of stretches of at most m of the `hashes`: (repetition, stretch, sample).

    About WALK_SYMBOLS are held at once.
    """
    step = max(1, WALK_SYMBOLS // (2 * REPETITIONS * m))
    out = np.zeros((REPETITIONS, len(start), SAMPLED), dtype=U64)
    along = np.arange(m)
    for a in range(0, len(start), step):
        at, size = start[a:a + step, None], length[a:a + step]
        rows = np.where(along < size[:, None], hashes[np.minimum(at + along, len(hashes) - 1)], U64(0))
        walks = walk_symbols(rows, size, 2 * m)
        out[:, a:a + step] = np.take_along_axis(walks, sampled_steps(m)[:, None, :], axis=2)
    return out


class ItemIndex:
    """Word hashes of a block of items and the places of their 3-word grams."""

    def __init__(self, items: list[tuple[int, str]]):
        words = Words([t.encode() for _, t in items])
        self.ids, self.words = [], []
        self.edited: list[tuple[int, np.ndarray]] = []
        short: dict[int, list[tuple[int, int]]] = {}
        for i, (item_id, _) in enumerate(items):
            w = words.hash[words.first[i]:words.first[i + 1]]
            if len(w) >= MIN_ITEM_WORDS:
                self.ids.append(item_id)
                self.words.append(w)
            elif edits_allowed(len(w)):
                self.edited.append((item_id, w))
            elif len(w):
                short.setdefault(len(w), []).append((int(run_hash(w, len(w))[0]), item_id))
        #: by number of words, the hashes of short items in order and their ids
        self.short = {n: (np.array([h for h, _ in sorted(x)], dtype=U64), [i for _, i in sorted(x)]) for n, x in short.items()}
        #: by length, the halves of short items with an edit: hashes in order, item and place in it
        halves: dict[int, list[tuple[int, int, int]]] = {}
        for k, (_, w) in enumerate(self.edited):
            for a, b in ((0, len(w) // 2), (len(w) // 2, len(w))):
                halves.setdefault(b - a, []).append((int(run_hash(w[a:b], b - a)[0]), k, a))
        self.halves = {
            n: (np.array([h for h, _, _ in sorted(x)], dtype=U64), np.array([r[1:] for r in sorted(x)], dtype=np.int64))
            for n, x in halves.items()
        }
        grams, item, place = [], [], []
        for i, w in enumerate(self.words):
            g = run_hash(w, GRAM)
            grams.append(g)
            item.append(np.full(len(g), i))
            place.append(np.arange(len(g)))
        empty = np.zeros(0, dtype=np.int64)
        g = np.concatenate(grams) if grams else empty.astype(U64)
        order = np.argsort(g, kind="stable")
        self.gram = g[order]
        self.item = (np.concatenate(item) if item else empty)[order]
        self.place = (np.concatenate(place) if place else empty)[order]
        # each gram's range of entries; within it the entries follow the items
        self.start = np.flatnonzero(np.diff(self.gram, prepend=self.gram[:1] ^ U64(1)))
        self.distinct = self.gram[self.start]
        self.start_after = np.append(self.start[1:], len(self.gram))
        self.rank = np.repeat(np.arange(len(self.start)), self.start_after - self.start) * len(self.ids) + self.item
        self.quick = np.zeros(1 << 22, dtype=bool)
        self.quick[(self.gram & U64((1 << 22) - 1)).astype(np.int64)] = True
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.edits = np.array([edits_allowed(len(w)) for w in self.words], dtype=np.int64)
        self._keys: dict[int, np.ndarray] = {}

    def keys(self, i: int) -> np.ndarray:
        """Sampled symbols of the pieces of item i: (repetition, piece, sample)."""
        if i not in self._keys:
            first, length = pieces(len(self.words[i]))
            self._keys[i] = piece_symbols(self.words[i], first, length, int(length.max()))
        return self._keys[i]


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of `item` to any stretch of `text`: (distance, start, end)."""

    def rows(a: np.ndarray, b: np.ndarray, free_start: bool) -> np.ndarray:
        along = np.arange(len(b) + 1)
        d = np.zeros(len(b) + 1, dtype=np.int64) if free_start else along.copy()
        for k, x in enumerate(a):
            new = np.empty_like(d)
            new[0] = k + 1
            new[1:] = np.minimum(d[1:] + 1, d[:-1] + (b != x))
            d = np.minimum.accumulate(new - along) + along
        return d

    d = rows(item, text, True)
    end = int(np.argmin(d))
    back = rows(item[::-1], text[:end][::-1], False)
    return int(d[end]), end - int(np.argmin(back)), end


def _shared_grams(words: Words, index: ItemIndex, p: np.ndarray, gram: np.ndarray) -> Iterator[tuple]:
    """(word, item, place in the item) of the grams that texts share with items.

    About SHARED_GRAMS come at once: whole texts together, and a text that
    shares more than that alone, one range of items after another.  All of a
    text's grams with one item are always together.
    """
    count = index.start_after[gram] - index.start[gram]
    text = words.text[p]
    edge = np.flatnonzero(np.diff(text, prepend=-1))
    size = np.add.reduceat(count, edge) if len(edge) else count
    groups, held = [], SHARED_GRAMS
    for a, n in zip(edge, size):
        if held + n > SHARED_GRAMS:
            groups.append(int(a))
            held = 0
        held += n
    items = len(index.ids)
    for a, b in zip(groups, [*groups[1:], len(p)]):
        ranges = min(items, -(-int(count[a:b].sum()) // SHARED_GRAMS))
        limits = np.arange(ranges + 1) * items // ranges
        for i, j in zip(limits[:-1], limits[1:]):
            first = np.searchsorted(index.rank, gram[a:b] * items + i)
            n = np.searchsorted(index.rank, gram[a:b] * items + j) - first
            if n.any():
                hit = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                yield np.repeat(p[a:b], n), index.item[hit], index.place[hit]


def _candidates(words: Words, index: ItemIndex, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Distinct (item, text, diagonal) rows that share enough grams, in that order."""
    text = words.text[at]
    diagonal = at - words.first[text] - place
    order = np.lexsort((diagonal, item, text))
    text, item, diagonal = text[order], item[order], diagonal[order]
    # enough shared grams within 2e + 1 neighbouring diagonals
    need = index.length[item] - (GRAM - 1) - GRAM * index.edits[item]
    k = np.arange(len(text))
    last = np.minimum(k + need - 1, len(text) - 1)
    ok = (k + need - 1 < len(text)) & (text[last] == text) & (item[last] == item)
    ok &= diagonal[last] - diagonal <= 2 * index.edits[item]
    marks = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(marks, k[ok], 1)
    np.add.at(marks, last[ok] + 1, -1)
    inside = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    return np.unique(np.stack([item[inside], text[inside], diagonal[inside]], axis=1), axis=0)


def _short_leaks(words: Words, index: ItemIndex) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item_id, 0, start word, end word) of the first copy of short items."""
    for n, (hashes, ids) in index.short.items():
        h = run_hash(words.hash, n)
        p = np.flatnonzero(words.text[:len(h)] == words.text[n - 1:]) if len(h) else np.zeros(0, dtype=np.int64)
        at = np.searchsorted(hashes, h[p])
        same = hashes[np.minimum(at, len(hashes) - 1)] == h[p]
        p, at = p[same], at[same]
        for k in np.unique(words.text[p] * len(hashes) + at, return_index=True)[1]:
            t, i = int(words.text[p[k]]), int(at[k])
            start = int(p[k] - words.first[t])
            while i < len(ids) and hashes[i] == hashes[at[k]]:
                yield t, ids[i], 0, start, start + n
                i += 1


def _edited_leaks(words: Words, index: ItemIndex) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item_id, distance, start word, end word), the best stretch of short
    items with one edit: around every copy of one of their halves."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    padded = np.concatenate([np.zeros(8, dtype=U64), words.hash, np.zeros(16, dtype=U64)])
    for n, (hashes, rows) in index.halves.items():
        h = run_hash(words.hash, n)
        if not len(h):
            continue
        p = np.flatnonzero(words.text[:len(h)] == words.text[n - 1:])
        first = np.searchsorted(hashes, h[p])
        count = np.searchsorted(hashes, h[p], side="right") - first
        at = np.repeat(p, count)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        for k in np.unique(rows[entry, 0]):
            item_id, item = index.edited[k]
            mine = rows[entry, 0] == k
            start = at[mine] - rows[entry[mine], 1]
            # all words but one stand at their place or next to it
            here = np.zeros(len(start), dtype=np.int64)
            for j, x in enumerate(item):
                here += (padded[start + j + 7] == x) | (padded[start + j + 8] == x) | (padded[start + j + 9] == x)
            for s, t in zip(start[here >= len(item) - 1], words.text[at[mine]][here >= len(item) - 1]):
                low, high = int(words.first[t]), int(words.first[t + 1])
                a, b = max(low, int(s) - 1), min(high, int(s) + len(item) + 1)
                d, x, y = best_stretch(item, words.hash[a:b])
                if d <= edits_allowed(len(item)):
                    key, found = (int(t), item_id), (d, a - low + x, a - low + y)
                    best[key] = min(best.get(key, found), found)
    for (t, item_id), found in best.items():
        yield t, item_id, *found


def find_leaks(texts: list[bytes], index: ItemIndex) -> list[tuple[int, int, int, int, int]]:
    """(text, item_id, distance, start word, end word), best stretch of each pair."""
    out: list[tuple[int, int, int, int, int]] = []
    for lo, hi in slices(texts):
        words = Words(texts[lo:hi])
        out += [(lo + t, *found) for t, *found in _short_leaks(words, index)]
        out += [(lo + t, *found) for t, *found in _edited_leaks(words, index)]
        if not len(index.gram):
            continue
        g = run_hash(words.hash, GRAM)
        p = np.flatnonzero(index.quick[(g & U64((1 << 22) - 1)).astype(np.int64)])
        p = p[words.text[p] == words.text[p + GRAM - 1]] if len(p) else p
        gram = np.minimum(np.searchsorted(index.distinct, g[p]), len(index.distinct) - 1)
        real = index.distinct[gram] == g[p]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at, item, place in _shared_grams(words, index, p[real], gram[real]):
            cand = _candidates(words, index, at, item, place)
            for mine in np.split(cand, np.flatnonzero(np.diff(cand[:, 0])) + 1):
                if not len(mine):
                    continue
                i = int(mine[0, 0])
                # long items have more pieces a window: fewer windows at once
                step = max(1, WALK_SYMBOLS // (2 * REPETITIONS * int(index.length[i])))
                for part in range(0, len(mine), step):
                    _check_windows(words, index, i, mine[part:part + step], best)
        out += [(lo + t, index.ids[i], *v) for (t, i), v in sorted(best.items())]
    return out


def _check_windows(words: Words, index: ItemIndex, i: int, cand: np.ndarray, best: dict) -> None:
    n, e = int(index.length[i]), int(index.edits[i])
    item = index.words[i]
    size = words.first[cand[:, 1] + 1] - words.first[cand[:, 1]]
    start = np.clip(cand[:, 2], 0, size)
    first, length = pieces(n)
    # (window, piece): a piece's words on the window's diagonal, inside the text
    at = cand[:, 2][:, None] + first
    a, b = np.clip(at, 0, size[:, None]), np.clip(at + length, 0, size[:, None])
    window, piece = np.nonzero(b > a)
    a, b = a[window, piece], b[window, piece]
    picked = piece_symbols(words.hash, words.first[cand[window, 1]] + a, b - a, int(length.max()))
    same = (picked == index.keys(i)[:, piece]).all(axis=2).any(axis=0)
    near = np.zeros(len(cand), dtype=bool)
    near[window[same]] = True
    for t in np.unique(cand[near, 1]):
        w = words.hash[words.first[t]:words.first[t + 1]]
        at = np.sort(start[near & (cand[:, 1] == t)])
        # neighbouring windows are verified together
        for group in np.split(at, np.flatnonzero(np.diff(at) > n) + 1):
            a, b = max(0, int(group[0]) - e), min(len(w), int(group[-1]) + n + e)
            d, s, end = best_stretch(item, w[a:b])
            if d <= e:
                found = (d, a + s, a + end)
                key = (int(t), i)
                best[key] = min(best.get(key, found), found)


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[ItemIndex]:
    """Indexes over blocks of items, read one after another from the table."""
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.select(items["item_id"].cast("long"), items["text"].cast("string")).toLocalIterator()
    for item_id, text in rows:
        if item_id is None or not text:
            continue
        n = len(text.split())
        if block and size + n > block_words:
            yield ItemIndex(block)
            block, size = [], 0
        block.append((item_id, text))
        size += n
    if block:
        yield ItemIndex(block)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it leaks, with the best stretch.

    A map over the documents for each block of items: no shuffle.
    """
    docs = base_docs(docs)
    result = docs.sparkSession.createDataFrame([], OUT)
    for index in item_blocks(items):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
                best: dict[tuple[int, int], tuple] = {}
                for t, item, *found in find_leaks(texts, index):
                    best[t, item] = min(best.get((t, item), tuple(found)), tuple(found))
                rows = [(ids[t], item, *found) for (t, item), found in best.items()]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in OUT.split(", ")]
                )

        result = result.unionByName(docs.mapInArrow(run, OUT))
    return result


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that leak no item, all columns unchanged."""
    at = docs.columns.index("text")
    for index in item_blocks(items):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
                bad = {t for t, *_ in find_leaks(texts, index)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
