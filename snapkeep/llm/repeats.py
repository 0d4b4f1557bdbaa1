"""Suffix-array deduplication of byte strings across documents.

A byte goes when it lies in a 50-byte string that also starts in a document
with a smaller doc_id; the first document keeps its copy.

The suffix array of the corpus is kept in pieces.  Two suffixes that share 50
bytes share the least 16-byte gram (by hash) of these 50 bytes, so suffixes
are dealt to buckets by that gram, and everything the longest-previous-factor
array needs up to length 50 lies in one bucket.  Consecutive suffixes with the
same least gram travel as one stretch of text, about 3.6 bytes for each byte
of the corpus before compression.  In a bucket the suffixes are put in
lexicographic order of their first 50 bytes, then of document; common prefixes
of neighbours and the previous and next smaller positions in that order give
the longest previous factor, and a suffix whose factor reaches 50 starts a
repeat.  Whole suffix positions never meet in one place.

Skew: a stretch that occurs several times in a task's batch is sent once, for
the least doc_id; the others are removed there and then, as an earlier
document of the batch holds the very same bytes (their bytes are compared, not
only their keys).  So a passage that a third of all documents share reaches
its bucket once a batch, not once a document.  The stretches around it differ
though, and would all meet in the bucket of its grams.  So grams with more than
`HOT` different stretches are looked for in a sample of the documents, and
their suffixes are dealt one by one, by all of their 50 bytes: equal ones still
meet, and the others spread over all buckets.  The sample steers the dealing
only.  At most `MAX_HOT` grams are listed; a larger group that was not found
is ordered in pieces, again by the 50 bytes, so ordering never takes more than
`CHUNK` suffixes or those of `HOT` stretches at a time.

A bucket stays compressed in its task and is read once for each of its parts,
which are dealt by the grams: about `PART_BYTES` of stretches are open at a
time, whatever a bucket holds (more only if one gram has more).

Defined cases: a null text has no bytes (hash of the empty string) and one
shorter than 50 bytes loses nothing; rows that repeat a doc_id do not count
as smaller than each other; a null doc_id counts as larger than all others;
texts of any length are read in overlapping segments; an empty table gives an
empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs, bucket_count, text_bytes
from snapkeep.llm.wordhash import U64, mix

LENGTH = 50
GRAM = 16
#: Grams whose least one stands for a string of LENGTH bytes.
GRAMS = LENGTH - GRAM + 1
#: Text bytes behind one bucket of stretches, and behind one block of results.
BUCKET_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
#: Bytes of stretches, not compressed, that a bucket opens at once.
PART_BYTES = 20 << 20
#: Bytes scanned at once, and suffixes ordered at once.
SEGMENT = 4 << 20
CHUNK = 1 << 17
#: Different stretches of a gram beyond which its suffixes are dealt singly.
HOT = 1 << 14
#: Hot grams listed at most (8 bytes each), the most frequent first.
MAX_HOT = 1 << 20
#: The sample that finds them: this many bytes, or this share if that is more.
SAMPLE_BYTES = 16 << 20
SAMPLE_SHARE = 1 / 256
NO_ID = np.iinfo(np.int64).max

_TYPES = {"b": np.dtype("u1"), "i": np.dtype("<u4"), "q": np.dtype("<i8")}


def pack(kinds: str, *arrays: np.ndarray) -> bytes:
    """Arrays of the types named in `kinds`, compressed together."""
    parts = [struct.pack("<q", len(a)) + np.ascontiguousarray(a, dtype=_TYPES[k]).tobytes() for k, a in zip(kinds, arrays)]
    return zstandard.ZstdCompressor(level=6).compress(b"".join(parts))


def result_block(ids: np.ndarray, keys: np.ndarray, blocks: int) -> np.ndarray:
    """The block of rows a row's result is made in; copies of a text spread out."""
    h = mix(ids.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15) + keys.astype(U64))
    return (h % U64(blocks)).astype(np.int64)


def unpack(kinds: str, data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for k in kinds:
        n = struct.unpack_from("<q", raw, at)[0]
        out.append(np.frombuffer(raw, dtype=_TYPES[k], count=n, offset=at + 8))
        at += 8 + n * _TYPES[k].itemsize
    return out


def _words_at(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as one number."""
    return np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    w = _words_at(buf)
    a = w[:-8] * U64(0x9E3779B97F4A7C15)
    a ^= a >> U64(32)
    a += w[8:]
    a *= U64(0xD6E8FEB86659FD93)
    a ^= a >> U64(29)
    a *= U64(0xBF58476D1CE4E5B9)
    return a


def sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:size - n], h[n - size:]) if size < n else h


class Stretches:
    """Runs of suffixes of a batch of segments that share their least gram.

    `start` (place in the batch), `count` (suffixes), `offset` (of the least
    gram from the start), `least` (its hash) and `segment` of each.
    """

    def __init__(self, segments: list[bytes]):
        self.buf = np.frombuffer(b"".join(segments), dtype=np.uint8)
        sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        n = len(self.buf) - LENGTH + 1
        if n <= 0:
            self.hash = np.zeros(0, dtype=U64)
            self.start = self.count = self.offset = self.segment = np.zeros(0, dtype=np.int64)
            self.least = np.zeros(0, dtype=U64)
            return
        self.hash = gram_hashes(self.buf)
        least = sliding_min(self.hash, GRAMS)
        ok = np.ones(n + 1, dtype=bool)
        for end in self.base[1:-1]:  # suffixes that would cross into the next segment
            ok[max(0, end - LENGTH + 1):end] = False
        ok[n] = False
        change = np.ones(n, dtype=bool)
        change[1:] = (least[1:] != least[:-1]) | ~ok[:n - 1]
        self.start = np.flatnonzero(change & ok[:n])
        stop = np.flatnonzero((change & ok[:n]) | ~ok[:n])
        stop = np.append(stop, n)
        self.count = stop[np.searchsorted(stop, self.start, side="right")] - self.start
        self.least = least[self.start]
        self.segment = np.searchsorted(self.base, self.start, side="right") - 1
        self.offset = self._offsets(self.start, self.least)

    def _offsets(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Place of the least gram in the strings from `start`."""
        offset = np.zeros(len(start), dtype=np.int64)
        left = np.arange(len(start))
        for j in range(GRAMS):
            hit = self.hash[start[left] + j] == least[left]
            offset[left[hit]] = j
            left = left[~hit]
        return offset

    def route(self, hot: np.ndarray) -> np.ndarray:
        """The key that each stretch is dealt by: its gram, or all of its bytes
        where the gram is one of `hot` (sorted), whose stretches are first cut
        into single suffixes."""
        at = np.minimum(np.searchsorted(hot, self.least), max(0, len(hot) - 1))
        is_hot = hot[at] == self.least if len(hot) else np.zeros(len(self.least), dtype=bool)
        if not is_hot.any():
            return mix(self.least.copy())
        n = np.where(is_hot, self.count, 1)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        single = np.repeat(is_hot, n)
        start, least = np.repeat(self.start, n) + step, np.repeat(self.least, n)
        offset = np.repeat(self.offset, n)
        moved = np.flatnonzero(single)
        offset[moved] = self._offsets(start[moved], least[moved])
        self.count = np.where(single, 1, np.repeat(self.count, n))
        self.segment = np.repeat(self.segment, n)
        self.start, self.least, self.offset = start, least, offset
        key = least.copy()
        key[moved] = string_keys(self.hash, start[moved])
        return mix(key)

    def content_keys(self) -> np.ndarray:
        """Equal for stretches of equal bytes; stretches of more suffixes than
        a gram can be least for (periodic text) get keys of their own."""
        last = self.start + self.count + LENGTH - 1 - GRAM
        key = mix(self.least + self.count.astype(U64))
        for at in range(0, GRAMS + LENGTH, GRAM):
            key = mix(key * U64(0x9E3779B97F4A7C15) + self.hash[np.minimum(self.start + at, last)])
        odd = np.flatnonzero(self.count > GRAMS)
        key[odd] = mix(key[odd] + odd.astype(U64) * U64(0xD6E8FEB86659FD93))
        return key


def string_keys(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A key of the LENGTH bytes from each start, from the hashes of the grams in them."""
    key = hashes[start].copy()
    for at in (*range(GRAM, LENGTH - GRAM, GRAM), LENGTH - GRAM):
        key = mix(key * U64(0x9E3779B97F4A7C15) + hashes[start + at])
    return key


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans from `a` and `b` hold equal bytes (sizes of 8 or more)."""
    w = _words_at(buf)
    same = np.ones(len(a), dtype=bool)
    left = np.arange(len(a))
    at = 0
    while len(left):
        # the last word of a span overlaps the one before it
        place = np.minimum(at, size[left] - 8)
        same[left] &= w[a[left] + place] == w[b[left] + place]
        at += 8
        left = left[same[left] & (size[left] > at)]
    return same


def gather(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of spans of `buf`, one after another."""
    shift = start - (np.cumsum(size) - size)
    return buf[np.repeat(shift, size) + np.arange(size.sum())]


def _segments(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Batches of (text, place in it, bytes); long texts overlap by LENGTH - 1."""
    owner, place, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), SEGMENT):
            part = t[at:at + SEGMENT + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if parts and size + len(part) > SEGMENT:
                yield owner, place, parts
                owner, place, parts, size = [], [], [], 0
            owner.append(i), place.append(at), parts.append(part)
            size += len(part)
    if parts:
        yield owner, place, parts


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (gram, number of different stretches of it in a batch)."""
    for batch in batches:
        column = batch.column(0)
        texts = (t or b"" for lo in range(0, len(column), 500) for t in column.slice(lo, 500).to_pylist())
        for _, _, parts in _segments(texts):
            s = Stretches(parts)
            _, one = np.unique(s.content_keys(), return_index=True)
            gram, n = np.unique(s.least[one], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])


def hot_grams(rows: DataFrame, total: int) -> np.ndarray:
    """Grams with more than about HOT different stretches, sorted.

    A sample of documents shows them: a gram with HOT stretches in the corpus
    has 64 or more in it.
    """
    share = max(SAMPLE_SHARE, min(1.0, SAMPLE_BYTES / max(total, 1)))
    parts = 1 << 16
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)) < int(share * parts)).select("text")
    found = (
        sample.mapInArrow(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(2.0, share * HOT)).orderBy(F.desc("n"), "gram").limit(MAX_HOT).select("gram").collect()
    )
    return np.sort(np.array([r["gram"] for r in found], dtype=np.int64).view(U64))


def _deal(buckets: int, blocks: int, hot: np.ndarray):
    """(doc_id, key, text) to (bucket, stretches, block, marks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(int(NO_ID)).to_numpy()
            keys = batch.column(1).to_numpy()
            column = batch.column(2)
            # texts become Python objects a few at a time
            texts = (t or b"" for lo in range(0, len(column), 500) for t in column.slice(lo, 500).to_pylist())
            for owner, place, parts in _segments(texts):
                yield _deal_batch(buckets, blocks, hot, ids, keys, np.array(owner), np.array(place), parts)

    return run


def _deal_batch(buckets, blocks, hot, ids, keys, owner, place, parts) -> pa.RecordBatch:
    s = Stretches(parts)
    route = s.route(hot)
    block_of = result_block(ids, keys, blocks)
    doc = owner[s.segment]
    at = place[s.segment] + s.start - s.base[s.segment]
    content = s.content_keys()
    order = np.lexsort((ids[doc], content))
    first = np.ones(len(order), dtype=bool)
    first[1:] = content[order][1:] != content[order][:-1]
    earliest = order[first][np.cumsum(first) - 1]
    later = np.zeros(len(order), dtype=bool)
    later[order] = ids[doc[order]] > ids[doc[earliest]]
    # equal keys are not yet equal bytes; what differs is sent like others
    copies = later[order]
    one, other = order[copies], earliest[copies]
    same = s.count[one] == s.count[other]
    one, other = one[same], other[same]
    later[:] = False
    later[one[same_bytes(s.buf, s.start[one], s.start[other], s.count[one] + LENGTH - 1)]] = True
    rows = []
    gone = np.flatnonzero(later)
    gone = gone[np.argsort(block_of[doc[gone]], kind="stable")]
    for part in np.split(gone, np.flatnonzero(np.diff(block_of[doc[gone]])) + 1) if len(gone) else ():
        d = doc[part]
        marks = pack("qiii", ids[d], keys[d], at[part], at[part] + s.count[part] + LENGTH - 1)
        block = int(block_of[d[0]])
        rows.append((block % buckets, None, block, marks))
    send = np.flatnonzero(~later)
    bucket = (route[send] % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    send, bucket = send[order], bucket[order]
    for part in np.split(np.arange(len(send)), np.flatnonzero(np.diff(bucket)) + 1) if len(send) else ():
        run = send[part]
        docs, local = np.unique(doc[run], return_inverse=True)
        text = gather(s.buf, s.start[run], s.count[run] + LENGTH - 1)
        # the runs are in order of place: differences are small
        same = np.diff(local, prepend=-1) == 0
        gap = np.where(same, np.diff(at[run], prepend=0), at[run])
        rows.append((int(bucket[part[0]]), pack("qiiibibb", ids[docs], keys[docs], np.diff(local, prepend=0), gap >> 8,
                                                gap & 255, s.count[run], s.offset[run], text), None, None))
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.binary()))],
        names=["bucket", "stretches", "block", "marks"],
    )


def suffix_order(buf: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes from `at` in lexicographic order of their first LENGTH
    bytes, ties by document, and the common prefix of each with the one before
    it in that order (at most LENGTH, 0 for the first).

    Ordered by eight bytes after eight: only groups that agree so far and
    differ later are put in order again, repeats are not.
    """
    w = _words_at(buf)
    places = (*range(0, LENGTH - 7, 8), LENGTH - 8)
    # the last word overlaps the one before it: equal bytes do not change the order
    words = [w[at + k] for k in places]
    order = np.lexsort((doc, words[0].byteswap()))
    new = np.ones(len(order), dtype=bool)
    new[1:] = words[0][order[1:]] != words[0][order[:-1]]
    mixed = np.arange(len(order))
    for k in range(1, len(words)):
        tied = mixed[~new[mixed]]
        here, before = order[tied], order[tied - 1]
        differ = np.zeros(len(tied), dtype=bool)
        for x in words[k:]:
            differ |= x[here] != x[before]
        group = np.cumsum(new)
        again = np.zeros(len(order) + 1, dtype=bool)
        again[group[tied[differ]]] = True
        mixed = np.flatnonzero(again[group])
        x = words[k][order[mixed]].byteswap()
        sort = np.lexsort((x, group[mixed]))
        order[mixed], x = order[mixed][sort], x[sort]
        new[mixed[1:]] |= x[1:] != x[:-1]
    common = np.zeros(len(order), dtype=np.int64)
    same = np.arange(1, len(order))
    for k, x in zip(places, words):
        differ = x[order[same]] ^ x[order[same - 1]]
        # whole bytes below the lowest differing bit
        bytes_equal = np.bitwise_count((differ & (~differ + U64(1))) - U64(1)).astype(np.int64) >> 3
        common[same] = k + bytes_equal
        same = same[differ == 0]
    return order, common


def smaller_neighbour(doc: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of every suffix with the previous one in suffix order of a
    smaller document, 0 where it is shorter than LENGTH.

    Candidates jump over suffixes of no smaller document by the candidates of
    those, all at once, so chains of equal documents take few rounds; a chain
    ends where its common prefix falls below LENGTH.
    """
    n = len(doc)
    before = np.arange(-1, n - 1)
    reach = common.copy()
    open_ = np.flatnonzero(reach >= LENGTH)
    while len(open_ := open_[doc[before[open_]] >= doc[open_]]):
        over = before[open_]
        reach[open_], before[open_] = np.minimum(reach[open_], reach[over]), before[over]
        open_ = open_[reach[open_] >= LENGTH]
    return np.where(reach >= LENGTH, reach, 0)


def longest_previous_factor(buf: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, up to LENGTH: the longer common
    prefix with its previous and its next smaller position in suffix order,
    where an earlier document is a smaller position; 0 where it is shorter
    than LENGTH, as such matches need not lie in one bucket."""
    order, common = suffix_order(buf, at, doc)
    docs = doc[order]
    previous = smaller_neighbour(docs, common)
    # the next one is the previous one of the reversed order
    following = smaller_neighbour(docs[::-1], np.append(common[1:], 0)[::-1])[::-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum(previous, following)
    return out


def _unpack_stretches(data: bytes) -> tuple:
    ids, keys, step, high, low, count, offset, text = unpack("qiiibibb", data)
    step = step.astype(np.int64)
    local = np.cumsum(step)
    gap = (high.astype(np.int64) << 8) + low
    total = np.cumsum(gap)
    first = np.flatnonzero(np.concatenate([[True], step[1:] != 0]))
    # places count from the text's start: each run of a text starts anew
    before = (total - gap)[first]
    at = total - np.repeat(before, np.diff(np.append(first, len(gap))))
    return ids, keys, local, at, count.astype(np.int64), offset, text


def _pieces(buf: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The suffixes from `at` in pieces of about CHUNK, equal strings together."""
    if len(at) <= 2 * CHUNK:
        yield np.arange(len(at))
        return
    w = _words_at(buf)
    pieces = -(-len(at) // CHUNK)
    piece = np.empty(len(at), dtype=np.int32)
    for lo in range(0, len(at), CHUNK):
        here = at[lo:lo + CHUNK]
        key = np.zeros(len(here), dtype=U64)
        for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            key = mix(key * U64(0x9E3779B97F4A7C15) + w[here + k])
        piece[lo:lo + CHUNK] = key % U64(pieces)
    for p in range(pieces):
        yield np.flatnonzero(piece == p)


def _part_of_bucket(stretches: pa.ChunkedArray, part: int, parts: int) -> tuple[np.ndarray, ...]:
    """The stretches of a bucket whose least gram falls to this part of it:
    document, key, place, number of suffixes and place in the text of each,
    its gram as a number, and the text."""
    got: list[list[np.ndarray]] = [[] for _ in range(6)]
    for data in stretches:
        ids, keys, local, at, count, offset, text = _unpack_stretches(data.as_py())
        size = count + LENGTH - 1
        begin = np.cumsum(size) - size
        w = _words_at(text)
        anchor = mix(w[begin + offset] * U64(0x9E3779B97F4A7C15) + mix(w[begin + offset + 8]))
        if parts > 1:
            take = np.flatnonzero((anchor >> U64(32)) % U64(parts) == U64(part))
            local, at, count, anchor = local[take], at[take], count[take], anchor[take]
            text = gather(text, begin[take], size[take])
        for p, a in zip(got, (ids[local], keys[local], at, count, anchor, text)):
            p.append(a)
    # one after another, so that one field at a time is held twice
    got.reverse()
    ids, keys, at, count, anchor, text = (np.concatenate(got.pop()) for _ in range(6))
    return ids, keys, at, count, np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1), anchor, text


def _mark_part(ids, keys, at, count, begin, anchor, buf) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, key, start, end) of the repeats among the stretches of some grams."""
    if not len(ids):
        return
    order = np.argsort(anchor, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))
    who = ids[order]
    several = np.minimum.reduceat(who, edge) != np.maximum.reduceat(who, edge)
    size = np.diff(np.append(edge, len(order)))
    group = np.repeat(np.arange(len(edge)), size)[np.repeat(several, size)]
    order = order[np.repeat(several, size)]
    # whole groups at a time, about CHUNK suffixes together
    done = np.cumsum(count[order])
    last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, dtype=bool)
    stops = np.flatnonzero(last)
    cuts, total = [], 0
    for stop in stops:
        if done[stop] - total >= CHUNK:
            cuts.append(stop + 1)
            total = done[stop]
    for part in np.split(order, cuts):
        if not len(part):
            continue
        run = np.repeat(part, count[part])
        step = np.arange(len(run)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        for piece in _pieces(buf, begin[run] + step):
            r, k = run[piece], step[piece]
            hit = np.flatnonzero(longest_previous_factor(buf, begin[r] + k, ids[r]) >= LENGTH)
            r, k = r[hit], k[hit]
            # consecutive hits of a stretch are one mark
            new = np.ones(len(hit), dtype=bool)
            new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1] + 1)
            end = np.append(new[1:], True) if len(hit) else new
            yield ids[r[new]], keys[r[new]], at[r[new]] + k[new], at[r[end]] + k[end] + LENGTH


def _mark_bucket(table: pa.Table, blocks: int) -> pa.Table:
    """All rows of one bucket to marks: (block, marks).

    The stretches stay compressed and are read once for each part of the
    bucket, so that about PART_BYTES of them are open at a time.
    """
    out_block = [b for b in table.column("block").to_pylist() if b is not None]
    out_marks = [m for m in table.column("marks").to_pylist() if m is not None]
    stretches = table.column("stretches").drop_null()
    size = sum(zstandard.frame_content_size(data.as_buffer()) for data in stretches)
    parts = -(-size // PART_BYTES)
    found = [x for part in range(parts) for x in _mark_part(*_part_of_bucket(stretches, part, parts))]
    if found:
        ids, keys, a, b = (np.concatenate(x) for x in zip(*found))
        block = result_block(ids, keys, blocks)
        order = np.argsort(block, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            if len(part):
                out_block.append(int(block[part[0]]))
                out_marks.append(pack("qiii", ids[part], keys[part], a[part], b[part]))
    return pa.table({"block": pa.array(out_block, pa.int64()), "marks": pa.array(out_marks, pa.binary())})


def _squeeze(blocks: int):
    """Texts compressed for their one shuffle, with their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                block = result_block(part.column(0).fill_null(int(NO_ID)).to_numpy(), part.column(1).to_numpy(), blocks)
                texts = pa.array([press.compress(t or b"") for t in part.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(block), texts], names=["doc_id", "key", "block", "packed"]
                )

    return run


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)] if len(end) else end


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"


def _finish(with_text: bool):
    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        got = [unpack("qiii", m) for m in marks.column("marks").to_pylist()]
        spans: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        if got:
            ids, keys, a, b = (np.concatenate(x) for x in zip(*got))
            order = np.lexsort((keys, ids))
            ids, keys, a, b = ids[order], keys[order], a[order].astype(np.int64), b[order].astype(np.int64)
            edge = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])]))
            for x, y in zip(edge, [*edge[1:], len(ids)]):
                spans[int(ids[x]), int(keys[x])] = merged(a[x:y], b[x:y])
        expand = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        for doc_id, key, packed in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "key", "packed"))):
            text = expand.decompress(packed)
            none = np.zeros(0, dtype=np.int64)
            a, b = spans.get((int(NO_ID) if doc_id is None else doc_id, key), (none, none))
            kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)])) if len(a) else text
            rows.append((doc_id, len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), a, b,
                         *([kept] if with_text else [])))
        fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
        fields += [("kept", pa.binary())] if with_text else []
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(fields, columns)})

    return run


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Per row: byte counts, the removed spans, the hash of what is left and,
    with `with_text`, the remaining bytes (`kept`)."""
    total = text_bytes(docs)
    buckets, blocks = bucket_count(total, BUCKET_BYTES), bucket_count(total, BLOCK_BYTES)
    # the key tells apart different texts of rows that repeat a doc_id
    rows = base_docs(docs).select(
        "doc_id", F.pmod(F.xxhash64("text"), F.lit(1 << 32)).alias("key"), F.col("text").cast("binary").alias("text")
    )

    def mark(table: pa.Table) -> pa.Table:
        return _mark_bucket(table, blocks)

    marks = (
        rows.mapInArrow(_deal(buckets, blocks, hot_grams(rows, total)), "bucket long, stretches binary, block long, marks binary")
        .groupBy("bucket").applyInArrow(mark, "block long, marks binary")
    )
    texts = rows.mapInArrow(_squeeze(blocks), "doc_id long, key long, block long, packed binary")
    schema = RESULT + (", kept binary" if with_text else "")
    return texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_finish(with_text), schema)


def repeats_query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
