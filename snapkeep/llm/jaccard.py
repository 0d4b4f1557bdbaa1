"""N-gram Jaccard join over sets of 5-word shingles, exact at 0.8.

Documents with equal sets form one class; classes are joined.

1. Every set is ordered by a global rule (frequent shingles last, then by
   hash); two sets of similarity 0.8 share at least l shingles among the first
   n - ceil(0.8 n) + l of each, for every l.  With l = 1 + n // 32 only classes
   sharing that many meet; l of the smaller set holds for the pair.
2. Classes sharing a shingle form a tile, sorted by set size; within a tile
   only sizes within the ratio 0.8 are compared (size bands).
3. Each set has a bitmap signature of four to eight bits per shingle, every
   shingle flipping one hashed bit.  Bits that differ bound the symmetric
   difference from below, so the overlap from above; pairs that cannot reach
   0.8 are dropped.
4. Surviving pairs are decided by intersecting the sorted shingle arrays.

Hot shingles.  Shingles of very many documents come last in the order, so
they are used only by sets made of little else (large groups of near copies).
Their tiles never meet in one task: neighbours by size are compared first,
their links give components, and only members of *different* components are
compared after that, in blocks of a bounded size, every block pair a task's
group of its own; the blocks of a shingle's largest component meet those of
the other components, not each other.  No pair between different texts is
lost for the components; pairs inside one component are not expanded.

Defined cases: null or empty texts have no set, link with nothing and are
their own component; a row with a null doc_id gets the least id of its
component, or null; repeated rows share a class; an empty table gives an
empty result; other columns are ignored; texts of any length count whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapkeep.functions.naming import quote
from snapkeep.llm.components import connected_components
from snapkeep.llm.frames import base_docs, bucket_count, cut, text_bytes
from snapkeep.llm.wordhash import U64, Words, mix, shingles, slices

SHINGLE = 5
#: Similarity as a fraction of 100.
PERCENT = 80
#: A tile of more classes than this goes to the path for hot shingles.
HOT_DF = 256
#: Shingles seen in more documents than this, counted over those that a chunk
#: of a task saw at least LOCAL_DF times, come last in the order.  The list
#: steers the order only (any order gives the same result) and is bounded:
#: the most frequent MAX_HOT.
LIST_DF = 64
LOCAL_DF = 3
MAX_HOT = 200_000
#: Rows of a block when classes sharing a hot shingle are compared.
BLOCK = 2048
#: Text bytes behind one bucket of shingle postings.
BUCKET_BYTES = 8 << 20

FEATURES = "doc_id long, text_key long, n long, key long, rare array<long>, hot array<long>, bitmap binary"
_FEATURE_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("rare", pa.list_(pa.int64())),
    ("hot", pa.list_(pa.int64())), ("bitmap", pa.binary()),
])


def needed_overlap(total: np.ndarray) -> np.ndarray:
    """Least overlap of two sets of `total` elements together for the threshold."""
    return -(-PERCENT * total // (100 + PERCENT))


def least_shared(n):
    """How many shingles of the prefix a set of n must share with a match."""
    return 1 + n // 32


def prefix_length(n: int) -> int:
    return min(n, n - -(-PERCENT * n // 100) + least_shared(n))


def bitmap_words(n: int) -> int:
    """64-bit words of the bitmap of a set of n: a power of two, 4 or more."""
    words = 4
    while words * 64 < 4 * n:
        words *= 2
    return words


def bitmap(values: np.ndarray) -> bytes:
    bits = bitmap_words(len(values)) * 64
    flips = np.bincount((mix(values) % U64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def fold(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of words) folded to a shorter length, as a shorter bitmap would be."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def doc_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi in slices(texts):
        h, owner = shingles(Words(texts[lo:hi]), SHINGLE)
        edge = np.searchsorted(owner, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield np.unique(h[edge[i]:edge[i + 1]])


def set_key(values: np.ndarray) -> int:
    """64-bit identity of a set."""
    h = mix(values + U64(0xA24BAED4963EE407)).sum(dtype=U64) ^ mix(np.array([len(values)], dtype=U64))[0]
    return int(np.array([h], dtype=U64).view(np.int64)[0])


def _encoded(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def hot_shingles(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles (sorted hashes), at most MAX_HOT.

    Tasks count all shingles of their documents in chunks and send those seen
    LOCAL_DF times or more; the sums decide.
    """

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n >= LOCAL_DF
        return pa.RecordBatch.from_arrays(
            [pa.array(values[often].view(np.int64)), pa.array(n[often])], names=["token", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for s in doc_sets(_encoded(batch.column(0))):
                parts.append(s)
                size += len(s)
                if size > 4_000_000:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    rows = (
        docs.select("text").mapInArrow(run, "token long, n long")
        .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > LIST_DF)
        .orderBy(F.desc("n"), "token").limit(MAX_HOT).select("token").collect()
    )
    return np.sort(np.array([r["token"] for r in rows], dtype=np.int64).view(U64))


def features(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """Per row of (doc_id, text, text_key): set size, class key, prefix shingles, bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                n, key, rare, often, maps = [], [], [], [], []
                for s in doc_sets(_encoded(part.column(1))):
                    n.append(len(s))
                    if not len(s):
                        key.append(None), rare.append([]), often.append([]), maps.append(b"")
                        continue
                    take = prefix_length(len(s))
                    is_hot = np.zeros(len(s), dtype=bool)
                    if len(hot):
                        i = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                        is_hot = hot[i] == s
                    first = s[~is_hot][:take]
                    key.append(set_key(s))
                    rare.append(first.view(np.int64))
                    often.append(s[is_hot][:take - len(first)].view(np.int64))
                    maps.append(bitmap(s))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *(pa.array(c, f.type) for c, f in zip((n, key, rare, often, maps),
                                                                                           list(_FEATURE_SCHEMA)[2:]))],
                    schema=_FEATURE_SCHEMA,
                )

    return docs.mapInArrow(run, FEATURES)


def _pack_postings(buckets: int):
    """Rows (bucket, tokens, owners, keys, sizes) holding a batch's postings by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            size = batch.column(1).to_numpy()
            lists = batch.column(2)
            values = lists.flatten().to_numpy().view(U64)
            owner = np.repeat(np.arange(len(key)), lists.value_lengths().to_numpy())
            # equal sets within the batch are one class already
            once = np.zeros(len(key), dtype=bool)
            once[np.unique(key, return_index=True)[1]] = True
            keep = once[owner]
            values, owner = values[keep], owner[keep]
            bucket = (mix(values) % U64(buckets)).astype(np.int64)
            order = np.lexsort((values, bucket))
            values, owner, bucket = values[order], owner[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = []
            for a, b in zip(starts, [*starts[1:], len(bucket)]):
                own, place = np.unique(owner[a:b], return_inverse=True)
                rows.append((int(bucket[a]), values[a:b].tobytes(), place.astype("<u4").tobytes(),
                             key[own].tobytes(), size[own].astype("<u4").tobytes()))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["bucket", "tokens", "owners", "keys", "sizes"],
            )

    return run


def _group_pairs(token: np.ndarray, key: np.ndarray, size: np.ndarray):
    """Pairs of classes sharing a token within the size band, as (a, b, shared
    tokens needed, shared tokens here), and the postings of tokens shared by
    more than HOT_DF classes."""
    order = np.lexsort((key, size, token))
    token, key, size = token[order], key[order], size[order]
    fresh = np.ones(len(token), dtype=bool)
    fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    token, key, size = token[fresh], key[fresh], size[fresh]
    start = np.flatnonzero(np.diff(token, prepend=token[:1] ^ U64(1))) if len(token) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(start, len(token)))
    large = np.repeat(count > HOT_DF, count)
    group = np.repeat(np.arange(len(start)), count)
    found = []
    small = np.flatnonzero(~large)
    # all pairs at distance d of the sorted order, until no group is that long
    for d in range(1, HOT_DF):
        i = small[small + d < len(token)]
        j = i + d
        ok = (group[i] == group[j]) & (100 * size[i] >= PERCENT * size[j])
        if not ok.any():
            break
        i, j = i[ok], j[ok]
        small = i
        a, b = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
        found.append(np.stack([a, b, least_shared(size[i])], axis=1))
    pairs, shared = np.unique(np.concatenate(found), axis=0, return_counts=True) if found else (
        np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64))
    return np.column_stack([pairs, shared]), token[large], key[large], size[large]


def _bucket_pairs(table: pa.Table) -> pa.Table:
    token, key, size = [], [], []
    for t, o, k, s in zip(*(table.column(c).to_pylist() for c in ("tokens", "owners", "keys", "sizes"))):
        owner = np.frombuffer(o, dtype="<u4")
        token.append(np.frombuffer(t, dtype=U64))
        key.append(np.frombuffer(k, dtype=np.int64)[owner])
        size.append(np.frombuffer(s, dtype="<u4").astype(np.int64)[owner])
    pairs, t, k, s = _group_pairs(np.concatenate(token), np.concatenate(key), np.concatenate(size))
    none = pa.nulls(len(pairs), pa.int64())
    return pa.table({
        "a": pa.concat_arrays([pa.array(pairs[:, 0]), pa.array(k)]),
        "b": pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(t), pa.int64())]),
        "token": pa.concat_arrays([none, pa.array(t.view(np.int64))]),
        "n": pa.concat_arrays([pa.array(pairs[:, 2]), pa.array(s)]),
        "shared": pa.concat_arrays([pa.array(pairs[:, 3]), pa.nulls(len(t), pa.int64())]),
    })


def bound_pairs(na: np.ndarray, nb: np.ndarray, maps_a: list[bytes], maps_b: list[bytes]) -> np.ndarray:
    """Which pairs may reach the threshold, by size and bitmap bounds."""
    out = np.zeros(len(na), dtype=bool)
    wa = np.array([len(m) // 8 for m in maps_a], dtype=np.int64)
    wb = np.array([len(m) // 8 for m in maps_b], dtype=np.int64)
    total = na + nb
    need = needed_overlap(total)
    near = (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))
    for x, y in {(int(p), int(q)) for p, q in zip(wa[near], wb[near])}:
        at = np.flatnonzero(near & (wa == x) & (wb == y))
        for part in np.array_split(at, -(-len(at) * max(x, y) // (1 << 20))):
            a = np.frombuffer(b"".join(maps_a[i] for i in part), dtype=U64).reshape(-1, x)
            b = np.frombuffer(b"".join(maps_b[i] for i in part), dtype=U64).reshape(-1, y)
            differ = np.bitwise_count(fold(a, min(x, y)) ^ fold(b, min(x, y))).sum(axis=1, dtype=np.int64)
            out[part] = (total[part] - differ) // 2 >= need[part]
    return out


def _bound_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, map_a, map_b) to the pairs (a, b) that may link."""
    for batch in batches:
        ok = bound_pairs(batch.column(2).to_numpy(), batch.column(3).to_numpy(),
                         batch.column(4).to_pylist(), batch.column(5).to_pylist())
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that the sizes and bitmaps of `classes` leave possible."""
    a = classes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("map_a"))
    b = classes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("map_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "map_a", "map_b")
    return both.mapInArrow(_bound_batches, "a long, b long")


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sorted shingle arrays reach the threshold, as edges (u, v)."""
    a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_link_batches, "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _compress_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            texts = [squeeze.compress(t) for t in _encoded(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=["doc_id", "packed"])


def _keyed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to the distinct (key, shingles) of a part of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            sets = {set_key(s): s.tobytes() for s in doc_sets(_encoded(batch.column(0).slice(at, 1000))) if len(s)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.keys(), pa.int64()), pa.array(sets.values(), pa.binary())], names=["key", "shingles"]
            )


def class_sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Shingle arrays of the classes `keys(key, doc_id)`, from one document each.

    Texts travel compressed, as this join moves all of them.  Classes of rows
    without doc_id only are taken from those rows.
    """
    packed = docs.where("doc_id is not null").mapInArrow(_compress_batches, "doc_id long, packed binary")
    some = packed.join(keys, "doc_id").select("key", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [expand.decompress(z) for z in part.column(1).to_pylist()]
                pairs = zip(part.column(0).to_pylist(), doc_sets(texts))
                rows = [(k, s.tobytes()) for k, s in pairs if set_key(s) == k]
                columns = list(zip(*rows)) or [(), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["key", "shingles"]
                )

    no_id = docs.where("doc_id is null").select("text").mapInArrow(_keyed_batches, "key long, shingles binary")
    no_id = no_id.join(keys.where("doc_id is null").select("key"), "key", "left_semi")
    return some.mapInArrow(run, "key long, shingles binary").unionByName(no_id).dropDuplicates(["key"])


def _neighbour_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (token, n, key): pairs of neighbours sharing the token."""
    last: tuple | None = None
    for batch in batches:
        token, n, key = (batch.column(i).to_numpy() for i in range(3))
        if last is not None:
            token, n, key = (np.append([x], y) for x, y in zip(last, (token, n, key)))
        if not len(token):
            continue
        last = (token[-1], n[-1], key[-1])
        ok = (token[1:] == token[:-1]) & (key[1:] != key[:-1]) & (100 * n[:-1] >= PERCENT * n[1:])
        pairs = np.stack([np.minimum(key[1:], key[:-1]), np.maximum(key[1:], key[:-1])], axis=1)[ok]
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _block_pairs(table: pa.Table) -> pa.Table:
    """One pair of blocks: bitmap survivors of different components, of each
    row the `nearest` ones only, where that is given.

    Rows are ordered by size within each side and compared row by row with
    the run of the other side inside the size band.
    """
    nearest = table.column("nearest")[0].as_py()
    side = table.column("side").to_numpy()
    key, n, root = (table.column(c).to_numpy() for c in ("key", "n", "root"))
    maps = table.column("bitmap").to_pylist()
    words = min(len(m) // 8 for m in maps)
    rows = np.concatenate([fold(np.frombuffer(m, dtype=U64).reshape(1, -1), words) for m in maps])
    order = np.argsort(n, kind="stable")
    same = int(table.column("i")[0].as_py()) == int(table.column("j")[0].as_py())
    left, right = order[side[order] == 0], order if same else order[side[order] == 1]
    if same:
        left = right = order
    sizes = n[right]
    found = []
    for p, x in enumerate(left):
        lo = np.searchsorted(sizes, -(-PERCENT * n[x] // 100))
        hi = np.searchsorted(sizes, 100 * n[x] // PERCENT, side="right")
        y = right[max(lo, p + 1) if same else lo:hi]
        y = y[root[y] != root[x]]
        if len(y):
            total = n[x] + n[y]
            differ = np.bitwise_count(rows[y] ^ rows[x]).sum(axis=1, dtype=np.int64)
            ok = (total - differ) // 2 >= needed_overlap(total)
            y = y[ok]
            if nearest and len(y) > nearest:
                y = y[np.argsort(differ[ok], kind="stable")[:nearest]]
            found += [(min(key[x], k), max(key[x], k)) for k in key[y]]
    pairs = np.unique(np.array(found, dtype=np.int64).reshape(-1, 2), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def hot_cross_pairs(hot: DataFrame, roots: DataFrame, classes: DataFrame, nearest: int = 0) -> DataFrame:
    """Possible pairs sharing a hot shingle whose components still differ.

    With `nearest`, only so many for each row, through an eighth of the
    shingles: enough to join most components before the full comparison.
    """
    if nearest:
        hot = hot.where("pmod(xxhash64(token), 8) = 0")
    rows = hot.join(roots, F.col("key") == F.col("node"), "left").select(
        "token", "key", "n", F.coalesce("root", "key").alias("root")
    )
    # shingles whose classes are all in one component are done; of the others the
    # largest component's rows need no comparison among themselves
    sizes = rows.groupBy("token", "root").agg(F.count("*").alias("m"))
    open_ = sizes.groupBy("token").agg(
        F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("m"), F.count("*").alias("roots")
    ).where("roots > 1").select(
        "token", F.col("top.root").alias("top"),
        F.ceil((F.col("m") - F.col("top.m")) / BLOCK).cast("long").alias("others"),
        F.ceil(F.col("top.m") / BLOCK).cast("long").alias("tops"),
    )
    # blocks of other rows come first, then those of the largest component
    in_top = F.col("root") == F.col("top")
    rows = rows.join(open_, "token").withColumn(
        "block", F.when(in_top, F.col("others") + F.pmod(F.xxhash64("key"), F.col("tops")))
        .otherwise(F.pmod(F.xxhash64("key"), F.col("others")))
    ).withColumn("partners", F.when(in_top, F.col("others")).otherwise(F.col("others") + F.col("tops")))
    # every row goes to the block pairs it belongs to, on the side it takes there
    spread = rows.select("token", "key", "n", "root", "block", F.explode(F.expr("sequence(0L, partners - 1)")).alias("other"))
    spread = spread.select(
        "token", "key", "n", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
    ).join(classes.select("key", "bitmap"), "key").withColumn("nearest", F.lit(nearest))
    return spread.groupBy("token", "i", "j").applyInArrow(_block_pairs, "a long, b long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`."""
    return components_by_text(docs).drop("text_key")


def components_by_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) for every row of `docs`;
    `text_key` tells apart the texts of rows that repeat a doc_id."""
    docs = base_docs(docs)
    hot = hot_shingles(docs)
    feats = cut(features(docs.withColumn("text_key", F.xxhash64("text")), hot), "jaccard-features")
    buckets = bucket_count(text_bytes(docs), BUCKET_BYTES)
    real = feats.where("n > 0")
    # one row for each class: its size, bitmap and a document that has it
    classes = cut(
        real.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")),
        "jaccard-classes",
    )
    shared = cut(
        real.select("key", "n", "rare").mapInArrow(
            _pack_postings(buckets), "bucket long, tokens binary, owners binary, keys binary, sizes binary"
        ).groupBy("bucket").applyInArrow(_bucket_pairs, "a long, b long, token long, n long, shared long"),
        "jaccard-shared",
    )
    hot_rows = cut(
        real.select(F.explode("hot").alias("token"), "key", "n").unionByName(
            shared.where("b is null").select("token", F.col("a").alias("key"), "n")
        ).distinct(),
        "jaccard-hot",
    )
    near = (
        hot_rows.select("token", "n", "key").repartitionByRange("token", "n", "key").sortWithinPartitions("token", "n", "key")
        .mapInArrow(_neighbour_batches, "a long, b long")
    )
    # a pair that also shares hot shingles may fall short here and is found by those
    met = shared.where("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("n").alias("need"))
    pairs = met.where("shared >= need").select("a", "b").unionByName(near).distinct()
    pairs = cut(bounded(pairs, classes), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).unionByName(
        hot_rows.select("key")
    ).distinct()
    sets = cut(class_sets(docs, classes.join(wanted, "key", "left_semi").select("key", "doc_id")), "jaccard-sets")
    edges = cut(linked(pairs, sets), "jaccard-links")
    roots = cut(connected_components(edges), "jaccard-roots")
    # near links first, so that few components are left for the full comparison
    for nearest in (4, 0):
        more = cut(linked(hot_cross_pairs(hot_rows, roots, classes, nearest), sets), "jaccard-links")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            roots = cut(connected_components(edges), "jaccard-roots")
    rows = feats.select("doc_id", "text_key", "n", "key").join(roots, F.col("key") == F.col("node"), "left")
    rows = rows.select("doc_id", "text_key", "n", "key", F.coalesce("root", "key").alias("root"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each component (its least doc_id), all columns unchanged.

    Rows that repeat a doc_id with different texts are judged one by one: a
    text goes if it is not in its component under the least doc_id.  Rows
    without doc_id all stay.  Of rows with one doc_id and one text, or one text
    and no doc_id, one is kept; they may differ in other columns, and the least
    in those that can be ordered is taken, whatever order they are read in.
    """
    names = docs.columns
    gone_id, gone_key, text_key = (_free_name(n, names) for n in ("gone_id", "gone_key", "text_key"))
    gone = components_by_text(docs).where("doc_id <> component_id").select(
        F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)
    ).distinct()
    keyed = docs.withColumn(text_key, F.xxhash64(F.col("text").cast("string")))
    left = keyed.join(
        gone, (F.col("doc_id").cast("long") == F.col(gone_id)) & (F.col(text_key) == F.col(gone_key)), "left_anti"
    )
    others = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text") and not isinstance(f.dataType, T.MapType)]
    row = F.struct(*[F.col(quote(n)) for n in names])
    least = F.min_by(row, F.struct(*[F.col(quote(n)) for n in others])) if others else F.first(row)
    one = left.groupBy("doc_id", text_key).agg(least.alias("row"))
    return one.select(*[F.col("row").getField(n).alias(n) for n in names])


def _free_name(name: str, taken: list[str]) -> str:
    """`name`, lengthened until no column is called so."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
