"""Packing token pieces into fixed windows by non-negative least squares.

Documents are tokenised once and cut into full windows and one shorter rest;
the length histogram of the pieces (at most `window` numbers, whatever the
corpus size) is all the driver sees.  Shallow combinations of lengths that
fill a window are enumerated, non-negative least squares finds how often to
repeat each so that together they use up the histogram, the counts are
rounded to whole numbers that fit, and a greedy best fit packs what is left.
The result is a list of patterns with repeat counts; each piece finds its
place from its length and its rank among the pieces of that length, so the
assignment is a join of ranks with a bounded table, not a pass of one task.

Defined cases: a null text is an empty one, whose document is the end id
alone; a null doc_id keeps its pieces; repeated rows are packed once each;
an empty table gives an empty table; texts of any length are cut.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs, cut

WINDOW = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k"
#: Partner lengths tried in combinations of three and four: the most frequent.
PARTNERS = 12
MAX_ITERATIONS = 150

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_encoder(ranks_path: str, pattern: str, special: dict[str, int]):
    """An encoder of a byte-level vocabulary given as merge ranks."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class TwoFileEncoder:
    """The rank file's encoder, and the JSON file's tokenizer for texts that it refuses.

    The rank file's pattern matcher has a bounded stack and raises on runs of
    about a million white-space characters; the JSON file's tokenizer
    takes any text and gives the same ids, several times slower.
    """

    def __init__(self, fast, json_path: str):
        self.fast, self.json_path, self.slow = fast, json_path, None

    def encode_to_numpy(self, text: str, allowed_special="all") -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special=allowed_special)
        except ValueError:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.json_path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def default_encoder():
    """Ids of the vocabulary `byte_bpe_50k`.

    They come from its rank file, which holds the same vocabulary as the JSON
    file and gives the same ids several times faster (tested on both); the
    special string keeps its id, as it does with the JSON file.  A text that
    the rank file's encoder cannot take goes through the JSON file.
    """
    import public_tokenizers

    fast = load_encoder(vocabulary_path(f"{TOKENIZER}.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    return TwoFileEncoder(fast, vocabulary_path(f"{TOKENIZER}.json"))


_encoders: dict = {}


def _encoder(make):
    key = make.__module__ + make.__qualname__
    if key not in _encoders:
        _encoders[key] = make()
    return _encoders[key]


def cut_pieces(docs: DataFrame, window: int = WINDOW, make_encoder=default_encoder) -> DataFrame:
    """Pieces of every document: full windows, then the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = _encoder(make_encoder)
        schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encoder.encode_to_numpy(text or "", allowed_special="all"), END_ID).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return base_docs(docs).mapInArrow(run, PIECES)


def combinations(counts: np.ndarray, window: int, partners: int = PARTNERS) -> np.ndarray:
    """Rows of up to four lengths (0: none) that fill the window exactly.

    All pairs of present lengths; triples and quadruples with one or two of
    the most frequent lengths.  Their number grows with the window only.
    """
    present = np.flatnonzero(counts)
    present = present[(present > 0) & (present < window)]
    frequent = present[np.argsort(-counts[present], kind="stable")][:partners]
    have = np.zeros(2 * window + 1, dtype=bool)
    have[present] = True
    out = []

    def add(*parts: np.ndarray) -> None:
        rest = window - sum(parts)
        last = np.where(rest > 0, rest, 2 * window)
        ok = have[last]
        rows = np.zeros((int(ok.sum()), 4), dtype=np.int64)
        for i, p in enumerate((*parts, rest)):
            rows[:, i] = np.broadcast_to(p, ok.shape)[ok]
        out.append(np.sort(rows, axis=1)[:, ::-1])

    add(present)
    for i, a in enumerate(frequent):
        add(present, np.full_like(present, a))
        for b in frequent[i:]:
            add(present, np.full_like(present, a), np.full_like(present, b))
    return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 4), dtype=np.int64)


def non_negative_least_squares(columns: np.ndarray, target: np.ndarray, iterations: int = MAX_ITERATIONS) -> np.ndarray:
    """min |A x - target| over x >= 0, A given by the lengths in each column.

    Accelerated projected gradient; A is never built, products are sums over
    the at most four entries of a column.
    """
    n = len(columns)
    if not n:
        return np.zeros(0)
    used = (columns > 0).astype(float)
    width = len(target)
    flat = columns.ravel()

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, weights=(used * x[:, None]).ravel(), minlength=width)

    def backward(r: np.ndarray) -> np.ndarray:
        return (r[columns] * used).sum(axis=1)

    v = np.ones(n)
    for _ in range(30):  # largest eigenvalue, for the step
        v = backward(forward(v))
        v /= max(np.linalg.norm(v), 1e-300)
    step = 1 / max(np.linalg.norm(backward(forward(v))) * 1.05, 1e-300)
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(iterations):
        nxt = np.maximum(0, y - step * backward(forward(y) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def round_counts(columns: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts near `x` that the remaining pieces allow; uses up `left`."""
    plan = []
    for j in np.argsort(-x, kind="stable"):
        want = int(round(x[j]))
        if want < 1:
            break
        lengths, need = np.unique(columns[j][columns[j] > 0], return_counts=True)
        n = min(want, int((left[lengths] // need).min()))
        if n > 0:
            left[lengths] -= n * need
            plan.append((tuple(int(v) for v in columns[j] if v > 0), n))
    return plan


def pack_rest(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the counts: the longest piece, then the longest
    that still fits, repeated while all its lengths last."""
    plan = []
    while (present := np.flatnonzero(left)).size:
        room, pattern = window, []
        taken = np.zeros_like(left)
        while room > 0:
            fits = present[(present <= room) & (left[present] > taken[present])]
            if not fits.size:
                break
            a = int(fits[-1])
            n = int(min(left[a] - taken[a], room // a)) if a * 2 <= room else 1
            pattern += [a] * n
            taken[a] += n
            room -= a * n
        used = np.flatnonzero(taken)
        n = int((left[used] // taken[used]).min())
        left[used] -= n * taken[used]
        plan.append((tuple(pattern), n))
    return plan


def make_plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths (each at most `window` in sum) with repeat counts
    that use every piece of the histogram `counts` exactly once."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan = []
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    columns = combinations(left, window)
    # repeated: each pass solves again for what rounding down has left
    for _ in range(2):
        if not len(columns) or not left.any():
            break
        got = round_counts(columns, non_negative_least_squares(columns, left.astype(float)), left)
        if not got:
            break
        plan += got
        columns = combinations(left, window)
    return plan + pack_rest(left, window)


def places(plan: list[tuple[tuple[int, ...], int]], window: int = WINDOW) -> list[np.ndarray]:
    """Per length: rows (first rank, first sequence, offset), sorted by rank."""
    nxt = np.zeros(window + 1, dtype=np.int64)
    rows: list[list] = [[] for _ in range(window + 1)]
    sequence = 0
    for pattern, n in plan:
        offset = 0
        for a in pattern:
            rows[a].append((nxt[a], sequence, offset))
            nxt[a] += n
            offset += a
        sequence += n
    return [np.array(r, dtype=np.int64).reshape(-1, 3) for r in rows]


def pack_documents(docs: DataFrame, window: int = WINDOW, make_encoder=default_encoder) -> DataFrame:
    """One row per piece with its sequence and offset.

    The pieces (five numbers each) are written once and read for the
    histogram and for the ranks.  A rank is the piece's row number within its
    length and a hash bucket, plus the number of pieces of that length in
    earlier buckets, so a length that a third of all pieces share is ranked
    by as many tasks as there are buckets.
    """
    spark = docs.sparkSession
    pieces = cut(cut_pieces(docs, window, make_encoder), "pieces")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `window` rows
        histogram[r["length"]] = r["n"]
    table = places(make_plan(histogram, window), window)
    # earlier buckets' counts: at most `window` x `buckets` rows, one length at a time
    before = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("rn", F.row_number().over(order))
        .join(before, ["length", "bucket"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rn") - 1).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(2).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for a in np.unique(length):
                at = np.flatnonzero(length == a)
                row = table[a][np.searchsorted(table[a][:, 0], rank[at], side="right") - 1]
                sequence[at] = row[:, 1] + rank[at] - row[:, 0]
                offset[at] = row[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
