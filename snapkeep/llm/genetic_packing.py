"""Packing documents into few sequences by a grouping genetic algorithm.

The genes of a solution are its whole bins.  A crossover injects well-filled
bins of one parent into the other, removes the other's bins that hold one of
the injected pieces, and puts the displaced pieces back by best fit, longest
first; solutions are compared by their number of bins, then by how unevenly
they are filled (mean square of the filling), which favours full bins beside
nearly empty ones that a later crossover can dissolve.

The work is distributed as islands: pieces are dealt at random, about `ISLAND`
to each, and every island evolves solutions for its own pieces.  After an epoch the
bins that are full (within the epoch's slack) are settled, the elite among
them, the most frequent patterns of lengths that fill a bin exactly, migrates
to all islands of the next epoch, and the pieces of the other bins are dealt
anew to fewer islands.  A migrated pattern is a bin of any pieces with these
lengths, so an island takes it in whole wherever it has such pieces: one
starting solution is built from the elite, and crossovers inject its bins.
The last epoch settles everything.

Scale.  Islands are bounded whatever the input; their number follows it.  The
driver sees one count and `ELITE` patterns an epoch.  Pieces are dealt by their
place in the written table of pieces, so copies of one row do not meet.  Each
epoch's result is written to the shared checkpoint folder.

Token ids come from `packing.default_encoder` (see there).

Defined cases.  A null text is an empty one: its document is the end id
alone.  Rows with a null doc_id and repeated rows are packed like others, one
document each.  A document of more than `WINDOW` ids is cut from its end into
full pieces, so that only the first can be shorter.  An empty table gives an
empty table.  Equal solutions: the earlier one stays.  All random choices come
from the island's number, so a repeated task gives the same rows.  Other
columns are dropped at the start.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs, cut
from snapkeep.llm.packing import _encoder, default_encoder

WINDOW = 2048
END_ID = 0
#: Short pieces an island gets on average.
ISLAND = 1500
#: Free room up to which a bin counts as full, by epoch; the last settles all.
SLACK = (0, 2, WINDOW)
GENERATIONS = 12
POPULATION = 6
#: Patterns of exactly full bins that migrate between epochs.
ELITE = 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long, settled boolean, pattern string"

Bins = list[tuple[int, list[int]]]


def cut_pieces(docs: DataFrame, window: int = WINDOW, make_encoder=default_encoder) -> DataFrame:
    """Pieces of every document: the first may be short, the rest are full."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = _encoder(make_encoder)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special="all"), END_ID).astype("<u4")
                    first = (len(ids) - 1) % window + 1
                    for k, start in enumerate([0, *range(first, len(ids), window)]):
                        piece = ids[start:first if k == 0 else start + window]
                        rows.append((doc_id, k, start, len(piece), zlib.crc32(piece.tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return base_docs(docs).mapInArrow(run, PIECES)


def best_fit(bins: Bins, items: Iterable[int], lengths: list[int], window: int) -> Bins:
    """`bins` (filled length, items) with `items` added in their order, each
    where it leaves the least room; new bins where none has enough."""
    done = list(bins)
    rooms = sorted((window - fill, b) for b, (fill, _) in enumerate(done) if fill < window)
    for i in items:
        a = lengths[i]
        at = bisect_left(rooms, (a, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            fill, inside = done[b]
            done[b] = (fill + a, [*inside, i])
        else:
            room, b = window, len(done)
            done.append((a, [i]))
        if room > a:
            insort(rooms, (room - a, b))
    return done


def worth(bins: Bins) -> tuple[int, int]:
    """Fewer bins first, then the larger sum of squared fillings."""
    return len(bins), -sum(fill * fill for fill, _ in bins)


def crossover(injected: Bins, other: Bins, lengths: list[int], window: int) -> Bins:
    """`injected` whole bins, the bins of `other` free of their pieces, and the
    displaced pieces by best fit."""
    taken = {i for _, inside in injected for i in inside}
    kept, displaced = list(injected), []
    for fill, inside in other:
        if taken.isdisjoint(inside):
            kept.append((fill, inside))
        else:
            displaced += [i for i in inside if i not in taken]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(kept, displaced, lengths, window)


def elite_bins(elite: list[tuple[int, ...]], lengths: list[int], window: int) -> Bins:
    """Bins of the migrated patterns, as often as the island's pieces allow."""
    having: dict[int, list[int]] = {}
    for i, a in enumerate(lengths):
        having.setdefault(a, []).append(i)
    bins: Bins = []
    for pattern in elite:
        need = {a: pattern.count(a) for a in pattern}
        while all(len(having.get(a, ())) >= n for a, n in need.items()):
            bins.append((sum(pattern), [having[a].pop() for a in pattern]))
    return bins


def evolve(lengths: list[int], elite: list[tuple[int, ...]], seed: int, window: int = WINDOW,
           generations: int = GENERATIONS, population: int = POPULATION, last: bool = True) -> Bins:
    """The best solution of one island.

    In the last epoch the search ends at the least possible number of bins;
    before it, fuller bins are still worth having at that number.
    """
    rnd = random.Random(seed)
    least = -(-sum(lengths) // window)
    longest_first = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = [best_fit([], longest_first, lengths, window)]
    if migrated := elite_bins(elite, lengths, window):
        people.append(crossover(migrated, people[0], lengths, window))
    while len(people) < population:
        blurred = [a * rnd.uniform(0.8, 1.25) for a in lengths]
        people.append(best_fit([], sorted(range(len(lengths)), key=lambda i: -blurred[i]), lengths, window))
    people.sort(key=worth)
    for _ in range(generations):
        if last and len(people[0]) == least:
            break
        for _ in range(population // 2):
            a, b = rnd.sample(people, 2)
            full = [g for g in a if g[0] >= window - 2] or a[:1]
            injected = rnd.sample(full, max(1, len(full) * rnd.randint(30, 90) // 100))
            child = crossover(injected, b, lengths, window)
            people.append(child)
        people.sort(key=worth)
        del people[population:]
    return people[0]


def pack_island(rows: list[tuple], epoch: int, island: int, elite: list[tuple[int, ...]], window: int, slack: int,
                last: bool) -> list[tuple]:
    """`rows` (of PIECES) with sequence, offset, whether settled, and the
    pattern of an exactly full bin on its first piece."""
    lengths = [r[3] for r in rows]
    out = []
    for b, (fill, inside) in enumerate(evolve(lengths, elite, epoch << 32 | island, window, last=last)):
        settled = last or window - fill <= slack
        pattern = ",".join(map(str, sorted((lengths[i] for i in inside), reverse=True))) if fill == window else None
        offset = 0
        for i in inside:
            out.append((*rows[i], (epoch << 44 | island) << 16 | b, offset, settled, pattern))
            offset, pattern = offset + lengths[i], None
    return out


_PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("settled", pa.bool_()), ("pattern", pa.string())])


def run_islands(pieces: DataFrame, epoch: int, elite: list[tuple[int, ...]], window: int, slack: int, last: bool,
                size: int = ISLAND) -> DataFrame:
    """One epoch over a written table of pieces, dealt by their place in it.

    The place (file and row) is the same whenever the table is read, and
    independent of the rows, so equal rows are spread like others.
    """
    islands = max(1, -(-pieces.count() // size))
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"), F.lit(epoch))
    dealt = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", F.pmod(place, F.lit(islands)).alias("island"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        columns = [table.column(i).to_pylist() for i in range(5)]
        # the order in which rows arrive may differ between attempts
        rows = sorted(zip(*columns), key=lambda r: tuple((v is not None, v or 0) for v in r))
        out = pack_island(rows, epoch, key[0].as_py(), elite, window, slack, last)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PLACED.types)], schema=_PLACED)

    return dealt.groupBy("island").applyInArrow(run, PLACED)


def migrating(placed: DataFrame, elite: int = ELITE) -> list[tuple[int, ...]]:
    """The most frequent patterns of the epoch's exactly full bins (at most `elite` rows)."""
    rows = (
        placed.where(F.col("pattern").isNotNull()).groupBy("pattern").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "pattern").limit(elite).collect()
    )
    return [tuple(map(int, r["pattern"].split(","))) for r in rows]


def pack_documents(docs: DataFrame, window: int = WINDOW, make_encoder=default_encoder, slack: tuple[int, ...] = SLACK,
                   size: int = ISLAND) -> DataFrame:
    """One row per piece with its sequence and offset."""
    pieces = cut(cut_pieces(docs, window, make_encoder), "genetic-pieces")
    # a full piece is a sequence: numbered below zero by its place in the table
    whole = pieces.where(F.col("length") == window).select(
        *pieces.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts, rest, elite = [whole], pieces.where(F.col("length") < window), []
    for epoch, room in enumerate(slack):
        last = epoch == len(slack) - 1
        placed = cut(run_islands(rest, epoch, elite, window, room, last, size), f"genetic-epoch-{epoch}")
        parts.append(placed.where("settled").select(whole.columns))
        if not last:
            elite = migrating(placed)
            rest = placed.where("NOT settled")
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
