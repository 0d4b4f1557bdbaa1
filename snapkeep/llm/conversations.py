"""Repair of conversation structure by Knuth's lightest-derivation agenda.

A conversation's rows are edited until their role initials spell
`(s?(ua)+)?`.  Items `(row, state)` mean "the rows before `row` are edited
and what is left drives the pattern's automaton into `state`"; a deduction
takes such an item and the axiom of one row to the next item by keeping,
re-roling or deleting the row, or an item to another by an insertion.  Its
function adds a cost and appends a letter to the audit string, so on weights
`(cost, audit)`, compared in that order, it is monotone and never yields less
than its argument (superior).  Knuth's generalisation of Dijkstra's algorithm
therefore holds: the agenda pops the least weight, a popped item is final, and
the search ends when the goal item is popped.  The least audit among the
cheapest edits is found by the same comparison, not by a second search.

Scale.  Rows are dealt by conversation and sorted inside their task; copies
are marked by a row number in the same partitioning, so the table is shuffled
once.  A task streams its rows: it holds `BLOCK` rows of one conversation and,
at a block's end, the at most four final items there, each with its audit
(what the four share is stored once) and a running SHA-256.  So memory does
not grow with a conversation's texts, however many rows it has.  The digest
of one conversation is defined over its texts in order and SHA-256 cannot be
split, so a conversation is read by one task; Spark's sort spills.  The audit
itself, one letter a row, is a value of the result.

Defined cases.  A null role or text is one space (so a null text is blank);
in the key that picks the damage a null `conv_id` or `turn` is one space too;
all rows with a null `conv_id` are one conversation.  Rows of equal turn are
taken in order of role, then text (bytes).  An empty role has no initial: it
can only be deleted or re-roled, and both its pairs are illegal.  A
conversation left without rows has zeros, an empty audit and the digest of
the empty string.  An empty table gives an empty table.  Other columns are
dropped at the start, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows whose texts a task holds at once.
BLOCK = 256
#: Rows of one Arrow batch looked at together.
SLICE = 2048

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States of the pattern's automaton, by the last initial read.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
ACCEPTING = (START, ASSISTANT)
#: The one of user / assistant that may follow each state.
FOLLOWS = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

WORD = re.compile(r"[^\x20\x09-\x0D]")

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, n_rows long")


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: columns conv_id, turn, role, text, gone, twice.

    Dropped rows stay as `gone` rows without text, so that a conversation
    losing all its rows is still known.
    """
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.coalesce(conversations["role"].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(conversations["text"].cast("string"), F.lit(" ")).alias("text"),
    )
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key.cast("binary")) % 20
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).when(F.col("kind") == 0, F.lit("")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        (F.col("kind") == 3).alias("twice"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted, with `again` on later copies.

    The window's partitioning is met by the one on `conv_id`, so this is one
    shuffle; its groups spill.  The digest stands for role and text: a fixed
    256-bit key instead of a second copy of the text in the sort.
    """
    digest = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    copies = Window.partitionBy("conv_id", "gone", "digest").orderBy(F.col("turn").asc_nulls_first())
    return (
        rows.withColumn("digest", digest)
        .repartition("conv_id")
        .withColumn("again", (F.row_number().over(copies) > 1) & ~F.col("gone"))
        .select("conv_id", "turn", "role", "text", "gone", "twice", "again")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    )


class Item:
    """A final item: its weight and the deduction that gave it."""

    __slots__ = ("cost", "audit", "back", "letter", "sha")

    def __init__(self, cost: int, audit: str, back: tuple[int, int] | None, letter: str, sha=None):
        self.cost, self.audit, self.back, self.letter, self.sha = cost, audit, back, letter, sha


def deduce(entry: dict[int, Item], rows: list[tuple], last: bool) -> dict[tuple[int, int], Item]:
    """Final items of a block of rows, from the final items at its start.

    `rows` holds (role, initial, deleted, truncated, ...).  With `last` the
    search stops at the goal, the first accepting item behind all rows; else
    when every item behind the rows that can be derived is final.
    """
    final: dict[tuple[int, int], Item] = {}
    # the number before the deduction decides between two equal derivations of
    # one item (an insertion at a block's end is also one at the next start)
    number = itertools.count()
    agenda = [(it.cost, it.audit, 0, state, next(number), None, "") for state, it in entry.items()]
    heapq.heapify(agenda)
    n = len(rows)
    while agenda:
        cost, audit, i, state, _, back, letter = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        at = final[i, state] = Item(cost, audit, back, letter)
        if back is None:
            at.sha = entry[state].sha
        if last and i == n and state in ACCEPTING:
            return final
        role = FOLLOWS[state]
        here = (i, state)
        moves = [(i, NEXT[state, role[0]], INSERT, "I")]
        if i < n:
            _, initial, deleted, truncated = rows[i][:4]
            moves.append((i + 1, state, DELETE, "D"))
            if not deleted:
                extra = TRUNCATED if truncated else 0
                moves.append((i + 1, NEXT[state, role[0]], REROLE + extra, "R"))
                if (state, initial) in NEXT:
                    moves.append((i + 1, NEXT[state, initial], KEEP + extra, "K"))
        for j, to, more, op in moves:
            if (j, to) not in final:
                heapq.heappush(agenda, (cost + more, audit + op, j, to, next(number), here, op))
    return final


def repaired_lines(final: dict[tuple[int, int], Item], goal: tuple[int, int], rows: list[tuple]) -> tuple[Item, int, list[str]]:
    """The block's entry item (and its state) of the derivation of `goal`, and
    the lines that it writes."""
    lines: list[str] = []
    at = goal
    while (item := final[at]).back is not None:
        i, state = item.back
        if item.letter == "K":
            lines.append(f"{rows[i][0]}:{rows[i][4]}")
        elif item.letter == "R":
            lines.append(f"{FOLLOWS[state]}:{rows[i][4]}")
        elif item.letter == "I":
            lines.append(f"{FOLLOWS[state]}:")
        at = item.back
    return item, at[1], lines[::-1]


class Conversation:
    """One conversation, fed row by row in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.n = 0
        self.first = self.turn = None
        self.turns = 0
        self.before: str | None = None
        self.rows: list[tuple] = []
        self.shared: list[str] = []
        self.entry = {START: Item(0, "", None, "", hashlib.sha256())}

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        self.n += 1
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.turn:
                self.turns += 1
                self.turn = turn
        end = len(text)
        while end and not WORD.match(text, end - 1):
            end -= 1
        blank = end == 0
        cut = not blank and not again and text[end - 1] not in ".!?"
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut
        initial = role[:1]
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        self.before = initial
        deleted = blank or again
        self.rows.append((role, initial, deleted, cut, "" if deleted else text))
        if len(self.rows) >= BLOCK:
            self.close_block()

    def close_block(self) -> None:
        final = deduce(self.entry, self.rows, last=False)
        n = len(self.rows)
        entry = {}
        for state in range(4):
            if (n, state) in final:
                item = final[n, state]
                entry[state] = Item(item.cost, item.audit, None, "", self._hashed(final, (n, state)))
        common = os.path.commonprefix([it.audit for it in entry.values()])
        if common:
            self.shared.append(common)
            for it in entry.values():
                it.audit = it.audit[len(common):]
        self.entry, self.rows = entry, []

    def _hashed(self, final, goal):
        start, state, lines = repaired_lines(final, goal, self.rows)
        sha = start.sha.copy()
        if lines:
            sha.update((("\n" if state != START else "") + "\n".join(lines)).encode())
        return sha

    def result(self) -> tuple:
        final = deduce(self.entry, self.rows, last=True)
        goal = next((len(self.rows), s) for s in ACCEPTING if (len(self.rows), s) in final)
        item = final[goal]
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, item.cost,
                "".join(self.shared) + item.audit, self._hashed(final, goal).hexdigest(), self.n)


_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")])


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_: Conversation | None = None
    out: list[tuple] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            columns = [c.to_pylist() for c in batch.slice(at, SLICE).columns]
            for conv_id, turn, role, text, gone, twice, again in zip(*columns):
                if open_ is None or conv_id != open_.conv_id:
                    if open_ is not None:
                        out.append(open_.result())
                        size += len(out[-1][7]) + 100
                        if size > 1 << 20:
                            yield _emit(out)
                            out, size = [], 0
                    open_ = Conversation(conv_id)
                if not gone:
                    open_.add(turn, role, text, again)
                    if twice:
                        open_.add(turn, role, text, True)
    if open_ is not None:
        out.append(open_.result())
        yield _emit(out)


def repair_rows(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text, gone, twice)."""
    return in_order(rows).mapInArrow(_repair, RESULT)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The contract's result: the damaged table, repaired (`n_rows`: rows after damage)."""
    return repair_rows(damage(conversations))
