"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and their first four and five bytes
(stems), hashed to 2**18 slots.  The machine scores
``w0 + sum w_i + sum_{i<j} <v_i, v_j>``: besides additive weights every pair
of terms has a learned interaction, such as an insult next to a group
mention.  It is trained by AdaGrad in numpy on a bounded sample of labelled
documents and applied to whole texts by a map over the table.

Terms are chosen by their own association with the label, and then by that of
their pairs: a term as frequent in toxic as in clean texts takes part if, among
the texts with one of the chosen terms, it tells toxic from clean ones.

Only documents whose crc32(doc_id as text) mod 3 is not 1 are learned from;
labels, language, source and doc_id are never inputs of a score.

Defined cases: a null or empty text, or one without a known term, gets the
score of the bias alone; repeated rows get equal scores; without usable
labels (none, or of one kind only) the bias is the smoothed share of toxic
labels and there are no term weights; an empty table gives an empty table;
labels with a null label or id are ignored; of documents repeating an id the
least text is learned from; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs
from snapkeep.llm.wordhash import U64, Words, slices

SLOTS = 1 << 18
FACTORS = 4
#: Labelled documents the machine is fitted on at most.
MAX_TRAIN = 12_000
#: A term is chosen if so many training documents have it and its share among
#: toxic ones differs by so many standard errors.
MIN_DF = 5
MIN_Z = 2.5
#: Chance, at most, that pairs without association add any term.
PAIR_ERROR = 0.05
#: Terms added by their pairs are fitted after the chosen ones; they start near
#: zero with this sum of squared gradients, so that they move only where the
#: chosen terms left errors.
PARTNER_SPREAD = 0.01
PARTNER_DAMPING = 1e-3
THRESHOLD = 0.7
EPOCHS = 12
OUT = "doc_id long, held_out boolean, score double, predicted int"

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null ids are learned from by nobody."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) == 1, F.lit(False))


def term_slots(texts: list[bytes], place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each text, as (slot, text) sorted by text; with
    `place`, only the slots it maps to a row."""
    words = Words(texts, lower=True, word_byte=_WORD_BYTE)
    slots = [words.hash >> U64(46)]
    owner = [words.text]
    for n in (4, 5):
        longer = np.flatnonzero(words.end - words.start > n)
        start = words.start[longer]
        slots.append((words.span_hash(start, start + n) + U64(n)) >> U64(46))
        owner.append(words.text[longer])
    slot, text = np.concatenate(slots), np.concatenate(owner).astype(U64)
    if place is not None:
        known = place[slot.astype(np.int64)] >= 0
        slot, text = slot[known], text[known]
    key = np.unique((text << U64(18)) | slot)
    return (key & U64(SLOTS - 1)).astype(np.int64), (key >> U64(18)).astype(np.int64)


@dataclass
class Machine:
    """Fitted weights; `place` maps a slot to its row, -1 for unused slots."""

    bias: float
    place: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, slot: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        row = self.place[slot]
        owner, row = owner[row >= 0], row[row >= 0]
        return self.bias + _sums(row, owner, n, self.weight, self.factor)[0]


def _sums(row, owner, n, weight, factor):
    linear = np.bincount(owner, weights=weight[row], minlength=n)
    total = np.stack([np.bincount(owner, weights=factor[row, f], minlength=n) for f in range(factor.shape[1])], axis=1)
    square = np.bincount(owner, weights=(factor * factor).sum(axis=1)[row], minlength=n)
    return linear + 0.5 * ((total * total).sum(axis=1) - square), total


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _divergence(k: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """n times the relative entropy of k/n and `share`: exp(-this) bounds either
    tail of the binomial distribution (Chernoff)."""
    hit, miss = np.maximum(k, 1e-9), np.maximum(n - k, 1e-9)
    return k * np.log(hit / (n * share)) + (n - k) * np.log(miss / (n * (1 - share)))


def partner_terms(owner: np.ndarray, slot: np.ndarray, toxic: np.ndarray, use: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Slots of `rest` whose share of toxic texts among those with a slot of
    `use` is beyond chance (Bonferroni over all pairs)."""
    place = np.full(SLOTS, -1, dtype=np.int64)
    place[rest] = np.arange(len(rest))
    other = place[slot] >= 0
    row = place[slot[other]]
    first = np.searchsorted(owner[other], np.arange(len(toxic) + 1))
    order = np.argsort(slot, kind="stable")
    start, end = np.searchsorted(slot[order], use), np.searchsorted(slot[order], use, side="right")
    limit = np.log(2 * len(use) * max(1, len(rest)) / PAIR_ERROR)
    found = np.zeros(len(rest), dtype=bool)
    for a, b in zip(start, end):
        texts = owner[order[a:b]]
        share = toxic[texts].mean()
        if not 0 < share < 1:
            continue
        size = first[texts + 1] - first[texts]
        at = np.repeat(first[texts] - np.cumsum(size) + size, size) + np.arange(size.sum())
        met, mark = row[at], np.repeat(toxic[texts] > 0, size)
        n, k = np.bincount(met, minlength=len(rest)), np.bincount(met[mark], minlength=len(rest))
        seen = np.flatnonzero(n >= MIN_DF)
        found[seen] |= _divergence(k[seen], n[seen], share) >= limit
    return rest[found]


def _descend(state: list, row: np.ndarray, owner: np.ndarray, toxic: np.ndarray, epochs: int, rng: np.random.Generator) -> None:
    """AdaGrad over [bias, weight, factor and their sums of squared gradients]."""
    bias, weight, factor, g_bias, g_weight, g_factor = state
    n, terms = len(toxic), len(weight)
    owner, row = owner[row >= 0], row[row >= 0]
    first = np.searchsorted(owner, np.arange(n + 1))
    for _ in range(epochs):
        order = rng.permutation(n)
        for part in np.array_split(order, max(1, n // 256)):
            size = first[part + 1] - first[part]
            own = np.repeat(np.arange(len(part)), size)
            r = row[np.repeat(first[part] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
            out, total = _sums(r, own, len(part), weight, factor)
            err = (sigmoid(bias + out) - toxic[part]) / len(part)
            d_weight = np.bincount(r, weights=err[own], minlength=terms) + 1e-5 * weight
            grad = err[own, None] * (total[own] - factor[r])
            d_factor = np.stack([np.bincount(r, weights=grad[:, f], minlength=terms) for f in range(FACTORS)], axis=1)
            d_factor += 1e-4 * factor
            d_bias = err.sum()
            g_bias += d_bias**2
            g_weight += d_weight**2
            g_factor += d_factor**2
            bias -= 0.3 * d_bias / np.sqrt(g_bias)
            weight -= 0.3 * d_weight / np.sqrt(g_weight)
            factor -= 0.03 * d_factor / np.sqrt(g_factor)
    state[:] = bias, weight, factor, g_bias, g_weight, g_factor


def fit(slots: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fit on the slots of each training text and its 0/1 label."""
    n = len(slots)
    positive = int(toxic.sum())
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    place = np.full(SLOTS, -1, dtype=np.int64)
    none = Machine(bias, place, np.zeros(0), np.zeros((0, FACTORS)))
    if positive == 0 or positive == n:
        return none
    owner = np.repeat(np.arange(n), [len(s) for s in slots])
    slot = np.concatenate(slots)
    df = np.bincount(slot, minlength=SLOTS)
    df_toxic = np.bincount(slot, weights=toxic[owner], minlength=SLOTS)
    share = positive / n
    z = np.abs(df_toxic - df * share) / np.sqrt(np.maximum(df * share * (1 - share), 1e-9))
    use = np.flatnonzero((df >= MIN_DF) & (z >= MIN_Z))
    use = use[np.argsort(-z[use], kind="stable")]
    if not len(use):
        return none
    rng = np.random.default_rng(seed)
    state = [bias, np.zeros(len(use)), rng.normal(0, 0.05, (len(use), FACTORS)),
             1e-8, np.full(len(use), 1e-8), np.full((len(use), FACTORS), 1e-8)]
    place[use] = np.arange(len(use))
    _descend(state, place[slot], owner, toxic, epochs, rng)
    rest = np.setdiff1d(np.flatnonzero(df >= MIN_DF), use)
    more = partner_terms(owner, slot, toxic, use, rest)
    if len(more):
        place[more] = len(use) + np.arange(len(more))
        _, weight, factor, _, g_weight, g_factor = state
        state[1] = np.concatenate([weight, np.zeros(len(more))])
        state[2] = np.concatenate([factor, rng.normal(0, PARTNER_SPREAD, (len(more), FACTORS))])
        state[4] = np.concatenate([g_weight, np.full(len(more), PARTNER_DAMPING)])
        state[5] = np.concatenate([g_factor, np.full((len(more), FACTORS), PARTNER_DAMPING)])
        _descend(state, place[slot], owner, toxic, epochs, rng)
    bias, weight, factor = state[:3]
    return Machine(float(bias), place, weight, factor)


def _slot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (toxic, slots)."""
    for batch in batches:
        toxic = batch.column(0).to_pylist()
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        for lo, hi in slices(texts):
            slot, owner = term_slots(texts[lo:hi])
            edge = np.searchsorted(owner, np.arange(hi - lo + 1))
            rows = [slot[edge[i]:edge[i + 1]].astype("<u4").tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic[lo:hi], pa.int32()), pa.array(rows, pa.binary())], names=["toxic", "slots"]
            )


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Machine:
    """Fit on at most `max_train` labelled documents, chosen by a hash of the id."""
    chosen = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    )
    # the limit bounds this side (two numbers a row); of rows that repeat a
    # doc_id one is learned from, so the limit bounds what is collected too
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = sample.select("toxic", "text").mapInArrow(_slot_batches, "toxic int, slots binary").collect()
    # partitions may arrive in any order; a fixed order makes the fit repeatable
    rows = sorted((bytes(r["slots"]), r["toxic"]) for r in rows)
    slots = [np.frombuffer(s, dtype="<u4").astype(np.int64) for s, _ in rows]
    return fit(slots, np.array([t for _, t in rows], dtype=float))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    docs = base_docs(docs)
    machine = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            scores = [np.zeros(0)]
            for lo, hi in slices(texts):
                slot, owner = term_slots(texts[lo:hi], machine.value.place)
                scores.append(sigmoid(machine.value.logits(slot, owner, hi - lo)))
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score, pa.float64()),
                 pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, OUT)
