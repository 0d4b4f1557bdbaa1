"""Language identification by a byte convolutional network.

A text is read as windows of a fixed number of UTF-8 bytes (the last one
filled up with spaces).  Bytes are embedded, filters of several widths slide
over the window, each filter's largest answer is kept, and a softmax layer
names the language; a text's score is the mean over all its windows.  The
network is trained in numpy (Adam) on windows of a bounded sample of labelled
documents and applied to batches of windows by a map over the table.

Only documents whose crc32(doc_id as text) mod 3 is not 1 are learned from;
lang, source and doc_id are never inputs of a prediction.  The sample is drawn
within each language by a hash of the id, so that a rare language is learned
however small its share is.

Defined cases: a null text, or one without a letter, is `und` with score 0;
texts shorter than a window are filled up; very long texts are read whole in
bounded batches; repeated rows get equal results; of documents repeating an id
one is learned from, in its least language and text; of equally likely
languages the first by name is predicted; without training rows every text is
`und`; with one language only it is always predicted; an empty table gives an
empty table; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs
from snapkeep.llm.toxicity import fold_of, held_out
from snapkeep.llm.wordhash import slices

WINDOW = 128
#: Filters are placed at every byte.
STRIDE = 1
WIDTHS = (4, 6)
FILTERS = 16
EMBED = 4
#: Labelled documents the network is fitted on at most, of one language and
#: together, and windows of each.  The first of every language come first, so a
#: language is left out only where there are more than MAX_TRAIN languages.
MAX_PER_LANGUAGE = 1_000
MAX_TRAIN = 4_000
TRAIN_WINDOWS = 6
EPOCHS = 6
#: Windows passed through the network at once.
BATCH = 2_048
UNKNOWN = "und"
OUT = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: list[np.ndarray]  # per width: width * EMBED x FILTERS
    bias: list[np.ndarray]
    dense: np.ndarray  # filters x languages
    out: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.dense, self.out]


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    f = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
    return Network(
        languages, f(256, EMBED, scale=0.5),
        [f(w * EMBED, FILTERS, scale=(w * EMBED) ** -0.5) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        f(FILTERS * len(WIDTHS), len(languages), scale=0.2), np.zeros(len(languages), np.float32),
    )


def text_windows(text: bytes) -> bytes:
    return text + b" " * (-len(text) % WINDOW or (0 if text else WINDOW))


def _patches(x: np.ndarray, width: int) -> np.ndarray:
    """Embedded windows (n, WINDOW, EMBED) to rows of `width` neighbours."""
    n = (x.shape[1] - width) // STRIDE + 1
    s = x.strides
    view = np.lib.stride_tricks.as_strided(x, (x.shape[0], n, width * EMBED), (s[0], STRIDE * s[1], s[2]), writeable=False)
    return np.ascontiguousarray(view)


def pooled(net: Network, windows: np.ndarray) -> tuple[np.ndarray, list]:
    """Largest answer of every filter, and what the backward pass needs."""
    x = net.embed[windows]
    tops, parts = [], []
    for w, k, b in zip(WIDTHS, net.filters, net.bias):
        patches = _patches(x, w)
        answers = patches.reshape(-1, patches.shape[2]) @ k
        answers = answers.reshape(len(windows), -1, FILTERS)
        tops.append(answers.max(axis=1) + b)
        parts.append((patches, answers))
    return np.maximum(np.concatenate(tops, axis=1), 0), parts


def probabilities(net: Network, hidden: np.ndarray) -> np.ndarray:
    z = hidden @ net.dense + net.out
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    hidden, parts = pooled(net, windows)
    p = probabilities(net, hidden)
    p[np.arange(len(target)), target] -= 1
    p /= len(target)
    d_hidden = (p @ net.dense.T) * (hidden > 0)
    d_embed = np.zeros_like(net.embed)
    d_filters, d_bias = [], []
    rows = np.arange(len(windows))[:, None]
    for i, (w, (patches, answers)) in enumerate(zip(WIDTHS, parts)):
        g = d_hidden[:, i * FILTERS:(i + 1) * FILTERS]
        at = answers.argmax(axis=1)  # only the largest answer gets a gradient
        chosen = patches[rows, at]
        d_filters.append(np.einsum("nfd,nf->df", chosen, g))
        d_bias.append(g.sum(axis=0))
        back = (g[:, :, None] * net.filters[i].T[None]).reshape(len(windows), FILTERS, w, EMBED)
        seen = windows[rows[:, :, None], (at * STRIDE)[:, :, None] + np.arange(w)]
        for e in range(EMBED):
            d_embed[:, e] += np.bincount(seen.ravel(), weights=back[..., e].ravel(), minlength=256)
    return [d_embed, *d_filters, *d_bias, hidden.T @ p, p.sum(axis=0)]


def fit(windows: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    net = new_network(languages, rng)
    params = net.parameters()
    m, v = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    step = 0
    # rare languages weigh as much as frequent ones in the draw
    share = np.bincount(target, minlength=len(languages))[target]
    draw = (1 / share) / (1 / share).sum()
    for _ in range(epochs):
        order = rng.choice(len(target), len(target), p=draw)
        for part in np.array_split(order, max(1, len(order) // 64)):
            step += 1
            for a, g, mi, vi in zip(params, gradients(net, windows[part], target[part]), m, v):
                mi += 0.1 * (g - mi)
                vi += 0.01 * (g * g - vi)
                a -= (0.004 * (mi / (1 - 0.9**step)) / (np.sqrt(vi / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, max_train: int = MAX_TRAIN, per_language: int = MAX_PER_LANGUAGE) -> Network | None:
    """Fit on at most `max_train` labelled documents, `per_language` of each.

    The rank within a language is limited before its shuffle (at most
    `per_language` rows leave a task), so a frequent language is no hot group.
    """
    usable = docs.where(F.col("lang").isNotNull() & (F.col("text") != "") & (fold_of(F.col("doc_id")) != 1))
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    within = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        ids.withColumn("place", F.row_number().over(within)).where(F.col("place") <= per_language)
        .orderBy("place", F.xxhash64("doc_id"), "doc_id").limit(max_train).select("doc_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                w = np.frombuffer(text_windows(t.encode()), np.uint8).reshape(-1, WINDOW)
                out.append(w[np.unique(np.linspace(0, len(w) - 1, TRAIN_WINDOWS).astype(int))].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["lang", "windows"])

    # of rows that repeat a doc_id one is learned from, so the limit bounds what is collected
    sample = usable.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    sample = sample.select("row.lang", "row.text")
    rows = sorted((r["lang"], bytes(r["windows"])) for r in sample.mapInArrow(run, "lang string, windows binary").collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    target = np.repeat([languages.index(lang) for lang, _ in rows], [len(w) // WINDOW for _, w in rows])
    return fit(windows, target, languages)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def classify(net: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and mean probability of each text over all its windows."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if net is None:
        return names, scores
    known = [i for i, t in enumerate(texts) if has_letter(t)]
    data = [texts[i].encode() for i in known]
    for lo, hi in slices(data):
        padded = [text_windows(t) for t in data[lo:hi]]
        count = np.array([len(t) // WINDOW for t in padded])
        windows = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, WINDOW)
        p = np.concatenate([
            probabilities(net, pooled(net, windows[at:at + BATCH])[0]) for at in range(0, len(windows), BATCH)
        ])
        mean = np.add.reduceat(p, np.cumsum(count) - count, axis=0) / count[:, None]
        for i, row in zip(known[lo:hi], mean):
            names[i] = net.languages[int(row.argmax())]
            scores[i] = float(min(1.0, row.max()))
    return names, scores


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document."""
    lang = docs["lang"].cast("string").alias("lang")
    net = docs.sparkSession.sparkContext.broadcast(
        train(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), lang))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                names, scores = classify(net.value, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return base_docs(docs).withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, OUT)
