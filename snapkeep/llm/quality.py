"""Line-first quality rules.

Every line is judged on its own by punctuation, navigation and boilerplate
rules; failing lines are removed, and a document that loses too much of its
text that way is rejected, as is one that fails the base rules (fewer than 50
words, or more than half of its words in repeated 3-word windows).

Defined cases: a null or empty text has no words, is not kept and cleans to
an empty text; blank lines are never judged and stay; equal rows get equal
results; an empty table gives an empty table; columns the rules do not use
are ignored by `score_lines` and returned unchanged by `clean_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapkeep.llm.frames import base_docs

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document is rejected when failing lines hold more than this share (in
#: percent) of the bytes in its words.
MAX_LOSS_PERCENT = 40

SYMBOLS = "#*$%&|<>"
#: Characters a full line may end with (after white space).
LINE_END = r"[.!?:;,\"')\]}]$"
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright|licensed under|terms of (use|service)|privacy policy|cookies?\b|"
    r"click here|sign (up|in)\b|log ?in\b|subscribe|javascript|read more|share (this|on)\b|powered by)"
)
_SPACES = " \t\n\x0b\x0c\r"
_END = re.compile(LINE_END.encode())
_BOILER = re.compile(BOILERPLATE.encode())
#: A boilerplate phrase condemns only a short line: prose may use the words.
BOILERPLATE_WORDS = 20

OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_bytes long, word_bytes long, "
    "clean_text string"
)


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """The rules for one line that has a word.

    * punctuation: it does not end like a sentence, or marks (``#*$%&|<>``
      or doubled ``!!``) number more than three for every ten words;
    * navigation: it holds three or more ``|`` separators, at least one for
      every four words;
    * boilerplate: a line of up to 20 words with a boilerplate phrase.
    """
    n = len(words)
    if not _END.search(words[-1]):
        return True
    bars = line.count(b"|")
    if bars >= 3 and 4 * bars >= n:
        return True
    marks = sum(line.count(c.encode()) for c in SYMBOLS) + line.count(b"!!")
    if 10 * marks > 3 * n:
        return True
    return n <= BOILERPLATE_WORDS and _BOILER.search(line) is not None


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=n)
    k = len(ids)
    if k == n:
        return 0
    if k < 1 << 20:
        key = (w[:-2] * k + w[1:-1]) * k + w[2:]
    else:  # pairs are renumbered first, so that the key stays within 64 bits
        pair = np.unique(w[:-1] * k + w[1:], return_inverse=True)[1]
        key = pair[:-1] * k + w[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for j in range(3):
        covered[j:n - 2 + j] |= twice
    return int(covered.sum())


def judge(text: str | None) -> tuple:
    """All figures of one text, in the order of `OUT` after doc_id."""
    text = text or ""
    data = text.encode()
    words = data.split()
    word_chars = len(text) - sum(text.count(c) for c in _SPACES)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[bytes] = set()
    dup = failed = lines = lost = total = 0
    kept_lines = []
    for line in data.split(b"\n"):
        in_line = line.split()
        if in_line:
            if line in seen:
                dup += 1
            else:
                seen.add(line)
            lines += 1
            size = sum(map(len, in_line))
            total += size
            if line_fails(line, in_line):
                failed += 1
                lost += size
                continue
        kept_lines.append(line)
    repeated = repeat_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    kept = not base_failed and 100 * lost <= MAX_LOSS_PERCENT * total
    return (len(words), word_chars, n_symbols, dup, repeated, base_failed, kept, lines, failed, lost, total,
            b"\n".join(kept_lines).decode())


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(c, kinds[t]) for c, t in (x.split() for x in OUT.split(", "))])


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            rows = [judge(t) for t in part.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in schema.names[1:]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema
            )


def score_lines(docs: DataFrame) -> DataFrame:
    """One row per document: base figures, line figures, verdict, clean text.

    A plain map over the rows: no shuffle, nothing kept between rows.
    """
    return base_docs(docs).mapInArrow(_judge_batches, OUT)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, failing lines removed, same columns.

    `n_chars`, where present, is counted again on the cleaned text.
    """
    names = docs.columns
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                rows = [judge(t) for t in part.column(at).to_pylist()]
                keep = [i for i, r in enumerate(rows) if r[6]]
                columns = [part.column(i).take(pa.array(keep, pa.int64())) for i in range(len(names))]
                clean = [rows[i][-1] for i in keep]
                columns[at] = pa.array(clean, part.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    columns[k] = pa.array([len(t) for t in clean], part.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, fields)


def quality_query(docs: DataFrame) -> DataFrame:
    return score_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", F.md5("clean_text").alias("clean_md5"),
    )
