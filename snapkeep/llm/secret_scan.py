"""Secret scans with structural confirmation.

Pattern matches find the plain secrets (assignments, access key ids, long hex
runs).  Encoded material is reported only after its structure was parsed:
base64 or hex candidates are decoded and must be a complete DER key (nested
lengths that fill the outer one exactly), a length-prefixed public key, an
armoured key block with such content, or a signed token whose header and
claims decode to JSON objects naming an algorithm.

Base64 may be wrapped: white space, escaped line breaks (``\\n`` as in JSON or
.env files) and escaped slashes between its stretches are left out for
decoding, and the span covers them.  Where a wrapped key ends follows from its
own lengths, and it must end with a stretch.  Armour may have header lines and
a checksum line.  An armoured private key whose body is encrypted, or an
OpenPGP one, is reported by its label if the body decodes to cipher blocks or
starts with a secret-key packet.

Defined cases: a null text is scanned as an empty one; results are per row,
so repeated rows get equal results; an empty table gives an empty table; a
very long text is scanned whole; other columns are ignored by `scan_secrets`
and returned unchanged by `redact_documents`.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from snapkeep.llm.frames import base_docs

ASSIGN_MIN = 8
ACCESS_MIN = 16
HEX_MIN = 32
#: Spans at the same start are listed in this order.
KINDS = ("assign", "access", "hex", "pem", "token", "der", "pubkey")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_MIN)
_ARMOUR = re.compile(r"-----(?=(BEGIN|END) ([A-Z0-9 ]+)-----)")
_ESCAPED = re.compile(r"\\+(?:(u000[9AaDd]|[nrt])|(u003[Dd])|(u002[Bb])|(?:/|u002[Ff]))")
_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
_CHECKSUM = re.compile(r"=[A-Za-z0-9+/]{4}")
#: A whole run of token characters with a dot and another run behind it, and a
#: run from a given place (possessive: each character is read once).
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?=\.[A-Za-z0-9_-])")
_PART = re.compile(r"[A-Za-z0-9_-]*+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_STRETCH = re.compile(r"[A-Za-z0-9+/_-]+")
#: Stretches of base64 with white space, escaped breaks or the backslash of an
#: escaped slash between them (possessive, so that time is linear).
_RUN = re.compile(r"[A-Za-z0-9+/_-]++(?:(?:\s|\\++(?:u000[9AaDd]|[nrt]|(?=/)))++[A-Za-z0-9+/_-]++)*+", re.A)
_BREAK = re.compile(r"(?:\s|\\++(?:u000[9AaDd]|[nrt]|(?=/)))++", re.A)
#: First stretch of a wrapped DER sequence or length-prefixed key.
_WRAPPED = re.compile(
    r"[MA](?:(?<![A-Za-z0-9+/_-][MA])|(?<=\\[nrt][MA])|(?<=\\u000[9AaDd][MA]))"
    r"(?:(?<=M)[A-P]|(?<=A)AAA)[A-Za-z0-9+/_-]*+(?=\s|\\)", re.A
)
_HEX_ANY = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")

#: Algorithm names of length-prefixed public keys.
PUBLIC_KEY_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384",
                    b"ecdsa-sha2-nistp521")
#: Fields of each, the name included.
PUBLIC_KEY_FIELDS = dict(zip(PUBLIC_KEY_NAMES, (3, 5, 2, 3, 3, 3)))

OUT = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"
)

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def decode_base64(text: str) -> bytes | None:
    """Decode standard or URL-safe base64, padding optional; None if invalid."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, value start, value end) of the elements filling data[at:end] exactly."""
    items = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE filling `data`, nested lengths consistent, with key fields.

    Key fields: at least two integers (a version and a number, or modulus and
    exponent), or an algorithm SEQUENCE starting with an object identifier
    next to a bit or octet string.
    """
    if len(data) < 16 or data[0] != 0x30:
        return False
    top = _der_items(data, 0, len(data))
    if not top or len(top) != 1:
        return False
    items = _der_items(data, top[0][1], top[0][2])
    if not items or len(items) < 2:
        return False
    algorithm = False
    for tag, a, b in items:
        if tag & 0x20:  # constructed: must nest exactly
            inner = _der_items(data, a, b)
            if inner is None:
                return False
            algorithm |= bool(inner) and inner[0][0] == 0x06
    tags = [t for t, _, _ in items]
    numbers = sum(t == 0x02 for t in tags)
    strings = any(t in (0x03, 0x04) for t in tags)
    return algorithm and strings or numbers >= 2 or (numbers >= 1 and strings)


def is_public_key(data: bytes) -> bool:
    """Length-prefixed fields that fill `data`, the first a known algorithm."""
    at, fields = 0, []
    while at < len(data):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and fields[0] in PUBLIC_KEY_NAMES


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    parts = []
    for part in (header, claims):
        raw = decode_base64(part)
        try:
            parts.append(json.loads(raw) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(p, dict) for p in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    if parts[0]["alg"].lower() == "none":
        return signature == ""
    return len(decode_base64(signature) or b"") >= 16


def dotted_tokens(text: str) -> Iterator[tuple[int, str, str, str, int]]:
    """(start, header, claims, signature, end) of `eyJ...` runs joined by dots,
    leftmost and not overlapping, in time linear in the text."""
    done = 0
    for m in _DOTTED.finditer(text):
        start = text.find("eyJ", m.start(), m.end())
        if m.start() < done or start < 0 or start + 3 == m.end():
            continue
        claims = _PART.match(text, m.end() + 1)
        if not text.startswith(".", claims.end()):
            continue
        signature = _PART.match(text, claims.end() + 1)
        done = signature.end()
        yield start, text[start:m.end()], claims[0], signature[0], done


class Taken:
    """Disjoint intervals of a text, in order."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i == len(self.ends) or b <= self.starts[i]

    def add(self, a: int, b: int) -> None:
        """An interval that is free."""
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def armour_blocks(text: str) -> Iterator[tuple[int, str, str, int]]:
    """(start, label, body, end) of BEGIN lines followed by their END line."""
    opened = None
    for m in _ARMOUR.finditer(text):
        kind, label = m.groups()
        if kind == "END" and opened and opened[1] == label:
            yield opened[0], label, text[opened[2]:m.start()], m.end(2) + 5
        opened = (m.start(), label, m.end(2) + 5) if kind == "BEGIN" else None


def is_armoured_key(label: str, body: str) -> bool:
    """Headers and a checksum aside, the body decodes to a key, or to an
    encrypted or OpenPGP private key as the label says."""
    body = _ESCAPED.sub(lambda m: "\n" if m[1] else "=" if m[2] else "+" if m[3] else "/", body)
    lines = [x.strip() for x in body.strip().splitlines()]
    at = 0
    while at < len(lines) and (not lines[at] or _HEADER.match(lines[at])):
        at += 1
    headers, parts = lines[:at], " ".join(lines[at:]).split()
    if parts and _CHECKSUM.fullmatch(parts[-1]):
        parts.pop()
    data = decode_base64("".join(parts))
    if not data:
        return False
    if is_der_key(data) or data.startswith(b"openssh-key-v1\0"):
        return True
    if "PRIVATE KEY" not in label:
        return False
    if label.startswith("PGP "):  # secret-key packet, new or old header
        return len(data) >= 16 and (data[0] == 0xC5 or data[0] & 0xFC == 0x94)
    encrypted = any(h.startswith("Proc-Type:") and "ENCRYPTED" in h for h in headers)
    return encrypted and len(data) >= 16 and len(data) % 8 == 0


def _bytes_at(chars: str, first: int, at: int, n: int) -> bytes:
    """Bytes at..at+n of what the characters from `first` on decode to; fewer at their end."""
    quads = chars[first + at // 3 * 4:first - (-(at + n) // 3) * 4]
    data = decode_base64(quads[:-1] if len(quads) % 4 == 1 else quads) or b""
    return data[at % 3:at % 3 + n]


def key_size(chars: str, first: int) -> int | None:
    """Bytes of the DER sequence or public key that starts at character `first`."""
    head = _bytes_at(chars, first, 0, 6)
    if len(head) < 6:
        return None
    if head[0] == 0x30:
        n = head[1] & 0x7F
        if not head[1] & 0x80:
            return 2 + n
        return 2 + n + int.from_bytes(head[2:2 + n], "big") if 1 <= n <= 4 else None
    name = _bytes_at(chars, first, 4, head[3]) if head[:3] == b"\0\0\0" else b""
    at = 0
    for _ in range(PUBLIC_KEY_FIELDS.get(name, 0)):
        size = _bytes_at(chars, first, at, 4)
        if len(size) < 4:
            return None
        at += 4 + int.from_bytes(size, "big")
    return at or None


def wrapped_keys(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of keys in base64 of more than one stretch."""
    run_end = key_end = 0
    for m in _WRAPPED.finditer(text):
        if m.start() < key_end:
            continue
        if m.start() >= run_end:
            run_end = _RUN.match(text, m.start()).end()
            starts, ends, before, parts = [], [], [0], []
            at = m.start()
            while at < run_end:
                part = _STRETCH.match(text, at)
                starts.append(at)
                ends.append(part.end())
                before.append(before[-1] + len(part[0]))
                parts.append(part[0])
                at = part.end()
                if at < run_end:
                    at = _BREAK.match(text, at).end()
            chars = "".join(parts)
        k = bisect_left(starts, m.start())
        first = before[k]
        size = key_size(chars, first)
        if size is None:
            continue
        stop = first - (-size * 4 // 3)
        last = bisect_left(before, stop)
        if last <= k + 1 or last == len(before) or before[last] != stop:
            continue
        data = decode_base64(chars[first:before[last]])
        kind = data and ("der" if is_der_key(data) else "pubkey" if is_public_key(data) else None)
        if kind:
            key_end = ends[last - 1]
            key_end += len(text[key_end:key_end + 2]) - len(text[key_end:key_end + 2].lstrip("="))
            yield m.start(), kind, key_end


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def confirmed_spans(text: str) -> list[Span]:
    """Candidates whose decoded structure is that of a key or signed token."""
    spans: list[Span] = []

    def mark(start: int, kind: str, end: int) -> None:
        spans.append((start, KINDS.index(kind), end))

    if "-----BEGIN " in text:
        for start, label, body, end in armour_blocks(text):
            if is_armoured_key(label, body):
                mark(start, "pem", end)
    if "eyJ" in text:
        for start, header, claims, signature, end in dotted_tokens(text):
            if is_signed_token(header, claims, signature):
                mark(start, "token", end)
    taken = Taken([(a, b) for a, _, b in spans])

    def found(start: int, kind: str, end: int) -> None:
        mark(start, kind, end)
        taken.add(start, end)

    for start, kind, end in wrapped_keys(text):
        if taken.free(start, end):
            found(start, kind, end)
    for m in _BASE64.finditer(text):
        if taken.free(*m.span()) and (data := decode_base64(m[0])) is not None:
            if is_der_key(data):
                found(m.start(), "der", m.end())
            elif is_public_key(data):
                found(m.start(), "pubkey", m.end())
    for m in _HEX_ANY.finditer(text):
        if m[0][:2] == "30" and taken.free(*m.span()) and is_der_key(bytes.fromhex(m[0])):
            found(m.start(), "der", m.end())
    return sorted(spans)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_text(text: str | None) -> tuple:
    text = text or ""
    base, more = base_spans(text), confirmed_spans(text)
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return (*counts, len(more), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_assign", "n_access", "n_hex", "n_confirmed")]
                       + [("base_sha256", pa.string()), ("spans", pa.string())])
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            rows = [scan_text(t) for t in part.column(1).to_pylist()]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema
            )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document with its counts and spans (code points, end exclusive)."""
    return base_docs(docs).mapInArrow(_scan_batches, OUT)


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """`text` with every reported span replaced; overlapping spans become one."""
    if not text:
        return text
    out, at, end = [], 0, 0
    for a, _, b in sorted(base_spans(text) + confirmed_spans(text)):
        if a >= end:
            out += [text[at:a], mark]
        at = end = max(end, b)
    out.append(text[at:])
    return "".join(out)


def redact_documents(docs: DataFrame) -> DataFrame:
    """All documents, secrets replaced in the text, `n_chars` counted again."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                columns = list(part.columns)
                before = part.column(at).to_pylist()
                after = [redact(t) for t in before]
                columns[at] = pa.array(after, part.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = part.column(k).to_pylist()
                    new = [n if a == b else len(b) for n, a, b in zip(old, before, after)]
                    columns[k] = pa.array(new, part.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
