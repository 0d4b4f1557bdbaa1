"""Every operator against a plain version, on edge cases and the small tables."""

import hashlib
import json
import random
import tracemalloc
import zlib
from base64 import b64encode, urlsafe_b64encode
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import frame
from pyspark.sql import functions as F

from snapkeep.llm import decontam, jaccard, language, packing, quality, repeats, secret_scan, shards, toxicity, url_lists
from snapkeep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def by_text(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# ---------------------------------------------------------------- quality rules


def test_quality_figures(ship, edge_docs):
    got = quality.score_lines(frame(ship, edge_docs))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert by_text(got, *names) == sorted(((d, *brute.quality(t)) for d, t in edge_docs), key=str)


def test_quality_verdicts():
    prose = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(8))
    judged = lambda t: quality.judge(t)[6]
    assert judged(prose) and not judged(None) and not judged("") and not judged("too short.")
    menu = "\n".join("home | news | about | contact | jobs | press" for _ in range(20))
    assert judged(prose + "\nAll rights reserved.") and not judged(menu + "\n" + prose[:200])
    assert "rights" not in quality.judge(prose + "\nAll rights reserved.")[-1]
    assert not judged("\n".join(["same line of seven words here again."] * 30))
    assert quality.judge(prose + "\n\n" + prose)[3] == 8


def test_clean_documents_keeps_columns(ship, edge_docs):
    docs = frame(ship, edge_docs)
    out = quality.clean_documents(docs)
    assert out.columns == docs.columns
    kept = {d for d, t in edge_docs if quality.judge(t)[6]}
    assert {r["doc_id"] for r in out.collect()} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    assert quality.clean_documents(docs.where("false")).count() == 0


# ---------------------------------------------------------------- secrets

DER_KEY = bytes([0x30, 20, 2, 1, 0, 2, 8, *range(1, 9), 2, 5, 9, 8, 7, 6, 5])


def _token():
    part = lambda x: urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    return f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 'x'})}.{urlsafe_b64encode(bytes(32)).decode().rstrip('=')}"


def test_secret_base_spans(ship, edge_docs):
    texts = [
        "password=short", 'API_KEY: "abcdefgh1234"', "é token = abcdefgh secret:passwd=longenough1", "AKIA1234567890AB AKIA123",
        "f" * 32 + " " + "f" * 31, "token=token=abcdefgh", "PaſSword=abcdefgh", None, "",
    ]
    docs = edge_docs + [(1000 + i, t) for i, t in enumerate(texts)]
    rows = secret_scan.scan_secrets(frame(ship, docs)).collect()
    got = sorted(((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows), key=str)
    want = []
    for d, t in docs:
        s = brute.secrets(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want.append((d, *(sum(k == x for k, _, _ in s) for x in ("assign", "access", "hex")), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_structures_are_confirmed():
    pad = bytes([0x30, 0x82, 0, 40, 2, 1, 0, 4, 35, *range(35)])
    pem = "-----BEGIN PRIVATE KEY-----\n" + b64encode(pad).decode() + "\n-----END PRIVATE KEY-----"
    ssh = b64encode(b"\0\0\0\x07ssh-rsa" + b"\0\0\0\x03\1\0\1" + b"\0\0\0\x10" + bytes(16)).decode()
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in secret_scan.confirmed_spans(t)]
    assert kinds(f"a {_token()} b") == ["token"]
    assert kinds(pem) == ["pem"]
    assert kinds("x " + b64encode(pad).decode() + " y") == ["der"]
    assert kinds("x " + pad.hex() + " y") == ["der"]
    assert kinds("ssh-rsa " + ssh) == ["pubkey"]
    assert kinds("eyJhbGciOi.e30.abc") == [] and kinds(b64encode(bytes(60)).decode()) == []
    assert kinds("x " + b64encode(pad[:-1] + b"\0\0").decode()) == []  # lengths do not fill
    assert secret_scan.is_der_key(DER_KEY) and not secret_scan.is_der_key(DER_KEY + b"\0")
    text = f"é password=abcdefgh1 and {_token()}"
    assert secret_scan.scan_text(text)[-1].startswith("assign:2:20,token:")
    assert secret_scan.redact(text) == "é [secret] and [secret]"


def test_wrapped_escaped_and_encrypted_keys():
    rnd = random.Random(4)
    number = lambda n: bytes([2, 0x82, n >> 8, n & 255, 1]) + rnd.randbytes(n - 1)
    inner = b"\2\1\0" + number(257) + b"\2\3\1\0\1" + number(256) + number(130)
    der = bytes([0x30, 0x82, len(inner) >> 8, len(inner) & 255]) + inner
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\1\0\1", rnd.randbytes(257)))
    fold = lambda data, n, by="\n": by.join(b64encode(data).decode()[i:][:n] for i in range(0, len(b64encode(data)), n))
    block = lambda label, body: f"-----BEGIN {label}-----\n{body}\n-----END {label}-----"
    legacy = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF\n\n"
    packets = b"\x95\3\xbe" + rnd.randbytes(500)
    armour = {
        "wrapped": block("RSA PRIVATE KEY", fold(der, 64)),
        "encrypted": block("RSA PRIVATE KEY", legacy + fold(rnd.randbytes(608), 64)),
        "pgp": block("PGP PRIVATE KEY BLOCK", "Version: GnuPG v2\nComment: a, b-c\n\n" + fold(packets, 64) + "\n=aB3/"),
        "pgp without headers": block("PGP PRIVATE KEY BLOCK", "\n" + fold(packets, 64) + "\n=aB3/"),
    }
    escapes = (lambda t: t, json.dumps, lambda t: json.dumps(json.dumps(t)), lambda t: t.replace("\n", "\\r\\n"),
               lambda t: json.dumps(t).replace("/", "\\/"), lambda t: t.replace("\n", "\\n"), lambda t: t.replace("\n", "\r\n"))
    for name, key in armour.items():
        for escape in escapes:
            written = escape(key)
            text = f"é KEY={written} then"
            start, end = text.index("-----BEGIN"), text.rindex("-----") + 5
            assert secret_scan.confirmed_spans(text) == [(start, secret_scan.KINDS.index("pem"), end)], (name, written)
            assert secret_scan.redact(text) == text[:start] + "[secret]" + text[end:]
    for data, kind in ((der, "der"), (ssh, "pubkey")):
        for width in (64, 70, 76):
            for escape in escapes:
                for before, after in (("", ""), ("key\n", "\nthe next line"), ("-----BEGIN X-----\n", "\nMIIBnotakey")):
                    text = "é {" + escape(before + fold(data, width) + after) + "} x"
                    [(start, k, end)] = secret_scan.confirmed_spans(text)
                    assert secret_scan.KINDS[k] == kind
                    key = text[start:end].replace("\\/", "/")
                    for gap in ("\\\\n", "\\r", "\\n", "\r", "\n"):
                        key = key.replace(gap, "")
                    assert key == b64encode(data).decode(), (width, text)
    # not keys: lengths that do not fill, bodies of no key, a label alone, a block without its end
    assert secret_scan.confirmed_spans(fold(der[:-1], 64)) == [] and secret_scan.confirmed_spans(fold(der + b"\0\0\0", 64)) == []
    for label in ("RSA PRIVATE KEY", "PGP PRIVATE KEY BLOCK"):
        for body in ("...", "Proc-Type: 4,ENCRYPTED", "your key here", fold(bytes(64), 64)):
            assert secret_scan.confirmed_spans(block(label, body)) == []
    assert secret_scan.confirmed_spans(block("CERTIFICATE REQUEST", legacy + fold(bytes(64), 64))) == []
    assert secret_scan.confirmed_spans(armour["encrypted"][:-9]) == []


def test_redaction_keeps_rows(ship, edge_docs):
    docs = frame(ship, edge_docs + [(1, "password=abcdefgh1 x")])
    out = secret_scan.redact_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text = '[secret] x' and n_chars = 10").count() == 1


# ---------------------------------------------------------------- Jaccard join


def test_jaccard_edge_cases(ship, edge_docs):
    got = by_text(jaccard.jaccard_components(frame(ship, edge_docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_components(edge_docs), key=str)
    assert jaccard.jaccard_components(frame(ship, edge_docs).where("false")).count() == 0


def test_jaccard_rows_without_id_link(ship, edge_docs):
    """A text that only rows without doc_id have joins its near copies, and joins two of them to one component."""
    w = [f"w{i}" for i in range(100)]
    other = lambda a, b: " ".join(f"x{i}" if a <= i < b else x for i, x in enumerate(w))
    docs = edge_docs + [(900, other(0, 7)), (901, other(93, 100)), (None, " ".join(w)), (None, " ".join(w)), (None, "alone " * 9)]
    got = by_text(jaccard.jaccard_components(frame(ship, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_components(docs), key=str)
    assert (901, 96, 900) in got and (None, 96, 900) in got


def test_jaccard_hot_groups(ship, monkeypatch):
    """Groups larger than the hot limit, with a chain of near copies and a shared passage."""
    monkeypatch.setattr(jaccard, "HOT_DF", 6)
    monkeypatch.setattr(jaccard, "LIST_DF", 6)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    common = [word() for _ in range(60)]
    docs = []
    w = [word() for _ in range(80)]
    for i in range(40):  # a chain: neighbours are near, ends are not
        w = list(w)
        w[(i * 7) % 80] = word()
        docs.append((i, " ".join(w)))
    docs += [(100 + i, " ".join(common + [word() for _ in range(rnd.choice([4, 8, 12, 40]))])) for i in range(60)]
    docs += [(200 + i, docs[3][1]) for i in range(20)]
    got = by_text(jaccard.jaccard_components(frame(ship, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_components(docs), key=str)


def test_jaccard_on_table_and_stage(ship, small):
    got = by_text(QUERIES["op6_jaccard_join"](ship, SF), "doc_id", "n_shingles", "component_id")
    want = brute.jaccard_components(small)
    assert got == sorted(want, key=str)
    docs = ship.read.parquet(f"{SF}/documents.parquet")
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want})


def test_hot_pairs_leave_out_the_largest_component(ship, monkeypatch):
    """All pairs of different components meet, rows of the largest one only with others."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    values = np.arange(1, 41, dtype=np.uint64)
    root_of = {k: 0 if k < 30 else (30 if k < 37 else k) for k in range(40)}
    maps = bytearray(jaccard.bitmap(values))
    classes = ship.createDataFrame([(k, 40, maps) for k in root_of], "key long, n long, bitmap binary")
    hot = ship.createDataFrame([(7, k, 40) for k in root_of] + [(8, k, 40) for k in range(5)], "token long, key long, n long")
    roots = ship.createDataFrame(list(root_of.items()), "node long, root long")
    got = {tuple(r) for r in jaccard.hot_cross_pairs(hot, roots, classes).collect()}
    assert got == {(a, b) for a in root_of for b in root_of if a < b and root_of[a] != root_of[b]}


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_components(ship, monkeypatch, block):
    from snapkeep.llm import components

    monkeypatch.setattr(components, "BLOCK_EDGES", block)
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(20)] + [(200, 200)]
    edges += [(300 + rnd.randrange(30), 300 + rnd.randrange(30)) for _ in range(25)]
    df = ship.createDataFrame([e if i % 2 else e[::-1] for i, e in enumerate(edges)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for u, v in edges if u != v for x in (u, v)}
    assert components.connected_components(df.where("false")).count() == 0


def test_bitmap_bound_never_drops_a_link():
    rng = np.random.default_rng(1)
    for n in (5, 60, 300, 1500):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for share in (0.0, 0.05, 0.1, 0.2):
            b = np.unique(np.concatenate([a[int(len(a) * share):], rng.integers(0, 2**63, int(n * share)).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            linked = 100 * both >= 80 * (len(a) + len(b) - both)
            ok = jaccard.bound_pairs(np.array([len(a)]), np.array([len(b)]), [jaccard.bitmap(a)], [jaccard.bitmap(b)])[0]
            assert ok or not linked


# ---------------------------------------------------------------- secrets: time


def test_tokens_are_those_of_the_plain_pattern():
    import re

    plain = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
    rnd = random.Random(8)
    for _ in range(3000):
        text = "".join(rnd.choices(["eyJ", ".", "..", " ", "a", "-_", "é", "eyJx.y.z", "eyJ."], k=rnd.randint(1, 14)))
        want = [(m.start(), *m.groups(), m.end()) for m in plain.finditer(text)]
        assert list(secret_scan.dotted_tokens(text)) == want, text


@pytest.mark.parametrize("text", ["eyJ" * 350_000, "eyJ." * 250_000, "eyJx.y." * 150_000, "a.b" * 350_000, "-----BEGIN X-----" * 50_000])
def test_scan_time_of_long_runs(text):
    import time

    begin = time.perf_counter()
    secret_scan.scan_text(text)
    assert time.perf_counter() - begin < 5


def test_taken_intervals():
    rnd = random.Random(2)
    spans = [(a, a + rnd.randint(1, 9)) for a in rnd.choices(range(200), k=12)]
    taken = secret_scan.Taken(spans)
    for _ in range(400):
        a = rnd.randrange(220)
        b = a + rnd.randint(1, 8)
        free = all(b <= x or a >= y for x, y in spans)
        assert taken.free(a, b) == free
        if free:
            taken.add(a, b)
            spans.append((a, b))


# ---------------------------------------------------------------- repeats


def test_repeats_edge_cases(ship, edge_docs):
    rows = repeats.remove_repeats(frame(ship, edge_docs)).collect()
    want = brute.repeats(edge_docs)
    assert len(rows) == len(edge_docs)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == Counter((d, *want[d, t]) for d, t in edge_docs)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)
    assert repeats.remove_repeats(frame(ship, edge_docs).where("false")).count() == 0


def test_repeats_in_small_segments_and_on_table(ship, edge_docs, small, monkeypatch):
    texts = [(t or "").encode() for _, t in edge_docs]
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    cut = [(i, at, p) for owner, place, parts in repeats._segments(texts) for i, at, p in zip(owner, place, parts)]
    for i, t in enumerate(texts):  # every suffix of 50 bytes is in exactly one segment
        seen = Counter(at + k for j, at, p in cut if j == i for k in range(len(p) - 49))
        assert seen == Counter(range(max(0, len(t) - 49)))
    monkeypatch.undo()
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_repeat_removal"](ship, SF).collect()}
    assert got == {d: v for (d, _), v in brute.repeats(small).items()}


def test_longest_previous_factor():
    rnd = random.Random(6)
    text = bytes(rnd.choices(b"ab\x00\xff", k=400)) + b"a" * 300
    parts = [text[i:i + 120] for i in (rnd.randrange(580) for _ in range(40))]
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    at = np.concatenate([np.arange(120 * i, 120 * i + 71) for i in range(40)])
    doc = np.repeat(np.array([rnd.randrange(12) for _ in parts]), 71)
    raw = bytes(buf)
    strings = [raw[a:a + repeats.LENGTH] for a in at]
    order, common = repeats.suffix_order(buf, at, doc)
    assert [(strings[i], doc[i]) for i in order] == sorted((x, d) for x, d in zip(strings, doc))
    for k in range(1, len(order)):
        x, y = strings[order[k - 1]], strings[order[k]]
        assert common[k] == next((i for i in range(50) if x[i] != y[i]), 50)
    least = {}
    for x, d in zip(strings, doc):
        least[x] = min(least.get(x, d), d)
    want = [50 if least[x] < d else 0 for x, d in zip(strings, doc)]
    assert repeats.longest_previous_factor(buf, at, doc).tolist() == want
    # any order of documents: both neighbours are needed
    docs, common = np.array([3, 1, 2, 2, 0]), np.array([0, 50, 50, 50, 50])
    assert repeats.smaller_neighbour(docs, common).tolist() == [0, 0, 50, 50, 0]
    assert repeats.smaller_neighbour(docs, np.array([0, 50, 50, 49, 50])).tolist() == [0, 0, 50, 0, 0]


# ---------------------------------------------------------------- decontamination


def test_leaks_against_brute_force(ship):
    rnd = random.Random(9)
    vocab = ["".join(rnd.choices("abcdefghijkl", k=5)) for _ in range(400)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(8, 40)))) for i in range(12)] + [(90, None), (91, "too short"), (0, "too")]
    docs = []
    for d in range(150):
        w = rnd.choices(vocab, k=rnd.randint(0, 60))
        if d % 2:
            item = items[rnd.randrange(12)][1].split()
            for _ in range(rnd.randint(0, len(item) // 4)):
                k = rnd.randrange(len(item))
                item[k:k + rnd.randint(0, 1)] = rnd.choices(vocab, k=rnd.randint(0, 1))
            w[len(w) // 2:len(w) // 2] = item
        docs.append((d, " ".join(w).upper() if d % 3 == 0 else " ".join(w)))
    docs += [(500, None), (501, ""), (7, docs[7][1])]
    table = ship.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontam.leaks(frame(ship, docs), table).collect()}
    want = {}
    for d, t in docs:
        for i, item in items[:12]:
            n = brute.edit_distance_in(item.split(), (t or "").lower().split())
            if n <= decontam.edits_allowed(len(item.split())):
                want[d, i] = n
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want) and len(want) > 50
    assert all(got[k] == want[k] for k in got)
    left = decontam.drop_leaks(frame(ship, docs), table)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, _ in docs if d not in {k for k, _ in got})
    assert decontam.leaks(frame(ship, docs), table.where("false")).count() == 0


@pytest.mark.parametrize("n", [20, 50, 200, 800, 1600])
def test_leaks_of_long_items_at_the_full_allowance(n):
    """Items with exactly floor(0.2 n) edits are found whatever their length."""
    e = decontam.edits_allowed(n)
    for seed in range(12):
        rnd = random.Random(seed)
        word = lambda: f"w{rnd.randrange(10**9)}"
        item = [word() for _ in range(n)]
        index = decontam.ItemIndex([(7, " ".join(item))])
        spread, anywhere, moved = item[:], item[:], item[:]
        for j in range(e):
            spread[j * n // e] = word()
        for k in rnd.sample(range(n), e):
            anywhere[k] = word()
        for k in sorted(rnd.sample(range(n), e), reverse=True):
            moved[k:k + rnd.randrange(2)] = [word()]
        text = lambda w: " ".join([*(word() for _ in range(9)), *w, *(word() for _ in range(9))]).encode()
        found = decontam.find_leaks([text(spread), text(anywhere), text(moved), " ".join(spread).encode()], index)
        assert [(t, i) for t, i, *_ in found] == [(t, 7) for t in range(4)]
        assert found[0][2] == found[1][2] == e


def test_items_of_few_words():
    items = [(1, "What is this"), (2, "what IS this"), (3, "why"), (4, "one two three four five six seven"), (5, "  ")]
    texts = [b"so what is\nThis and what is this", b"what is", b"this", b"WHY not why", b"",
             b"zero one two three four five six seven", b"one two three four five six"]
    # seven words allow one edit, so the last text leaks item 4; up to four allow none
    want = [(0, 1, 0, 1, 4), (0, 2, 0, 1, 4), (3, 3, 0, 0, 1), (5, 4, 0, 1, 8), (6, 4, 1, 0, 6)]
    assert sorted(decontam.find_leaks(texts, decontam.ItemIndex(items))) == want
    long = (6, " ".join(f"w{i}" for i in range(20)))
    assert sorted(decontam.find_leaks(texts, decontam.ItemIndex([*items, long]))) == want


def test_leaks_in_small_groups_of_grams(monkeypatch):
    """The same leaks whether all shared grams are held at once or few, down to one item's."""
    rnd = random.Random(2)
    vocab = [f"v{i}" for i in range(12)]  # few words: grams are in many items and many places
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(8, 30)))) for i in range(40)]
    index = decontam.ItemIndex(items)
    texts = [" ".join([*rnd.choices(vocab, k=rnd.randint(0, 150)), items[i][1], *rnd.choices(vocab, k=rnd.randint(0, 150))]).encode()
             for i in range(30)]
    texts += [b"", *(" ".join(["v1", *rnd.choices(vocab, k=5), "v2"] * 40).encode() for _ in range(2))]
    want = decontam.find_leaks(texts, index)
    for limit in (3000, 100, 1):
        monkeypatch.setattr(decontam, "SHARED_GRAMS", limit)
        assert decontam.find_leaks(texts, index) == want
    assert len(want) > 20 and not decontam.find_leaks([b"none of these words"], index)


# ---------------------------------------------------------------- packing


def _check_pieces(rows, docs, window=2048):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for at in range(0, len(ids), window):
            p = ids[at:at + window]
            want[d, at, len(p), zlib.crc32(p.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


def test_packing(ship, edge_docs):
    docs = edge_docs + [(5000, "a<|endoftext|>b 😀 　x")]
    rows = packing.pack_documents(frame(ship, docs)).collect()
    _check_pieces(rows, docs)
    assert packing.pack_documents(frame(ship, docs).where("false")).count() == 0


def test_packing_table_has_little_padding(ship, small):
    rows = QUERIES["op8_packing"](ship, SF).collect()
    n = _check_pieces(rows, small)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // 2048) + 3


def test_plan_uses_every_piece():
    rng = np.random.default_rng(2)
    for counts in (rng.integers(0, 50, 257), np.eye(257, dtype=int)[100] * 1000, np.zeros(257, int)):
        counts = counts.copy()
        counts[0] = 0
        plan = packing.make_plan(counts, 256)
        used = Counter(a for pattern, n in plan for a in pattern for _ in range(n))
        assert used == Counter({i: int(c) for i, c in enumerate(counts) if c})
        assert all(sum(p) <= 256 for p, _ in plan)


# ---------------------------------------------------------------- shards


def _hilbert(x, bits):
    x, n, q = list(x), len(x), 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_hilbert_index(spark):
    df = spark.range(512).selectExpr("id % 8 AS a", "id div 8 % 8 AS b", "id div 64 AS c")
    rows = shards.with_hilbert(df, [F.col("a"), F.col("b"), F.col("c")], 3, "h").collect()
    assert all(r["h"] == _hilbert((r["a"], r["b"], r["c"]), 3) for r in rows)
    path = [tuple(r)[:3] for r in sorted(rows, key=lambda r: r["h"])]
    assert all(sum(abs(p - q) for p, q in zip(u, v)) == 1 for u, v in zip(path, path[1:]))


def _check_shards(rows, docs, n=16):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(n)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_prune_by_several_columns(spark):
    """Shards whose value ranges meet a filter on size and source, against runs of doc_id."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    rows = docs.select("doc_id", "source", size.cast("long").alias("size")).toPandas()
    shard = QUERIES["op5_hilbert_shards"](spark, sf).select("doc_id", "shard").toPandas()
    rows = rows.merge(shard, on="doc_id")
    rows["by_id"] = rows["doc_id"].rank(method="first").sub(1).mul(16).floordiv(len(rows)).astype(int)
    edges = rows["size"].quantile([i / 8 for i in range(9)]).tolist()

    def opened(column):
        hit = total = 0
        for source in rows["source"].dropna().unique():
            for a, b in zip(edges, edges[1:]):
                inside = rows[(rows["source"] == source) & (rows["size"] >= a) & (rows["size"] < b)]
                hit += inside[column].nunique()
                total += 16
        return hit / total

    curve, by_id = opened("shard"), opened("by_id")
    print("share of shards opened:", round(curve, 3), "by doc_id:", round(by_id, 3))
    assert curve < 0.3 < 0.5 * by_id


def test_shards(spark, edge_docs, small):
    _check_shards(shards.curve_shards(frame(spark, edge_docs)).collect(), edge_docs)
    _check_shards(shards.curve_shards(frame(spark, edge_docs[:5])).collect(), edge_docs[:5])
    _check_shards(QUERIES["op5_hilbert_shards"](spark, SF).collect(), small)
    assert shards.curve_shards(frame(spark, edge_docs).where("false")).count() == 0
    plan = shards.curve_shards(frame(spark, edge_docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- URL lists


def test_temporal_lists(spark):
    captures = spark.createDataFrame(
        [(1, "http://www.Bad.example.com/x", "2024-01-05"), (2, "https://bad.example.com:8080/", "2024-01-10"),
         (3, "http://bad.example.com./", "2024-01-20"), (4, "http://notbad.example.com/", "2024-01-05"), (5, None, "2024-01-05"),
         (6, "no url", "2024-01-05"), (7, "http://u:p@bad.example.com/", None), (1, "http://www.Bad.example.com/x", "2024-01-05"),
         (8, "http://bad.example.com/", "2023-12-31")], "page_id bigint, url string, fetch_day string")
    entries = spark.createDataFrame(
        [("a", "bad.example.com", "add", "2024-01-01"), ("a", "BAD.example.com", "remove", "2024-01-10"),
         ("a", "bad.example.com", "add", "2024-01-20"), ("b", "example.com", "add", "2024-01-05"), ("b", "example.com", "add", "2024-01-06"),
         ("b", "example.com", "remove", "2024-01-06"), (None, "x.com", "add", "2024-01-01"), ("c", "bad.example.com", "add", None)],
        "list string, domain string, action string, day string")
    got = sorted((r["page_id"], r["lists"], r["n_lists"], r["blocked"]) for r in url_lists.judge_captures(captures, entries).collect())
    assert got == [(1, "a,b", 2, True), (1, "a,b", 2, True), (2, "", 0, False), (3, "a", 1, True), (4, "b", 1, True),
                   (5, "", 0, False), (6, "", 0, False), (7, "", 0, False), (8, "", 0, False)]
    none = url_lists.judge_captures(captures, entries.where("false"))
    assert none.count() == 9 and none.where("blocked").count() == 0
    plan = none._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- classifiers


def test_toxicity_held_out(ship):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op1_toxicity_fm"](ship, sf).collect()}
    assert all(r["held_out"] == brute.held_out(d) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for d, r in rows.items())
    labels = [(r["doc_id"], r["toxic"]) for r in ship.read.parquet(f"{sf}/labels.parquet").collect() if brute.held_out(r["doc_id"])]
    hits = [(rows[d]["predicted"], y) for d, y in labels if d in rows]
    assert sum(p and y for p, y in hits) >= 0.75 * sum(y for _, y in hits)
    assert sum(p and not y for p, y in hits) <= 0.01 * len(hits)


def test_toxicity_learns_pairs():
    rng = np.random.default_rng(0)
    slots, y = [], []
    for _ in range(3000):  # toxic only where both terms meet
        a, b = rng.random(2) < 0.5
        slots.append(np.array([10] * int(a) + [20] * int(b) + [int(rng.integers(100, 130))], dtype=np.int64))
        y.append(float(a and b))
    m = toxicity.fit(slots, np.array(y), epochs=20)
    own = np.array([0, 1, 2, 2])
    p = toxicity.sigmoid(m.logits(np.array([10, 20, 10, 20]), own, 3))
    assert p[0] < 0.3 and p[1] < 0.3 and p[2] > 0.7


def test_toxicity_learns_pairs_of_a_neutral_term():
    """A term as frequent in toxic as in clean texts, toxic only beside another."""
    rng = np.random.default_rng(1)
    slots, y = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.3, rng.random() < 0.5
        slots.append(np.array([10] * int(a) + [20] * int(b) + [int(rng.integers(100, 130))], dtype=np.int64))
        y.append(float(a and b or not a and not b and rng.random() < 3 / 7))
    has, y = np.array([20 in s for s in slots]), np.array(y)
    assert abs(y[has].mean() - y[~has].mean()) < 0.03
    m = toxicity.fit(slots, y, epochs=20)
    assert m.place[20] >= 0
    p = toxicity.sigmoid(m.logits(np.array([10, 20, 10, 20]), np.array([0, 1, 2, 2]), 3))
    assert p[0] < 0.3 and p[1] < 0.3 and p[2] > 0.7


def test_toxicity_edge_cases(ship, edge_docs):
    labels = ship.createDataFrame([(i, 1, 0) for i in range(6)] + [(None, 1, 1), (9, 1, None)], "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.where("false")):
        rows = toxicity.score_toxicity(frame(ship, edge_docs), lab).collect()
        assert len(rows) == len(edge_docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(frame(ship, edge_docs).where("false"), labels).count() == 0


def test_language_held_out(ship):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in ship.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_language_cnn"](ship, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == brute.held_out(r["doc_id"]) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_language_edge_cases(ship, edge_docs):
    rows = language.identify_languages(frame(ship, edge_docs + [(77, "123 ...")])).collect()
    assert len(rows) == len(edge_docs) + 1
    for r in rows:
        if r["doc_id"] in (77, 400, 401, 402):
            assert r["lang_pred"] == "und" and r["score"] == 0
    assert {r["lang_pred"] for r in rows} <= {"und", "en"} and all(0 <= r["score"] <= 1 for r in rows)
    none = frame(ship, edge_docs).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify_languages(none).collect()} == {"und"}
    assert language.identify_languages(none.where("false")).count() == 0


def test_repeated_ids_do_not_exceed_the_sample(ship, monkeypatch):
    ids = [i for i in range(40) if not brute.held_out(i)][:10]
    docs = frame(ship, [(i, f"some words number {k} here") for i in ids for k in range(30 if i == ids[0] else 2)])
    docs = docs.withColumn("lang", F.lit("en"))
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda slots, toxic: sizes.append((len(slots), len(toxic))))
    toxicity.train(docs, ship.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, toxic int"), 8)
    monkeypatch.setattr(language, "fit", lambda windows, target, languages: sizes.append((len(windows), len(target))))
    language.train(docs.select("doc_id", "text", "lang"), 8)
    assert sizes == [(8, 8), (8, 8)]


def test_language_scores_are_those_of_a_plain_convolution():
    rng = np.random.default_rng(4)
    net = language.new_network(["a", "b", "c"], rng)
    for b in net.bias:
        b += rng.normal(0, 0.3, b.shape).astype(np.float32)
    texts = ["Hello there, world", "x" * 300, "é" * 70 + " fin", "a b"]
    names, scores = language.classify(net, texts)
    for t, name, score in zip(texts, names, scores):
        data = t.encode()
        data += b" " * (-len(data) % language.WINDOW)
        rows = []
        for at in range(0, len(data), language.WINDOW):
            x = [net.embed[c] for c in data[at:at + language.WINDOW]]
            hidden = []
            for w, filters, bias in zip(language.WIDTHS, net.filters, net.bias):
                for f in range(language.FILTERS):
                    top = max(
                        sum(float(v) * float(q) for v, q in zip(np.concatenate(x[i:i + w]), filters[:, f]))
                        for i in range(language.WINDOW - w + 1)  # every byte position
                    )
                    hidden.append(max(0.0, top + float(bias[f])))
            z = np.array(hidden) @ net.dense + net.out
            rows.append(np.exp(z - z.max()) / np.exp(z - z.max()).sum())
        mean = np.mean(rows, axis=0)
        assert name == net.languages[int(mean.argmax())] and abs(score - mean.max()) < 1e-4


def test_a_rare_language_is_learned(ship, monkeypatch):
    rnd = random.Random(1)
    common = ["the", "house", "green", "and", "walks", "under", "bright", "sky"]
    rare = ["zxq", "qvz", "xxzq", "vqqx", "zzvx"]
    say = lambda words: " ".join(rnd.choices(words, k=30))
    ids = [i for i in range(9000) if not brute.held_out(i)][:4030]
    docs = [(i, say(rare if k < 30 else common), "xx" if k < 30 else "en") for k, i in enumerate(ids)]
    docs += [(100_000 + i, say(rare), None) for i in range(5)]
    table = ship.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(4)
    monkeypatch.setattr(language, "MAX_PER_LANGUAGE", 100)
    net = language.train(table, 120, 100)
    assert net.languages == ["en", "xx"]
    names, _ = language.classify(net, [t for i, t, _ in docs if i >= 100_000])
    assert set(names) == {"xx"}


def test_short_items_leak_with_their_edits():
    rnd = random.Random(12)
    vocab = ["".join(rnd.choices("abcdef", k=4)) for _ in range(9)]
    say = lambda n: rnd.choices(vocab, k=n)
    items = [(10 * n + k, say(n)) for n in range(1, 13) for k in range(4)]
    texts = [say(rnd.randint(0, 40)) for _ in range(150)]
    for _, item in items:  # copies with one word changed, added or left out
        w, at = list(item), rnd.randrange(len(item))
        texts.append(say(6) + w[:at] + ["new"] + w[at + 1:] + say(6))
        texts.append(say(6) + w[:at] + ["new"] + w[at:] + say(6))
        texts.append(w[:at] + w[at + 1:])
    index = decontam.ItemIndex([(i, " ".join(w)) for i, w in items])
    got = {(t, i): d for t, i, d, _, _ in decontam.find_leaks([" ".join(t).upper().encode() for t in texts], index)}
    want = {}
    for t, text in enumerate(texts):
        for i, w in items:
            d = brute.edit_distance_in(w, text)
            if d <= decontam.edits_allowed(len(w)):
                want[t, i] = d
    short = {k: d for k, d in want.items() if k[1] < 80}
    assert {k: d for k, d in got.items() if k[1] < 80} == short and len(short) > 100
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want)


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(ship, edge_docs, tmp):
    import corpus_pipeline

    ship.createDataFrame([(0, edge_docs[20][1])], "item_id bigint, text string").write.parquet(f"{tmp}/benchmark.parquet")
    prose = [(d, (t or "").replace("changed", "changed now")) for d, t in edge_docs]
    docs = frame(ship, [(d, t) for d, t in prose] + [(600, edge_docs[22][1] + " password=abcdefgh123 end.")])
    docs.write.parquet(f"{tmp}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_leaks", "secrets", "packing"]
    got = ship.read.parquet(f"{tmp}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in got.collect()]
        out = stage(ship, got, tmp)
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(f"{tmp}/{name}")
        got = ship.read.parquet(f"{tmp}/{name}")
        rows = got.collect()
        if name == "quality_rules":
            assert sorted((r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None) == sorted(
                (d, quality.judge(t)[-1]) for d, t in before if quality.judge(t)[6] and d is not None)
        elif name == "near_duplicates":
            want = {c for _, _, c in brute.jaccard_components(before) if c is not None}
            assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(want)
        elif name == "benchmark_leaks":
            item = edge_docs[20][1].split()
            clean = [d for d, t in before if brute.edit_distance_in(item, t.lower().split()) > decontam.edits_allowed(len(item))]
            assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, clean))
        elif name == "secrets":
            assert len(rows) == len(before) and not any("password=" in r["text"] for r in rows)
        else:
            _check_pieces(rows, before)
    ship.createDataFrame([], "item_id bigint, text string").write.mode("overwrite").parquet(f"{tmp}/benchmark.parquet")
    docs.where("false").write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
    assert corpus_pipeline.run(ship, tmp).count() == 0


def shared_line_docs(n, seed=3):
    """One 88-byte line in every document, random bytes around it."""
    rnd = random.Random(seed)
    noise = lambda k: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    line = noise(88)
    return [(i, noise(rnd.randint(0, 70)) + line + noise(rnd.randint(0, 70))) for i in range(n)]


def test_repeats_around_a_line_of_every_document(ship, monkeypatch):
    docs = shared_line_docs(400) + [(1000 + i, "ab" * 90 + str(i)) for i in range(40)] + [(2000 + i, "z" * 300) for i in range(5)]
    monkeypatch.setattr(repeats, "HOT", 30)
    rows = repeats.base_docs(frame(ship, docs)).select(
        "doc_id", F.pmod(F.xxhash64("text"), F.lit(1 << 32)).alias("key"), F.col("text").cast("binary").alias("text"))
    hot = repeats.hot_grams(rows, 100_000)
    assert len(hot) >= 3
    got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.remove_repeats(frame(ship, docs)).collect()}
    assert got == {d: v for (d, _), v in brute.repeats(docs).items()}


def test_repeats_of_a_hot_gram_are_dealt_over_all_buckets():
    docs = shared_line_docs(3000)
    ids, texts = np.arange(len(docs)), [t.encode() for _, t in docs]
    (owner, place, parts), = repeats._segments(texts)
    s = repeats.Stretches(parts)
    gram, n = np.unique(s.least, return_counts=True)
    hot = np.sort(gram[n > 100])

    def largest(hot):
        batch = repeats._deal_batch(16, 4, hot, ids, ids, np.array(owner), np.array(place), parts)
        sizes = [0] * 16
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if data is not None:
                count = repeats.unpack("qiiibibb", data)[5]
                sizes[bucket] += int(count.sum())
        return sizes

    before, after = largest(np.zeros(0, dtype=repeats.U64)), largest(hot)
    # far below one bucket's share of the suffixes around the line
    assert max(after) < 1.3 * sum(after) / 16 < max(before)


def test_large_groups_are_ordered_in_pieces(monkeypatch):
    texts = [t.encode() for _, t in shared_line_docs(200)]
    buf = np.frombuffer(b"".join(texts) + b"\0" * 8, dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    at = np.concatenate([np.arange(e - len(t), e - 49) for e, t in zip(ends, texts)])
    doc = np.repeat(np.arange(200), [len(t) - 49 for t in texts])
    whole = repeats.longest_previous_factor(buf, at, doc)
    monkeypatch.setattr(repeats, "CHUNK", 500)
    pieces = list(repeats._pieces(buf, at))
    assert len(pieces) > 20 and max(map(len, pieces)) < 3 * 500
    assert np.array_equal(np.sort(np.concatenate(pieces)), np.arange(len(at)))
    got = np.zeros(len(at), dtype=np.int64)
    for p in pieces:
        got[p] = repeats.longest_previous_factor(buf, at[p], doc[p])
    assert np.array_equal(got, whole)


def test_a_bucket_is_opened_in_parts(monkeypatch):
    rnd = random.Random(5)
    noise = lambda k: bytes(rnd.choices(range(97, 123), k=k))
    shared = [noise(rnd.randint(50, 300)) for _ in range(50)]
    texts = [noise(2000) + rnd.choice(shared) + noise(rnd.randint(0, 60)) for _ in range(800)]
    tables = []
    for lo in range(0, len(texts), 20):
        ids = np.arange(lo, lo + 20)
        (owner, place, parts), = repeats._segments(texts[lo:lo + 20])
        tables.append(repeats._deal_batch(1, 1, np.zeros(0, dtype=repeats.U64), ids, ids, np.array(owner), np.array(place), parts))
    table = pa.Table.from_batches(tables)
    size = sum(zstandard.frame_content_size(x) for x in table.column("stretches").drop_null().to_pylist())

    def marked(part_bytes):
        monkeypatch.setattr(repeats, "PART_BYTES", part_bytes, raising=False)
        tracemalloc.start()
        out = repeats._mark_bucket(table, 1)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        marks = [np.concatenate(x) for x in zip(*(repeats.unpack("qiii", m) for m in out.column("marks").to_pylist()))]
        return sorted(zip(*(x.tolist() for x in marks))), peak

    whole, _ = marked(size)
    got, peak = marked(size // 20)
    assert got == whole
    # the first document with a passage keeps it, the others lose it
    first, want = set(), set()
    for d, t in enumerate(texts):
        grams = [t[p:p + 50] for p in range(len(t) - 49)]
        want |= {(d, p) for p, g in enumerate(grams) if g in first}
        first.update(grams)
    covered = {(d, x) for d, p in want for x in range(p, p + 50)}
    assert covered and {(d, x) for d, _, a, b in got for x in range(a, b)} == covered
    assert peak < size


def test_repeats_do_not_rest_on_equal_keys(ship, edge_docs, monkeypatch):
    monkeypatch.setattr(repeats.Stretches, "content_keys", lambda self: np.zeros(len(self.start), dtype=repeats.U64))
    docs = [d for d in edge_docs if d[0] is not None]
    batches = list(repeats._segments([(t or "").encode() for _, t in docs]))
    ids = np.array([d for d, _ in docs])
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], d), d)
    for owner, place, parts in batches:
        out = repeats._deal_batch(2, 2, np.zeros(0, dtype=repeats.U64), ids, np.arange(len(ids)), np.array(owner), np.array(place), parts)
        for marks in out.column(3).to_pylist():
            if marks is not None:
                for d, k, a, b in zip(*repeats.unpack("qiii", marks)):
                    text = (docs[k][1] or "").encode()
                    assert all(first[text[p:p + 50]] < d for p in range(a, b - 49))


def test_equal_spans_are_compared_byte_by_byte():
    buf = np.frombuffer(b"abcdefghijXabcdefghijYabcdefghiZ" + b"\0" * 16, dtype=np.uint8)
    a, b = np.array([0, 0, 0]), np.array([11, 11, 22])
    assert repeats.same_bytes(buf, a, b, np.array([10, 11, 10])).tolist() == [True, False, False]


def test_near_duplicates_with_any_column_names(ship, edge_docs):
    docs = frame(ship, edge_docs)
    names = ("gone", "gone_id", "text_key", "__mark", "row", "root", "component_id")
    extra = docs.select("*", *[(F.col("n") + 1).alias(name) for name in names])
    kept = jaccard.keep_one_each(extra)
    assert kept.columns == extra.columns
    rows = kept.collect()
    assert all(r[name] == r["n"] + 1 for r in rows for name in names)
    assert max(Counter((r["doc_id"], r["text"]) for r in rows).values()) == 1
    # doc 410 is a copy of 2 in one row, and a text of its own in the other: only that stays
    assert [r["text"] for r in rows if r["doc_id"] == 410] == [edge_docs[-1][1]]


def test_near_duplicates_pick_one_row_whatever_the_order(ship):
    docs = [(1, "a b c d e f g h")] * 3
    rows = [(d, t, "en", "s", 15, float(i), i, "k") for i, (d, t) in enumerate(docs)]
    from conftest import SCHEMA

    for order in (rows, rows[::-1]):
        kept = jaccard.keep_one_each(ship.createDataFrame(order, SCHEMA).repartition(3)).collect()
        assert [r["n"] for r in kept] == [0]
