"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from snapkeep.llm import conversations as cv
from snapkeep.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gone string, again int, digest double"


def plain(rows):
    """{conv_id: result} by a table over (row, state), each cell the least (cost, audit, lines)."""
    by = {}
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        mine = by.setdefault(c, [])
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        mine += [(t, r, x)] * (2 if kind == 3 else 1)
    out = {}
    for c, mine in by.items():
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode()))
        seen, faults = set(), []
        for _, r, x in mine:
            body = re.sub(r"[\x20\x09-\x0D]", "", x)
            faults.append("b" if not body else "d" if (r, x) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        follow = {"": "us", "s": "u", "u": "a", "a": "u"}

        @functools.cache
        def best(i, last, inserts):
            """Least (cost, audit, lines) from row i on, by trying every edit."""
            found = []
            if i == len(mine):
                if last in ("", "a"):
                    found.append((0, "", ()))
            else:
                _, r, x = mine[i]
                rest = best(i + 1, last, 3)
                if rest:
                    found.append((2 + rest[0], "D" + rest[1], rest[2]))
                if faults[i] not in ("b", "d"):
                    extra = 5 if faults[i] == "t" else 0
                    for op, cost, role in [("K", 0, r), ("R", 1, "user"), ("R", 1, "assistant")]:
                        if role[:1] and role[:1] in follow[last]:
                            rest = best(i + 1, role[0], 3)
                            if rest:
                                found.append((cost + extra + rest[0], op + rest[1], (f"{role}:{x}", *rest[2])))
            if inserts:
                for role in ("user", "assistant"):
                    if role[0] in follow[last]:
                        rest = best(i, role[0], inserts - 1)
                        if rest:
                            found.append((5 + rest[0], "I" + rest[1], (role + ":", *rest[2])))
            return min(found, key=lambda f: f[:2]) if found else None

        cost, audit, lines = best(0, "", 3)
        turns = [t for t, _, _ in mine if t is not None]
        pairs = [(a[1][:1], b[1][:1]) for a, b in zip(mine, mine[1:])]
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in [("s", "u"), ("u", "a"), ("a", "u")] for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), len(mine),
        )
    return out


def results(df):
    rows = df.collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA).repartition(3)


def made(n, seed):
    rnd = random.Random(seed)
    texts = ["Hello there.", "What?", "cut off", " ", "", "Yes!", None, "Done. \n", "é…", "a", "b.", "c."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "usher"]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            turn = rnd.choice([t, t, t, t * 2, None])
            text = rnd.choice(texts) if rnd.random() < 0.6 else f"Text {rnd.random()}."
            rows.append((c if c % 17 else None, turn, rnd.choice(roles) if rnd.random() < 0.5 else ["user", "assistant"][t % 2], text))
    return rows


@pytest.mark.parametrize("block", [1, 3, cv.BLOCK])
def test_equals_trying_every_edit(ship, monkeypatch, block):
    rows = made(300, block)
    expected = plain(rows)
    local = {}
    ordered = cv.in_order(cv.damage(frame(ship, rows))).collect()
    import pyarrow as pa

    monkeypatch.setattr(cv, "BLOCK", block)
    by_id = sorted(range(len(ordered)), key=lambda i: (ordered[i][0] is not None, ordered[i][0] or 0, i))
    columns = list(zip(*[ordered[i] for i in by_id]))
    names = ["conv_id", "turn", "role", "text", "gone", "twice", "again"]
    for out in cv._repair(iter([pa.RecordBatch.from_pydict({k: list(c) for k, c in zip(names, columns)})])):
        for r in zip(*[c.to_pylist() for c in out.columns]):
            local[r[0]] = r[1:]
    assert local == expected


def test_query_on_frames(ship):
    rows = made(150, 9)
    assert results(cv.repair_conversations(frame(ship, rows))) == plain(rows)


def test_query_on_the_table(ship):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in ship.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = results(QUERIES["op13_conversation_repair"](ship, d))
    assert got == plain(rows)
    assert all(re.fullmatch("[DIKR]*", g[6]) for g in got.values())


def test_empty_and_all_dropped(ship):
    assert cv.repair_conversations(frame(ship, [])).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = results(cv.repair_conversations(frame(ship, [(5, turn, "user", "Hi.")])))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)}


def test_long_conversation_and_long_text(ship):
    n = 20000
    rows = ship.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    one = ship.createDataFrame([(2, 0, "user", "x" * 300000 + "."), (2, 1, "assistant", "ok.")], rows.schema)
    got = results(cv.repair_conversations(rows.union(one)))
    assert got[1][8] > 0.9 * n and len(got[1][6]) >= got[1][8]
    assert got[2] == plain([(2, 0, "user", "x" * 300000 + "."), (2, 1, "assistant", "ok.")])[2]


def test_one_shuffle(ship):
    plan = cv.repair_conversations(ship.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
