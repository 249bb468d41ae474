"""Conversation repair against a plain search over all edits, on small fixtures and the given tables."""
import hashlib
import heapq
import random
import zlib

import pytest

from lakeshore.llm import turns
from lakeshore.llm.common import table

from .cases import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """(cost, audit, lines): Dijkstra over (rows done, state), ordered by cost and then audit. ``rows``: (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, r, state, lines = heapq.heappop(heap)
        if (r, state) in done:
            continue
        done.add((r, state))
        if r == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        nxt = "a" if state == "u" else "u"
        word = {"u": "user", "a": "assistant"}[nxt]
        heapq.heappush(heap, (cost + 5, audit + "I", r, nxt, (*lines, word + ":")))
        if r < len(rows):
            role, text, fault = rows[r]
            heapq.heappush(heap, (cost + 2, audit + "D", r + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] == nxt or (state == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + more, audit + "K", r + 1, role[:1], (*lines, f"{role}:{text}")))
                if role[:1] != nxt:
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", r + 1, nxt, (*lines, f"{word}:{text}")))


def expected(rows):
    """The contract's row for the damaged rows (turn, role, text) of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))
    seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")
        f = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(f)
        if f:
            counts[f] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    told = [t for t, _, _ in rows if t is not None]
    gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
    cost, audit, lines = cheapest([(r, x, f) for (_, r, x), f in zip(rows, faults, strict=True)])
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256(lines.encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(told).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def grouped(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


def answers(report, texts):
    sha = {r.conv_id: r.repaired_sha256 for r in turns.digests(texts).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    rows = report.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sha.get(r.conv_id, empty)) for r in rows}


ROLES = ["user", "assistant", "system", "tool", "", None, "usher", "Assistant"]
TEXTS = ["Yes.", "No!", "why", " \n", "", None, "Hm?  ", "é", "end. ", "a\x0b"]


def fuzz(n, longest, seed):
    rnd = random.Random(seed)
    return [(c if c else None, rnd.choice([None, *range(9)]) if rnd.random() < 0.2 else t, rnd.choice(ROLES[:rnd.choice([2, 3, 8])]),
             rnd.choice(TEXTS) if rnd.random() < 0.4 else f"text {rnd.randint(0, 12)}.")
            for c in range(n) for t in range(rnd.randint(1, longest))]


@pytest.mark.parametrize("block", [1, 2, 3, 16])
def test_tables_of_every_pattern(block, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK_ROWS", block)
    rnd, solver = random.Random(block), turns.Solver()
    of = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in [0, 1, 1, 2, 3, 4, 5, 6, 9, 13, 20] * 12:
        pattern = "".join(rnd.choice("suaSUAoOxuaua") for _ in range(n))
        rows = [(of.get(p.lower(), "user"), str(i), "blank" if p == "x" else "truncated" if p.isupper() else "") for i, p in enumerate(pattern)]
        cost, audit, lines = cheapest(rows)
        assert turns.best(solver.table(pattern)) == (cost, audit), pattern
        assert turns.repaired(audit, turns.START, [r[0] for r in rows], [r[1] for r in rows])[0] == lines


@pytest.mark.parametrize("chunk,block", [(512, 16), (5, 2), (1, 1)])
def test_fuzz(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(turns, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(turns, "BLOCK_ROWS", block)
    rows = fuzz(60, 14, chunk) + [(99, t % 7, "user", f"x{t % 3}.") for t in range(150)] + [(98, None, "user", "Same.")] * 40
    got = answers(*turns.repair(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == {c: expected(r) for c, r in grouped(rows).items()}


def test_small_chunks_by_size(spark, monkeypatch):
    monkeypatch.setattr(turns, "CHUNK_CHARS", 300)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "long " * 50 + ".") for t in range(30)]
    got = answers(*turns.repair(spark.createDataFrame(rows, SCHEMA)))
    assert got == {1: expected([r[1:] for r in rows])} and got[1][6] == "K" * 30


def test_damage_and_query_on_the_tables(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    after = grouped(damage(rows))
    want = {c: expected(after.get(c, [])) for c in grouped(rows)}
    got = {r.conv_id: tuple(r)[1:] for r in turns.query(spark, SF).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == want


def test_damage_of_odd_rows(spark):
    rows = fuzz(80, 6, 5)
    got = sorted(map(tuple, turns.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(damage(rows), key=repr)


def test_empty_and_other_columns(spark):
    report, texts = turns.repair(spark.createDataFrame([], SCHEMA))
    assert report.count() == 0 and texts.count() == 0
    named = spark.createDataFrame([("c", 1, "user", "Hi.", 5, 6)], "talk string, n bigint, who string, said string, part bigint, audit bigint")
    report, texts = turns.repair(named, "talk", "n", "who", "said")
    assert [tuple(r) for r in report.collect()] == [("c", 0, 0, 0, 0, 0, 2, "D")] and texts.count() == 0
    with pytest.raises(ValueError):
        turns.repair(named, "part")
