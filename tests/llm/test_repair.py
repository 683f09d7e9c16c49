"""Conversation repair against a cheapest-path search over edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from chatloom.llm import repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(turns):
    """(cost, audit, roles of what stays) over turns (initial, must go, truncated), by Dijkstra in the order of (cost, audit)."""
    heap, seen = [(0, "", 0, 0, "")], set()
    while heap:
        cost, audit, i, state, roles = heapq.heappop(heap)
        if i == len(turns) and state in (0, 3):
            return cost, audit, roles
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i < len(turns):
            initial, must, truncated = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, roles))
            if not must:
                for r, to in NEXT[state].items():
                    if r == initial:
                        heapq.heappush(heap, (cost + 5 * truncated, audit + "K", i + 1, to, roles + r))
                    if r != "s":
                        heapq.heappush(heap, (cost + 1 + 5 * truncated, audit + "R", i + 1, to, roles + r))
        for r, to in NEXT[state].items():
            if r != "s":
                heapq.heappush(heap, (cost + 5, audit + "I", i, to, roles + r))


def plain(rows):
    """The contract's figures of one conversation's (turn, role, text) after damage."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:32], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        last = WORD.findall(text)[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "-" if last[0] in ".!?" else "t")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, roles = cheapest([(i, f in "bd", f == "t") for i, f in zip(initials, faults)])
    lines, i, roles = [], 0, list(roles)
    for edit in audit:
        if edit != "D":
            r = roles.pop(0)
            name = {"u": "user", "a": "assistant"}.get(r)
            lines.append(f"{rows[i][1] if edit == 'K' else name}:{rows[i][2] if edit != 'I' else ''}")
        i += edit != "I"
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def test_cells_equal_a_cheapest_path():
    rng, short = random.Random(5), repair.Short()
    for _ in range(3000):
        symbols = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 14)))
        turns = [(c.lower(), c == "x", c.isupper()) for c in symbols]
        cost, audit, roles = cheapest(turns)
        assert repair.best(repair.parsed(symbols, short)) == (cost, audit)
        assert "".join(r for _, _, r in repair.edited(symbols, audit, 0)) == roles
        cuts = sorted(rng.sample(range(1, len(symbols)), min(len(symbols) - 1, rng.randint(0, 3))))
        blocks = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        parts = list(repair.slices(audit, blocks))
        assert "".join(p for p, _ in parts) == audit
        assert "".join(r for b, (p, s) in zip(blocks, parts) for _, _, r in repair.edited(b, p, s)) == roles
        # every way to split a span gives the same cells
        k = rng.randint(1, len(symbols))
        halves = [repair.parsed(x, short) for x in (symbols[:k], symbols[k:]) if x]
        assert repair.combined(halves) == repair.parsed(symbols, short)


def checked(found, rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r, x))
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.digests(found.turns).collect()}
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, hashlib.sha256(b"").hexdigest())) for r in found.audits.collect()}
    assert got == {c: plain(x) for c, x in by.items()}


@pytest.mark.parametrize("block,fan", [(12, 6), (1, 1)])
def test_repair_of_odd_rows(spark, monkeypatch, block, fan):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "FAN", fan)
    rng = random.Random(block)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "agent", "ü", "user"], ["Yes.", "No", " ", "", None, "a\nb!\n ", "中。", "x" * 5000 + ".", "é?", "word"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, 3, 4, 9, None]), rng.choice(roles), rng.choice(texts)) for _ in range(60)]
    rows += [(7, i, "user" if i % 2 else "assistant", f"line {i % 40}" + "." * (i % 3)) for i in range(90)] + [(8, 5, "user", "same.")] * 40 + [(9, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, _c string")
    checked(repair.repair(df.repartition(5)), rows)


def test_no_rows(spark):
    found = repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.audits.collect() == [] and found.turns.collect() == [] and repair.digests(found.turns).collect() == []


def test_damage(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3, 4, 5) for t in (None, 0, 1, 2, 3, 4, 5, 6) for r, x in (("assistant", "A. B! C?"), (None, None))]
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if r is None else r, " " if x is None else x
        new = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [new] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
