"""Conversation structure repair: weighted CYK interval parsing of a conversation's turns with a repair grammar.

A repaired conversation reads ``(s?(ua)+)?`` in the initials of its roles. The grammar in Chomsky normal form has a nonterminal ``pq`` for each two states of
that pattern (start, after s, after u, after a): ``pq`` covers a span of turns whose edits lead from p to q, ``pr -> pq qr`` joins neighbouring spans, and
single turns are kept (0), given another role (1), or deleted (2, the only edit of a blank or duplicate turn); a truncated turn that stays adds 5. A new turn
(5) covers no turn: its nonterminals are closed over each other (at most two in a row pay) and joined to the left of each turn and to the end of the whole.
A cell is the minimum (cost, audit) of its nonterminal over its span, where the audit is the initials of the edits (Keep, Rerole, Delete, Insert).

Equal costs over equal spans never belong to audits of which one begins the other (they hold as many letters other than I, so the longer has more inserts
and costs more); so minima of parts make minima of wholes. And as every state lies between two spans, each way to split a span gives the same cell. The chart
therefore needs the aligned spans only: cells are combined bottom-up by span length, 1, 2, 4, ..., inside blocks of turns, and the blocks' cells in rounds of
``FAN`` neighbours. A conversation of any length is dealt over many tasks; the best audit is cut back into blocks, which write the repaired turns.

Turns are ordered by ``order`` (nulls first), then by the first 32 characters of the role, then by the MD5 of role and text. Equal turns are counted before
they are shuffled. The texts themselves are read for the repaired turns only.

Edge cases: nulls in role and text are one space; a null key is a conversation of its own; nulls in ``order`` come first and leave the gaps alone; equal rows are
duplicates; turns of any length pass; an empty table gives empty results. Only the key and the results are returned, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import WORD, cut

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# nonterminals that derive anything, and where a turn of each initial leads
PAIRS = tuple((p, q) for p in range(4) for q in range(4) if q >= p and (p, q) != (ASSISTANT, START) or (p, q) == (ASSISTANT, USER))
NUMBER = {pq: i for i, pq in enumerate(PAIRS)}
RULES = tuple(tuple((NUMBER[p, q], NUMBER[q, r]) for q in range(4) if (p, q) in NUMBER and (q, r) in NUMBER) for p, r in PAIRS)
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
ROLES = {"u": "user", "a": "assistant"}
BLOCK, FAN = 12, 6  # bits: a block is a run of 4096 places, and 64 neighbours are combined in a round

Cells = tuple  # (cost, audit) or None for each nonterminal of PAIRS
CELLS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
CELLS_SQL = "array<struct<cost: long, audit: string>>"


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans as one."""
    out = []
    for rules in RULES:
        low, best = None, None
        for x, y in rules:
            a, b = left[x], right[y]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if low is None or cost < low:
                low, best = cost, a[1] + b[1]
            elif cost == low:
                best = min(best, a[1] + b[1])
        out.append(None if low is None else (low, best))
    return tuple(out)


def closure() -> Cells:
    """Spans without a turn: nothing, or new turns."""
    cells = [None] * len(PAIRS)
    for p in range(4):
        cells[NUMBER[p, p]] = (0, "")
    for role in ROLES:
        for pq in STEPS[role]:
            cells[NUMBER[pq]] = (INSERT, "I")
    while (more := joined(tuple(cells), tuple(cells))) != tuple(cells):
        cells = more
    return tuple(cells)


INSERTED = closure()


def turn(symbol: str) -> Cells:
    """Cells of one turn: the initial of its role (o: another), a capital where it is truncated, x where it must go."""
    cells = [None] * len(PAIRS)
    for p in range(4):
        cells[NUMBER[p, p]] = (DELETE, "D")
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for role, cost, edit in (("u", REROLE, "R"), ("a", REROLE, "R"), (symbol.lower(), KEEP, "K")):
            for pq in STEPS.get(role, ()):
                new, old = (extra + cost, edit), cells[NUMBER[pq]]
                cells[NUMBER[pq]] = new if old is None else min(old, new)
    return joined(INSERTED, tuple(cells))


class Short(dict):
    """Cells of runs of a few turns, remembered; there are few kinds of turns."""

    MOST = 1 << 13

    def __missing__(self, symbols: str) -> Cells:
        half = len(symbols) // 2
        cells = joined(self[symbols[:half]], self[symbols[half:]]) if half else turn(symbols)
        if len(self) < self.MOST:
            self[symbols] = cells
        return cells


def combined(spans: list[Cells]) -> Cells:
    """Neighbouring spans, joined two by two until one is left."""
    while len(spans) > 1:
        spans = [joined(spans[i], spans[i + 1]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def parsed(symbols: str, short: Short) -> Cells:
    """Cells over a run of turns."""
    return combined([short[symbols[i : i + 8]] for i in range(0, len(symbols), 8)])


def best(cells: Cells) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    whole = joined(cells, INSERTED)
    return min(x for x in (whole[NUMBER[START, START]], whole[NUMBER[START, ASSISTANT]]) if x is not None)


AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def edited(symbols: str, edits: str, state: int) -> Iterator[tuple[int, str, str]]:
    """(number of the turn, edit, initial of its role) of what stays of a run of turns; an insert has the number of the next turn."""
    i = 0
    for edit in edits:
        if edit != "D":
            role = "s" if edit == "K" and symbols[i] in "sS" else "a" if state == USER else "u"
            yield i, edit, role
            state = AFTER[role]
        i += edit != "I"


def slices(audit: str, blocks: list[str]) -> Iterator[tuple[str, int]]:
    """The audit cut into the edits of each block, with the state before it. Inserts go with the turn they stand before, those at the end with the last block."""
    at, state = 0, START
    for k, symbols in enumerate(blocks):
        end, turns = at, 0
        while turns < len(symbols):
            turns += audit[end] != "I"
            end += 1
        edits = audit[at:] if k + 1 == len(blocks) else audit[at:end]
        yield edits, state
        for _, _, role in edited(symbols, edits, state):
            state = AFTER[role]
        at = end


class Repaired(NamedTuple):
    audits: DataFrame  # key, gaps, blank, duplicate, truncated, illegal, cost, audit: a row per key that has turns
    turns: DataFrame  # key, place, seq, role, text, edit: the repaired turns, in the order of (place, seq) inside a key


def narrow_turns(rows: DataFrame) -> DataFrame:
    """Equal turns counted: _c, _t, _role, _d (MD5 of role and text), _fault (blank, truncated or none), _n, and _again: the first of them is a duplicate."""
    last = F.regexp_extract("_text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~F.col("_text").rlike(WORD), F.lit("b")).when(last.isin(".", "!", "?"), F.lit("-")).otherwise(F.lit("t"))
    found = cut(rows.withColumn("_fault", fault).groupBy("_c", "_t", "_role", "_d", "_fault").agg(F.count(F.lit(1)).alias("_n")))
    place = F.struct(F.col("_t").isNotNull().alias("known"), F.col("_t").alias("t"))
    first = found.groupBy("_c", "_d").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_m")).filter("_m > 1").drop("_m")
    return found.join(first, ["_c", "_d"], "left").withColumn("_again", F.col("_first").isNotNull() & ~place.eqNullSafe(F.col("_first"))).drop("_first")


def placed(narrow: DataFrame) -> DataFrame:
    """``_place``: numbers that grow in the order of the turns of a key. Ranges of the order are dealt over the tasks, so a key may lie in many."""
    order = ["_c", F.col("_t").asc_nulls_first(), F.substring("_role", 1, 32), "_d"]
    return cut(narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))


def in_blocks(turns: DataFrame) -> DataFrame:
    """(_c, _block, turns): the turns of a key at neighbouring places, at most 4096 kinds of equal ones, in order."""
    one = F.struct("_place", "_t", "_role", "_d", "_n", "_symbol")
    return cut(turns.groupBy("_c", F.shiftright("_place", BLOCK).alias("_block")).agg(F.array_sort(F.collect_list(one)).alias("turns")))


def symbols_of(turns: list[dict]) -> str:
    return "".join(t["_symbol"] + "x" * (t["_n"] - 1) for t in turns)


def charts(blocks: DataFrame) -> DataFrame:
    """(_c, _block, symbols, illegal, first, last, cells) of every block: its cells, its illegal pairs, and the initials at its ends."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = Short()
        for part in parts:
            out = {"symbols": [], "illegal": [], "first": [], "last": [], "cells": []}
            for turns in part.column("turns").to_pylist():
                initials = [t["_role"][:1] for t in turns]
                out["symbols"].append(symbols_of(turns))
                out["illegal"].append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])) + sum(t["_n"] - 1 for t in turns))
                out["first"].append(initials[0])
                out["last"].append(initials[-1])
                out["cells"].append(written(parsed(out["symbols"][-1], short)))
            columns = [part.column("_c"), part.column("_block"), *[pa.array(out[n], pa.int64() if n == "illegal" else CELLS if n == "cells" else pa.string()) for n in out]]
            yield pa.RecordBatch.from_arrays(columns, ["_c", "_block", *out])

    return cut(blocks.mapInArrow(batches, f"_c string, _block long, symbols string, illegal long, first string, last string, cells {CELLS_SQL}"))


def written(cells: Cells) -> list[dict | None]:
    return [x and {"cost": x[0], "audit": x[1]} for x in cells]


def read(cells: list[dict | None]) -> Cells:
    return tuple(x and (x["cost"], x["audit"]) for x in cells)


def whole(spans: DataFrame) -> DataFrame:
    """(_c, illegal, cost, audit): the cells of blocks combined by ever longer spans until every key has its few left, and then its best repair."""
    spans = spans.select("_c", "_block", "illegal", "first", "last", "cells")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = {"illegal": [], "first": [], "last": [], "cells": []}
            for near in part.column("spans").to_pylist():
                out["illegal"].append(sum(x["illegal"] for x in near) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(near, near[1:])))
                out["first"].append(near[0]["first"])
                out["last"].append(near[-1]["last"])
                out["cells"].append(written(combined([read(x["cells"]) for x in near])))
            columns = [part.column("_c"), part.column("_block"), *[pa.array(out[n], pa.int64() if n == "illegal" else CELLS if n == "cells" else pa.string()) for n in out]]
            yield pa.RecordBatch.from_arrays(columns, ["_c", "_block", *out])

    def final(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [best(read(x)) for x in part.column("cells").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_c"), part.column("illegal"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                ["_c", "illegal", "cost", "audit"],
            )

    done = []
    while True:
        # the few keys that reach beyond one block go on
        open_ = cut(spans.groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
        most = open_.agg(F.max("_n")).first()[0]
        done.append(spans if most is None else spans.join(open_.select("_c"), "_c", "left_anti"))
        if most is None:
            return reduce(DataFrame.unionByName, done).mapInArrow(final, "_c string, illegal long, cost long, audit string")
        by = F.lit(0).cast("long") if most <= 1 << FAN else F.shiftright("_block", FAN)
        near = spans.join(open_.select("_c"), "_c", "left_semi").groupBy("_c", by.alias("_block")).agg(F.array_sort(F.collect_list(F.struct("_block", "illegal", "first", "last", "cells"))).alias("spans"))
        near = near.mapInArrow(batches, f"_c string, _block long, illegal long, first string, last string, cells {CELLS_SQL}")
        spans = cut(near)


def kept_turns(blocks: DataFrame, symbols: DataFrame, audits: DataFrame) -> DataFrame:
    """(_c, place, seq, edit, _new, _t, _role, _d) of the turns that stay and of the new ones; _new is the role if it is not the turn's own."""

    def cuts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, numbers, edits, states = [], [], [], []
            for key, spans, audit in zip(*(part.column(n).to_pylist() for n in ("_c", "spans", "audit"))):
                for x, (part_, state) in zip(spans, slices(audit, [x["symbols"] for x in spans])):
                    keys.append(key)
                    numbers.append(x["_block"])
                    edits.append(part_)
                    states.append(state)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int64()), pa.array(edits, pa.string()), pa.array(states, pa.int32())], ["_c", "_block", "edits", "state"])

    def stays(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("place", pa.int64()), ("seq", pa.int32()), ("edit", pa.string()), ("_new", pa.string()), ("turn", pa.int32())])
        for part in parts:
            out = []
            for turns, edits, state in zip(*(part.column(n).to_pylist() for n in ("turns", "edits", "state"))):
                symbols = symbols_of(turns)
                own = [k for k, t in enumerate(turns) for _ in range(t["_n"])]
                seq, items = {}, []
                for i, edit, role in edited(symbols, edits, state):
                    k = own[min(i, len(own) - 1)]
                    n = seq[k] = seq.get(k, -1) + 1
                    items.append({"place": turns[k]["_place"], "seq": n, "edit": edit, "_new": None if edit == "K" else ROLES[role], "turn": None if edit == "I" else k})
                out.append(items)
            yield pa.RecordBatch.from_arrays([part.column("_c"), part.column("turns"), pa.array(out, pa.list_(kind))], ["_c", "turns", "items"])

    spans = symbols.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct("_block", "symbols"))).alias("spans")).join(audits.select("_c", "audit"), "_c")
    parts = spans.mapInArrow(cuts, "_c string, _block long, edits string, state int")
    turn_type = blocks.schema["turns"].dataType.simpleString()
    items = blocks.join(parts, ["_c", "_block"]).mapInArrow(
        stays, f"_c string, turns {turn_type}, items array<struct<place: long, seq: int, edit: string, _new: string, turn: int>>"
    )
    one = items.select("_c", "turns", F.explode("items").alias("x"))
    own = F.get("turns", F.col("x.turn"))
    return one.select("_c", "x.place", "x.seq", "x.edit", "x._new", own["_t"].alias("_t"), own["_role"].alias("_role"), own["_d"].alias("_d"))


def repair(rows: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest repair of every conversation. ``order`` is a whole number. Runs jobs when called."""
    own = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = rows.select(own.alias("_c"), F.col(key).alias("_key"), F.col(order).alias("_t"), space(role).alias("_role"), space(text).alias("_text"))
    rows = rows.withColumn("_d", F.unhex(F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"))))
    narrow = cut(narrow_turns(rows))
    initial = F.substring("_role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = F.when((F.col("_fault") == "b") | F.col("_again"), F.lit("x")).when(F.col("_fault") == "t", F.upper(known)).otherwise(known)
    blocks = in_blocks(placed(narrow.withColumn("_symbol", symbol)))
    spans = charts(blocks)
    parses = cut(whole(spans))
    blank, first = F.col("_fault") == "b", ~F.col("_again")
    total = lambda c, n: F.sum(F.when(c, n).otherwise(0)).cast("long")
    counts = narrow.groupBy("_c").agg(
        F.coalesce(F.max("_t") - F.min("_t") + 1 - F.count_distinct("_t"), F.lit(0)).cast("long").alias("gaps"),
        total(blank, F.col("_n")).alias("blank"),
        total(~blank, F.col("_n") - first.cast("long")).alias("duplicate"),
        total((F.col("_fault") == "t") & first, F.lit(1)).alias("truncated"),
    )
    keys = cut(rows.groupBy("_c").agg(F.first("_key").alias(key)))
    audits = keys.join(counts, "_c").join(parses, "_c").select(key, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    stays = kept_turns(blocks, spans.select("_c", "_block", "symbols"), parses)
    same = ["_c", "_t", "_role", "_d"]
    texts = rows.select(*same, "_text").dropDuplicates(same)
    held = stays.filter("edit <> 'I'").alias("s").join(
        texts.alias("x"), (F.col("s._c") == F.col("x._c")) & (F.col("s._role") == F.col("x._role")) & (F.col("s._d") == F.col("x._d")) & F.col("s._t").eqNullSafe(F.col("x._t"))
    ).select("s._c", "place", "seq", F.coalesce("_new", "s._role").alias("role"), F.col("_text").alias("text"), "edit")
    new = stays.filter("edit = 'I'").select("_c", "place", "seq", F.col("_new").alias("role"), F.lit("").alias("text"), "edit")
    return Repaired(audits, held.unionByName(new).join(keys, "_c").select(key, "place", "seq", "role", "text", "edit"))


def digests(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, repaired_sha256): SHA-256 of ``role:text`` lines of every key.

    A hash is a chain over the whole conversation, so one task reads a conversation's turns, sorted on disk, as a stream; it holds a batch at a time.
    """
    rows = turns.select(F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("_c"), F.col(key).alias("_key"), "place", "seq", F.concat_ws(":", "role", "text").alias("_line"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, state = None, None, None
        for part in parts:
            out = []
            for c, k, line in zip(part.column("_c").to_pylist(), part.column("_key"), part.column("_line").to_pylist()):
                if c != now:
                    if now is not None:
                        out.append((own, state.hexdigest()))
                    now, own, state = c, k.as_py(), sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], part.column("_key").type), pa.array([h for _, h in out])], ["_key", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], part.column("_key").type), pa.array([state.hexdigest()])], ["_key", "repaired_sha256"])

    dealt = rows.repartition("_c").sortWithinPartitions("_c", "place", "seq").select("_c", "_key", "_line")
    return dealt.mapInArrow(batches, f"_key {turns.schema[key].dataType.simpleString()}, repaired_sha256 string").withColumnRenamed("_key", key)


def damaged(rows: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults at seeded turns, to try a repair on: by the CRC-32 of ``key:order`` modulo 20 a turn is dropped (0), emptied (1), loses its ends of
    sentences (2), is repeated (3), or is given to the user (4). Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space(key), F.lit(":"), space(order)).cast("binary")), F.lit(20))
    copies = F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select(
        key, order, F.when(kind == 4, F.lit("user")).otherwise(space(role)).alias(role),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text)).alias(text),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")
