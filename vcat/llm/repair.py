"""Repair of conversation structure by the auction algorithm for shortest paths (operator 12).

A conversation is a lattice: layer i stands before row i, and in a layer there is a node for each state of the roles so far (nothing yet, behind a system row,
behind a user row, behind an assistant row). Arcs are edits with integer costs: keep or rerole or delete the row and go to the next layer, or
insert an empty row and stay. The cheapest edits are a shortest path to an end of allowed roles.

The auction keeps a path from the origin and prices under which no arc is worth more than its cost. At the path's end, if the price is below the best
of cost + price over the outgoing arcs, it is raised to that and the path contracts by a node; else the path extends along the best arc. When it arrives, the
prices are a converged dual: every arc of every shortest path is tight (price = cost + price behind), so the tight arcs from which the end can still be
reached, followed by the least initial of their edits, are the least of the cheapest audits.

Conversations are cut into segments of at most ``SEGMENT`` rows, read from sorted ranges, so a conversation with any share of all rows is many. One that is longer
has a tree over its segments: the costs between states of each segment (by auctions towards each state, sharing prices) are multiplied upwards, what is left to pay at
the end of each segment is handed down, the segments' own auctions then say which state leads to which, and these maps are composed and handed down likewise. No
step holds more than ``FANOUT`` segments of a conversation; the digest's SHA-256 alone reads a conversation in order, in a stream.

Rows are in order of turn (nulls first), role and text; null roles and texts are one space each. Defined results: null ids: one conversation. Repeated
rows: all but the first are duplicates. Very long texts: cut off from other rows, so that a segment has few megabytes and one text. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import join_equal, ranked, settle

SEGMENT, FANOUT, BYTES = 64, 256, 4 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits; an undeleted truncated row adds ``CUT``.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
INF = 1 << 60
#: State behind a row of this role's initial, by the state before; the state behind an inserted or reroled row.
_AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What is left to pay behind the last row, and the edits it takes.
LAST = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
_OTHER, _MUST_GO, _IS_CUT = 3, 4, 8
_INITIALS = "sua"


def row_code(role: str, blank: bool, duplicate: bool, cut: bool) -> int:
    """What the lattice needs to know of a row."""
    kind = _INITIALS.find(role[:1]) if role else -1
    return (kind if kind >= 0 else _OTHER) | _MUST_GO * (blank or duplicate) | _IS_CUT * (cut and not blank and not duplicate)


class Lattice:
    """A segment's nodes are ``4 * layer + state``, the last layer's arcs lead to the end (node -1) and cost what is left to pay."""

    def __init__(self, codes: bytes, ends: tuple[int, ...], tails: tuple[str, ...] = ("",) * 4):
        n = len(codes)
        self.arcs: list[list[tuple[int, str, int]]] = []  # (cost, edit, node), by edit
        for i, code in enumerate(codes):
            initial, extra = _INITIALS[code & 3] if code & 3 < _OTHER else "", CUT if code & _IS_CUT else 0
            for q in range(4):
                down = 4 * (i + 1)
                out = [(DELETE, "D", down + q), (INSERT, "I", 4 * i + _NEXT[q])]
                if not code & _MUST_GO:
                    if initial in _AFTER[q]:
                        out.append((extra, "K", down + _AFTER[q][initial]))
                    out.append((REROLE + extra, "R", down + _NEXT[q]))
                self.arcs.append(out)
        for q in range(4):
            self.arcs.append([(ends[q], tails[q], -1)] if ends[q] < INF else [])
        # prices to begin with: what each row costs at least, whatever the state
        self.price = [0] * (4 * n + 5)
        for i in range(n - 1, -1, -1):
            code = codes[i]
            least = DELETE if code & (_MUST_GO | _IS_CUT) else REROLE if code & 3 == _OTHER else 0
            self.price[4 * i:4 * i + 4] = [self.price[4 * i + 4] + least] * 4

    def auction(self, origin: int) -> int:
        """Length of the shortest path from a node to the end, which has to be in reach."""
        arcs, price, path, at = self.arcs, self.price, [], origin
        while at != -1:
            best, to = INF, -1
            for cost, _, j in arcs[at]:
                if cost + price[j] < best:
                    best, to = cost + price[j], j
            if price[at] < best:
                price[at] = best
                if path:
                    at = path.pop()
            else:
                path.append(at)
                at = to
        return price[origin]

    def trace(self, origin: int) -> tuple[int, str]:
        """(last state, edits): of the paths over tight arcs to the end the one whose edits are least."""
        arcs, price = self.arcs, self.price
        tight = [[a for a in out if a[0] + price[a[2]] == price[i]] for i, out in enumerate(arcs)]
        good = [False] * len(arcs) + [True]  # the end is the last one
        for layer in range(len(arcs) // 4 - 1, -1, -1):
            for _ in range(3):  # two inserted rows at most lead to another state of the layer
                for i in range(4 * layer, 4 * layer + 4):
                    good[i] = good[i] or any(good[a[2]] for a in tight[i])
        edits, at = [], origin
        while at != -1:
            _, edit, to = min((a for a in tight[at] if good[a[2]]), key=lambda a: a[1])
            edits.append(edit)
            state, at = at % 4, to
        return state, "".join(edits)


@lru_cache(1 << 15)
def solve(codes: bytes, ends: tuple[int, ...], tails: tuple[str, ...], origins: tuple[int, ...]) -> tuple[tuple[int, int, str], ...]:
    """(cost, last state, edits) from each origin."""
    lattice = Lattice(codes, ends, tails)
    return tuple((lattice.auction(q), *lattice.trace(q)) for q in origins)


@lru_cache(1 << 12)
def costs_between(codes: bytes) -> tuple[int, ...]:
    """Costs from each state before the segment (rows of the result) to each state behind it."""
    out = [INF] * 16
    for target in range(4):
        lattice = Lattice(codes, tuple(0 if q == target else INF for q in range(4)))
        for q in range(4):
            never = target == START and q != START or target == SYSTEM and q not in (START, SYSTEM)
            if not never and not (target == SYSTEM and q == START and not any(c & 7 == 0 for c in codes)):
                out[4 * q + target] = lattice.auction(q)
    return tuple(out)


# --- segments -------------------------------------------------------------------------------------


def _faults(role: str, text: str, first: bool) -> tuple[bool, bool, bool]:
    body = text.rstrip(" \t\n\x0b\f\r")
    return not body, not first, body[-1:] not in (".", "!", "?")


SEGMENTS = "seg long, codes binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, turns long, turn_low long, turn_high long"


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows: conv_id, turn, role, text, n (rows of that role and text in the conversation), first_turn (of these; null: a null one or none), part."""
    kept: list[tuple] = []
    done: list[tuple] = []
    ids = None
    conv = before = last = None
    size = seg = held = 0

    def close():
        nonlocal kept, size, seg, held
        if kept:
            turns = [r[0] for r in kept if r[0] is not None]
            faults = [r[3] for r in kept]
            done.append((conv, seg, bytes(row_code(r[1], *r[3]) for r in kept), [r[1] for r in kept], [r[2] for r in kept], sum(f[0] for f in faults),
                         sum(f[1] and not f[0] for f in faults), sum(f[2] and not f[1] and not f[0] for f in faults), len(set(turns)), min(turns, default=None), max(turns, default=None)))
            held += size
            seg += 1
        kept, size = [], 0

    def flush():
        nonlocal done, held
        cols = list(zip(*done))
        kinds = [ids, pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 6]
        names = ["conv_id", *(f.split()[0] for f in SEGMENTS.split(", "))]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        done, held = [], 0
        return batch

    for batch in batches:
        ids = batch.column(0).type
        for key, turn, role, text, n, first_turn, part in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if before is None or key != conv:
                close()
                conv, seg, last = key, part << 32, None
            elif len(kept) == SEGMENT or size + len(text) > BYTES:
                close()
            before = key, turn
            # the first of its like: rows of one turn, role and text stand together
            first = n == 1 or turn == first_turn and last != (turn, role, text)
            last = turn, role, text
            kept.append((turn, role, text, _faults(role, text, first)))
            size += len(text)
        if held >= BYTES or len(done) >= 4096:
            yield flush()
    close()
    if done:
        yield flush()


def segments(rows: DataFrame) -> DataFrame:
    """``conv_id``, the place ``seg`` and what ``SEGMENTS`` lists, of the rows ``conv_id, turn, role, text``."""
    space = F.lit(" ")
    named = settle(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")), "rows")
    mark = F.md5(F.concat_ws("\0", "role", "text"))
    named = named.withColumn("mark", mark)
    # a null turn is the first one, and then the least of the others says nothing
    again = named.groupBy("conv_id", "mark").agg(F.count("*").alias("n"), F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("none")).filter("n > 1")
    again = settle(again.select("conv_id", "mark", "n", F.when(~F.col("none"), F.col("first_turn")).alias("first_turn")), "again")
    marked = join_equal(named, again, ["conv_id", "mark"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]
    laid = marked.repartitionByRange(*by).sortWithinPartitions(*by[:3], F.col("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    cut = laid.select("conv_id", "turn", "role", "text", "n", "first_turn", F.spark_partition_id().cast("long").alias("part"))
    return settle(cut.mapInArrow(_cut_segments, f"conv_id {kind}, {SEGMENTS}"), "segments")


# --- long conversations ---------------------------------------------------------------------------


def multiply(values: list[list[int]]) -> list[int]:
    """Least costs over consecutive segments."""
    out = values[0]
    for v in values[1:]:
        out = [min(out[4 * i + k] + v[4 * k + j] for k in range(4)) for i in range(4) for j in range(4)]
        out = [min(x, INF) for x in out]
    return out


def compose(values: list[list[int]]) -> list[int]:
    """State behind consecutive segments by the state before them."""
    out = values[0]
    for v in values[1:]:
        out = [v[q] for q in out]
    return out


def left_to_pay(values: list[list[int]], above: list[int]) -> list[list[int]]:
    """What is left to pay behind each of consecutive segments, by state."""
    out = [above]
    for v in reversed(values[1:]):
        out.append([min(v[4 * i + j] + out[-1][j] for j in range(4)) for i in range(4)])
    return out[::-1]


def states_before(values: list[list[int]], above: list[int]) -> list[list[int]]:
    """The state before each of consecutive segments."""
    out = [above]
    for v in values[:-1]:
        out.append([v[out[-1][0]]])
    return out


def over_segments(nodes: DataFrame, merge: Callable, hand_down: Callable, top: list[int]) -> DataFrame:
    """``conv_id, rank, given``: a value for every segment (``conv_id, rank, total, value``) that depends on all others of its conversation, by a tree
    of ``FANOUT`` children a node: ``merge`` goes up, ``hand_down`` gives the children's from the parent's; that of a conversation is ``top``."""
    kind = nodes.schema["conv_id"].dataType.simpleString()
    grouped = lambda d: d.withColumn("up", F.floor(F.col("rank") / FANOUT).cast("long")).groupBy("conv_id", "up")

    def up(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        first = table.slice(0, 1)
        return pa.table({"conv_id": first["conv_id"], "rank": first["up"], "total": pa.array([-(-first["total"][0].as_py() // FANOUT)], pa.int64()),
                         "value": pa.array([merge(table["value"].to_pylist())], pa.list_(pa.int64()))})

    def down(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        given = hand_down(table["value"].to_pylist(), table["above"][0].as_py())
        return pa.table({"conv_id": table["conv_id"], "rank": table["rank"], "given": pa.array(given, pa.list_(pa.int64()))})

    floors = [nodes]
    while not floors[-1].filter("total > 1").isEmpty():
        floors.append(settle(grouped(floors[-1]).applyInArrow(up, f"conv_id {kind}, rank long, total long, value array<bigint>"), "floor"))
    given = floors[-1].select("conv_id", "rank", F.array(*map(F.lit, top)).cast("array<bigint>").alias("given"))
    for floor in reversed(floors[:-1]):
        above = given.withColumnsRenamed({"rank": "up", "given": "above"})
        dealt = join_equal(floor.withColumn("up", F.floor(F.col("rank") / FANOUT).cast("long")), above, ["conv_id", "up"])
        given = settle(dealt.groupBy("conv_id", "up").applyInArrow(down, f"conv_id {kind}, rank long, given array<bigint>"), "given")
    return given


def _tails(ends: list[int], last: bool) -> tuple[tuple[int, ...], tuple[str, ...]]:
    return tuple(ends), tuple(t for _, t in LAST) if last else ("",) * 4


def _by_codes(fn: Callable, *columns: str):
    """A column of lists of numbers from rows of the named columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [list(fn(*row)) for row in zip(*(batch.column(c).to_pylist() for c in columns))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("rank"), batch.column("total"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "rank", "total", "value"])

    return run


def _places(segs: DataFrame) -> DataFrame | None:
    """``conv_id, seg, ends, entry, last`` of the segments of conversations that have several."""
    several = settle(segs.groupBy("conv_id").count().filter("count > 1").select("conv_id", F.lit(True).alias("_several")), "several")
    if several.isEmpty():
        return None
    long = ranked(join_equal(segs.select("conv_id", "seg", "codes"), several, ["conv_id"]).drop("_several"), ["conv_id"], [F.col("seg")])
    schema = f"conv_id {segs.schema['conv_id'].dataType.simpleString()}, rank long, total long, value array<bigint>"
    between = settle(long.mapInArrow(_by_codes(costs_between, "codes"), schema), "between")
    ends = over_segments(between, multiply, left_to_pay, [c for c, _ in LAST]).withColumnRenamed("given", "ends")
    placed = settle(join_equal(long, ends, ["conv_id", "rank"]).withColumn("last", F.col("rank") == F.col("total") - 1), "placed")

    def states(codes, own_ends, last):
        return [state for _, state, _ in solve(codes, *_tails(own_ends, last), (0, 1, 2, 3))]

    maps = settle(placed.mapInArrow(_by_codes(states, "codes", "ends", "last"), schema), "maps")
    entry = over_segments(maps, compose, states_before, [START])
    return settle(join_equal(placed, entry, ["conv_id", "rank"]).select("conv_id", "seg", "ends", F.col("given")[0].alias("entry"), "last"), "entries")


# --- edits ----------------------------------------------------------------------------------------


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """Rows after the edits."""
    out, i = [], 0
    for e in edits:
        if e == "K":
            state = _AFTER[state][roles[i][0]]
            out.append((roles[i], texts[i]))
        elif e != "D":
            state = _NEXT[state]
            out.append((_ROLES[state], "" if e == "I" else texts[i]))
        i += e != "I"
    return out


PIECES = ("seg long, cost long, audit string, turns array<struct<role: string, text: string>>, blank long, duplicate long, truncated long, turns_before long, "
          "turn_low long, turn_high long, illegal long, first_role string, last_role string")


def _repair_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), row_type, *[pa.int64()] * 7, pa.string(), pa.string()]
    names = ["conv_id", *(f.strip().split()[0] for f in PIECES.replace("struct<role: string, text: string>", "s").split(","))]
    for batch in batches:
        out = []
        for seg, codes, roles, texts, blank, duplicate, truncated, turns, low, high, ends, entry, last in zip(*(batch.column(i).to_pylist() for i in range(1, batch.num_columns))):
            entry = entry or START
            ends, last = (ends, last) if ends is not None else ([c for c, _ in LAST], True)
            ((cost, _, edits),) = solve(codes, *_tails(ends, last), (entry,))
            rows = [{"role": r, "text": t} for r, t in apply_edits(edits, entry, roles, texts)]
            starts = [r[:1] for r in roles]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
            out.append((seg, cost, edits, rows, blank, duplicate, truncated, turns, low, high, illegal, starts[0], starts[-1]))
        cols = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id`` and what ``PIECES`` lists, a row for each segment in the order of ``seg``: its edits, its repaired ``turns`` and its faults. The first
    segment's ``cost`` is the conversation's."""
    segs = segments(rows)
    places = _places(segs)
    if places is None:
        own = segs.withColumns({"ends": F.lit(None).cast("array<bigint>"), "entry": F.lit(None).cast("long"), "last": F.lit(True)})
    else:
        own = join_equal(segs, places, ["conv_id", "seg"], "left")
    kind = rows.schema["conv_id"].dataType.simpleString()
    cols = ["conv_id", "seg", "codes", "roles", "texts", "blank", "duplicate", "truncated", "turns", "turn_low", "turn_high", "ends", "entry", "last"]
    return own.select(*cols).mapInArrow(_repair_segments, f"conv_id {kind}, {PIECES}")


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and running hash of the sorted pieces of each conversation."""
    done, open_, ids = [], None, None

    def close():
        if open_:
            o = open_
            gaps = o["high"] - o["low"] + 1 - o["turns"] if o["turns"] else 0
            done.append((o["conv"], gaps, *o["faults"], o["illegal"], o["cost"], "".join(o["audit"]), o["sha"].hexdigest()))

    def flush():
        nonlocal done
        kinds = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv_id", *(f.split()[0] for f in DIGEST.split(", "))]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*done)) or [()] * 9, kinds)], names)
        done = []
        return out

    for batch in batches:
        ids = batch.column(0).type
        for conv, _, cost, audit, turns, blank, duplicate, truncated, n, low, high, illegal, first, last in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ is None or conv != open_["conv"]:
                close()
                open_ = {"conv": conv, "cost": cost, "audit": [], "sha": hashlib.sha256(), "any": False, "faults": [0, 0, 0], "illegal": 0, "turns": 0, "low": None, "high": None, "role": None}
            o = open_
            o["faults"] = [a + b for a, b in zip(o["faults"], (blank, duplicate, truncated))]
            o["illegal"] += illegal + (o["role"] is not None and o["role"] + first not in ("su", "ua", "au"))
            o["role"] = last
            o["audit"].append(audit)
            o["turns"] += n - (n > 0 and o["high"] == low)  # a turn may go on in the next segment
            o["low"] = low if o["low"] is None else o["low"]
            o["high"] = high if high is not None else o["high"]
            for t in turns:
                o["sha"].update((("\n" if o["any"] else "") + t["role"] + ":" + t["text"]).encode())
                o["any"] = True
        if done:
            yield flush()
    close()
    if done:
        yield flush()


def digest(pieces: DataFrame) -> DataFrame:
    """``conv_id`` and what ``DIGEST`` lists, a row for each conversation: ``gaps`` between turns, faults, neighbours whose roles don't follow, the edits and the
    SHA-256 of the repaired rows."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = [f.strip().split()[0] for f in PIECES.replace("struct<role: string, text: string>", "s").split(",")]
    return pieces.select("conv_id", *names).repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(_fold, f"conv_id {kind}, {DIGEST}")
