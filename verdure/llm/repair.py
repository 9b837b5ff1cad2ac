"""Conversation structure repair: layers of increasing cost, each a bitset of grammar states for every turn.

The roles of a repaired conversation are ``(s?(ua)+)?`` by their initials, an automaton of four states. For cost c = 0, 1, 2, ... a layer holds for each place t the bitset of states from
which the rows from t on can be brought to an end by edits of exactly that cost: made from the same layer (Keep), the one three below (Insert, Rerole, Keep of a truncated row), four below
(Delete) and six below (Rerole of a truncated row) by table look-ups. The first layer that has the start state gives the cost, and walking down from there over the bits, the least letter
first, gives the ASCII-least audit.

Rows are dealt by ranges of (conversation, turn, role, text) and read in that order, so no conversation has to fit a task. One that lies inside a task and has up to ``SEGMENT`` rows is repaired
there. Of others each segment gives the costs from state to state as a matrix, a scan over a conversation's matrices gives each segment the costs that are left after it, the segments are
walked from each of the four states, and a second scan picks the state that they are entered in. A segment is some numbers in a scan, whatever its texts. Repeated (role, text) of such
conversations are found by grouping their hashes (128 bits).

Faults, a row's first one counts: blank (no character but space, tab, newline, vertical tab, form feed, carriage return), duplicate (an earlier row of the conversation has its role and text),
truncated (the last character but those isn't one of ``.!?``).

Cases: null role or text is one space; a null conversation id is a conversation; rows of equal turn are ordered by role and text, null turns come first; repeated rows are duplicates; an empty
role can't be kept; a conversation without rows is repaired to none at cost 0; an empty table gives an empty result; a very long text is a row like others; further columns are left out,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, only, small, stored

#: Rows of a conversation that are repaired at once.
SEGMENT = 1000
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
FAULTS = ("", "blank", "duplicate", "truncated")
LEGAL = {"su", "ua", "au"}
_INF = 1 << 60

#: States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn. Where each initial leads, -1: nowhere.
STEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: The initial that is put in or rerole to in each state, and where that leads.
NEED, NEXT = "uuau", (2, 2, 3, 2)
ACCEPT = (0, _INF, _INF, 0)


def _back(step: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(sum(1 << s for s in range(4) if step[s] >= 0 and bits >> step[s] & 1) for bits in range(16))


_KEPT = {k: _back(v) for k, v in STEP.items()}
_NEEDED = _back(NEXT)
_NOTHING = (0,) * 16


def initial(role: str) -> str:
    return role[:1]


def fault(role: str, text: str, seen: bool) -> int:
    """The place in FAULTS of the row's first fault."""
    last = text.rstrip(" \t\n\x0b\x0c\r")
    return 1 if not last else 2 if seen else 3 if last[-1] not in ".!?" else 0


def layers(codes: list[tuple[str, int]], ends: tuple[int, ...], starts: tuple[int, ...], last: bool) -> tuple[list[list[int]], dict[int, int]]:
    """The layers up to the one that has all ``starts``, and each start's cost. ``codes``: (initial, fault) of the rows; ``ends``: what is left to pay in each state after the last row;
    ``last``: rows can be put in after the last one as well (otherwise the next segment does so)."""
    n, out, found = len(codes), [], {}
    rules = []
    for kind, f in codes:
        kept = _KEPT.get(kind, _NOTHING)
        rules.append(None if f in (1, 2) else (kept, TRUNCATED_COST if f == 3 else KEEP_COST))
    none = [0] * (n + 1)
    while len(found) < len(starts):
        c = len(out)
        at = lambda below: out[c - below] if c >= below else none
        three, four, six = at(INSERT_COST), at(DELETE_COST), at(REROLE_COST + TRUNCATED_COST)
        own = [0] * (n + 1)
        own[n] = sum(1 << s for s in range(4) if ends[s] == c) | (_NEEDED[three[n]] if last else 0)
        for t in range(n - 1, -1, -1):
            bits = _NEEDED[three[t]] | four[t + 1]
            if rule := rules[t]:
                kept, extra = rule
                bits |= kept[three[t + 1]] | _NEEDED[six[t + 1]] if extra else kept[own[t + 1]] | _NEEDED[three[t + 1]]
            own[t] = bits
        out.append(own)
        for s in starts:
            if s not in found and own[0] >> s & 1:
                found[s] = c
    return out, found


def walk(codes: list[tuple[str, int]], out: list[list[int]], ends: tuple[int, ...], s: int, c: int) -> tuple[str, int]:
    """The least audit from state ``s`` at cost ``c``, and the state that it ends in."""
    t, n, audit = 0, len(codes), []
    has = lambda c, t, s: c >= 0 and out[c][t] >> s & 1
    while t < n or ends[s] != c:
        kind, f = codes[t] if t < n else ("", 0)
        extra = TRUNCATED_COST if f == 3 else 0
        kept = STEP[kind][s] if kind in STEP and f not in (1, 2) else -1
        if t < n and has(c - DELETE_COST, t + 1, s):
            audit.append("D")
            t, c = t + 1, c - DELETE_COST
        elif has(c - INSERT_COST, t, NEXT[s]):
            audit.append("I")
            s, c = NEXT[s], c - INSERT_COST
        elif kept >= 0 and has(c - KEEP_COST - extra, t + 1, kept):
            audit.append("K")
            s, t, c = kept, t + 1, c - KEEP_COST - extra
        else:
            audit.append("R")
            s, t, c = NEXT[s], t + 1, c - REROLE_COST - extra
    return "".join(audit), s


def apply(rows: list[tuple[str, str]], audit: str, s: int) -> list[tuple[str, str]]:
    """The (role, text) rows after the edits, from state ``s`` on."""
    names, it, out = {"u": "user", "a": "assistant"}, iter(rows), []
    for e in audit:
        role, text = ("", "") if e == "I" else next(it)
        if e == "D":
            continue
        if e != "K":
            role = names[NEED[s]]
        s = STEP[initial(role)][s]
        out.append((role, text))
    return out


def matrix(codes: list[tuple[str, int]]) -> list[int]:
    """16 costs, of state 0 to 0, 0 to 1, ..., for a segment that others follow."""
    n = len(codes)
    cost = [[_INF] * 4 for _ in range(4)]
    if not n:
        return [0 if s == e else _INF for s in range(4) for e in range(4)]
    cost[0][0] = cost[1][1] = DELETE_COST * n  # nothing leads back to these states
    if kept := [f for k, f in codes if k == "s" and f in (0, 3)]:
        cost[0][1] = DELETE_COST * (n - 1) + (0 if 0 in kept else TRUNCATED_COST)
    for e in (2, 3):
        for s, c in layers(codes, tuple(0 if x == e else _INF for x in range(4)), (0, 1, 2, 3), False)[1].items():
            cost[s][e] = c
    return [c for row in cost for c in row]


def statistics(rows: list[tuple[int | None, str, str]], codes: list[tuple[str, int]]) -> dict:
    """What a segment adds to its conversation's report; ``first`` and ``end`` are the initials of its outer rows."""
    turns = [t for t, _, _ in rows if t is not None]
    kinds = [k for k, _ in codes]
    own = {"n_rows": len(rows), "lo": turns[0] if turns else None, "hi": turns[-1] if turns else None, "turns": len(set(turns))}
    own |= {name: sum(f == i for _, f in codes) for i, name in enumerate(FAULTS) if name}
    return own | {"illegal": sum(x + y not in LEGAL for x, y in zip(kinds, kinds[1:])), "first": kinds[0] if kinds else None, "end": kinds[-1] if kinds else None}


STATS = "n_rows long, lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long, first string, end string"
REPAIRED = f"conv_id long, part int, seg int, whole boolean, {STATS}, cost long, audit string, repaired array<struct<role:string,text:string>>"
_ROWS = "array<struct<turn:long,role:string,text:string>>"
_AT = ["conv_id", "part", "seg"]


_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
    "array<struct<role:string,text:string>>": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
    _ROWS: pa.list_(_TURN),
}


def _arrow(fields: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split(" ") for x in fields.split(", "))])


def _codes(rows: list[tuple[int | None, str, str]], again: set[int]) -> list[tuple[str, int]]:
    return [(initial(role), fault(role, text, i in again)) for i, (_, role, text) in enumerate(rows)]


def _solve(codes: list[tuple[str, int]], rows: list[tuple[int | None, str, str]]) -> dict:
    out, found = layers(codes, ACCEPT, (0,), True)
    audit, _ = walk(codes, out, ACCEPT, 0, found[0])
    return statistics(rows, codes) | {"cost": found[0], "audit": audit, "repaired": [{"role": r, "text": t} for r, t in apply([r[1:] for r in rows], audit, 0)]}


def _segments(segment: int):
    """Sorted rows to segments: repaired at once if ``whole``, else with their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, schema = TaskContext.get().partitionId(), _arrow(f"{REPAIRED}, rows {_ROWS}")
        done, size = [], 0
        conv, rows, seg, inside = None, [], 0, None  # inside: whether the conversation surely begins in this task

        def close(ended: bool) -> None:
            """``ended``: the conversation surely ends here."""
            nonlocal size
            own = {"conv_id": conv, "part": part, "seg": seg}
            if inside and ended and seg == 0:
                firsts, again = set(), set()
                for i, (_, role, text) in enumerate(rows):
                    again |= {i} if (role, text) in firsts else set()
                    firsts.add((role, text))
                done.append(own | {"whole": True} | _solve(_codes(rows, again), rows))
            else:
                done.append(own | {"whole": False, "rows": [dict(zip(("turn", "role", "text"), r)) for r in rows]})
            size += sum(len(t) + 100 for _, _, t in rows)

        for b in small(batches):
            for c, turn, role, text, copies in zip(*(x.to_pylist() for x in b.columns)):
                if inside is None:
                    conv, inside = c, False
                elif c != conv:
                    close(True)
                    conv, rows, seg, inside = c, [], 0, True
                for _ in range(copies):
                    if len(rows) == segment:
                        close(False)
                        rows, seg = [], seg + 1
                    rows.append((turn, role, text))
                if size > 4_000_000 or len(done) > 2000:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, size = [], 0
        if inside is not None:
            close(False)
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _duplicates(parts: DataFrame) -> DataFrame:
    """(conv_id, part, seg, again): the places of rows that repeat an earlier one of their conversation."""
    each = parts.select(*_AT, F.posexplode("rows").alias("i", "r"))
    keys = [F.xxhash64("r.role", "r.text").alias("k1"), F.xxhash64("r.text", F.lit(1), "r.role").alias("k2"), F.coalesce("conv_id", F.lit(0)).alias("k3"), F.col("conv_id").isNull().alias("k4")]
    names = ["k1", "k2", "k3", "k4"]
    each = stored(each.select(*_AT, "i", *keys), "turn-keys")
    groups = each.groupBy(*names).agg(F.min(F.struct("part", "seg", "i")).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    later = join_groups(each, groups, names).filter(F.struct("part", "seg", "i") != F.col("earliest"))
    return later.groupBy(*_AT).agg(F.collect_set("i").alias("again"))


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """A left join on a segment's name, null conversations included."""
    named = right.toDF(*(f"_{c}" if c in _AT else c for c in right.columns))
    on = [left[c].eqNullSafe(named[f"_{c}"]) for c in _AT]
    return left.join(named, on, "left").drop(*(f"_{c}" for c in _AT))


def _scan(costs: pd.DataFrame) -> pd.DataFrame:
    """One conversation's matrices to what is left to pay after each segment, relative to the least."""
    costs = costs.sort_values(["part", "seg"]).reset_index(drop=True)
    left, out, last = [0, 2 * INSERT_COST, INSERT_COST, 0], [], True  # after the last row, what rows put in there cost
    for m in costs["costs"][::-1]:
        least = min(left)
        left = [x - least for x in left]
        out.append((list(ACCEPT) if last else left, last))
        at = range(4)
        left = [min(min(int(m[4 * s + e]) + left[e] for e in at), _INF) for s in at]
        last = False
    ends, flags = zip(*out[::-1])
    return pd.DataFrame({"conv_id": costs["conv_id"].astype("Int64"), "part": costs["part"], "seg": costs["seg"], "ends": list(ends), "last": flags})


def _enter(exits: pd.DataFrame) -> pd.DataFrame:
    """One conversation's exits for each state that a segment is entered in, to the state that it is entered in."""
    exits = exits.sort_values(["part", "seg"]).reset_index(drop=True)
    s, out = 0, []
    for e in exits["exits"]:
        out.append(s)
        s = int(e[s])
    return pd.DataFrame({"conv_id": exits["conv_id"].astype("Int64"), "part": exits["part"], "seg": exits["seg"], "entry": out})


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(f"conv_id long, part int, seg int, rows {_ROWS}, again array<int>, costs array<long>")
    for b in small(batches, 50):
        rows = b.to_pylist()
        for r in rows:
            r["costs"] = matrix(_codes([tuple(x.values()) for x in r["rows"]], set(r["again"] or ())))
        yield pa.RecordBatch.from_pylist(rows, schema)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow("conv_id long, part int, seg int, exits array<int>, audits array<string>, paid array<long>")
    for b in small(batches, 50):
        out = []
        for r in b.to_pylist():
            codes, ends, states = _codes([tuple(x.values()) for x in r["rows"]], set(r["again"] or ())), tuple(r["ends"]), (0, 1, 2, 3)
            levels, found = layers(codes, ends, states, r["last"])
            walks = [walk(codes, levels, ends, s, found[s]) for s in states]
            out.append({a: r[a] for a in _AT} | {"exits": [e for _, e in walks], "audits": [a for a, _ in walks], "paid": [found[s] - ends[walks[s][1]] for s in states]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(REPAIRED)
    for b in small(batches, 50):
        out = []
        for r in b.to_pylist():
            rows, s = [tuple(x.values()) for x in r["rows"]], r["entry"]
            audit = r["audits"][s]
            own = statistics(rows, _codes(rows, set(r["again"] or ())))
            fixed = [{"role": x, "text": t} for x, t in apply([x[1:] for x in rows], audit, s)]
            out.append({a: r[a] for a in _AT} | own | {"whole": False, "cost": r["paid"][s], "audit": audit, "repaired": fixed})
        yield pa.RecordBatch.from_pylist(out, schema)


def repair_conversations(rows: DataFrame, copies: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations of (conv_id, turn, role, text) as segments: REPAIRED. ``whole`` ones are a conversation, others follow each other by (part, seg). ``copies``, a column, says
    how often a row stands there; with 0 it only names its conversation."""
    names = ["conv_id", "turn", "role", "text", *([copies] if copies else [])]
    own = only(rows, *names)
    own = own.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.col(copies).cast("int") if copies else F.lit(1)).alias("copies"),
    )
    order = ["conv_id", "turn", "role", "text"]
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = stored(dealt.mapInArrow(_segments(segment), f"{REPAIRED}, rows {_ROWS}"), "segments")
    parts = segments.filter(~F.col("whole")).select(*_AT, "rows")
    coded = _same(parts, _duplicates(parts)).select(*_AT, "rows", "again")
    coded = stored(coded.mapInArrow(_coded, f"conv_id long, part int, seg int, rows {_ROWS}, again array<int>, costs array<long>"), "coded")
    ends = coded.select(*_AT, "costs").groupBy("conv_id").applyInPandas(_scan, "conv_id long, part int, seg int, ends array<long>, last boolean")
    walked = stored(_same(coded, ends).mapInArrow(_walked, "conv_id long, part int, seg int, exits array<int>, audits array<string>, paid array<long>"), "walked")
    entries = walked.select(*_AT, "exits").groupBy("conv_id").applyInPandas(_enter, "conv_id long, part int, seg int, entry int")
    rest = _same(_same(coded, walked), entries).mapInArrow(_applied, REPAIRED)
    return segments.filter("whole").drop("rows").unionByName(rest)


def repaired_turns(segments: DataFrame) -> DataFrame:
    """(conv_id, part, seg, i, role, text): the repaired rows, in this order."""
    return segments.select(*_AT, F.posexplode("repaired").alias("i", "r")).select(*_AT, "i", "r.role", "r.text")


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order to a row for each conversation; the hash is carried on from segment to segment."""
    schema, now, hold, audit, begun, done = _arrow(REPORT), None, None, [], False, []

    def close() -> dict:
        gaps = now["hi"] - now["lo"] + 1 - now["turns"] if now["lo"] is not None else 0
        own = {k: now[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        return own | {"gaps": gaps, "audit": "".join(audit), "repaired_sha256": hold.hexdigest()}

    for b in small(batches, 100):
        for r in b.to_pylist():
            if now is None or r["conv_id"] != now["conv_id"]:
                if now:
                    done.append(close())
                now, hold, audit, begun = {k: r[k] for k in ("conv_id", "lo", "hi")} | dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"end": None, "hi": None}, hashlib.sha256(), [], False
            if r["first"] is not None:
                now["illegal"] += now["end"] is not None and now["end"] + r["first"] not in LEGAL
                now["end"] = r["end"]
            if r["lo"] is not None:
                now["turns"] -= now["hi"] == r["lo"]
                now["lo"] = r["lo"] if now["lo"] is None else now["lo"]
                now["hi"] = r["hi"]
            for k in ("turns", "blank", "duplicate", "truncated", "illegal", "cost"):
                now[k] += r[k]
            audit.append(r["audit"])
            for x in r["repaired"]:
                hold.update(f"{chr(10) if begun else ''}{x['role']}:{x['text']}".encode())
                begun = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if now:
        yield pa.RecordBatch.from_pylist([close()], schema)


def report(segments: DataFrame) -> DataFrame:
    """REPORT: gaps in turns, counts of faults and illegal neighbours before the repair, its cost and audit, and the hash of the repaired ``role:text`` lines."""
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0).cast("long"))
    whole = segments.filter("whole").select("conv_id", gaps.alias("gaps"), *(n for n in FAULTS if n), "illegal", "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    rest = segments.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions(*_AT).mapInArrow(_reported, REPORT)
    return whole.unionByName(rest)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults by the crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets its role to user."""
    own = only(rows, "conv_id", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(blank("conv_id"), F.lit(":"), blank("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return own.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(blank("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def brute(rows: list[tuple[int | None, str | None, str | None]]) -> dict:
    """One conversation's report and repaired rows by trying all edits in each (place, state), for tests; rows are (turn, role, text) after damage."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes = set(), []
    for _, role, text in rows:
        codes.append((role[:1], fault(role, text, (role, text) in seen)))
        seen.add((role, text))
    best: dict[int, tuple[int, str]] = {0: (0, "")}

    def inserted(best: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        for _ in range(4):
            for s, (c, a) in list(best.items()):
                e = NEXT[s]
                best[e] = min(best.get(e, (_INF, "")), (c + 3, a + "I"))
        return best

    for kind, f in codes:
        new: dict[int, tuple[int, str]] = {}

        def offer(s: int, c: int, a: str) -> None:
            new[s] = min(new.get(s, (_INF, "")), (c, a))  # noqa: B023

        for s, (c, a) in inserted(best).items():
            offer(s, c + 4, a + "D")
            if f not in (1, 2):
                extra = 3 if f == 3 else 0
                if kind in STEP and STEP[kind][s] >= 0:
                    offer(STEP[kind][s], c + extra, a + "K")
                offer(NEXT[s], c + 3 + extra, a + "R")
        best = new
    cost, audit = min(v for s, v in inserted(best).items() if s in (0, 3))
    turns = [t for t, _, _ in rows if t is not None]
    fixed = apply([r[1:] for r in rows], audit, 0)
    kinds = [k for k, _ in codes]
    own = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0} | {n: sum(f == i for _, f in codes) for i, n in enumerate(FAULTS) if n}
    lines = "\n".join(f"{r}:{t}" for r, t in fixed)
    return own | {"illegal": sum(x + y not in LEGAL for x, y in zip(kinds, kinds[1:])), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}
