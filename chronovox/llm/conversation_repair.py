"""Cheapest repairs of conversations' turn structure.

A conversation's roles should read ``(s?(ua)+)?``: nothing, or an optional
system turn and then pairs of user and assistant.  Four edits lead there:
Keep (0), Rerole to user or assistant (3), Delete (4) and Insert an empty turn
of user or assistant (3); a truncated turn that stays adds 3, and a blank or
duplicate turn must go.

Edits are the arcs of a graph whose nodes are a place between turns and a
state of the grammar.  Minimum costs forward from the start and backward from
the end identify the tight arcs, those of some cheapest repair; from the start,
the frontier (all states reached by the letters so far) then follows the least
edit letter that has a tight arc.

Turns are dealt by ranges of (conversation, turn) and cut into segments of
bounded size, so a conversation of any length is spread over tasks.  A segment
of one byte a turn stands for a 4 x 4 matrix of costs; a conversation of
several segments is solved by three passes over such rows, which carry four
numbers along: forward costs, backward costs, and the state in which the path
enters each segment.  Turns seen in an earlier segment are found by digests.

Defined cases: a null role or text is one space; null conversation ids are one
conversation; turns with a null number come first; turns of equal number are
ordered by role, then by a hash of the text; equal rows are repeats.  A role's
initial is its first character, and an empty role can't be kept.  A
conversation without turns (all of them marked dropped) has an empty repair.
An empty table gives an empty result.  Texts may be of any length: a segment
holds 4 MB or one turn.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

SEGMENT_TURNS, SEGMENT_BYTES = 16_384, 4 << 20
#: The costs of edits and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
#: States: at the start, after system, after user, after assistant.  What an inserted or reroled turn leads to, and its role.
ONWARD, ROLE = (2, 2, 3, 2), (None, None, "user", "assistant")
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
INITIALS, FAULTS = "sua?", ("", "truncated", "blank", "duplicate")
#: What ends a conversation: nothing yet, or after an assistant.
ENDS = (0, FAR, FAR, 0)
LEGAL = {"su", "ua", "au"}

SPACES = " \t\n\v\f\r"
METRICS = ("blank", "duplicate", "truncated", "illegal")


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with faults drawn by crc32 of ``conv:turn``; a dropped turn keeps its row, with ``dropped`` set."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")) % 20
    out = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), draw.alias("draw"))
    return out.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("draw") == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


# --- one segment -------------------------------------------------------------------------------


def arc(letter: str, code: int, state: int) -> tuple[int, int] | None:
    """(cost, next state) of an edit of a turn, by its code (fault * 4 + initial); None where it isn't allowed."""
    fault, initial = FAULTS[code >> 2], INITIALS[code & 3]
    if letter == "D":
        return DELETE, state
    if fault in ("blank", "duplicate"):
        return None
    more = TRUNCATED if fault else 0
    if letter == "R":
        return REROLE + more, ONWARD[state]
    to = KEPT.get((initial, state))
    return None if to is None else (more, to)


#: All arcs over a turn, by code and state: (letter, cost, next state), letters in order.
ARCS = [[[(x, *a) for x in "DKR" if (a := arc(x, code, q))] for q in range(4)] for code in range(16)]


def inserted(costs: list[int]) -> list[int]:
    """Forward costs after any turns inserted at this place."""
    s, y, u, a = costs
    u = min(u, s + INSERT, y + INSERT, a + INSERT)
    return [s, y, u, min(a, u + INSERT)]


def to_insert(costs: list[int]) -> list[int]:
    """Backward costs before any turns inserted at this place."""
    s, y, u, a = costs
    u, a = min(u, a + INSERT), min(a, u + INSERT)
    return [min(s, u + INSERT), min(y, u + INSERT), u, a]


def forward(codes: bytes, start: list[int]) -> list[list[int]]:
    """Least costs from the conversation's start to each place of a segment, inserts at the place included but for the last."""
    out, now = [], start
    for code in codes:
        now = inserted(now)
        out.append(now)
        then = [FAR] * 4
        for q, cost in enumerate(now):
            for _, more, to in ARCS[code][q]:
                then[to] = min(then[to], cost + more)
        now = then
    return [*out, now]


def backward(codes: bytes, end: list[int]) -> list[list[int]]:
    """Least costs from each place of a segment to the conversation's end; ``end`` has the inserts at the last place."""
    out, now = [end], end
    for code in reversed(codes):
        now = to_insert([min(more + now[to] for _, more, to in ARCS[code][q]) for q in range(4)])
        out.append(now)
    return out[::-1]


def matrix(codes: bytes) -> list[int]:
    """Costs from each state before a segment to each after it."""
    return [c for q in range(4) for c in forward(codes, [0 if p == q else FAR for p in range(4)])[-1]]


def path(codes: bytes, start: list[int], end: list[int], state: int, last: bool) -> tuple[str, int]:
    """The least letters from ``state`` through a segment along tight arcs, and the state after it."""
    before, after = forward(codes, start), backward(codes, end)
    total = min(map(sum, zip(start, after[0], strict=True)))
    if last:
        before[-1] = inserted(before[-1])
    letters, frontier, place = [], {state}, 0
    while True:
        steps: dict[str, set[int]] = {}
        for q in frontier:
            if place < len(codes) or last:
                arcs = [(x, cost, to, place + 1) for x, cost, to in ARCS[codes[place]][q]] if place < len(codes) else []
                for x, cost, to, at in [*arcs, ("I", INSERT, ONWARD[q], place)]:
                    if before[place][q] + cost + after[at][to] == total:
                        steps.setdefault(x, set()).add(to)
        if not steps:
            return "".join(letters), min(frontier)
        letters.append(min(steps))
        frontier = steps[letters[-1]]
        place += letters[-1] != "I"


def coded(roles: list[str], texts: list[str], keys: list[bytes], earlier: set[bytes]) -> bytes:
    """A byte for each turn: its first fault and its role's initial."""
    seen, out = set(earlier), bytearray()
    for role, text, key in zip(roles, texts, keys, strict=True):
        bare = text.rstrip(SPACES)
        fault = 2 if not bare else 3 if key in seen else 0 if bare[-1] in ".!?" else 1
        seen.add(key)
        out.append(fault << 2 | ("s", "u", "a", role[:1]).index(role[:1]))
    return bytes(out)


def measured(codes: bytes, roles: list[str], turns: list[int | None]) -> dict:
    """Counts of one segment, and what its neighbours need."""
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    faults = [c >> 2 for c in codes]
    return {
        "blank": faults.count(2), "duplicate": faults.count(3), "truncated": faults.count(1), "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "first": initials[0] if initials else None, "last": initials[-1] if initials else None, "least": min(known, default=None), "most": max(known, default=None), "distinct": len(set(known)),
    }


def repaired(letters: str, roles: list[str], texts: list[str], state: int) -> list[dict]:
    """The turns that a path leaves."""
    out, place = [], 0
    for x in letters:
        if x == "K":
            state = KEPT[roles[place][0], state]
            out.append({"role": roles[place], "text": texts[place]})
        elif x != "D":
            state = ONWARD[state]
            out.append({"role": ROLE[state], "text": texts[place] if x == "R" else ""})
        place += x != "I"
    return out


# --- all conversations --------------------------------------------------------------------------

SEGMENT = "part long, turns array<long>, roles array<string>, texts array<string>, keys array<binary>"
RESULT = ", ".join(f"{c} long" for c in (*METRICS, "cost", "distinct", "least", "most"))
TURNS = "array<struct<role: string, text: string>>"


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(schema))


def _mapped(df: DataFrame, schema: str, function: Callable[[dict], dict]) -> DataFrame:
    """Each row, of bounded size, turned into a row of ``schema``; they leave in batches of some 4 MB."""
    arrow = _arrow(schema)
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in arrow], schema=arrow)

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                rows.append(function(one.to_pylist()[0]))
                size += one.nbytes
                if len(rows) >= 256 or size >= SEGMENT_BYTES:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)

    return df.mapInArrow(run, schema)


def segments(rows: DataFrame, dropped: str | None = "dropped", turns: int = SEGMENT_TURNS, size: int = SEGMENT_BYTES) -> DataFrame:
    """Turns in order, cut into one row for at most ``turns`` turns of a conversation or ``size`` characters (or one turn); ``part`` orders them."""
    common.text_session(rows.sparkSession)
    spaced = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    source = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"), (F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)).alias("gone"))
    source = source.withColumn("text", F.when(F.col("gone"), "").otherwise(F.col("text"))).withColumns({"hash": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "hash", "salt"]
    schema = f"conv {_kind(source, 'conv')}, {SEGMENT}"
    arrow = _arrow(schema)

    def cut(batches):
        base, n, held, chars, open_ = TaskContext.get().partitionId() << 33, 0, [], 0, None

        def closed(conv, rows):
            return {
                "conv": conv, "part": base + n, "turns": [r[0] for r in rows], "roles": [r[1] for r in rows], "texts": [r[2] for r in rows],
                "keys": [hashlib.blake2b(f"{len(r[1])}:{r[1]}{r[2]}".encode(), digest_size=16).digest() for r in rows],
            }

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array([d[f.name] for d in done], f.type) for f in arrow], schema=arrow)

        done, waiting = [], 0
        for batch in batches:
            for conv, turn, role, text, gone in zip(*(common.column(batch, c).to_pylist() for c in ("conv", "turn", "role", "text", "gone")), strict=True):
                if open_ is None or open_[0] != conv or len(held) >= turns or chars + len(text) > size and held:
                    if open_ is not None:
                        done.append(closed(open_[0], held))
                        waiting += chars
                        n += 1
                    if len(done) >= 256 or waiting >= size:
                        yield out(done)
                        done, waiting = [], 0
                    held, chars, open_ = [], 0, (conv,)
                if not gone:
                    held.append((turn, role, text))
                    chars += len(text)
        if open_ is not None:
            yield out([*done, closed(open_[0], held)])

    return source.repartitionByRange(*order).sortWithinPartitions(*order).drop("hash", "salt").mapInArrow(cut, schema)


def _carried(df: DataFrame, schema: str, start: Callable[[], object], step: Callable[[object, dict], tuple[object, dict]], back: bool = False) -> DataFrame:
    """A pass over the segments of each conversation in order, which carries a small value along; nothing is gathered."""
    arrow = _arrow(schema)

    def run(batches):
        conv, value = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if conv is None or conv[0] != row["conv"]:
                    conv, value = (row["conv"],), start()
                value, made = step(value, row)
                rows.append(made)
            yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in arrow], schema=arrow)

    return df.repartition("conv").sortWithinPartitions("conv", F.col("part").desc() if back else F.col("part")).mapInArrow(run, schema)


def _whole(row: dict) -> dict:
    """A conversation of one segment."""
    codes = coded(row["roles"], row["texts"], row["keys"], set())
    start, end = [0, FAR, FAR, FAR], to_insert(list(ENDS))
    letters, _ = path(codes, start, end, 0, True)
    found = measured(codes, row["roles"], row["turns"])
    return {"conv": row["conv"], "part": row["part"], "audit": letters, "cost": backward(codes, end)[0][0], "repaired": repaired(letters, row["roles"], row["texts"], 0), **{c: found[c] for c in (*METRICS, "distinct", "least", "most")}}


def _code(row: dict) -> dict:
    codes = coded(row["roles"], row["texts"], row["keys"], set(row["earlier"] or ()))
    return {"conv": row["conv"], "part": row["part"], "codes": codes, "costs": matrix(codes), **measured(codes, row["roles"], row["turns"])}


def _forward(carry, row):
    """Costs before each segment, and what its border to the one before adds."""
    costs, last, most = carry
    joined = {"illegal": row["illegal"] + (last is not None and row["first"] is not None and last + row["first"] not in LEGAL), "distinct": row["distinct"] - (most is not None and row["least"] == most)}
    then = [min(FAR, *(costs[q] + row["costs"][4 * q + p] for q in range(4))) for p in range(4)]
    after = (then, row["last"] if row["last"] is not None else last, row["most"] if row["most"] is not None else most)
    return after, {**row, **joined, "before": costs}


def _backward(carry, row):
    """Costs after each segment, and for each state before it that a cheapest path has the state after it."""
    end, last = carry
    if last:
        end = to_insert(list(ENDS))
    start = [min(FAR, *(row["costs"][4 * q + p] + end[p] for p in range(4))) for q in range(4)]
    total = min(map(sum, zip(row["before"], start, strict=True)))
    leads = [path(row["codes"], row["before"], end, q, last)[1] if row["before"][q] + start[q] == total else -1 for q in range(4)]
    return (start, False), {**row, "after": end, "leads": leads, "is_last": last, "cost": total if last else 0}


def _enter(state, row):
    return row["leads"][state], {**row, "state": state, "audit": path(row["codes"], row["before"], row["after"], state, row["is_last"])[0]}


def repair(rows: DataFrame, dropped: str | None = "dropped", turns: int = SEGMENT_TURNS, size: int = SEGMENT_BYTES) -> DataFrame:
    """Cheapest repairs of the conversations in ``rows`` (conv_id, turn, role, text and, if named, the mark of dropped turns).

    One row for each segment of a conversation: conv_id, ``part`` (in its
    order), ``audit`` (letters), ``repaired`` (turns), ``cost`` (on the last
    segment), counts of faults, and ``distinct``, ``least`` and ``most`` of the
    turn numbers.  Sums over a conversation's rows are its own.
    """
    cut = common.written(segments(rows, dropped, turns, size), "conversation-segments")
    kind = _kind(cut, "conv")
    # written, so that its size is known: it goes to the tasks where it is small, instead of all texts to it
    several = common.written(cut.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv").alias("of")), "long-conversations")
    same = F.col("conv").eqNullSafe(F.col("of"))
    out = f"conv {kind}, part long, audit string, repaired {TURNS}, {RESULT}"
    alone = _mapped(cut.join(several, same, "left_anti"), out, _whole)

    parted = cut.join(several, same, "left_semi")
    keys = parted.select("conv", "part", F.explode(F.array_distinct("keys")).alias("key"))
    firsts = keys.groupBy("conv", "key").agg(F.min("part").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv").alias("of"), F.col("key").alias("seen"), "first")
    earlier = keys.join(firsts, same & (F.col("key") == F.col("seen")) & (F.col("part") > F.col("first"))).groupBy(F.col("part").alias("in")).agg(F.collect_list("key").alias("earlier"))
    narrow = f"conv {kind}, part long, codes binary, costs array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string, least long, most long, distinct long"
    codes = common.written(_mapped(parted.join(earlier, F.col("part") == F.col("in"), "left").drop("in"), narrow, _code), "conversation-codes")
    ahead = _carried(codes, f"{narrow}, before array<long>", lambda: ([0, FAR, FAR, FAR], None, None), _forward)
    behind = _carried(ahead, f"{narrow}, before array<long>, after array<long>, leads array<int>, is_last boolean, cost long", lambda: (None, True), _backward, back=True)
    paths = _carried(behind, f"{narrow}, before array<long>, after array<long>, leads array<int>, is_last boolean, cost long, state int, audit string", lambda: 0, _enter)
    results = paths.select(F.col("part").alias("in"), "state", "audit", "cost", *METRICS, "distinct", "least", "most")
    done = parted.join(results, F.col("part") == F.col("in")).drop("in", "turns", "keys")
    pieces = _mapped(done, out, lambda r: {**r, "repaired": repaired(r["audit"], r["roles"], r["texts"], r["state"])})
    return alone.withColumn("alone", F.lit(True)).unionByName(pieces.withColumn("alone", F.lit(False))).withColumnRenamed("conv", "conv_id")


def report(pieces: DataFrame) -> DataFrame:
    """One row for each conversation of repair()'s: gaps, faults, cost, audit and the SHA-256 of its repaired turns.

    Texts of several segments pass one task in order, as their hash must, a
    segment at a time.
    """
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("distinct"), F.lit(0)).alias("gaps")
    sums = [F.sum(c).alias(c) for c in (*METRICS, "cost")]
    one = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("distinct"), F.lit(0)).alias("gaps")
    whole = pieces.filter("alone").select("conv_id", one, *METRICS, "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parts = pieces.filter("not alone")
    counts = parts.groupBy(F.col("conv_id").alias("of")).agg(gaps, *sums)
    schema = f"conv {_kind(pieces, 'conv_id')}, audit string, repaired_sha256 string"

    def run(batches):
        conv, audit, digest, some = None, [], None, False
        out = lambda: pa.RecordBatch.from_pylist([{"conv": conv[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema=arrow)
        for batch in batches:
            for row in batch.to_pylist():
                if conv is None or conv[0] != row["conv"]:
                    if conv is not None:
                        yield out()
                    conv, audit, digest, some = (row["conv"],), [], hashlib.sha256(), False
                audit.append(row["audit"])
                if row["lines"] is not None:
                    digest.update((b"\n" if some else b"") + row["lines"].encode())
                    some = True
        if conv is not None:
            yield out()

    arrow = _arrow(schema)
    texts = parts.select(F.col("conv_id").alias("conv"), "part", "audit", F.when(F.size("repaired") > 0, lines).alias("lines"))
    joined = texts.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, schema)
    return whole.unionByName(joined.join(counts, F.col("conv").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("conv", "conv_id"))
