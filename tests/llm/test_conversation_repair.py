"""Repairs of conversations against a search over all edit strings."""

import hashlib
import random
import zlib

import pytest

from chronovox.llm import conversation_repair as repair
from chronovox.llm import queries

SPACE = " \t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """(cost, audit, repaired turns): the least of all edit strings, grown a letter at a time from the cheapest."""
    faults, best = faults_of(rows), None
    onward = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    level = {(0, ""): (0, "", ())}  # place, last initial -> the least (cost, letters, turns)
    for place in range(len(rows) + 1):
        for _ in range(4):  # inserts in a row
            for (at, last), (cost, letters, turns) in list(level.items()):
                if at == place:
                    to = (at, onward[last])
                    new = (cost + 3, letters + "I", (*turns, (names[onward[last]], "")))
                    if to not in level or new[:2] < level[to][:2]:
                        level[to] = new
        if place == len(rows):
            break
        (role, text), fault = rows[place], faults[place]
        for (at, last), (cost, letters, turns) in list(level.items()):
            if at != place:
                continue
            moves = [("D", 4, last, turns)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                moves.append(("R", 3 + more, onward[last], (*turns, (names[onward[last]], text))))
                if (last, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    moves.append(("K", more, role[0], (*turns, (role, text))))
            for x, more, to, then in moves:
                new = (cost + more, letters + x, then)
                if (place + 1, to) not in level or new[:2] < level[place + 1, to][:2]:
                    level[place + 1, to] = new
    ends = [v for (at, last), v in level.items() if at == len(rows) and last in ("", "a")]
    best = min(ends, key=lambda v: v[:2])
    return best


def answer(turns):
    """The contract's row for one conversation; turns: (turn, role, text) in order."""
    rows = [(r, t) for _, r, t in turns]
    faults, known = faults_of(rows), [n for n, _, _ in turns if n is not None]
    cost, audit, left = plain(rows)
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    }


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if draw == 2 else text
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (1 + (draw == 3))
    return out


def answers(rows):
    turns = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damaged(rows):
        turns[conv].append((turn, role, text))
    return {c: answer(sorted(t, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))) for c, t in turns.items()}


def made(seed=5, conversations=60, length=14):
    rng = random.Random(seed)
    words = ["ok.", "ok", "yes!", "", " \n", "no?", "a b.", None]
    return [
        (c, None if rng.random() < 0.05 else 100 * t + rng.randint(0, 2), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(words) if rng.random() < 0.6 else f"text {rng.random()}.")
        for c in [*range(conversations), None]
        for t in range(rng.randint(1, length))
    ]


def rows_of(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def distinct_nulls(rows):
    """Only one turn without a number a conversation, so that the order of turns is given."""
    seen, out = set(), []
    for r in rows:
        if r[1] is not None or r[0] not in seen:
            out.append(r)
        if r[1] is None:
            seen.add(r[0])
    return out


@pytest.mark.parametrize("turns", [1, 3, 1000])
def test_against_all_edit_strings(spark, turns):
    rows = distinct_nulls(made())
    random.Random(1).shuffle(rows)
    found = repair.report(repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA)), turns=turns))
    assert rows_of(found) == answers(rows)


def test_segments_by_size_and_many_partitions(spark):
    rows = [(7, t, "user" if t % 3 else "assistant", "x" * (t % 50) + ".") for t in range(400)] + [(8, 1, "user", "only.")]
    found = repair.report(repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(7)), size=100))
    assert rows_of(found) == answers(rows)


def test_undamaged_general_interface(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 5, "assistant", "Well."), (3, None, None, None)]
    clash = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text AS part", "turn AS conv", "role AS codes")
    pieces = {r["conv_id"]: r for r in repair.repair(clash, dropped=None).collect()}
    assert pieces[1]["audit"] == "KKK" and [t["text"] for t in pieces[1]["repaired"]] == ["Be brief.", "Hi.", "Hello."]
    assert pieces[2]["audit"] == "IK" and pieces[2]["cost"] == 3 and [t.asDict() for t in pieces[2]["repaired"]] == [{"role": "user", "text": ""}, {"role": "assistant", "text": "Well."}]
    assert pieces[3]["audit"] == "D" and pieces[3]["repaired"] == [] and pieces[3]["blank"] == 1


def test_empty_table_dropped_conversations_and_ties(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.report(repair.repair(repair.damage(empty))).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row = rows_of(repair.report(repair.repair(repair.damage(spark.createDataFrame([(1, gone, "user", "Hi.")], SCHEMA)))))[1]
    assert row == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    kept = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 > 4)
    same = [(1, kept, "user", "Hi.")] * 5 + [(1, kept, "assistant", "Yes.")]  # of one number: by role
    for turns in (1, 2, 100):
        row = rows_of(repair.report(repair.repair(repair.damage(spark.createDataFrame(same, SCHEMA)), turns=turns)))[1]
        assert row == answer([(kept, "assistant", "Yes."), *[(kept, "user", "Hi.")] * 5]) and row["duplicate"] == 4


def test_a_long_text_and_string_ids(spark):
    rows = [("a", 1, "user", "word " * 400_000 + "."), ("a", 2, "assistant", "Fine."), ("b", 1, "assistant", "é" * 100_000)]
    found = rows_of(repair.report(repair.repair(repair.damage(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")))))
    assert found == answers(rows)


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op11_conversation_repair(spark, folder)) == answers(rows)
