"""Operator 11: the search against plain dynamic programming over whole strings, the table against plain code, and the defined cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from seatloom.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain(rows):
    """(cost, audit) over rows (letter, fault) by layers, whole strings kept."""

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                nxt = "a" if state == "u" else "u"
                made = (cost + 3, audit + "I")
                best[nxt] = min(best.get(nxt, made), made)
        return best

    best = inserted({"": (0, "")})
    for letter, fault in rows:
        after = {}

        def offer(state, made, after=after):
            after[state] = min(after.get(state, made), made)

        for state, (cost, audit) in best.items():
            offer(state, (cost + 4, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            offer("a" if state == "u" else "u", (cost + 3 + more, audit + "R"))
            if letter == "s" and state == "" or letter == "u" and state != "u" or letter == "a" and state == "u":
                offer(letter, (cost + more, audit + "K"))
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


def brute(table):
    """The contract's rows, conversation by conversation."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        told = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        text = "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        groups[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        letters = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        cost, audit = plain(list(zip(letters, faults, strict=True)))
        kept, state, at = [], "", 0
        for edit in audit:
            if edit in "IR":
                state = "a" if state == "u" else "u"
            elif edit == "K":
                state = letters[at]
            role = {"u": "user", "a": "assistant"}.get(state) if edit in "IR" else rows[at][1] if edit == "K" else None
            if role is not None:
                kept.append(f"{role}:{'' if edit == 'I' else rows[at][2]}")
            at += edit != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cheapest(seed):
    rng = random.Random(seed)
    names = {"s": 0, "u": 1, "a": 2, "x": 3}
    faults = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for _ in range(400):
        rows = [(rng.choice("ssuuuuaaaax"), rng.choice(["", "", "", *faults])) for _ in range(rng.randrange(14))]
        assert c.cheapest(bytes(names[a] * 4 + faults[f] for a, f in rows)) == plain(rows), rows


def test_long_conversations_take_time_in_proportion():
    rng = random.Random(5)
    rows = bytes(rng.choice((4, 8)) + rng.choice((0, 0, 1, 3)) for _ in range(20_000))
    cost, audit = c.cheapest(rows)
    assert (cost, audit) == plain([("sua"[b >> 2], ("", "blank", "duplicate", "truncated")[b & 3]) for b in rows]) and len(audit) >= 20_000


def test_random_tables_with_ties_nulls_and_repeats(spark):
    rng = random.Random(1)
    table = []
    for conv in [None, *range(300)]:
        for turn in rng.choices([None, *range(9)], k=rng.randrange(1, 12)):
            table.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]), rng.choice([None, "", " \t\n", "A.", "B! ", "no end", "é?\r\n", "a\x0bb.", "\x85", "wait..."])))
    assert got(c.repair_damaged(spark.createDataFrame(table, SCHEMA).repartition(5))) == brute(table)


def test_conversations_that_lose_all_rows(spark):
    lost = [(i, 0) for i in range(500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    out = got(c.repair_damaged(spark.createDataFrame([(i, t, "user", "Hi.") for i, t in lost], SCHEMA)))
    assert out == {i: (0, 0, 0, 0, 0, 0, "", EMPTY) for i, _ in lost}


def test_one_conversation_of_many_rows_over_many_batches(spark):
    """A third of all rows in one conversation: streamed, and the same as plain code says."""
    table = [(7, t, "user" if t % 2 == 0 else "assistant", f"Line {t % 4999}.") for t in range(9000)]
    table += [(conv, t, ("user", "assistant")[t % 2], f"Text {conv} {t}.") for conv in range(100, 3100) for t in range(6)]
    assert got(c.repair_damaged(spark.createDataFrame(table, SCHEMA))) == brute(table)


def test_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert c.repair_damaged(none).count() == 0 and c.repaired(none, c.audits(none)).count() == 0
    rows = spark.createDataFrame([(1, 1, "user", "Hello."), (1, 2, "assistant", "Yes.")], SCHEMA)
    wide = rows.selectExpr("*", "0 AS kind", "'x' AS audit", "1 AS digest", "2 AS what", "3 AS `_id`", "4 AS place")
    assert got(c.repair_damaged(wide)) == got(c.repair_damaged(rows))


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hm."), (1, 1, "user", "What?"), (1, 2, "user", "What?"), (1, 3, "user", "Well."), (1, 4, "system", "Be good.")], SCHEMA)
    found = c.audits(rows)
    want = plain([("a", ""), ("u", ""), ("u", "duplicate"), ("u", ""), ("s", "")])
    assert [tuple(r) for r in found.collect()] == [(1, 5, 0, 0, 1, 0, 3, *want)]
    out = c.repaired(rows, found).orderBy("place").collect()
    assert "".join(r.edit for r in out) == found.first().audit and [r.role for r in out if r.edit != "D"] == ["user", "assistant"] * 3
    assert all(r.text == "" and r.turn is None for r in out if r.edit == "I")


def test_no_second_shuffle_for_duplicates(spark):
    plan = c.audits(spark.createDataFrame([(1, 0, "user", "A.")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan


def test_paths_compare_as_their_texts():
    rng = random.Random(3)
    nodes = [c.Edits(None, "", 0)]
    while len(nodes) < 400:
        parent = rng.choice(nodes[-30:])
        edit = rng.choice("DIKR")
        if not any(x.before is parent and x.edit == edit for x in nodes[1:]):
            nodes.append(c.Edits(parent, edit, 0))
    for _ in range(5000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert (a < b) == (a.text() < b.text())
