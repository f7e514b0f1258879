"""Repair of conversation structure by Dijkstra over an edit lattice (operator 11).

A conversation's roles, by their first letters, should read ``(s?(ua)+)?``. Its rows, in order of turn, are edited: Keep (0),
Rerole to user or assistant (3), Delete (4; blank and duplicate rows must go), Insert an empty user or assistant turn (3). A
truncated row that stays costs 3 more. The cheapest edits win, of equally cheap ones those whose initials come first.

1. ``audits``: of each row only its key, turn, role, a digest and two bits are shuffled, by conversation, and sorted in their
   partition; a window on the same partitioning finds duplicates without another shuffle. A task then streams over the
   conversations. What it holds of one is a byte a row; its edits are found by Dijkstra on the lattice (rows consumed, state
   of the grammar), which is never built: nodes come into being when they are reached. The priority is (cost, edits); the
   first accepting end node that is popped is the answer. Edits are paths of a tree with jump pointers, so that two of them
   are compared in logarithmic time whatever their length. Distinct short conversations are solved once a worker.
2. ``repaired``: the texts are shuffled once, each conversation's edits sorted before its rows, so a task that streams over
   them applies an edit as it meets a row. No conversation is ever held, however many rows it has.

One conversation is one sequence (its repair at a row depends on all others, and so does a hash of it), so its rows pass
through one task; that task's memory does not grow with them but for a byte a row, some more while its edits are found.

Defined cases: a null role or text is one blank, so its row is blank or has the role " ", which no grammar has. Turns that
are null come first; rows with the same turn are ordered by role, then by the digest of role and text, and equal rows are
duplicates. Rows without conv_id are one conversation. Empty text is blank. An empty table gives no rows. Extra columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.llm.common import bound_batches, cut, fields, tidy

# Costs of the edits, what a truncated row costs that stays, blanks, what may end a text.
RECAST, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"

#: Faults of a row, of which the first counts.
FINE, BLANK, DUPLICATE, UNENDED = range(4)
#: States of the grammar: nothing yet, after a system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn leads to, whichever may come next.
AFTER = (USER, USER, ASSISTANT, USER)
#: By first letter of a role (its place in "sua", else 3) the states that may come before it.
MAY_FOLLOW = ((START,), (START, SYSTEM, ASSISTANT), (USER,), ())
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Conversations of at most so many rows are remembered by what their rows are like, so many of them.
SHORT, REMEMBERED = 64, 1 << 16
#: Rows that a task hands on at a time.
ROWS = 1000


# ---------------------------------------------------------------- the search


class Edits:
    """A path of edits and its cost: the last edit, the path before it, and a jump to a far enough earlier one."""

    __slots__ = ("before", "cost", "edit", "jump", "length")

    def __init__(self, before: Edits | None, edit: str, cost: int):
        self.before, self.edit, self.cost = before, edit, cost
        self.length = before.length + 1 if before else 0
        if before is None:
            self.jump = self
        else:
            near = before.jump
            self.jump = near.jump if before.length - near.length == near.length - near.jump.length else before

    def up(self, length: int) -> Edits:
        """The path's first so many edits."""
        node = self
        while node.length > length:
            node = node.jump if node.jump.length >= length else node.before
        return node

    def __lt__(self, other: Edits) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        n = min(self.length, other.length)
        a, b = self.up(n), other.up(n)
        if a is b:
            return self.length < other.length
        while a.before is not b.before:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.before, b.before)
        return a.edit < b.edit

    def text(self) -> str:
        out, node = [], self
        while node.before is not None:
            out.append(node.edit)
            node = node.before
        return "".join(reversed(out))


def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and initials of the edits. A row is 4 times the place of its role's first letter in "sua" (else 3), plus its fault."""
    n = len(rows)
    done = bytearray(4 * (n + 1))
    heap = [(Edits(None, "", 0), START)]  # lattice nodes are 4 * rows consumed + state
    while True:
        path, node = heappop(heap)
        if done[node]:
            continue
        done[node] = 1
        i, state = divmod(node, 4)
        if i == n and state in (START, ASSISTANT):
            return path.cost, path.text()

        def reach(edit: str, cost: int, target: int, path: Edits = path) -> None:
            if not done[target]:
                heappush(heap, (Edits(path, edit, path.cost + cost), target))

        reach("I", INSERT, 4 * i + AFTER[state])
        if i == n:
            continue
        letter, fault = divmod(rows[i], 4)
        reach("D", DELETE, 4 * (i + 1) + state)
        if fault in (BLANK, DUPLICATE):
            continue
        more = TRUNCATED if fault == UNENDED else 0
        reach("R", RECAST + more, 4 * (i + 1) + AFTER[state])
        if state in MAY_FOLLOW[letter]:
            reach("K", more, 4 * (i + 1) + letter + 1)


_remembered = lru_cache(REMEMBERED)(cheapest)


def edits_of(rows: bytes) -> tuple[int, str]:
    return _remembered(rows) if len(rows) <= SHORT else cheapest(rows)


# ---------------------------------------------------------------- rows in order


def _rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a digest of the two, by which equal rows are known."""
    rows = fields(turns, "conv_id", "turn", "role", "text")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", text("role"), text("text"))
    return rows.withColumn("digest", F.unhex(F.left(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256), F.lit(32))))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations together, their rows in order."""
    return rows.sortWithinPartitions("conv_id", *first, "turn", "role", "digest")


def _same(a, b) -> bool:
    return a == b or a is None and b is None


def _stretches(column: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and row after the last of each stretch of equal (or null) values."""
    values, i = column.to_pylist(), 0
    for j in range(1, len(values) + 1):
        if j == len(values) or not _same(values[i], values[j]):
            yield i, j
            i = j


class _Tally:
    """What is known of one conversation so far: a byte for each row, and its turns."""

    def __init__(self):
        self.rows, self.least, self.turn, self.distinct = bytearray(), None, None, 0

    def add(self, codes: np.ndarray, turns: list) -> None:
        self.rows += codes.tobytes()
        for t in turns:  # in order, nulls first
            if t is not None and t != self.turn:
                self.least, self.turn, self.distinct = t if self.least is None else self.least, t, self.distinct + 1

    def told(self) -> tuple:
        codes = np.frombuffer(self.rows, np.uint8)
        faults, letters = codes & 3, codes >> 2
        pairs = letters[:-1] * 4 + letters[1:]
        gaps = self.turn - self.least + 1 - self.distinct if self.distinct else 0
        counts = [int((faults == f).sum()) for f in (BLANK, DUPLICATE, UNENDED)]
        return len(codes), gaps, *counts, int((~np.isin(pairs, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))).sum()), *edits_of(bytes(self.rows))


_TOLD = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(turns: DataFrame) -> DataFrame:
    """A row for each conversation: conv_id, n_rows, gaps (turns that are missing between the first and the last), rows by
    fault (blank, duplicate, truncated), illegal (neighbours that the grammar doesn't have), cost and audit (the edits'
    initials: D, I, K, R)."""
    bound_batches(turns.sparkSession)
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(*ENDS), UNENDED).otherwise(FINE)
    rows = _rows(turns)
    light = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "digest", fault.alias("fault")).repartition("conv_id")
    # the partitioning by conversation serves the window too
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy("turn"))
    light = light.withColumn("fault", F.when((F.col("fault") != BLANK) & (seen > 1), DUPLICATE).otherwise(F.col("fault")))
    letter = F.position(F.left("role", F.lit(1)), F.lit("sua"))
    code = F.when((letter > 0) & (F.col("role") != ""), letter - 1).otherwise(3) * 4 + F.col("fault")
    kind = light.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, tally, out = None, None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:-1]], pa.array(columns[-1], pa.string())], ["conv_id", *_TOLD, "audit"])

        for batch in batches:
            ids, codes, when = batch.column("conv_id"), batch.column("code").to_numpy().astype(np.uint8), batch.column("turn").to_pylist()
            id_type = ids.type
            for i, j in _stretches(ids):
                key = ids[i].as_py()
                if tally is None or not _same(key, open_):
                    if tally is not None:
                        out.append((open_, *tally.told()))
                    open_, tally = key, _Tally()
                tally.add(codes[i:j], when[i:j])
            if len(out) >= ROWS:
                yield batch_of(out)
                out = []
        if tally is not None:
            yield batch_of([*out, (open_, *tally.told())])

    return _in_order(light).select("conv_id", "turn", code.cast("int").alias("code")).mapInArrow(tidy(run), f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _TOLD) + ", audit string")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (D, I, K, R), turn (null where inserted), role, text: every row of the conversations in
    turns after the edits of found (audits() of them) with what was deleted and inserted, in order inside a partition."""
    rows = _rows(turns).select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "text", "digest", F.lit(None).cast("string").alias("audit"))
    none = lambda k: F.lit(None).cast(k)
    heads = found.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("binary").alias("digest"), "audit")
    both = _in_order(heads.union(rows).repartition("conv_id"), "kind").select("conv_id", "kind", "turn", "role", "text", "audit")
    kind = both.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, at, state, place, out = None, "", 0, START, 0, []

        def put(edit: str, turn, role, text) -> None:
            nonlocal place
            out.append((key, place, edit, turn, role, text))
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                at, state = at + 1, AFTER[state]
                put("I", None, ROLES[state], "")

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "place", "edit", "turn", "role", "text"])

        for batch in batches:
            id_type = batch.column("conv_id").type
            for id_, head, turn, role, text, edits in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "audit")], strict=True):
                if head == 0:
                    inserts()  # those at the end of the one before
                    key, audit, at, state, place = id_, edits, 0, START, 0
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "R":
                    state = AFTER[state]
                    role = ROLES[state]
                elif edit == "K":
                    state = "sua".index(role[0]) + 1
                put(edit, turn, role, text)
            if out:
                yield batch_of()
                out.clear()
        inserts()
        if out:
            yield batch_of()

    return both.mapInArrow(tidy(run), f"conv_id {kind}, place long, edit string, turn long, role string, text string")


# ---------------------------------------------------------------- the query's damage and digest


def damage(turns: DataFrame) -> tuple[Column, DataFrame]:
    """What is done to a row (by a checksum of its conversation and turn): 0 drops it, 1 empties its text, 2 takes the text's
    ends of sentences, 3 repeats it, 4 makes it the user's; and the rows afterwards. Nulls are one blank."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = fields(turns, "conv_id", "turn", "role", "text").withColumn("what", what)
    left = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    role = F.when(F.col("what") == 4, "user").otherwise(text("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("what") == 0, 0).when(F.col("what") == 3, 2).otherwise(1).cast("int"))
    return what, rows.select("conv_id", "turn", role.alias("role"), left.alias("text"), F.explode(times).alias("_")).drop("_")


def hashes(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of repaired() rows, those that stay as ``role:text``, joined by line breaks. A task takes
    them as they come and holds none."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, first, out = None, None, True, []

        def batch_of(id_type) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], id_type), pa.array([h for _, h in out], pa.string())], ["conv_id", "repaired_sha256"])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("conv_id").type
            for id_, place, edit, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "edit", "role", "text")], strict=True):
                if place == 0:
                    if sha is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha, first = id_, hashlib.sha256(), True
                if edit != "D":
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if len(out) >= ROWS:
                yield batch_of(id_type)
                out.clear()
        if sha is not None:
            out.append((key, sha.hexdigest()))
            yield batch_of(id_type)

    return rows.mapInArrow(tidy(run), f"conv_id {kind}, repaired_sha256 string")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """The query: conversations are damaged, audited and repaired. A row for each conversation of turns; one of which
    damage leaves nothing has zeros, no edits and the hash of the empty text."""
    what, rows = damage(turns)
    found = cut(audits(rows))
    told = [F.col(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")]
    sums = hashes(repaired(rows, found)).withColumnRenamed("conv_id", "_id")
    out = found.join(sums, F.col("conv_id").eqNullSafe(F.col("_id"))).select("conv_id", *told, "repaired_sha256")
    gone = fields(turns, "conv_id", "turn").groupBy("conv_id").agg(F.max((what != 0).cast("int")).alias("left")).where("left = 0")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.union(gone.select("conv_id", *zeros, F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256")))
