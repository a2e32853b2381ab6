"""Repair of damaged conversations at least cost, by depth-first branch and bound.

A repaired conversation is empty, or an optional system turn followed by pairs of user and
assistant. Each row is kept, given another role or deleted, and empty turns may be inserted
anywhere. A search node is (row, what was last said); its children are the edits that may
come next. An explicit stack holds open nodes, a bound per node says what the rest costs at
least, the incumbent is the cheapest whole repair so far, and the dominance table drops a
node reached before at no greater cost.

Conversations are sorted by ranges over all rows, so that a long one is dealt over tasks.
One that lies whole inside a task is repaired there. Others are cut into blocks: bounds run
backwards over the blocks, edits, counts and the hash of the text forwards, both one
block at a time. The hash is one sequence, so a conversation's last pass is one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import stage

BLOCK_ROWS = 4096
BLOCK_CHARS = 4_000_000

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
BLANKS = " \t\n\v\f\r"
LEGAL_PAIRS = ("su", "ua", "au")

# What was last said: nothing, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER_SPEECH = (USER, USER, ASSISTANT, USER)  # where a turn of user or assistant leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
END_BOUNDS = (0, 2 * COST[INSERT], COST[INSERT], 0)  # inserts that still complete the last pair
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults

RESULT_TYPE = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
               "audit string, repaired_sha256 string")
_FIELDS = [f.split()[0] for f in RESULT_TYPE.split(", ")]


# ---- damage

def damaged(rows: DataFrame) -> DataFrame:
    """Rows after the damage that ``crc32(conv_id:turn) % 20`` names; nulls are one blank.

    Alike rows are counted (``n``), so that each travels once. A lost row stays as a row
    with ``n`` 0, so that its conversation is not forgotten.
    """
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, text = shown("role"), shown("text")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(kind != 0, F.col("turn").cast("long")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("_n"),
    ).groupBy("conv_id", "turn", "role", "text", (F.col("_n") == 0).alias("lost")).agg(
        F.sum("_n").alias("n")).drop("lost")


# ---- search

def moves(q: int, initial: str, fault: int) -> list[tuple[str, int, int]]:
    """Edits of a row after state ``q``: (edit, cost, next state), in ASCII order."""
    out = [(DELETE, COST[DELETE], q)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    speech = AFTER_SPEECH[q]
    if initial == "s" and q == NOTHING:
        out.append((KEEP, COST[KEEP] + extra, SYSTEM))
    elif initial == ("u" if speech == USER else "a"):
        out.append((KEEP, COST[KEEP] + extra, speech))
    out.append((REROLE, COST[REROLE] + extra, speech))
    return out


# Per row kind and state what may be done with the row
MOVES = {(i, f): tuple(tuple(moves(q, i, f)) for q in range(4)) for i in ("s", "u", "a", "")
         for f in (FINE, BLANK, DUPLICATE, TRUNCATED)}
Code = tuple[str, int]  # initial of the role ("" if none of s, u, a), fault


def earlier_bounds(code: Code, after: tuple) -> tuple:
    """Least cost from before a row, given the least cost from after it, per state."""
    row = [min(c + after[to] for _, c, to in MOVES[code][q]) for q in range(4)]
    one = [min(row[q], COST[INSERT] + row[AFTER_SPEECH[q]]) for q in range(4)]
    return tuple(min(row[q], COST[INSERT] + one[AFTER_SPEECH[q]]) for q in range(4))


def repair(codes: list[Code], entry: int = NOTHING, exit_bounds: tuple = END_BOUNDS,
           last: bool = True) -> tuple[int, str, int]:
    """Cheapest edits over ``codes`` from state ``entry``: (cost, audit, state reached).

    ``exit_bounds`` is what the rows behind ``codes`` cost at least; ``last`` says that there
    are none, so that the search ends in a whole conversation. Of equal cost the audit that
    is least in ASCII wins: children wait on the stack cheapest bound first, then by edit,
    so the first whole repair of a cost has the least audit of that cost. (Two audits to
    one node of equal cost never are one the beginning of the other, as inserts cost.)
    """
    n = len(codes)
    bounds = [exit_bounds] * (n + 1)
    for i in range(n - 1, -1, -1):
        bounds[i] = earlier_bounds(codes[i], bounds[i + 1])
    best_cost, best_audit, best_state = None, None, entry
    reached: dict[tuple[int, int], int] = {}
    path: list[str] = []
    stack = [(0, "", 0, entry, 0)]  # depth, edit, row, state, cost
    while stack:
        depth, edit, i, q, cost = stack.pop()
        if best_cost is not None and cost + bounds[i][q] >= best_cost:
            continue
        if reached.get((i, q), cost + 1) <= cost:
            continue
        reached[i, q] = cost
        del path[max(depth - 1, 0):]
        if edit:
            path.append(edit)
        if i == n and (not last or q in (NOTHING, ASSISTANT)):
            # Before further rows the node's bound is what counts; inserts belong to them.
            best_cost, best_audit, best_state = cost + bounds[n][q] * (not last), "".join(path), q
            continue
        children = [] if i == n else [(e, i + 1, to, cost + c) for e, c, to in MOVES[codes[i]][q]]
        if i < n or last:
            children.append((INSERT, i, AFTER_SPEECH[q], cost + COST[INSERT]))
        children.sort(key=lambda x: (x[3] + bounds[x[1]][x[2]], x[0]), reverse=True)
        stack.extend((depth + 1, *child) for child in children)
    return best_cost, best_audit, best_state


# ---- one conversation, read in order

def fault_of(text: str, repeated: bool) -> int:
    """The first fault of a row."""
    seen = text.strip(BLANKS)
    if not seen:
        return BLANK
    if repeated:
        return DUPLICATE
    return FINE if seen[-1] in ".!?" else TRUNCATED


def code_of(role: str, fault: int) -> Code:
    return (role[:1] if role[:1] in ("s", "u", "a") else "", fault)


@dataclass
class Account:
    """Counts, edits and hash of a conversation whose rows come in order, block by block."""

    faults: list[int] = field(default_factory=lambda: [0] * 4)
    illegal: int = 0
    turns: list = field(default_factory=lambda: [None, None, 0])  # first, last, number
    said: str | None = None
    cost: int = 0
    audits: list[str] = field(default_factory=list)
    state: int = NOTHING
    lines: int = 0
    digest: object = field(default_factory=hashlib.sha256)

    def count(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.said is not None and self.said + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.said = role[:1]
        if turn is not None and turn != self.turns[1]:
            first = turn if self.turns[0] is None else self.turns[0]
            self.turns = [first, turn, self.turns[2] + 1]

    def _line(self, line: str) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.lines += 1
        self.digest.update(line.encode("utf-8", "surrogatepass"))

    def take(self, rows: list[tuple], faults: list[int], exit_bounds: tuple = END_BOUNDS,
             last: bool = True) -> None:
        """Rows ``(turn, role, text)`` with their faults, edited as the search says."""
        codes = [code_of(role, fault) for (_, role, _), fault in zip(rows, faults)]
        _, audit, _ = repair(codes, self.state, exit_bounds, last)
        at = 0
        for edit in audit:
            if edit == INSERT:
                self.state = AFTER_SPEECH[self.state]
                self.cost += COST[INSERT]
                self._line(f"{ROLE[self.state]}:")
                continue
            turn, role, text = rows[at]
            self.count(turn, role, faults[at])
            _, cost, to = next(m for m in MOVES[codes[at]][self.state] if m[0] == edit)
            self.cost += cost
            at += 1
            if edit != DELETE:
                self._line(f"{role if edit == KEEP else ROLE[to]}:{text}")
            self.state = to
        self.audits.append(audit)

    def result(self) -> tuple:
        first, end, number = self.turns
        gaps = 0 if first is None else min(end - first + 1 - number, 2**63 - 1)
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED],
                self.illegal, self.cost, "".join(self.audits), self.digest.hexdigest())


# ---- passes

_BLOCK_TYPE = ("conv_id long, block long, turns array<long>, roles array<string>, "
               "texts array<string>, marks array<binary>")
_FIRST_TYPE = f"{_BLOCK_TYPE}, {RESULT_TYPE}"
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("turns", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("marks", pa.list_(pa.binary())),
    *[(name, pa.string() if kind == "string" else pa.int64())
      for name, kind in (f.split() for f in RESULT_TYPE.split(", "))]])


def _mark(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{role}\0{text}".encode("utf-8", "surrogatepass")).digest()[:16]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for r in zip(*(b.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "n"))):
            yield r


def _emit(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded length and text."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(map(len, row.get("texts") or ()))
        if len(held) >= 2000 or chars >= BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def _first_pass(block_rows: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Results of conversations whole in this task, blocks of the others."""
        number = TaskContext.get().partitionId() << 32
        begun = whole = False
        conv, rows, chars = None, [], 0

        def block() -> dict:
            nonlocal number, rows, chars
            made = {"conv_id": conv, "block": number, "turns": [t for t, _, _ in rows],
                    "roles": [r for _, r, _ in rows], "texts": [t for _, _, t in rows],
                    "marks": [_mark(r, t) for _, r, t in rows]}
            number, rows, chars = number + 1, [], 0
            return made

        for next_conv, turn, role, text, n in _rows(batches):
            if not begun or next_conv != conv:
                if begun and whole:
                    seen: set = set()
                    faults = []
                    for _, r, t in rows:
                        faults.append(fault_of(t, (r, t) in seen))
                        seen.add((r, t))
                    account = Account()
                    account.take(rows, faults)
                    yield {"conv_id": conv, **dict(zip(_FIELDS, account.result()))}
                    rows, chars = [], 0
                elif begun:
                    yield block()
                # The first conversation of a task may have begun in the task before.
                whole, begun, conv = begun, True, next_conv
            for _ in range(n):
                if len(rows) >= block_rows or (rows and chars + len(text) > BLOCK_CHARS):
                    whole = False
                    yield block()
                rows.append((turn, role, text))
                chars += len(text)
        if begun:
            yield block()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit(pieces(batches))
    return run


def _faults(b: dict) -> list[int]:
    firsts = set(b["firsts"] or ())
    return [fault_of(t, i not in firsts) for i, t in enumerate(b["texts"])]


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in reverse order: per block the bounds behind it and whether it is the last."""
    conv, bounds, begun = None, END_BOUNDS, False
    for b in batches:
        out = []
        for block in b.to_pylist():
            last = not begun or block["conv_id"] != conv
            if last:
                conv, bounds, begun = block["conv_id"], END_BOUNDS, True
            out.append((block["block"], list(bounds), last))
            for initial, fault in zip(reversed(block["initials"]), reversed(block["faults"])):
                bounds = earlier_bounds((initial, fault), bounds)
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64())),
             pa.array([o[2] for o in out], pa.bool_())], names=["block", "bounds", "last"])


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order: one result per conversation."""
    def results() -> Iterator[dict]:
        account = Account()
        for b in batches:
            for block in (row for i in range(b.num_rows) for row in b.slice(i, 1).to_pylist()):
                rows = list(zip(block["turns"], block["roles"], block["texts"]))
                account.take(rows, _faults(block), tuple(block["bounds"]), block["last"])
                if block["last"]:
                    yield {"conv_id": block["conv_id"], **dict(zip(_FIELDS, account.result()))}
                    account = Account()
    yield from _emit(results())


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks without their texts: initials and faults alone."""
    for b in batches:
        blocks = [row for i in range(b.num_rows) for row in b.slice(i, 1).to_pylist()]
        faults = [_faults(x) for x in blocks]
        initials = [[code_of(r, FINE)[0] for r in x["roles"]] for x in blocks]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("block"), pa.array(initials, pa.list_(pa.string())),
             pa.array(faults, pa.list_(pa.int32()))], names=["conv_id", "block", "initials", "faults"])


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repair of every conversation after damage: ``conv_id`` and the columns of ``RESULT_TYPE``.

    ``rows`` has ``conv_id, turn, role, text``; other columns are ignored. Rows are taken
    by turn, null turns first; within a turn by role and then by the hash of the text.
    Null conversation ids are one conversation, null roles and texts one blank. A role that
    begins with none of s, u, a (the empty one too) cannot be kept, only changed. Alike rows
    are all but the first duplicates. Repeats across blocks are told by a 128-bit hash.
    """
    keys = ["conv_id", "turn", "role", "_mark"]
    marked = damaged(rows).withColumn("_mark", F.xxhash64("text"))
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").drop("_mark")
    found = stage(ordered.mapInArrow(_first_pass(block_rows), _FIRST_TYPE), "conversations")
    done = found.where("block IS NULL").select("conv_id", *_FIELDS)

    blocks = found.where("block IS NOT NULL").select(
        "conv_id", "block", "turns", "roles", "texts", "marks")
    firsts = blocks.select("conv_id", "block", F.posexplode("marks").alias("at", "mark")).groupBy(
        "conv_id", "mark").agg(F.min(F.struct("block", "at")).alias("first")).groupBy(
        F.col("first.block").alias("block")).agg(F.collect_list("first.at").alias("firsts"))
    known = stage(blocks.drop("marks").join(firsts, "block", "left"), "blocks")
    codes = known.mapInArrow(_codes, "conv_id long, block long, initials array<string>, faults array<int>")
    bounds = codes.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(
        _backwards, "block long, bounds array<long>, last boolean")
    forwards = known.join(stage(bounds, "bounds"), "block").repartition("conv_id").sortWithinPartitions(
        "conv_id", "block").mapInArrow(_forwards, _FIRST_TYPE).select("conv_id", *_FIELDS)
    return done.unionByName(forwards)
