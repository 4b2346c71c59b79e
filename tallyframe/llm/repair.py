"""Conversation repair by a generalised LR parse with weighted edits.

The grammar of roles says which sequences of role initials are a conversation.
Its LR table is built from the productions.  A stack of the parse is a linked
cell (state, stack below); equal stacks are one cell, so all stacks of a
conversation form a graph with shared tails.  Before each row the live stacks
are the possible readings of the edited rows so far.  A row is kept, gets
another role or is deleted, and roles may be inserted before it; every edit has
a weight, and readings that end in the same cell are merged: the cheapest one
stays, the audit (initials of the edits) that comes first in ASCII order among
equally cheap ones.

Two audits that have used up the same rows are never prefixes of each other, so
their order is settled once and for all and a number per live stack tells it.
A step depends only on the live stacks with their relative costs and on the
row's class, hence it is computed once and looked up afterwards; per row only a
reference to the step is held until the conversation ends.

Spark deals the rows by conversation, marks repeated rows with a window over
the same partitioning, sorts each partition by conversation and turn
(externally), and the parse streams through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import reach_workers

# The role grammar over role initials, the weights of the edits, and the roles that may be written.
GRAMMAR = {"Talk": ("", "Turns", "s Turns"), "Turns": ("u a", "Turns u a")}
START = "Talk"
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
WRITABLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

# From the cheapest reading any other can be imitated for at most two inserted roles more (to the end of a pair), then one
# deleted row or inserted role; a reading that costs more than that above it is on no cheapest repair.
MARGIN = 2 * INSERT + DELETE

END = "$"
FACTS = "n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# ------------------------------------------------------------------ LR table
class Table:
    """LR(0) states of a grammar; an action of every applicable kind is taken, so conflicts need no lookahead."""

    def __init__(self, grammar: dict[str, tuple[str, ...]], start: str) -> None:
        self.rules = [("", (start,))] + [(head, tuple(body.split())) for head, bodies in grammar.items() for body in bodies]
        self.heads = set(grammar)
        self.states: list[frozenset] = []
        self.moves: dict[tuple[int, str], int] = {}
        self._state(self._closure({(0, 0)}))

    def _closure(self, items: set[tuple[int, int]]) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in self.heads:
                for k, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (k, 0) not in items:
                        items.add((k, 0))
                        todo.append((k, 0))
        return frozenset(items)

    def _state(self, items: frozenset) -> int:
        if items in self.states:
            return self.states.index(items)
        self.states.append(items)
        number = len(self.states) - 1
        after: dict[str, set] = {}
        for rule, dot in items:
            body = self.rules[rule][1]
            if dot < len(body):
                after.setdefault(body[dot], set()).add((rule, dot + 1))
        for symbol, moved in sorted(after.items()):
            self.moves[number, symbol] = self._state(self._closure(moved))
        return number

    def reductions(self, state: int) -> list[tuple[str, int]]:
        """(head, body length) of every rule that is complete in ``state``; the start rule has head ''."""
        return [(self.rules[rule][0], dot) for rule, dot in self.states[state] if dot == len(self.rules[rule][1])]


class Stacks:
    """Stacks as interned cells (state, cell below): number 0 is the empty parse."""

    def __init__(self, table: Table) -> None:
        self.table = table
        self.cells: list[tuple[int, int | None]] = []
        self.number: dict[tuple[int, int | None], int] = {}
        self.known: dict[tuple[int, str], frozenset[int]] = {}
        self._cell(0, None)

    def _cell(self, state: int, below: int | None) -> int:
        key = (state, below)
        if key not in self.number:
            self.number[key] = len(self.cells)
            self.cells.append(key)
        return self.number[key]

    def _reduced(self, cell: int) -> list[int]:
        """The cell and all that reductions make of it."""
        found, todo = [cell], [cell]
        while todo:
            top = todo.pop()
            for head, size in self.table.reductions(self.cells[top][0]):
                below: int | None = top
                for _ in range(size):
                    below = self.cells[below][1]
                to = self.table.moves.get((self.cells[below][0], head)) if head else None
                if to is not None:
                    new = self._cell(to, below)
                    if new not in found:
                        found.append(new)
                        todo.append(new)
        return found

    def after(self, cell: int, symbol: str) -> frozenset[int]:
        """Cells after reading ``symbol`` (``END``: the cell itself if the parse may end there, else none)."""
        key = (cell, symbol)
        if key not in self.known:
            tops = self._reduced(cell)
            if symbol == END:
                done = any(head == "" for t in tops for head, _ in self.table.reductions(self.cells[t][0]))
                self.known[key] = frozenset([cell] if done else [])
            else:
                moved = (self.table.moves.get((self.cells[t][0], symbol)) for t in tops)
                self.known[key] = frozenset(self._cell(to, t) for t, to in zip(tops, moved, strict=True) if to is not None)
        return self.known[key]


# ------------------------------------------------------------------ weighted edits
#: Row classes: the initial of its role, and whether it must go or lacks an ending.
FINE, CUT_SHORT, MUST_GO = 0, 1, 2


class Repairer:
    """Cheapest edits of one conversation after another; steps are remembered across conversations."""

    HELD_STEPS = 100_000

    def __init__(self, grammar: dict[str, tuple[str, ...]] = GRAMMAR, start: str = START, margin: int = MARGIN) -> None:
        self.stacks, self.margin = Stacks(Table(grammar, start)), margin
        self.steps: dict[tuple, tuple] = {}

    def _inserted(self, cell: int) -> list[tuple[int, int]]:
        """(inserts, cell) for every cell that inserted roles reach, fewest inserts first."""
        best, rim, n = {cell: 0}, [cell], 0
        while rim:
            n += 1
            rim = [c for old in rim for t in WRITABLE for c in self.stacks.after(old, t) if c not in best]
            best.update((c, n) for c in rim)
            if n > 2 * len(WRITABLE):
                break
        return [(n, c) for c, n in best.items()]

    def step(self, live: tuple, row: tuple[str, int] | None) -> tuple[tuple, int, tuple]:
        """(live stacks after the row, cost taken off them all, their origins).

        ``live`` holds (cell, cost above the cheapest) in the order of the
        audits; an origin is (place in ``live``, edits).  Without a row: the end.
        """
        key = (live, row)
        if key in self.steps:
            return self.steps[key]
        best: dict[int, tuple[int, int, str]] = {}

        def offer(cell: int, cost: int, place: int, edits: str) -> None:
            if cell not in best or (cost, place, edits) < best[cell]:      # place: rank of the audit so far
                best[cell] = (cost, place, edits)

        for place, (cell, cost) in enumerate(live):
            for n, top in self._inserted(cell):
                spent, edits = cost + n * INSERT, "I" * n
                if row is None:
                    if self.stacks.after(top, END):
                        offer(0, spent, place, edits)
                    continue
                initial, kind = row
                if kind == MUST_GO:
                    continue
                extra = TRUNCATED if kind == CUT_SHORT else 0
                for to in self.stacks.after(top, initial):
                    offer(to, spent + extra, place, edits + "K")
                for t in WRITABLE:
                    for to in self.stacks.after(top, t):
                        offer(to, spent + extra + REROLE, place, edits + "R")
            if row is not None:
                offer(cell, cost + DELETE, place, "D")
        least = min(cost for cost, _, _ in best.values())
        kept = sorted((place, edits, cell, cost) for cell, (cost, place, edits) in best.items() if cost <= least + self.margin)
        found = (tuple((cell, cost - least) for _, _, cell, cost in kept), least, tuple((place, edits) for place, edits, _, _ in kept))
        if len(self.steps) > self.HELD_STEPS:
            self.steps.clear()
        self.steps[key] = found
        return found


@dataclass
class Reading:
    """What one live stack has written up to the last commit: its digest, the initial of its last role, its audit."""

    digest: object
    last: str | None
    audit: tuple | None                 # (audit before, edits)

    def extended(self, edits: str, rows: list[tuple[str, str]]) -> Reading:
        digest, last = self.digest.copy(), self.last
        for _, role, text in written_rows(edits, rows, last):
            digest.update(f"{'' if last is None else chr(10)}{role}:{text}".encode())
            last = role[:1]
        return Reading(digest, last, (self.audit, edits))


def written_rows(edits: str, rows: Sequence[tuple[str, str]], last: str | None = None) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that the edits leave or insert; ``last`` is the initial of the role before them."""
    left = iter(rows)
    for edit in edits:
        role, text = next(left) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = WRITABLE["a" if last == "u" else "u"]
        last = role[:1]
        yield edit, role, text


class Parse:
    """One conversation being read.

    Per row it holds the text and a reference to the step taken.  After
    ``CHUNK_ROWS`` rows or ``CHUNK_CHARS`` characters these are given up: every
    live stack (there are a few) takes over the digest and the audit of the
    stack it came from.  So a conversation of any length needs a chunk and its audits.
    """

    CHUNK_ROWS = 4096
    CHUNK_CHARS = 1 << 20

    def __init__(self, repairer: Repairer) -> None:
        self.repairer, self.live, self.cost = repairer, ((0, 0),), 0
        self.readings = [Reading(hashlib.sha256(), None, None)]
        self.taken: list[tuple] = []
        self.rows: list[tuple[str, str]] = []
        self.chars = 0

    def _step(self, row: tuple[str, int] | None) -> None:
        self.live, least, origins = self.repairer.step(self.live, row)
        self.cost += least
        self.taken.append(origins)

    def read(self, role: str, text: str, kind: int) -> None:
        self._step((role[:1], kind))
        self.rows.append((role, text))
        self.chars += len(text)
        if len(self.rows) >= self.CHUNK_ROWS or self.chars >= self.CHUNK_CHARS:
            self._commit()

    def _commit(self) -> None:
        readings = []
        for place in range(len(self.live)):
            edits = []
            for origins in reversed(self.taken):
                place, own = origins[place]
                edits.append(own)
            readings.append(self.readings[place].extended("".join(reversed(edits)), self.rows))
        self.readings, self.taken, self.rows, self.chars = readings, [], [], 0

    def finish(self) -> tuple[int, str, str]:
        """(cost, audit, digest of the repaired rows)."""
        self._step(None)
        self._commit()
        audit, parts = self.readings[0].audit, []
        while audit is not None:
            audit, edits = audit
            parts.append(edits)
        return self.cost, "".join(reversed(parts)), self.readings[0].digest.hexdigest()


# ------------------------------------------------------------------ Spark
def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with planted faults: by crc32('conv:turn') % 20, 0 drops a row, 1 empties its text, 2 removes ``.!?`` from
    it, 3 repeats it, 4 makes it the user's.  Columns _conv, _turn, _role, _text, _copy; _copy is null for a dropped
    row, which stays as a trace of its conversation.  Nulls in role, text and in the key of the checksum are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(text_col), space)
    copies = F.when(hit == 0, F.array(F.lit(None).cast("int"))).when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"),
        F.when(hit == 4, "user").otherwise(F.coalesce(F.col(role_col), space)).alias("_role"),
        F.when(hit <= 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("_text"),
        F.explode(copies).alias("_copy"))


def plain(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows as they are, in the columns that :func:`repair_conversations` reads."""
    return df.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("_role"),
                     F.coalesce(F.col(text_col), F.lit(" ")).alias("_text"), F.lit(0).alias("_copy"))


def _last_char(text: Column) -> Column:
    """The last character that is no ASCII white space ('' if there is none)."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted by turn in it, with ``_fault`` ('' for none, null for a dropped row).

    One exchange: the window that finds repeated rows and the sort run inside
    the same partitions, both with external sorts.
    """
    last = _last_char(F.col("_text"))
    order = [F.col("_turn").asc_nulls_first(), "_role", "_text", "_copy"]
    dealt = rows.withColumn("_last", last).repartition("_conv")
    seen = F.row_number().over(Window.partitionBy("_conv", "_role", "_text").orderBy(F.col("_turn").asc_nulls_first(), "_copy"))
    fault = (F.when(F.col("_copy").isNull(), None).when(F.col("_last") == "", "blank")
             .when(F.col("_seen") > 1, "duplicate").when(~F.col("_last").isin(".", "!", "?"), "truncated").otherwise(""))
    # A dropped row is no earlier copy of another: it sorts into a group of its own.
    marked = dealt.withColumn("_role", F.when(F.col("_copy").isNull(), None).otherwise(F.col("_role"))).withColumn("_seen", seen)
    return (marked.withColumn("_fault", fault).drop("_last", "_seen")
            .sortWithinPartitions("_conv", *order))


class _Open:
    """Facts of the conversation that a task is reading."""

    def __init__(self, conv: object, repairer: Repairer) -> None:
        self.conv, self.parse = conv, Parse(repairer)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.n = self.illegal = self.turns = 0
        self.before = ""
        self.low = self.turn = None

    def read(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.turn:            # rows come by turn
            self.low, self.turn, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.n and self.before + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.before, self.n = role[:1], self.n + 1
        if fault:
            self.faults[fault] += 1
        self.parse.read(role, text, MUST_GO if fault in ("blank", "duplicate") else CUT_SHORT if fault else FINE)

    def facts(self) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.conv, self.n, gaps, *self.faults.values(), self.illegal, *self.parse.finish())


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its faults and its cheapest repair.

    ``rows`` comes from :func:`plain` or :func:`damaged`.  Columns: ``conv_col``, n_rows, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256 (of ``role:text`` lines).

    A conversation is read by one task, since the digest of its text runs
    through it from first to last; the task holds a chunk of it at a time.

    Defined cases: a null turn comes before all others; rows of equal turn go by
    role, then text; null role and null text are one space, thus a role that
    is nobody's and a blank text; rows without a conversation form one; repeated
    rows are duplicates; roles with other initials than s, u, a fit nowhere
    unless rewritten; a conversation without rows (all dropped) has zeros, an
    empty audit and the digest of the empty text; an empty table gives an empty
    result; extra columns are ignored, whatever their names.
    """
    reach_workers(rows.sparkSession)
    ordered = ordered_rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, current = Repairer(), None
        for batch in batches:
            done = []
            for conv, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_turn", "_role", "_text", "_fault")), strict=True):
                if current is None or conv != current.conv:
                    if current is not None:
                        done.append(current.facts())
                    current = _Open(conv, repairer)
                if fault is not None:
                    current.read(turn, role, text, fault)
            yield from _facts(done, batch.schema.field("_conv").type)
            kind = batch.schema.field("_conv").type
        if current is not None:
            yield from _facts([current.facts()], kind)

    conv_type = rows.schema["_conv"].dataType.simpleString()
    return ordered.mapInArrow(run, f"_conv {conv_type}, {FACTS}").withColumnRenamed("_conv", conv_col)


def _facts(done: list[tuple], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if done:
        conv, *numbers, audit, digest = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, conv_type), *[pa.array(n, pa.int64()) for n in numbers], pa.array(audit, pa.string()), pa.array(digest, pa.string())],
            ["_conv", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])


def repaired_rows(rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The conversations after repair: ``conv_col``, place (from 0), edit (K, R or I), role, text.

    ``repairs`` is the result of :func:`repair_conversations` for the same
    ``rows``; each audit is sorted before the rows of its conversation, so one
    task streams through both.
    """
    reach_workers(rows.sparkSession)
    kept = rows.where("_copy IS NOT NULL").withColumn("_audit", F.lit(None).cast("string"))
    heads = repairs.select(F.col(conv_col).alias("_conv"), F.col("audit").alias("_audit"))
    both = kept.unionByName(heads, allowMissingColumns=True).repartition("_conv").sortWithinPartitions(
        "_conv", F.col("_audit").isNull(), F.col("_turn").asc_nulls_first(), "_role", "_text", "_copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits: list[str] = []
        last, place = None, 0

        def put(out: list, conv: object, upto_row: tuple[str, str] | None) -> None:
            nonlocal last, place
            while edits and (edits[-1] == "I" or upto_row is not None):
                edit = edits.pop()
                own = [] if edit == "I" else [upto_row]
                for kind, role, text in written_rows(edit, own, last):
                    out.append((conv, place, kind, role, text))
                    last, place = role[:1], place + 1
                if own:
                    return

        conv_type, previous = None, None
        for batch in batches:
            conv_type, out = batch.schema.field("_conv").type, []
            for conv, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_role", "_text", "_audit")), strict=True):
                if audit is not None:
                    put(out, previous, None)
                    edits, last, place, previous = list(reversed(audit)), None, 0, conv
                else:
                    put(out, conv, (role, text))
            yield from _batch(out, conv_type)
        out = []
        put(out, previous, None)
        yield from _batch(out, conv_type)

    def _batch(out: list, conv_type: pa.DataType | None) -> Iterator[pa.RecordBatch]:
        if out:
            conv, place, edit, role, text = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(conv, conv_type), pa.array(place, pa.int64()), pa.array(edit, pa.string()),
                                              pa.array(role, pa.string()), pa.array(text, pa.string())], ["_conv", "place", "edit", "role", "text"])

    conv_type = rows.schema["_conv"].dataType.simpleString()
    return both.mapInArrow(run, f"_conv {conv_type}, place long, edit string, role string, text string").withColumnRenamed("_conv", conv_col)
