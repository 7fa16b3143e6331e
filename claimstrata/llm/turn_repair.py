"""Conversation structure repair: the cheapest edits that give well-formed turns.

A conversation is well formed if its role initials are empty, or an optional
system turn and then user and assistant turns in alternation. Four states
follow from that: nothing yet (0), after system (1), after user (2), after
assistant (3). A row is kept, given the role that the state asks for, or
deleted, and turns may be inserted; a dynamic program over rows and states
finds the cheapest edits. Of equally cheap ones that with the least string of
initials is taken.

The strings are not held. Each edit is a node that links to the one before, so
states share their beginnings. Nodes know ancestors at distances of powers of
two and a rolling hash of the edits from the root, and two strings are compared
by a search for their longest common prefix.

Two strings of equal cost that lead to one state over the same rows are never a
prefix of one another: what the longer one adds would be inserted turns that
return to the same state, and those cost. So the least string so far stays
least however it goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from claimstrata.llm.frames import with_package

# Fixed values of the contract.
RESHAPE, REMOVE, INSERT, TRUNCATED = 1, 2, 5, 5
DAMAGES = 20
DROPPED, EMPTIED, UNPOINTED, REPEATED, TURNED = range(5)
POINTS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"

BASE, MODULUS = 1_000_003, (1 << 61) - 1
# Edits between two looks for a beginning that all states share.
SETTLE = 2048
OUT_ROWS = 4096

# The state after a turn that is made or given the right role, and that role.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
# The state after a kept turn by its role's initial; others cannot be kept.
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ORDERLY = {"su", "ua", "au"}


class Edit:
    """An edit after another one, with ancestors at distances 1, 2, 4 and so on."""

    __slots__ = ("initial", "depth", "hash", "up")

    def __init__(self, before: Edit | None = None, initial: str = "") -> None:
        self.initial = initial
        self.up: list[Edit] = []
        if before is None:
            self.depth = self.hash = 0
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * BASE + ord(initial)) % MODULUS
        ancestor, k = before, 0
        while True:
            self.up.append(ancestor)
            if k >= len(ancestor.up):
                break
            ancestor, k = ancestor.up[k], k + 1

    def above(self, steps: int) -> Edit:
        node, k = self, 0
        while steps:
            if steps & 1:
                node = node.up[k]
            steps, k = steps >> 1, k + 1
        return node


def _parting(a: Edit, b: Edit) -> tuple[Edit, Edit] | None:
    """The first nodes that differ in two strings of one depth, edit by edit back to a shared node."""
    found = None
    while a is not b:
        if a.initial != b.initial:
            found = a, b
        a, b = a.up[0], b.up[0]
    return found


def less(a: Edit, b: Edit) -> bool:
    """Whether the string of ``a`` stands before that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.above(a.depth - depth), b.above(b.depth - depth)
    if x.hash == y.hash:
        parted = _parting(x, y)
        if parted is None:
            return a.depth < b.depth
        x, y = parted
    else:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        # The hashes of the two prefixes agree; the strings part earlier if that is a collision.
        x, y = _parting(x.up[0], y.up[0]) or (x, y)
    return x.initial < y.initial


class Audit:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.edits = 0
        self.states: list[tuple[int, Edit] | None] = [(0, Edit()), None, None, None]
        self._insert()

    @staticmethod
    def _offer(states: list, state: int, cost: int, before: Edit, initial: str) -> None:
        held = states[state]
        if held is not None and cost > held[0]:
            return
        made = Edit(before, initial)
        if held is None or cost < held[0] or less(made, held[1]):
            states[state] = (cost, made)

    def _insert(self) -> None:
        """Turns put in here. Those that end after a user turn come first; no other way round is cheaper."""
        states = self.states
        for state in (0, 1, 3, 2):
            if states[state] is not None:
                cost, node = states[state]
                self._offer(states, _NEXT[state], cost + INSERT, node, "I")
        # After an assistant turn all goes on that does from 0 or 1, for a deleted system turn more.
        bound = states[3][0]
        for state, more in ((0, REMOVE), (1, 0)):
            if states[state] is not None and states[state][0] > bound + more:
                states[state] = None

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        after: list[tuple[int, Edit] | None] = [None] * 4
        stays = TRUNCATED if truncated else 0
        for state, held in enumerate(self.states):
            if held is None:
                continue
            cost, node = held
            self._offer(after, state, cost + REMOVE, node, "D")
            if must_go:
                continue
            self._offer(after, _NEXT[state], cost + RESHAPE + stays, node, "R")
            if initial in _KEPT[state]:
                self._offer(after, _KEPT[state][initial], cost + stays, node, "K")
        self.states = after
        self._insert()
        self.edits += 1
        if self.edits % SETTLE == 0:
            self._settle()

    def _settle(self) -> None:
        """Put the beginning that all states share aside and start a new tree behind it."""
        live = [held[1] for held in self.states if held is not None]
        depth = min(node.depth for node in live)
        nodes = {node.above(node.depth - depth) for node in live}
        while len(nodes) > 1:
            nodes, depth = {node.up[0] for node in nodes}, depth - 1
        shared = nodes.pop()
        self.settled.append(_initials(shared, 0))
        made = {id(shared): Edit()}

        def copy(node: Edit) -> Edit:
            path = []
            while id(node) not in made:
                path.append(node)
                node = node.up[0]
            new = made[id(node)]
            for old in reversed(path):
                new = made[id(old)] = Edit(new, old.initial)
            return new

        self.states = [held and (held[0], copy(held[1])) for held in self.states]

    def result(self) -> tuple[int, str]:
        """Cost and initials of the cheapest edits that end well."""
        ends = [held for held in (self.states[0], self.states[3]) if held is not None]
        best = ends[0]
        for held in ends[1:]:
            if held[0] < best[0] or (held[0] == best[0] and less(held[1], best[1])):
                best = held
        return best[0], "".join(self.settled) + _initials(best[1], 0)


def _initials(node: Edit, depth: int) -> str:
    found = []
    while node.depth > depth:
        found.append(node.initial)
        node = node.up[0]
    return "".join(reversed(found))


class _Figures:
    """Faults and the audit of one conversation, from its rows in order."""

    def __init__(self) -> None:
        self.audit = Audit()
        self.first = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, initial: str, blank: bool, repeat: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        repeat = repeat and not blank
        truncated = truncated and not blank and not repeat
        self.blank += blank
        self.duplicate += repeat
        self.truncated += truncated
        if self.before is not None:
            self.illegal += self.before + initial not in _ORDERLY
        self.before = initial
        self.audit.row(initial, blank or repeat, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = self.audit.result()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_NAMES = [field.split(" ")[0] for field in _FIGURES.split(", ")]


class _Followed:
    """The turns that the edits make of a conversation's rows, taken one by one."""

    def __init__(self) -> None:
        self.figures, self.at, self.state, self.place = (), 0, 0, 0

    def _turn(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        return self.place - 1, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        audit = self.figures[-1]
        while self.at < len(audit) and audit[self.at] == "I":
            yield self._turn("I", _ROLE[self.state], "")
            self.state, self.at = _NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.figures[-1][self.at]
        self.at += 1
        if edit == "R":
            yield self._turn(edit, _ROLE[self.state], text)
            self.state = _NEXT[self.state]
        elif edit == "K":
            yield self._turn(edit, role, text)
            self.state = _KEPT[self.state][role[:1]]


class _Digested(_Followed):
    """The digest of a repaired conversation."""

    def __init__(self) -> None:
        super().__init__()
        self.digest = hashlib.sha256()

    def _turn(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        return super()._turn(edit, role, text)


def _audit_row(state: _Figures, turn, initial, stays, blank, repeat, truncated) -> Iterator[tuple]:
    if stays:
        state.row(turn, initial, blank, repeat, truncated)
    return iter(())


def _text_row(state: _Followed, head, stays, role, text, *figures) -> Iterator[tuple]:
    if head:
        state.figures = figures
    elif stays:
        yield from state.row(role, text)


def _digest_row(state: _Digested, *values) -> Iterator[tuple]:
    for _ in _text_row(state, *values):
        pass
    return iter(())


def _digest_end(state: _Digested) -> Iterator[tuple]:
    for _ in state.inserted():
        pass
    yield *state.figures, state.digest.hexdigest()


def _by_conversation(
    names: tuple[str, ...], start: Callable, take: Callable, end: Callable, schema: pa.Schema
) -> Callable:
    """Feed sorted rows to one state per conversation and send what it gives for a row and at its end."""

    def packed(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made) if made else ([] for _ in schema)
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        key, state = None, None
        for batch in batches:
            columns = [batch.column(name) for name in ("conv", *names)]
            for i in range(batch.num_rows):
                conversation, *values = (column[i].as_py() for column in columns)
                if state is None or conversation != key:
                    if state is not None:
                        made.extend((key, *x) for x in end(state))
                    key, state = conversation, start()
                made.extend((key, *x) for x in take(state, *values))
                if len(made) >= OUT_ROWS:
                    yield packed(made)
                    made = []
        if state is not None:
            made.extend((key, *x) for x in end(state))
        yield packed(made)

    return run


def _streamed(rows: DataFrame, names: tuple[str, ...], start: Callable, take: Callable, end: Callable, made: str) -> DataFrame:
    """One pass over rows that are sorted by conversation; ``made`` lists the columns behind it."""
    fields = StructType([rows.schema["conv"], *StructType.fromDDL(made).fields])
    run = _by_conversation(names, start, take, end, to_arrow_schema(fields))
    return rows.mapInArrow(run, fields)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copy, stays``: the rows after the damage their number decides.

    A null role or text is one blank, as is a null conversation or turn in the
    key of the damage. Dropped rows stay as rows with ``stays`` false, so that
    their conversation is not lost.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), blank) for name in ("conv_id", "turn")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(DAMAGES))
    text = F.coalesce("text", blank)
    cut = F.translate(text, POINTS, "")
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == TURNED, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == EMPTIED, "").when(kind == UNPOINTED, cut).otherwise(text).alias("text"),
        (kind != DROPPED).alias("stays"),
        F.when(kind == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copies")


def as_given(conversations: DataFrame) -> DataFrame:
    """Rows in the form of ``damaged`` without any damage."""
    blank = F.lit(" ")
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.lit(True).alias("stays"), F.lit(0).alias("copy"),
    )


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


_ORDER = ("turn", "role", "digest", "copy")


def audits(rows: DataFrame) -> DataFrame:
    """``conv``, the figures and the edits of every conversation, from rows without their texts."""
    with_package(rows.sparkSession)
    seen = Window.partitionBy("conv", "digest").orderBy(F.desc("stays"), "turn", "copy")
    spaced = F.translate("text", BLANKS[1:], " " * (len(BLANKS) - 1))
    tail = F.right(F.rtrim(spaced), F.lit(1))
    light = rows.select(
        "conv", "turn", "role", "copy", "stays",
        _digest(F.col("role"), F.col("text")).alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        (tail == "").alias("blank"),
        (F.instr(F.lit(POINTS), tail) == 0).alias("truncated"),
    ).withColumn("repeat", F.row_number().over(seen) > 1)
    # Of equal rows the first is the one that repeats none.
    light = light.repartition("conv").sortWithinPartitions("conv", *_ORDER, "repeat")
    names = ("turn", "initial", "stays", "blank", "repeat", "truncated")
    return _streamed(light, names, _Figures, _audit_row, lambda state: [state.result()], _FIGURES)


def _with_texts(rows: DataFrame) -> DataFrame:
    """Each conversation's edits and, behind them, its rows in the same order as for the edits."""
    heads = audits(rows).withColumns({"head": F.lit(True), "stays": F.lit(False)})
    texts = rows.withColumns({"head": F.lit(False), "digest": _digest(F.col("role"), F.col("text"))})
    both = heads.unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", F.desc("head"), *_ORDER)


def repair(rows: DataFrame) -> DataFrame:
    """``conv`` with the figures, edits and digest of every conversation, from rows as ``damaged`` gives them.

    Rows are taken by turn (null first); those of one turn by role, then by a
    digest of role and text, so the order does not depend on how they arrive.
    Rows that repeat are duplicates by their text. A conversation none of whose
    rows stay has zeros, no edits and the digest of the empty text. A null
    conversation is one of its own; an empty table gives an empty one.

    Light rows without text decide the edits; the texts follow in a second
    pass, sorted the same way behind their conversation's edits, and go into
    the digest one after another. Neither pass holds a conversation: what grows
    with it are its string of edits, which is part of the result, and, where
    the states do not come to share a beginning, the nodes of its edits. The
    rows of one conversation go through one task in order, since its edits and
    SHA-256 need that. Whether a row repeats an earlier one is decided apart,
    by conversation and digest.
    """
    names = ("head", "stays", "role", "text", *_NAMES)
    made = f"{_FIGURES}, repaired_sha256 string"
    return _streamed(_with_texts(rows), names, _Digested, _digest_row, _digest_end, made)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv, place, edit, role, text``: the turns of every repaired conversation, places from 0.

    Inserted turns have an empty text. Deleted ones are missing, and so are
    conversations of which nothing is left. Odd rows are as in ``repair``.
    """
    names = ("head", "stays", "role", "text", *_NAMES)
    made = "place long, edit string, role string, text string"
    return _streamed(_with_texts(rows), names, _Followed, _text_row, _Followed.inserted, made)
