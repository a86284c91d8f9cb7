"""Repair of a conversation's structure by the cheapest edits, with a survivor-coalescence Viterbi search.

Rows of a conversation are read in order of turn. Each is kept (0), given the role user or assistant (1) or
deleted (2, required of blank and repeated rows); empty rows of user or assistant may be inserted anywhere (5);
a truncated row that stays costs 5. The roles that result must read ``(s?(ua)+)?`` by their initials. Of equally
cheap edits those stand whose letters (D, I, K, R) are least in ASCII order.

Search. One survivor for each state of that pattern: cost and a node of a backpointer tree. Nodes count what
refers to them; a survivor that loses takes its branch with it. Once all survivors share an ancestor, the edits up
to it are decided and emitted, with the rows' texts, so only undecided edits are held. Equal costs are settled by
comparing the whole undecided letters of both, back to where they part. (Equal costs never belong to a text and its
own beginning, since each further letter of that kind, an insertion, costs.)

On Spark. One shuffle by conversation; repeated rows are found by a window within that partitioning, and rows
stream through the task in order, so that a conversation of any length needs memory for its undecided edits only. The
search and the digest of a conversation run in order, so one conversation is one task's stream; its rows are sorted on disk
where they don't fit.

Defined results. Null conv_id is a conversation of its own. A null turn comes first; equal turns follow by role and text, so
that ties give one result. A null role or text counts as one space (and so as blank). Roles other than
system, user and assistant go by their initial; a row with an empty role has none and can't be kept as it is. Conversations without a row give zeros and no edits. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshelf.llm.common import small_batches

SPACES = " \t\n\x0b\f\r"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5

#: The pattern (s?(ua)+)? as states: nothing yet, after s, after u, after a. What follows which.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
#: The role that may be put in after a state, and where it leads.
PUT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LEGAL = ("su", "ua", "au")

#: Rows of edits handed back at once.
OUT_ROWS = 512

EDIT_FIELDS = "place long, edit string, turn long, role string, text string, fault string, illegal boolean"


# ---------------------------------------------------------------- the search


class Node:
    """An edit, the edit before it, and how many edits and survivors follow from it."""

    __slots__ = ("parent", "edit", "row", "depth", "refs", "kids")

    def __init__(self, parent: Node | None, edit: str, row: tuple | None):
        self.parent, self.edit, self.row = parent, edit, row
        self.depth = parent.depth + 1 if parent else 0
        self.refs, self.kids = 0, []
        if parent:
            parent.refs += 1
            parent.kids.append(self)


def let_go(node: Node) -> None:
    """One reference less; what nothing refers to any more leaves the tree."""
    node.refs -= 1
    while not node.refs and node.parent:
        parent = node.parent
        parent.kids.remove(node)
        parent.refs -= 1
        node.parent = None
        node = parent


def reads_less(a: Node, edit_a: str, b: Node, edit_b: str) -> bool:
    """Whether the undecided letters up to a, then edit_a, come before those of b and edit_b."""
    left, right = [edit_a], [edit_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """Takes rows (role, text, deletable only, truncated, whatever else) one by one; gives decided edits.

    An edit is (letter, role, row): row is None for an insertion, role the one that the row gets or keeps.
    """

    def __init__(self):
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def _move(self, found: dict, state: int, cost: int, parent: Node, edit: str, row: tuple | None) -> None:
        other = found.get(state)
        if other is None or cost < other[0] or cost == other[0] and reads_less(parent, edit, other[1], other[2]):
            found[state] = (cost, parent, edit, row)

    def _settle(self, found: dict) -> None:
        """Make nodes of the moves that won; survivors that lost are let go."""
        before = self.best
        self.best = {}
        for state, (cost, parent, edit, row) in found.items():
            node = Node(parent, edit, row) if edit else parent
            node.refs += 1
            self.best[state] = (cost, node)
        for _, node in before.values():
            let_go(node)

    def _insertions(self) -> None:
        """Put rows in where that makes a state cheaper: at most two one after the other."""
        for _ in range(2):
            found = {s: (cost, node, "", None) for s, (cost, node) in self.best.items()}
            for state, (cost, node) in self.best.items():
                role, to = PUT[state]
                self._try_insert(found, to, cost + COSTS[INSERT], node, role)
            self._settle(found)
        self._drop_beaten()

    def _drop_beaten(self) -> None:
        """Let go of survivors that can't win any more, else the one that deleted every row would hold them all.

        Whatever follows the first two states can follow an assistant's row too, but for a system row, which costs
        a deletion there. Only strictly dearer survivors go, so ties stand.
        """
        least = self.best[ASSISTANT][0]
        for state, more in ((START, COSTS[DELETE]), (SYSTEM, 0)):
            if state in self.best and self.best[state][0] > least + more:
                let_go(self.best.pop(state)[1])

    def _try_insert(self, found: dict, state: int, cost: int, parent: Node, role: str) -> None:
        other = found.get(state)
        if other is not None and other[0] == cost:
            edit = other[2]
            held = (other[1], edit) if edit else (other[1].parent, other[1].edit)
            if held[0] is None or not reads_less(parent, INSERT, *held):
                return
        elif other is not None and other[0] < cost:
            return
        found[state] = (cost, parent, INSERT, (role, None))

    def add(self, role: str, must_go: bool, truncated: bool, row: tuple) -> Iterator[tuple]:
        self._insertions()
        found: dict[int, tuple] = {}
        more = TRUNCATED_COST if truncated else 0
        for state, (cost, node) in self.best.items():
            self._move(found, state, cost + COSTS[DELETE], node, DELETE, (None, row))
            if must_go:
                continue
            to = FOLLOWS.get((state, role[:1]))
            if to is not None:
                self._move(found, to, cost + COSTS[KEEP] + more, node, KEEP, (role, row))
            given, to = PUT[state]
            self._move(found, to, cost + COSTS[REROLE] + more, node, REROLE, (given, row))
        self._settle(found)
        return self._decided()

    def _decided(self) -> Iterator[tuple]:
        """Edits that all survivors share."""
        while self.root.refs == 1 and self.root.kids:
            node = self.root.kids[0]
            yield node.edit, node.row[0], node.row[1]
            node.parent, self.root = None, node

    def end(self) -> Iterator[tuple]:
        self._insertions()
        cost, last = None, None
        for state in ENDS:
            if state in self.best:
                c, node = self.best[state]
                if last is None or c < cost or c == cost and self._node_less(node, last):
                    cost, last = c, node
        path = []
        while last.parent:
            path.append((last.edit, last.row[0], last.row[1]))
            last = last.parent
        return reversed(path)

    @staticmethod
    def _node_less(a: Node, b: Node) -> bool:
        if a.parent is None or b.parent is None:  # nothing undecided on one side
            return a.parent is None and b.parent is not None
        return reads_less(a.parent, a.edit, b.parent, b.edit)

    def held(self) -> int:
        """Undecided edits."""
        count, stack = 0, list(self.root.kids)
        while stack:
            node = stack.pop()
            count += 1
            stack.extend(node.kids)
        return count


# ---------------------------------------------------------------- on Spark


def spaced(column: Column) -> Column:
    """As text; null counts as one space."""
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live: the rows with seeded faults; dropped rows stay with live = false."""
    kind = F.crc32(F.concat(spaced(F.col("conv_id")), F.lit(":"), spaced(F.col("turn"))).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), spaced(F.col("role")).alias("role"), spaced(F.col("text")).alias("text"), kind.alias("kind")
    )
    changed = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("live"),
        F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"),
    )
    return changed.select("conv_id", "turn", "role", "text", "live", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add each row's first fault; partitioned by conversation and in its order."""
    bare = F.rtrim("text", F.lit(SPACES))
    again = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.repartition("conv_id").withColumn("seen", F.row_number().over(again))
    fault = (
        F.when(bare == "", F.lit(BLANK)).when(F.col("seen") > 1, F.lit(DUPLICATE))
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED))
    )
    marked = marked.withColumn("fault", F.when(F.col("live"), fault)).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen"
    )
    return marked.select("conv_id", "turn", "role", "text", "live", "fault")


def edits(rows: DataFrame) -> DataFrame:
    """The edits of every conversation of rows (conv_id, turn, role, text, live), in order within its partition.

    conv_id, place, edit (its letter), turn, role and text (after the edit; what was deleted as it was), fault of the
    row as it came, illegal (whether its role may not follow that of the row before it). Every conversation has a first row
    of place 0 without an edit, so that those without rows appear.
    """
    small_batches(rows.sparkSession)
    marked = with_faults(rows)
    conv = marked.schema["conv_id"].dataType.simpleString()

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, search, place, before = [], _NOTHING, None, 0, None

        def put(found: Iterable[tuple]) -> None:
            nonlocal place
            for edit, role, row in found:
                place += 1
                turn, old, text, fault, illegal = row or (None, None, "", None, None)
                out.append((key, place, edit, turn, old if edit == DELETE else role, text, fault, illegal))

        for b in batches:
            schema = pa.schema([("conv_id", b.schema.field("conv_id").type), *_EDIT_ARROW])
            for conv_id, turn, role, text, live, fault in zip(*(c.to_pylist() for c in b.columns)):
                if conv_id != key or key is _NOTHING:
                    if search:
                        put(search.end())
                    key, search, place, before = conv_id, Repair(), 0, None
                    out.append((key, 0, None, None, None, None, None, None))
                if live:
                    illegal = before is not None and before + role[:1] not in LEGAL
                    before = role[:1]
                    put(search.add(role, fault in (BLANK, DUPLICATE), fault == TRUNCATED, (turn, role, text, fault, illegal)))
                if len(out) >= OUT_ROWS:
                    yield from _rows(out, schema)
                    out.clear()
        if search:
            put(search.end())
            yield from _rows(out, schema)

    return marked.mapInArrow(repaired, f"conv_id {conv}, {EDIT_FIELDS}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text of the rows that stay or were put in."""
    return edits(rows).where("edit IN ('K', 'R', 'I')").select("conv_id", "place", "role", "text")


def summaries(found: DataFrame) -> DataFrame:
    """A row for each conversation from ``edits``, read in its order in the same tasks.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    conv = found.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            schema = pa.schema([("conv_id", b.schema.field("conv_id").type), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            done = []
            for conv_id, place, edit, turn, role, text, fault, illegal in zip(*(c.to_pylist() for c in b.columns)):
                if place == 0:
                    if now:
                        done.append(now.row())
                    now = _Summary(conv_id)
                else:
                    now.add(edit, turn, role, text, fault, illegal)
            yield from _rows(done, schema)
        if now:
            yield from _rows([now.row()], schema)

    fields = ", ".join(f"{c} long" for c in counts)
    return found.mapInArrow(summed, f"conv_id {conv}, {fields}, audit string, repaired_sha256 string")


class _Summary:
    def __init__(self, conv_id):
        self.conv_id, self.faults, self.illegal, self.cost = conv_id, dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0), 0, 0
        self.first = self.last = None
        self.turns, self.audit, self.hash, self.some = 0, bytearray(), hashlib.sha256(), False

    def add(self, edit, turn, role, text, fault, illegal) -> None:
        self.audit += edit.encode()
        self.cost += COSTS[edit]
        self.illegal += bool(illegal)
        if fault:
            self.faults[fault] += 1
            self.cost += TRUNCATED_COST if fault == TRUNCATED and edit != DELETE else 0
        if edit != INSERT and turn is not None and turn != self.last:  # rows come in order of turn
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        if edit != DELETE:
            self.hash.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
            self.some = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


_NOTHING = object()
_EDIT_ARROW = [
    ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("fault", pa.string()), ("illegal", pa.bool_()),
]


def _rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
