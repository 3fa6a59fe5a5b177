"""Repair of damaged conversations by survivor-coalescence Viterbi.

A conversation's rows are read in order of their turns. Each row is kept, given another role or
deleted, and empty turns may be inserted, so that the roles read: an optional system turn, then user
and assistant in turn. The cheapest edits are found by a Viterbi search over four states, told by the
role that came last: none, system, user or assistant.

Each state's best path is a leaf of a tree of backpointers. Nodes count their references, survivors
and children, and go when nobody refers to them. Once all survivors share an ancestor, the edits up to
it are decided and leave the tree, so a conversation of any length takes the memory of its undecided
part only. Of equally cheap paths the one whose initials come first in ASCII order wins: the undecided
parts of both are compared whole, back to the node they share.

A survivor goes when another state can follow whatever it does for less, and a run of deletions is one
node. Text is held by the nodes that keep a row, until they are emitted.

Spark deals rows by conversation, marks faults with windows and sorts on disk where memory ends. The
repaired text of one conversation is one hash, which cannot be computed in parts, so each conversation
is one stream in one task, never a group held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, small_batches, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
#: (role of the last turn, role of the next) by initials.
ALLOWED = {(NONE, SYSTEM), (NONE, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: The state after a turn whose role is chosen, and the role's name.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"
ROWS_OUT, BYTES_OUT = 2000, 1 << 22


class _Node:
    """One edit of a path, or a run of deletions."""

    __slots__ = ("children", "count", "depth", "edit", "parent", "refs", "role", "text")

    def __init__(self, edit: str, parent: _Node | None, role: str | None = None, text: str | None = None):
        self.edit, self.parent, self.role, self.text = edit, parent, role, text
        self.count, self.refs, self.children = 1, 0, set()
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.refs += 1
            parent.children.add(self)


def _release(node: _Node) -> None:
    """Take a reference back; nodes without any go, up to the first that is still in use."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        parent = node.parent
        parent.children.discard(node)
        parent.refs -= 1
        node.parent = None
        node = parent


def _join_run(node: _Node) -> None:
    """Make deletions that follow one another, with no other path between them, one node."""
    parent = node.parent
    while node.edit == "D" and parent is not None and parent.edit == "D" and parent.refs == 1:
        node.count += parent.count
        node.parent = parent.parent
        node.parent.children.discard(parent)
        node.parent.children.add(node)
        parent = node.parent


def _before(a: _Node, last_a: str, b: _Node, last_b: str) -> bool:
    """Whether the path to ``a`` and then ``last_a`` comes before that to ``b`` and then ``last_b``."""
    left, right = [last_a], [last_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit * a.count)
            a = a.parent
        else:
            right.append(b.edit * b.count)
            b = b.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Repairer:
    """The search over one conversation: ``row`` for each row, then ``finish``; both give decided edits.

    An edit is (initial, times, role, text); only deletions come several at a time.
    """

    def __init__(self) -> None:
        self.root = _Node("", None)
        self.survivors: dict[str, tuple[int, _Node]] = {NONE: (0, self.root)}
        self.root.refs = 1
        self._insert()

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> list[tuple]:
        extra = TRUNCATED if truncated else 0
        best: dict[str, tuple[int, _Node, str]] = {}

        def offer(state: str, cost: int, parent: _Node, edit: str) -> None:
            held = best.get(state)
            if held is None or cost < held[0] or (cost == held[0] and _before(parent, edit, held[1], held[2])):
                best[state] = (cost, parent, edit)

        initial = role[:1]
        for state, (cost, node) in self.survivors.items():
            offer(state, cost + DELETE, node, "D")
            if not must_go:
                offer(NEXT[state], cost + REROLE + extra, node, "R")
                if (state, initial) in ALLOWED:
                    offer(initial, cost + extra, node, "K")
        before, self.survivors = self.survivors, {}
        for state, (cost, parent, edit) in best.items():
            kept = (role if edit == "K" else NAMES[state], text) if edit in "KR" else (None, None)
            node = _Node(edit, parent, *kept)
            node.refs = 1
            self.survivors[state] = (cost, node)
        for _, node in before.values():
            _release(node)
        self._insert()
        self._prune()
        for _, node in self.survivors.values():
            _join_run(node)
        return self._decided()

    def finish(self) -> tuple[list[tuple], int]:
        """The rest of the edits, and the cost of all."""
        ends = [self.survivors[s] for s in (NONE, ASSISTANT) if s in self.survivors]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or (other_cost == cost and _before(other, "", node, "")):
                cost, node = other_cost, other
        path = []
        while node is not self.root:
            path.append((node.edit, node.count, node.role, node.text))
            node = node.parent
        return path[::-1], cost

    def _insert(self) -> None:
        """Reach further states by inserted turns, as long as that is cheaper or comes first."""
        again = True
        while again:
            again = False
            for state, (cost, node) in list(self.survivors.items()):
                if self.survivors[state][1] is not node:
                    continue
                to, price = NEXT[state], cost + INSERT
                held = self.survivors.get(to)
                if held and (held[0] < price or (held[0] == price and not _before(node, "I", held[1], ""))):
                    continue
                new = _Node("I", node, NAMES[to], "")
                new.refs = 1
                self.survivors[to] = (price, new)
                if held:
                    _release(held[1])
                again = True

    def _prune(self) -> None:
        """Drop states that another can follow: whatever comes next, it costs them more."""
        if ASSISTANT not in self.survivors:
            return
        bound = self.survivors[ASSISTANT][0]
        # An assistant's turn may be followed by all that follows a system turn; what may begin a
        # conversation follows it too, but for a system turn, which it can delete.
        for state, more in ((NONE, DELETE), (SYSTEM, 0)):
            if state in self.survivors and self.survivors[state][0] > bound + more:
                _release(self.survivors.pop(state)[1])

    def _decided(self) -> list[tuple]:
        out = []
        while self.root.refs == 1 and self.root.children:
            node = next(iter(self.root.children))
            self.root.children, node.parent = set(), None
            out.append((node.edit, node.count, node.role, node.text))
            self.root = node
            node.edit, node.role, node.text, node.count = "", None, None, 1
        return out


STEPS = (
    "conv_id bigint, step bigint, edit string, times bigint, role string, text string, "
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
)
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()] + [pa.int64()] * 6
_NAMES = [part.split()[0] for part in STEPS.split(", ")]


@dataclass
class _Conversation:
    conv_id: int | None
    repairer: Repairer = field(default_factory=Repairer)
    step: int = 0
    #: Deletions decided, but not written yet: more may follow.
    run: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    faults: dict = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0})
    illegal: int = 0
    last_role: str | None = None

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> list[tuple]:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if fault:
            self.faults[fault] += 1
        if self.last_role is not None and self.last_role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_role = role
        return self._rows(self.repairer.row(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def _rows(self, edits: list[tuple]) -> list[tuple]:
        out = []
        for edit, times, role, text in edits:
            if edit == "D":
                self.run += times
                continue
            out += self._deletions()
            out.append((self.conv_id, self.step, edit, 1, role, text, *[None] * 6))
            self.step += 1
        return out

    def _deletions(self) -> list[tuple]:
        if not self.run:
            return []
        row = (self.conv_id, self.step, "D", self.run, None, None, *[None] * 6)
        self.step, self.run = self.step + self.run, 0
        return [row]

    def close(self) -> list[tuple]:
        edits, cost = self.repairer.finish()
        out = self._rows(edits) + self._deletions()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        out.append((self.conv_id, self.step, None, 0, None, None, gaps, *self.faults.values(), self.illegal, cost))
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _KINDS, strict=True)], _NAMES)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of sorted rows, conversation after conversation."""
    current: _Conversation | None = None
    out: list[tuple] = []
    size = 0
    for batch in batches:
        for conv_id, here, turn, role, text, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    out += current.close()
                current = _Conversation(conv_id)
            if here:
                new = current.add(turn, role, text, fault)
                size += sum(len(row[5] or "") for row in new)
                out += new
            if len(out) >= ROWS_OUT or size >= BYTES_OUT:
                yield _batch(out)
                out, size = [], 0
    if current is not None:
        out += current.close()
    if out:
        yield _batch(out)


def repair(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """The cheapest edits of each conversation of ``rows`` (conv_id, turn, role, text), in order.

    One row per edit and partition-wise sorted by conversation and ``step``: K, R and I rows carry the
    turn's role and text; a D row stands for ``times`` deletions. A last row per conversation has a
    null edit, counts of its faults before the repair and the ``cost``. Rows where ``present`` is false
    only name their conversation, which then has at least that last row.

    Rows are taken by turn, nulls first; rows of one turn by role and text, so that repeated rows stand
    together. A null role or text is one space. Rows with a null ``conv_id`` are one conversation. A
    row's fault is blank, else duplicate of an earlier row's role and text, else truncated: its last
    character that is not white space is none of ``.!?``. An empty table gives no rows.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    space = F.lit(" ")
    read = rows.select(
        F.col("conv_id").cast("bigint"),
        here.alias("here"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    read = read.select("conv_id", "here", *[F.when(F.col("here"), F.col(c)).alias(c) for c in ("turn", "role", "text")])
    dealt = read.repartition("conv_id")
    same = Window.partitionBy("conv_id", "here", "role", "text").orderBy(F.asc_nulls_first("turn"))
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(end == "", "blank")
        .when(F.col("copy") > 1, "duplicate")
        .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated")
    )
    marked = dealt.withColumn("copy", F.row_number().over(same)).withColumn("fault", fault)
    order = ["conv_id", "here", F.asc_nulls_first("turn"), "role", "text", "copy"]
    ready = marked.sortWithinPartitions(*order).select("conv_id", "here", "turn", "role", "text", "fault")
    return ready.mapInArrow(_steps, STEPS)


def repaired(steps: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, turn (from 0), role, text."""
    kept = steps.where(F.col("edit").isin("K", "R", "I"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("step")) - 1
    return kept.select("conv_id", place.cast("bigint").alias("turn"), "role", "text")


DIGEST = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit: list[str] = []
    digest, turns = hashlib.sha256(), 0
    names = [part.split()[0] for part in DIGEST.split(", ")]
    for batch in batches:
        out = []
        for conv_id, _, edit, times, role, text, *counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if edit is None:
                out.append((conv_id, *counts, "".join(audit), digest.hexdigest()))
                audit, digest, turns = [], hashlib.sha256(), 0
                continue
            audit.append(edit * times)
            if edit != "D":
                digest.update(("\n" * (turns > 0) + f"{role}:{text}").encode())
                turns += 1
        if out:
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def digests(steps: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: counts, cost, the edits' initials and a hash of the repaired turns.

    Reads the edits as they come, without a shuffle, so ``steps`` must not have been dealt anew.
    """
    return steps.mapInArrow(_digests, DIGEST)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with damage by the hash of id and turn, and a column ``present``: false for a dropped row."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    read = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    done = read.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), copies.alias("copy"))
    return done.drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations by rule, repair them, and describe each."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    with small_batches(spark):
        return saved(digests(repair(rows, F.col("present"))), "conversation-digests")


def _sql() -> str:
    """DuckDB SQL of the same result: the search row by row, with whole paths in place of a tree."""

    def edit(path: str, cost: str, initial: str, line: str | None = None, when: str = "true") -> str:
        turns = f"list_append({path}.turns, {line})" if line else f"{path}.turns"
        return f"CASE WHEN {path} IS NOT NULL AND {when} THEN {{cost: {path}.cost + {cost}, audit: {path}.audit || '{initial}', turns: {turns}}} END"

    def rerole(path: str, name: str) -> str:
        return edit(path, "3 + extra", "R", f"'{name}:' || text", "NOT must_go")

    def keep(path: str, initial: str) -> str:
        return edit(path, "extra", "K", "role || ':' || text", f"NOT must_go AND role[1] = '{initial}'")

    def insert(path: str, name: str) -> str:
        return edit(path, "3", "I", f"'{name}:'")

    u = ", ".join([edit("u", "4", "D"), *[f(p, x) for p in "nsa" for f, x in ((rerole, "user"), (keep, "u"))]])
    a = ", ".join([edit("a", "4", "D"), rerole("u", "assistant"), keep("u", "a")])
    start = "{cost: CAST(0 AS BIGINT), audit: '', turns: CAST([] AS VARCHAR[])}"
    nothing = "CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, turns VARCHAR[]))"
    first = f"SELECT conv_id, {start} AS n, {nothing} AS s, {nothing} AS u, {nothing} AS a FROM (SELECT DISTINCT conv_id FROM conversations)"
    closed_u = f"least(u, {insert('n', 'user')}, {insert('s', 'user')}, {insert('a', 'user')})"
    return f"""
WITH RECURSIVE
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
kinds AS (
    SELECT * EXCLUDE (key, t), xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(key, ''), lambda x: CAST(unicode(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind
    FROM keyed, crc_table
),
after_damage AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind <> 0
),
ended AS (
    SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place
    FROM after_damage
),
faults AS (
    SELECT conv_id, turn, role, text, place, lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS last_role,
           CASE WHEN body = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM ended
),
steps AS (
    SELECT conv_id, place, role, text, fault IN ('blank', 'duplicate') AS must_go,
           CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra
    FROM faults
),
begun AS ({first}),
started AS (SELECT conv_id, n, s, {insert('n', 'user')} AS u FROM begun),
search AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, n, s, u, {insert('u', 'assistant')} AS a FROM started
    UNION ALL
    SELECT conv_id, place, n, s, u, least(a, {insert('u', 'assistant')}) AS a
    FROM (
        SELECT conv_id, place, n, s, {closed_u} AS u, a
        FROM (
            SELECT conv_id, next.place, {edit('n', '4', 'D')} AS n, least({edit('s', '4', 'D')}, {keep('n', 's')}) AS s,
                   least({u}) AS u, least({a}) AS a
            FROM search JOIN steps next USING (conv_id)
            WHERE next.place = search.place + 1
        )
    )
),
last AS (
    SELECT conv_id, least(n, a) AS best FROM search
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (last_role IS NOT NULL AND last_role[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(array_to_string(best.turns, chr(10))) AS repaired_sha256
FROM last LEFT JOIN counts USING (conv_id)
"""


OP11_SQL = _sql()
