"""Conversation repair: the cheapest edits that give a conversation a legal order of roles.

Legal are an optional system turn and then pairs of user and assistant, or nothing at all. A turn may
be kept (0), given another role (1) or deleted (2), and an empty turn may be put in anywhere (5). A
blank turn and one said before must be deleted; a truncated turn costs 5 unless it is deleted.

The method is Viterbi's over the four states of the legal order, with one surviving path for each
state. The paths are a tree of backpointers that counts references. As soon as all survivors
descend from one child of the root that edit is decided: it is emitted and the root moves on. What is
held is only the undecided end of the paths, and survivors of equal cost are told apart by the whole
of it: paths that took the same turns are never prefixes of each other but for insertions after the
last of them, so their order, once found, is carried along as a rank.

A survivor is dropped when another state can do all it can for less (an untouched start or a lone
system turn against a complete pair). Survivors then part for a few turns only, unless
a tie runs on: where user follows user without end, whether the first of them goes is decided by
the last, and the turns wait that long.

Rows come to a task sorted by Spark and pass through it as a stream. Which turns repeat an earlier
one is found before that, by aggregates and a join spread over all tasks, not by a set in one task.

Turns of a conversation are taken by turn number (nulls first), then role, then text; conversations
with a null id are one conversation. Null roles and texts count as one space. Other columns are not
read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import BATCH_ROWS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLE = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: From each state the initials that may follow and the state each leads to.
FOLLOW = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The same for turns whose role may be chosen.
CHOICE = tuple(tuple((c, to) for c, to in after.items() if c in ROLE) for after in FOLLOW)
ENDS = (START, ASSISTANT)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
WHITE = " \t\n\x0b\x0c\r"


# -- the search ---------------------------------------------------------------------------------


class _Node:
    """An edit on a path, with the state it leads to and how many children or survivors refer to it."""

    __slots__ = ("parent", "letter", "state", "refs")

    def __init__(self, parent: "_Node | None", letter: str, state: int):
        self.parent, self.letter, self.state, self.refs = parent, letter, state, 0
        if parent is not None:
            parent.refs += 1


def _release(node: _Node) -> None:
    """One reference less; what nothing refers to any more goes, up to where the paths part."""
    node.refs -= 1
    while not node.refs and node.parent is not None:
        node = node.parent
        node.refs -= 1


class Search:
    """Cheapest edits of one conversation, turn by turn. ``turn`` and ``finish`` give the edits that
    are decided by then, each as (letter, state).

    A survivor is (cost, rank, tail, node): its path is the path that took the last turn, ``rank``
    telling the order of those paths over their whole length, and the insertions since, ``tail``.
    No path that took the last turn is a prefix of another, so rank and tail order the paths.
    """

    def __init__(self) -> None:
        self.root = _Node(None, "", START)
        self.root.refs = 1  # as the only survivor
        self.alive: list[tuple[int, int, str, _Node] | None] = [(0, 0, "", self.root), None, None, None]
        self.total = 0
        self._insert()

    def _insert(self) -> None:
        """Insertions between two turns: at most two are of use."""
        alive = self.alive
        for at, to in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if alive[at] is None:
                continue
            cost, rank, tail, node = alive[at]
            key = (cost + INSERT, rank, tail + "I")
            if alive[to] is None or key < alive[to][:3]:
                new = _Node(node, "I", to)
                new.refs = 1
                if alive[to] is not None:
                    _release(alive[to][3])
                alive[to] = (*key, new)

    def turn(self, initial: str, must_go: bool, truncated: bool) -> list[tuple[str, int]]:
        best: list[tuple[int, int, str, _Node] | None] = [None] * 4
        extra = TRUNCATED if truncated else 0
        for at, survivor in enumerate(self.alive):
            if survivor is None:
                continue
            cost, rank, tail, node = survivor
            offers = [(at, cost + DELETE, "D")]
            if not must_go:
                to = FOLLOW[at].get(initial)
                if to is not None:
                    offers.append((to, cost + extra + KEEP, "K"))
                offers += [(to, cost + extra + REROLE, "R") for i, to in CHOICE[at] if i != initial]
            for to, price, letter in offers:
                if best[to] is None or (price, rank, tail + letter) < best[to][:3]:
                    best[to] = (price, rank, tail + letter, node)
        order = sorted(b[1:3] for b in best if b is not None)
        before = self.alive
        self.alive = [None] * 4
        for to, found in enumerate(best):
            if found is not None:
                price, rank, path, parent = found
                new = _Node(parent, path[-1], to)
                new.refs = 1
                self.alive[to] = (price, order.index((rank, path)), "", new)
        for survivor in before:
            if survivor is not None:
                _release(survivor[3])
        self._insert()
        # What a complete pair can do, too, and for less in any case.
        done = self.alive[ASSISTANT]
        if done is not None:
            for at, more in ((START, DELETE), (SYSTEM, 0)):
                if self.alive[at] is not None and self.alive[at][0] > done[0] + more:
                    _release(self.alive[at][3])
                    self.alive[at] = None
        return self._decided()

    def _decided(self) -> list[tuple[str, int]]:
        if self.root.refs > 1:
            return []
        path = []
        node = next(survivor[3] for survivor in self.alive if survivor is not None)
        while node is not self.root:
            path.append(node)
            node = node.parent
        out = []
        while path and self.root.refs == 1:  # one child, and no survivor at the root
            self.root = path.pop()
            self.root.parent = None
            out.append((self.root.letter, self.root.state))
        return out

    def finish(self) -> list[tuple[str, int]]:
        best = min(self.alive[at] for at in ENDS if self.alive[at] is not None)
        self.total = best[0]
        out, node = [], best[3]
        while node is not self.root:
            out.append((node.letter, node.state))
            node = node.parent
        return out[::-1]


class Conversation:
    """One conversation as it passes: its turns wait until their edits are decided."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.search = Search()
        self.waiting: deque[tuple[str, str]] = deque()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last = None
        self.distinct = 0
        self.before: str | None = None
        self.held = 0  # turns that waited at most

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> list[tuple[str, str | None, str | None]]:
        """The next turn. Gives the edits decided by it, each (letter, role, text) as repaired;
        a deleted turn as it was."""
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.last = self.high = turn
            if self.low is None:
                self.low = turn
        initial = role[:1]
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        self.before = initial
        body = text.rstrip(WHITE)
        cut = False
        if not body:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif body[-1] not in ".!?":
            self.truncated += 1
            cut = True
        self.waiting.append((role, text))
        self.held = max(self.held, len(self.waiting))
        return self._apply(self.search.turn(initial, not body or seen, cut))

    def finish(self) -> list[tuple[str, str | None, str | None]]:
        return self._apply(self.search.finish())

    def _apply(self, edits: list[tuple[str, int]]) -> list[tuple[str, str | None, str | None]]:
        out = []
        for letter, state in edits:
            if letter == "I":
                out.append((letter, _role(state), ""))
                continue
            role, text = self.waiting.popleft()
            out.append((letter, _role(state) if letter == "R" else role, text))
        return out

    @property
    def gaps(self) -> int:
        if self.low is None:
            return 0
        gaps = self.high - self.low + 1 - self.distinct
        return (gaps + 2**63) % 2**64 - 2**63  # as longs do


def _role(state: int) -> str:
    return "user" if state == USER else "assistant"


# -- over tables --------------------------------------------------------------------------------


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Columns conv_id, turn, role, text, copies of any table of turns; a null role or text is a space."""
    return rows.select(
        rows[conv_col].cast("long").alias("conv_id"), rows[turn_col].cast("long").alias("turn"),
        F.coalesce(rows[role_col].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text_col].cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Turns as ``turns`` gives them, damaged by crc32(``conv_id:turn``) % 20: 0 drops the turn, 1
    empties its text, 2 takes its ``[.!?]``, 3 repeats it, 4 makes it the user's. A dropped turn
    leaves a row without copies, so that its conversation is still known."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                      F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    gone = fault == 0
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(~gone, F.when(fault == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~gone, text).alias("text"),
        F.when(gone, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, seen: equal turns as one row with their number, ``seen``
    where role and text were said at an earlier turn; each conversation in one task, sorted.

    Equal turns are counted before anything is joined, and the join is on conversation, role and a
    digest of the text, which adaptive execution splits where it is skewed."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    keyed = once.withColumns({
        "said": F.unhex(F.sha2(F.concat_ws(":", "role", "text"), 256)),
        "at": F.when(F.col("role").isNotNull(), F.struct(F.col("turn").isNotNull().alias("known"), "turn")),
        "whose": F.struct("conv_id")})
    first = keyed.where("copies > 0").groupBy("whose", "said", "role").agg(
        F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    found = keyed.join(first, ["whose", "said", "role"], "left")
    seen = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    ordered = found.select("conv_id", "turn", "role", "text", "copies", seen.alias("seen"))
    return ordered.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, list, bool]]:
    """Of sorted rows each conversation with the edits as they are decided; True with its last."""
    now: Conversation | None = None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv_id, turn, role, text, copies, seen in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now, now.finish(), True
                now = Conversation(conv_id)
            for k in range(copies):
                yield now, now.add(turn, role, text, seen or k > 0), False
    if now is not None:
        yield now, now.finish(), True


def _written_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repair(rows: DataFrame) -> DataFrame:
    """Columns conv_id, position (from 0, null for a deleted turn), edit (K, R, D or I), role, text:
    the edits of every conversation, and with them the repaired turns. ``rows`` as from ``turns``.

    A conversation without turns has no rows. Repeated rows are turns of their own."""
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at = 0
        for conversation, done, last in _conversations(batches):
            for letter, role, text in done:
                yield conversation.conv_id, None if letter == "D" else at, letter, role, text
                at += letter != "D"
            if last:
                at = 0

    return _in_order(rows).mapInArrow(
        lambda batches: _written_batches(edits(batches), schema),
        "conv_id long, position long, edit string, role string, text string")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256. ``rows`` as from ``turns`` or ``damaged``.

    A conversation all of whose turns were dropped has zeros, an empty audit and the hash of nothing.
    The hash and the audit take a conversation's edits as they are decided; only the audit, a letter
    an edit, is held whole, as it is one value."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        audit, digest, between = bytearray(), hashlib.sha256(), b""
        for c, done, last in _conversations(batches):
            for letter, role, text in done:
                audit += letter.encode()
                if letter != "D":
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
            if last:
                yield (c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.search.total,
                       audit.decode(), digest.hexdigest())
                audit, digest, between = bytearray(), hashlib.sha256(), b""

    return _in_order(rows).mapInArrow(
        lambda batches: _written_batches(reports(batches), schema),
        f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


#: The counts of a report, in order.
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
