"""Repair of conversation structure by a Viterbi search whose survivors coalesce (operator 12).

A conversation's rows, in order of turn, become a sequence of roles ``(s?(ua)+)?`` (first letters of system, user, assistant)
by the cheapest edits: keep, rerole, delete, and insert an empty turn. Equal costs are decided by the edits' letters in
order, the ASCII-least first.

Faults are found by Spark: blank and truncated rows from their own text, duplicates from a window over equal rows of a
conversation. One exchange by ``conv_id`` serves that window, the sort by turn and the search.

The search reads a conversation row by row. It keeps at most one survivor for each state (nothing yet, after s, after u,
after a): its cost, the running hash of its repaired text, and its last node in a tree of back pointers. Nodes count what refers
to them; those that no survivor descends from are freed, and once all survivors share a node, the edits up to
it are final and leave the tree. Survivors that no continuation can make the cheapest are dropped, else the one that has deleted
everything would hold the tree for ever. What may stay open is compared whole: survivors' letters never
are each other's beginning after a row, so the order among them is known from their order before the row
and from the letters that the row added.

Texts are hashed and let go row by row. Memory is the script of the conversation at hand (a byte an edit) and the open part
of the tree, however long a conversation is; a conversation is one sequence, so its rows pass one task.

Defined results: a null conversation id is a conversation by itself; rows with equal turns are ordered by role, then text, null
turns first; a null role or text counts as one space; a role's first letter decides; an empty table gives no row; other columns are
ignored. Very long texts are only hashed.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, S, U, A = range(4)
#: State before and after each role, and the letter of the role.
STEPS = {"s": ((START, S),), "u": ((START, U), (S, U), (A, U)), "a": ((U, A),)}
NAMES = {"s": "system", "u": "user", "a": "assistant"}
#: Most that a survivor in the first state can cost more than one in the second from here on, whatever follows.
BEHIND = {(A, S): 0, (A, START): 3, (A, U): 2, (START, A): 0, (START, S): 0, (START, U): 2, (S, U): 2, (S, A): 4, (S, START): 7, (U, A): 2, (U, S): 2, (U, START): 5}
LEGAL = frozenset({"su", "ua", "au"})
WHITE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Tree:
    """Back pointers as numbers in arrays: parent, letters, references, and the sum of children's numbers."""

    def __init__(self) -> None:
        self.parent, self.refs, self.children = array("q", [-1]), array("q", [0]), array("q", [0])
        self.letters, self.free = [""], []
        self.root, self.script = 0, bytearray()

    def grow(self, parent: int, letters: str) -> int:
        if self.free:
            node = self.free.pop()
            self.parent[node], self.refs[node], self.children[node], self.letters[node] = parent, 0, 0, letters
        else:
            node = len(self.parent)
            self.parent.append(parent)
            self.refs.append(0)
            self.children.append(0)
            self.letters.append(letters)
        self.refs[parent] += 1
        self.children[parent] += node
        return node

    def hold(self, node: int) -> None:
        self.refs[node] += 1

    def release(self, node: int) -> None:
        """A survivor leaves a node; nodes that nothing refers to go, up to the first that something does."""
        self.refs[node] -= 1
        while self.refs[node] == 0 and node != self.root:
            up = self.parent[node]
            self.free.append(node)
            self.refs[up] -= 1
            self.children[up] -= node
            node = up

    def settle(self, held: set[int]) -> None:
        """Move the root down while all survivors descend from one child, and write out the letters on the way."""
        while self.refs[self.root] == 1 and self.root not in held:
            child = self.children[self.root]
            self.free.append(self.root)
            self.script += self.letters[child].encode()
            self.root = child

    def path(self, node: int) -> str:
        """Letters below the root."""
        out = []
        while node != self.root:
            out.append(self.letters[node])
            node = self.parent[node]
        return "".join(reversed(out))

    @property
    def open(self) -> int:
        return len(self.parent) - len(self.free)


class Survivor:
    __slots__ = ("cost", "rank", "letters", "node", "hash", "count")

    def __init__(self, cost: int, rank: int, letters: str, node: int, hash_, count: int) -> None:
        self.cost, self.rank, self.letters, self.node, self.hash, self.count = cost, rank, letters, node, hash_, count

    def key(self) -> tuple[int, int, str]:
        """Cost, then the whole script: the order among the scripts before the row, then the letters since."""
        return self.cost, self.rank, self.letters

    def then(self, cost: int, letter: str, role: str | None = None, text: str = "") -> Survivor:
        """One edit more; ``role`` names the turn that it leaves."""
        after, count = self.hash, self.count
        if role is not None:
            after = after.copy()
            after.update(f"{chr(10) if count else ''}{role}:{text}".encode())
            count += 1
        return Survivor(self.cost + cost, self.rank, self.letters + letter, self.node, after, count)


class Search:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self) -> None:
        self.tree = Tree()
        self.tree.hold(0)
        self.now: dict[int, Survivor] = {START: Survivor(0, 0, "", 0, hashlib.sha256(), 0)}
        self.most_open = 1

    def _inserted(self) -> dict[int, Survivor]:
        """Survivors with any turns inserted at this place."""
        best = dict(self.now)
        for _ in range(3):
            for role in "ua":
                for before, after in STEPS[role]:
                    if before in best:
                        _offer(best, after, best[before], INSERT, "I", NAMES[role], "")
        return best

    def row(self, role: str, text: str, fault: str | None) -> None:
        before, after = self._inserted(), {}
        for state, survivor in before.items():
            _offer(after, state, survivor, DELETE, "D", None, "")
        if fault not in ("blank", "duplicate"):
            more = TRUNCATED if fault == "truncated" else 0
            for own, letter, cost, name in ((role[:1], "K", 0, role), ("u", "R", REROLE, NAMES["u"]), ("a", "R", REROLE, NAMES["a"])):
                for state, to in STEPS.get(own, ()):
                    if state in before:
                        _offer(after, to, before[state], cost + more, letter, name, text)
        cheap = {x: y.cost for x, y in after.items()}
        alive = {x: y for x, y in after.items() if not any(cheap[o] + BEHIND[o, x] < y.cost for o in cheap if o != x)}
        self._advance(alive)

    def _advance(self, alive: dict[int, Survivor]) -> None:
        old = {y.node for y in self.now.values()}
        # Scripts end with the row's own letter here, so none begins another: their order is final.
        ranks = {x: i for i, (x, _) in enumerate(sorted(alive.items(), key=lambda e: (e[1].rank, e[1].letters)))}
        for x, y in alive.items():
            y.node = self.tree.grow(y.node, y.letters)
            self.tree.hold(y.node)
            y.rank, y.letters = ranks[x], ""
        for node in old:
            self.tree.release(node)
        self.now = alive
        self.tree.settle({y.node for y in alive.values()})
        self.most_open = max(self.most_open, self.tree.open)

    def end(self) -> tuple[int, str, str]:
        """Cost, script and hash of the repaired text."""
        last = self._inserted()
        best = min((last[x] for x in (START, A) if x in last), key=Survivor.key)
        script = self.tree.script.decode() + self.tree.path(best.node) + best.letters
        return best.cost, script, best.hash.hexdigest()


def _offer(states: dict[int, Survivor], to: int, before: Survivor, cost: int, letter: str, role: str | None, text: str) -> None:
    """Take an edit for a state if it beats what the state has; only then is its text hashed."""
    own = states.get(to)
    if own is None or (before.cost + cost, before.rank, before.letters + letter) < own.key():
        states[to] = before.then(cost, letter, role, text)


def _plain(rows: DataFrame) -> DataFrame:
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, each conversation in one partition and in order."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    equal = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    fault = (
        F.when(bare == "", "blank")
        .when(F.col("again") > 1, "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    marked = _plain(rows).repartition("conv_id").withColumn("again", F.row_number().over(equal)).withColumn("fault", fault)
    return marked.sortWithinPartitions("conv_id", "turn", "role", "text", "again")


class _Conversation:
    """Counts and search of the conversation that is read."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.search = conv_id, Search()
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.search.row(role, text, fault)

    def report(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, script, digest = self.search.end()
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, script, digest)


def audit(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps between turns, faults, illegal neighbours, cost, the edits' letters, hash of the repaired text."""
    names = [f.split()[0] for f in REPORT.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        done: list[tuple] = []
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.report())
                    now = _Conversation(conv_id)
                now.row(*row)
            if done:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([now.report()])

    return ordered(rows).select("conv_id", "turn", "role", "text", "fault").mapInArrow(run, REPORT)


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The turns that the reports of :func:`audit` leave, numbered: conversation, place, role, text and the edit that made them.

    A conversation's report comes before its rows in one sorted stream, and its letters are taken one by one.
    """
    scripts = report.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.col("audit").alias("script"))
    both = scripts.unionByName(_plain(rows).withColumn("script", F.lit(None).cast("string")))
    both = both.withColumn("kind", F.col("script").isNull())
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").drop("kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters: Iterator[str] = iter("")
        number, conv, first = 0, None, False
        for batch in batches:
            out: list[tuple] = []
            for conv_id, _, role, text, script in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if script is not None:
                    out += _inserts(letters, number, conv, first)[0]
                    made = len(script) - script.count("D")
                    conv, letters, number, first = conv_id, iter(script), 0, made % 2 == 1
                    continue
                turns, number, letter = _inserts(letters, number, conv, first)
                out += turns
                if letter in ("K", "R"):
                    out.append((conv, number, _role(number, first) if letter == "R" else role, text, letter))
                    number += 1
            if out:
                yield _turns(out)
        rest = _inserts(letters, number, conv, first)[0]
        if rest:
            yield _turns(rest)

    return stream.mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def _role(number: int, system: bool) -> str:
    return NAMES["u" if (number - system) % 2 == 0 else "a"]


def _inserts(letters: Iterator[str], number: int, conv: int | None, system: bool) -> tuple[list[tuple], int, str | None]:
    """The inserted turns up to the next letter of a row, the number after them, and that letter."""
    turns = []
    for letter in letters:
        if letter != "I":
            return turns, number, letter
        turns.append((conv, number, _role(number, system), "", "I"))
        number += 1
    return turns, number, None


def _turns(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "place", "role", "text", "edit"])


def damage_of(conv_id: Column, turn: Column) -> Column:
    """What is done to a row, 0 to 19, by a hash of its place."""
    key = F.concat(F.coalesce(conv_id.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    return F.crc32(key.cast("binary")) % 20


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after damage by a rule: 0 drops, 1 empties, 2 removes ends of sentences, 3 repeats, 4 sets role user."""
    plain = _plain(rows).withColumn("damage", damage_of(F.col("conv_id"), F.col("turn"))).where("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, 2).otherwise(1)))
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def audit_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The reports of ``rows`` for every conversation that ``conversations`` names, also those without rows."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("own")).distinct()
    report = audit(rows)
    found = ids.join(report, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return found.select(F.col("own").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
