"""Repair of conversations whose turns are blank, repeated, cut off or out of turn.

``damaged`` spoils rows in a fixed way (so that there is something to repair), ``repaired`` finds for each conversation the
cheapest edits that make its role initials ``(s?(ua)+)?``.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and repeated rows), Insert an empty turn of user
or assistant 5; a truncated row that is not deleted adds 5.  The audit is the edits' initials in order; of equally cheap
ones the ASCII-least counts.

* A dynamic program runs over the rows with four states: nothing yet, system, user, assistant.  The audit decides state,
  cost and repaired text, and of two equally cheap audits over the same rows none is the beginning of the other; so the best
  audit of a state is all that later rows need.
* Audits are paths in a tree of linked nodes, which share their beginnings.  A node knows its ancestors at distances of
  powers of two and a rolling hash of its path.  A tie is settled by searching the longest common beginning through those
  ancestors; what the hashes call equal is verified node by node, up to the node that both paths share.
* Rows arrive sorted, a batch at a time; each state carries the SHA-256 of its text so far.  So a task holds no texts but one
  batch, whatever the length of a conversation: it keeps the nodes still in use, as the audit has a letter for each row.
* Equal rows of one turn fold to one with a count before they are shuffled, so repeated rows cost no more than one.  Which
  rows were seen before is found by aggregation over digests, not in the task.

A conversation's rows meet in one task in their order, because its SHA-256 cannot be put together from parts.

Defined cases: null ids, turns, roles and texts count as one space where they are spelled out; rows without id are one
conversation, with a null id in the result; null turns come first, ties follow by role and text; an empty role has no initial
and can be kept nowhere; a conversation without rows after the damage has zeros, an empty audit and the hash of nothing; an
empty table gives an empty one; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.common import bound_batches

BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn that is made a user's or an assistant's, and after one that is kept, by its initial.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LEGAL = frozenset(("su", "ua", "au"))

_MOD, _BASE = (1 << 61) - 1, 911_382_323


class Node:
    """One edit of an audit: the letter, and the way back to the first."""

    __slots__ = ("up", "letter", "depth", "hash")

    def __init__(self, parent: Node | None, letter: str):
        self.letter = letter
        if parent is None:
            self.up, self.depth, self.hash = (), 0, 0
            return
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up, self.depth = tuple(up), parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % _MOD

    def at_depth(self, depth: int) -> Node:
        node, left = self, self.depth - depth
        while left:
            k = left.bit_length() - 1
            node, left = node.up[k], left - (1 << k)
        return node

    def path(self) -> str:
        letters, node = [], self
        while node.up:
            letters.append(node.letter)
            node = node.up[0]
        return "".join(reversed(letters))


def _same(a: Node, b: Node) -> bool:
    """Two paths of one length, letter by letter up to the node they share."""
    while a is not b and a.up:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Whether the path to ``a`` comes before the one to ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.at_depth(depth), b.at_depth(depth)
    if x.hash == y.hash and _same(x, y):
        return a.depth < b.depth
    for k in reversed(range(len(x.up))):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    if x.hash != y.hash and _same(x.up[0], y.up[0]):
        return x.letter < y.letter
    return a.path() < b.path()          # hashes that met by chance


class Repair:
    """The repair of one conversation, row by row."""

    def __init__(self) -> None:
        self.states: list[tuple[int, Node, object] | None] = [(0, Node(None, ""), hashlib.sha256()), None, None, None]
        self._insert()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.initial = None

    def _insert(self) -> None:
        """Inserted turns behind the last row; in this order one pass reaches every state."""
        for p in (START, SYSTEM, USER, ASSISTANT):
            if self.states[p]:
                cost, node, text = self.states[p]
                q = NEXT[p]
                self._offer(self.states, q, cost + INSERT, Node(node, "I"), text, p, ROLE[q] + ":")

    @staticmethod
    def _offer(states: list, q: int, cost: int, node: Node, text, p: int, turn: str | None) -> None:
        held = states[q]
        if held and (held[0] < cost or held[0] == cost and not before(node, held[1])):
            return
        if turn is not None:
            text = text.copy()
            text.update((turn if p == START else "\n" + turn).encode())
        states[q] = (cost, node, text)

    def _edit(self, role: str, text: str, forced: bool, extra: int) -> None:
        offers: list[list] = [[], [], [], []]
        for p, held in enumerate(self.states):
            if held:
                cost = held[0]
                offers[p].append((cost + DELETE, p, "D", None))
                if not forced:
                    kept = KEPT[p].get(role[:1])
                    if kept:
                        offers[kept].append((cost + extra, p, "K", role))
                    offers[NEXT[p]].append((cost + REROLE + extra, p, "R", ROLE[NEXT[p]]))
        new: list[tuple[int, Node, object] | None] = [None] * 4
        for q, given in enumerate(offers):
            if given:
                least = min(given)[0]
                for cost, p, letter, name in given:
                    if cost == least:
                        _, node, so_far = self.states[p]
                        self._offer(new, q, cost, Node(node, letter), so_far, p, None if name is None else f"{name}:{text}")
        self.states = new
        self._insert()

    def row(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        """``copies`` equal rows; ``seen`` if an earlier row has the same role and text."""
        solid = text.rstrip(BLANKS)
        for i in range(copies):
            repeated = seen or i > 0
            cut = bool(solid) and not repeated and solid[-1] not in ".!?"
            self.blank += not solid
            self.duplicate += bool(solid) and repeated
            self.truncated += cut
            if self.initial is not None and self.initial + role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = role[:1]
            self._edit(role, text, not solid or repeated, TRUNCATED if cut else 0)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn

    def result(self) -> tuple:
        ends = [s for s in (self.states[START], self.states[ASSISTANT]) if s]
        best = ends[0]
        for s in ends[1:]:
            if s[0] < best[0] or s[0] == best[0] and before(s[1], best[1]):
                best = s
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, best[0], best[1].path(), best[2].hexdigest()


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows spoiled by the crc32 of ``conv_id:turn``; dropped ones have no copies."""
    conv_id, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = F.concat_ws(":", F.coalesce(conv_id.cast("string"), F.lit(" ")), F.coalesce(turn.cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    kind = F.col("kind")
    return (conversations.select(conv_id.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
                                 (F.crc32(name.cast("binary")) % 20).alias("kind"))
            .select("conv_id", F.when(kind != 0, F.col("turn")).alias("turn"),
                    F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies")))


def repaired(rows: DataFrame) -> DataFrame:
    """``RESULT``, one row per conversation of ``rows(conv_id, turn, role, text, copies)``.

    A row without copies only says that its conversation exists.
    """
    bound_batches(rows.sparkSession)
    none = F.lit("")
    named = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), none).alias("conv"), F.coalesce(F.col("turn").cast("string"), none).alias("at"),
        F.when(F.col("copies") > 0, F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))).otherwise(none).alias("digest"),
        "conv_id", "turn", "role", "text", "copies")
    keys = ["conv", "at", "digest"]
    folded = named.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")], F.sum("copies").alias("copies"))
    # the first turn of each role and text; false, for null turns, comes before true
    first = (named.filter("copies > 0").groupBy("conv", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "at")).alias("first"))
             .select("conv", F.col("first.at").alias("at"), "digest", F.lit(True).alias("is_first")))
    ordered = (folded.join(first.hint("merge"), keys, "left")
               .select("conv", "conv_id", "turn", "role", "text", "copies", F.col("is_first").isNull().alias("seen"))
               .repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RESULT.split(", ")]
        types = [pa.int64()] * 7 + [pa.string()] * 2

        def packed(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

        last, repair, done = None, None, []
        for b in batches:
            for conv, conv_id, turn, role, text, copies, seen in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if repair is None or conv != last:
                    if repair is not None:
                        done.append((last_id, *repair.result()))
                    last, last_id, repair = conv, conv_id, Repair()
                if copies:
                    repair.row(turn, role, text, copies, seen)
            if done:
                yield packed(done)
                done = []
        if repair is not None:
            yield packed([(last_id, *repair.result())])

    return ordered.mapInArrow(run, RESULT)
