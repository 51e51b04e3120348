"""Repair of the structure of conversations.

A conversation should be an optional system turn and then pairs of user and assistant
turns, `(s?(ua)+)?` by the first letters of the roles, without blank, repeated or cut off
texts. The cheapest edits to get there are found in one pass over the rows: they are
dealt by conversation and sorted by turn, and a task carries the state of a dynamic
programme from row to row, whatever Arrow batch they come in.

What it carries is small: which positions in the pattern are reachable at what cost
above the cheapest, and in what order their edits compare as strings. Few such fronts
exist, so each step from one to the next is worked out once and looked up from then on.
Beside the front stand a SHA-256 per reachable position and the steps taken, four bytes
a row, which go to a temporary file of the task once there are many. Texts are never held.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import table
from pagewell.llm.words import NOT_BLANK

#: What an edit costs; an undeleted truncated row adds TRUNCATED.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Positions in the pattern: nothing yet, after a system, user or assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Positions that a kept row leads to by the first letter of its role.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that a row gets, or that is inserted, and where it leads.
GIVEN = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
#: No fault, a row that must go, a truncated one.
FINE, GONE, CUT = range(3)
#: Steps held in memory before they are written to the task's file.
HELD_STEPS = 1 << 20
LETTERS = "sua?"
BLANK_SET = " \t\n\x0b\x0c\r"


class Fronts:
    """Steps between fronts, worked out when first taken.

    A front is a tuple of `(position, cost, rank)` right after a row's edit: costs are
    above the cheapest, ranks order the edits so far as strings. Of those strings none is
    the beginning of another, as each ends in the edit of the same row, so what is
    appended matters only between equal ones.
    """

    def __init__(self):
        self.fronts = [((NOTHING, 0, 0),)]
        self.numbers = {self.fronts[0]: 0}
        self.steps: list[tuple] = []
        self.known: dict[tuple[int, int], int] = {}

    @staticmethod
    def reached(front) -> dict:
        """By position: the cheapest, then least `(cost, rank, inserts)` and where from."""
        best: dict[int, tuple] = {}
        for index, (position, cost, rank) in enumerate(front):
            inserts, to = "", position
            for _ in range(3):
                one = (cost + INSERT * len(inserts), rank, inserts, index)
                if to not in best or one < best[to]:
                    best[to] = one
                inserts, to = inserts + "I", GIVEN[to][1]
        # A system turn to come is worth a deletion; after one, only a user turn may follow.
        if NOTHING in best and best[NOTHING][0] > best[ASSISTANT][0] + DELETE:
            del best[NOTHING]
        if SYSTEM in best and best[SYSTEM][0] > best[ASSISTANT][0]:
            del best[SYSTEM]
        return best

    @staticmethod
    def inserted(position: int, inserts: int) -> tuple[bytes, int]:
        """The lines of so many inserted turns, and the position after them."""
        lines = b""
        for _ in range(inserts):
            role, to = GIVEN[position]
            lines += (b"\n" if position != NOTHING else b"") + role.encode() + b":"
            position = to
        return lines, position

    def step(self, number: int, symbol: int) -> int:
        """The number of the step from a front by a row: `letter * 3 + fault`."""
        found = self.known.get((number, symbol))
        if found is not None:
            return found
        letter, fault = LETTERS[symbol // 3], symbol % 3
        front = self.fronts[number]
        moves: dict[int, tuple] = {}
        for position, (cost, rank, inserts, index) in self.reached(front).items():
            options = [("D", DELETE, position, None)]
            if fault != GONE:
                more = TRUNCATED if fault == CUT else 0
                role, to = GIVEN[position]
                options.append(("R", REROLE + more, to, role))
                if letter in KEPT[position]:
                    options.append(("K", more, KEPT[position][letter], None))
            for edit, price, to, role in options:
                one = (cost + price, rank, inserts + edit, index, position, role)
                if to not in moves or one[:3] < moves[to][:3]:
                    moves[to] = one
        least = min(m[0] for m in moves.values())
        ranks = {key: i for i, key in enumerate(sorted({m[1:3] for m in moves.values()}))}
        after = [(to, m[0] - least, ranks[m[1:3]]) for to, m in sorted(moves.items())]
        used = {one[3] for one in self.reached(after).values()}
        kept = [k for k in range(len(after)) if k in used]
        order = {r: i for i, r in enumerate(sorted({after[k][2] for k in kept}))}
        target = tuple((after[k][0], after[k][1], order[after[k][2]]) for k in kept)
        if target not in self.numbers:
            self.numbers[target] = len(self.fronts)
            self.fronts.append(target)
        told = []
        for k in kept:
            _, _, edits, index, position, role = moves[after[k][0]]
            lines, _ = self.inserted(front[index][0], len(edits) - 1)
            begin = None
            if edits[-1] != "D":
                begin = (b"\n" if position != NOTHING else b"") + (role.encode() + b":" if role else b"")
            told.append((index, edits, lines, begin, role is not None))
        self.known[number, symbol] = len(self.steps)
        self.steps.append((self.numbers[target], least, tuple(told)))
        return len(self.steps) - 1

    def last(self, number: int) -> tuple:
        """`(cost, rank, inserts, index)` of the cheapest end."""
        best = self.reached(self.fronts[number])
        return min(best[p] for p in (NOTHING, ASSISTANT) if p in best)


class _Conversation:
    """What is carried from row to row."""

    def __init__(self, key: str, fronts: Fronts):
        self.key, self.fronts = key, fronts
        self.front, self.cost = 0, 0
        self.digests = [hashlib.sha256()]
        self.steps, self.file = array("I"), None
        self.counts = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.turns, self.first, self.turn = 0, None, None
        self.before, self.letter = None, None

    def add(self, has_turn, turn, role, text, letter, blank, again, cut):
        if has_turn and (self.turns == 0 or turn != self.turn):
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.turn = turn
        row = (has_turn, turn, role, text)
        fault = FINE
        if blank:
            self.counts[0] += 1
            fault = GONE
        elif again or row == self.before:
            self.counts[1] += 1
            fault = GONE
        elif cut:
            self.counts[2] += 1
            fault = CUT
        if self.letter is not None and self.letter + letter not in ("su", "ua", "au"):
            self.counts[3] += 1
        self.before, self.letter = row, letter
        step = self.fronts.step(self.front, LETTERS.index(letter) * 3 + fault)
        self.front, more, moves = self.fronts.steps[step]
        self.cost += more
        self.steps.append(step)
        if len(self.steps) >= HELD_STEPS:
            self.file = self.file or tempfile.TemporaryFile()
            self.steps.tofile(self.file)
            self.steps = array("I")
        after = []
        for index, _, lines, begin, renamed in moves:
            digest = self.digests[index]
            if lines or begin is not None:
                digest = digest.copy()
                digest.update(lines)
                if begin is not None:
                    digest.update(begin)
                    digest.update(text if renamed else role + b":" + text)
            after.append(digest)
        self.digests = after

    def _backwards(self):
        yield from reversed(self.steps)
        if self.file is not None:
            size = self.steps.itemsize
            left = self.file.tell() // size
            while left:
                n = min(left, HELD_STEPS)
                left -= n
                self.file.seek(left * size)
                held = array("I")
                held.fromfile(self.file, n)
                yield from reversed(held)
            self.file.close()

    def result(self) -> tuple:
        cost, _, inserts, index = self.fronts.last(self.front)
        lines, _ = self.fronts.inserted(self.fronts.fronts[self.front][index][0], len(inserts))
        digest = self.digests[index].copy()
        digest.update(lines)
        audit = bytearray(inserts.encode())
        for step in self._backwards():
            index, edits, *_ = self.fronts.steps[step][2][index]
            audit += edits[::-1].encode()
        audit.reverse()
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.key, min(gaps, (1 << 63) - 1), *self.counts, self.cost + cost, audit.decode(),
                digest.hexdigest())


RESULT = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _conversations(frames):
    """The rows of each conversation go through one `_Conversation`, also across batches."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    fronts, current = Fronts(), None
    for frame in frames:
        done = []
        for key, gone, *row in zip(*(frame[c].tolist() for c in STREAMED)):
            if current is None or key != current.key:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(key, fronts)
            if not gone:
                current.add(*row)
        if done:
            yield pd.DataFrame(done, columns=names)
    if current is not None:
        yield pd.DataFrame([current.result()], columns=names)


#: The columns of a streamed row.
STREAMED = ("key", "gone", "has_turn", "turn", "role", "text", "letter", "blank", "again", "cut")


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def marked(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: str | None = None) -> DataFrame:
    """The rows as they are streamed: `STREAMED`, with what can be told of a row outside
    of its conversation's order.

    `again`: the same role and text stand in an earlier turn, told by digests of them. That
    is found by an aggregation and a join on whole rows, so that a long conversation is
    spread over all tasks for it.
    """
    base = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("key"),
        (F.col(gone) if gone else F.lit(False)).alias("gone"),
        F.col(turn).isNotNull().alias("has_turn"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        _text(F.col(role)).alias("role"), _text(F.col(text)).alias("text"))
    base = base.select("*", F.sha2("text", 256).alias("_digest"))
    firsts = base.where(~F.col("gone")).groupBy("key", "role", "_digest").agg(
        F.min(F.struct("has_turn", "turn")).alias("_first"))
    firsts = firsts.select("key", "role", "_digest", F.col("_first")["has_turn"].alias("has_turn"),
                           F.col("_first")["turn"].alias("turn"), F.lit(True).alias("_is_first"))
    initial = F.substring("role", 1, 1)
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANK_SET)), -1, 1)
    return base.join(firsts, ["key", "role", "_digest", "has_turn", "turn"], "left").select(
        "key", "gone", "has_turn", "turn", F.col("role").cast("binary").alias("role"),
        F.col("text").cast("binary").alias("text"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("letter"),
        (~F.col("text").rlike(NOT_BLANK)).alias("blank"),
        F.col("_is_first").isNull().alias("again"), (~end.isin(".", "!", "?")).alias("cut"))


def _own_key(rows: DataFrame, result: DataFrame, conv: str) -> DataFrame:
    kind = rows.schema[conv].dataType
    own = F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(kind).alias(conv)
    return result.select(own, *(c for c in result.columns if c != "key"))


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "has_turn", "turn", "role", "text")


def repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            gone: str | None = None) -> DataFrame:
    """One row per conversation: `conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256`.

    Rows of a conversation follow each other by turn, null first, equal turns by role and
    text. A null role or text is one space; null ids are a conversation of their own. Of
    equal rows all but the first are duplicates. `gone` names a column that marks rows to
    be taken for absent; a conversation without others has no faults, an empty audit and
    the digest of nothing. An empty table gives no rows, other columns are not carried.

    A conversation is one task's, however long, as its digest runs over it in order; what
    the task holds of it does not grow but for four bytes a row on disk and the audit.
    """
    streamed = _by_conversation(marked(rows, conv, turn, role, text, gone))
    return _own_key(rows, streamed.mapInPandas(_conversations, RESULT), conv)


REPAIRED = "key string, position long, edit string, has_turn boolean, turn long, role string, text string"


def _replay(frames):
    """Rows of conversations, each after its audit, become repaired ones."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]
    key, audit, at, position, number = None, "", 0, NOTHING, 0
    for frame in frames:
        out = []

        def inserts():
            nonlocal at, position, number
            while audit[at:at + 1] == "I":
                role, position = GIVEN[position]
                out.append((key, number, "I", False, 0, role, ""))
                at, number = at + 1, number + 1

        for own, told, has_turn, turn, role, text, letter in zip(*(frame[c].tolist() for c in (
                "key", "audit", "has_turn", "turn", "role", "text", "letter"))):
            if told is not None:
                key, audit, at, position, number = own, told, 0, NOTHING, 0
            else:
                inserts()
                edit = audit[at]
                at += 1
                if edit != "D":
                    if edit == "K":
                        position = KEPT[position][letter]
                    else:
                        role, position = GIVEN[position]
                    out.append((key, number, edit, has_turn, turn, role, text))
                    number += 1
            if at < len(audit) and not audit[at:].strip("I"):
                inserts()
        if out:
            yield pd.DataFrame(out, columns=names)


def repaired(rows: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", gone: str | None = None) -> DataFrame:
    """The repaired rows `conv_id, position, edit, turn, role, text`, by the audits of `repairs`.

    Inserted rows have no turn and an empty text; deleted ones are not there.
    """
    base = marked(rows, conv, turn, role, text, gone).where(~F.col("gone")).select(
        "key", F.lit(None).cast("string").alias("audit"), "has_turn", "turn",
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), "letter")
    told = found.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("key"), "audit",
        F.lit(False).alias("has_turn"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit("").alias("letter"))
    both = base.unionByName(told).repartition("key").sortWithinPartitions(
        "key", F.col("audit").isNull(), "has_turn", "turn", "role", "text").withColumn(
        "turn", F.coalesce("turn", F.lit(0)))
    out = _own_key(rows, both.mapInPandas(_replay, REPAIRED), conv)
    return out.select(conv, "position", "edit", F.when(F.col("has_turn"), F.col("turn")).alias("turn"), "role", "text")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of `conv_id, turn, role, text` after repeatable damage, with `gone` for dropped ones."""
    def told(name):
        return _text(F.col(name))

    kind = F.pmod(F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")), F.lit(20))
    text = (F.when(F.col("_kind") <= 1, F.lit(""))
            .when(F.col("_kind") == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text")))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("_kind")).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(told("role")).alias("role"),
        text.alias("text"), (F.col("_kind") == 0).alias("gone"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    ).drop("_copy")


def op11_conversations(spark, sf_dir: str) -> DataFrame:
    return repairs(damaged(table(spark, sf_dir, "conversations")), gone="gone")


QUERIES = {"op11_conversations": op11_conversations}
