"""Repair of conversation structure with the cheapest audited edits.

A conversation shall be ``(s?(ua)+)?`` in the initials of its roles: maybe a system row,
then user and assistant in turns.  Rows in order get an edit each: Keep (cost 0), Rerole to
user or assistant (2) or Delete (3, the only one for blank and repeated rows); an empty user or
assistant row may be Inserted anywhere (2); a truncated row that is not deleted adds 1.  Of
the cheapest edits those whose initials, the audit, come first in ASCII order are taken.

The search is dynamic programming over rows and the four states of the pattern.  A state's
best audit is a node of a shared tree of edit prefixes: linked to its parent, with ancestors
at powers of two and a rolling hash.  Ties of cost are decided by the longest common prefix of
two audits, found through ancestors whose hashes agree.  Hashes are verified: a node is looked up by hash, then by parent
and letter, so one prefix is one node, and equal hashes of two nodes are a collision.

Two passes stream over rows sorted by conversation.  The first carries facts about
rows, no texts, and finds the audits; the second lets each audit meet its conversation's
texts and yields the repaired rows, or their digest.  No conversation is held in memory: a task keeps its audit, the prefixes on which the states still
differ, and a digest of each different row (repeats may be any number of rows apart).  The
digest of repaired rows is sequential by its definition, so one conversation's texts pass
through one task, as a stream.

Defined results.  A null role or text is one space (a null text is blank, a null role has no
legal initial); an empty role has no initial.  Rows are taken by turn, nulls first, equal turns by role, then by a
digest of role and text.  A null ``conv_id`` is a conversation.  A conversation without rows
gets zeros, an empty audit and the digest of nothing.  Gaps that do not fit a long are null.  An
empty table gives no rows.  Columns other than ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.llm.common import given, written

#: Costs of the edits, and of a truncated row that stays.
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
#: Pattern states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: Where a role's initial leads from a state.
STEPS = {
    (START, b"s"): SYSTEM, (START, b"u"): USER, (SYSTEM, b"u"): USER, (ASSISTANT, b"u"): USER, (USER, b"a"): ASSISTANT,
}
#: The role that an inserted or changed row gets in a state.
FREE = {START: b"user", SYSTEM: b"user", ASSISTANT: b"user", USER: b"assistant"}
LEGAL_PAIRS = {b"su", b"ua", b"au"}
#: Prefix nodes of a conversation before those that all states share are let go.
PRUNE_AT = 1 << 15
MODULUS, BASE = (1 << 61) - 1, 1_000_003
LONGEST = 2**63 - 1


class Prefixes:
    """Edit strings as nodes of a tree; node 0 is the empty string."""

    def __init__(self) -> None:
        self.letters, self.depths, self.hashes, self.ups = [""], [0], [0], [[]]
        self.by_hash: dict[int, list[int]] = {}

    def extend(self, node: int, letter: str) -> int:
        """The node of the string of ``node`` and one more letter."""
        rolled = (self.hashes[node] * BASE + ord(letter)) % MODULUS
        same = self.by_hash.setdefault(rolled, [])
        for found in same:
            if self.ups[found][0] == node and self.letters[found] == letter:
                return found
        ups, above, power = [node], node, 0
        while power < len(self.ups[above]):
            above = self.ups[above][power]
            ups.append(above)
            power += 1
        self.letters.append(letter)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append(rolled)
        self.ups.append(ups)
        same.append(len(self.letters) - 1)
        return len(self.letters) - 1

    def _equal(self, a: int, b: int) -> bool:
        return self.hashes[a] == self.hashes[b] and a == b  # the second excludes a collision

    def above(self, node: int, depth: int) -> int:
        """The prefix of ``node`` of that length."""
        left, power = self.depths[node] - depth, 0
        while left:
            if left & 1:
                node = self.ups[node][power]
            left, power = left >> 1, power + 1
        return node

    def parting(self, a: int, b: int) -> tuple[int, int]:
        """The shortest prefixes of ``a`` and ``b`` of equal length that differ, or twice the shorter string."""
        depth = min(self.depths[a], self.depths[b])
        a, b = self.above(a, depth), self.above(b, depth)
        if self._equal(a, b):
            return a, b
        for power in range(len(self.ups[a]) - 1, -1, -1):
            if power < len(self.ups[a]) and not self._equal(self.ups[a][power], self.ups[b][power]):
                a, b = self.ups[a][power], self.ups[b][power]
        return a, b

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        x, y = self.parting(a, b)
        if x == y:
            return self.depths[a] < self.depths[b]
        return self.letters[x] < self.letters[y]

    def text(self, node: int, depth: int = 0) -> str:
        """The letters of ``node`` after its prefix of length ``depth``."""
        letters = []
        while self.depths[node] > depth:
            letters.append(self.letters[node])
            node = self.ups[node][0]
        return "".join(reversed(letters))


class Search:
    """The cheapest audit of one conversation, fed row by row."""

    def __init__(self) -> None:
        self.settled, self.tree, self.prune_at = [], Prefixes(), PRUNE_AT
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self._insert()

    def _offer(self, best: list, state: int, cost: int, node: int, letter: str) -> None:
        have = best[state]
        if have is None or cost < have[0]:
            best[state] = (cost, self.tree.extend(node, letter))
        elif cost == have[0]:
            found = self.tree.extend(node, letter)
            if self.tree.less(found, have[1]):
                best[state] = (cost, found)

    def _insert(self) -> None:
        for state in (START, SYSTEM, ASSISTANT, USER):  # the last goes on from what the others reach
            if self.best[state]:
                cost, node = self.best[state]
                target = STEPS[state, FREE[state][:1]]
                if self.best[target] is None or cost + COSTS["I"] <= self.best[target][0]:
                    self._offer(self.best, target, cost + COSTS["I"], node, "I")

    def row(self, initial: bytes, must_go: bool, truncated: bool) -> None:
        best: list[tuple[int, int] | None] = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, have in enumerate(self.best):
            if have is None:
                continue
            cost, node = have
            if not must_go:
                kept = STEPS.get((state, initial))
                if kept is not None:
                    self._offer(best, kept, cost + COSTS["K"] + extra, node, "K")
                self._offer(best, STEPS[state, FREE[state][:1]], cost + COSTS["R"] + extra, node, "R")
            self._offer(best, state, cost + COSTS["D"], node, "D")
        self.best = best
        self._insert()
        if len(self.tree.letters) > self.prune_at:
            self._prune()

    def _prune(self) -> None:
        """Settle the letters that all states share and start a new tree at their end."""
        live = [have[1] for have in self.best if have]
        shared = min(self._common(live[0], node) for node in live)
        if shared:
            self.settled.append(self.tree.text(self.tree.above(live[0], shared)))
        old, self.tree = self.tree, Prefixes()
        for state, have in enumerate(self.best):
            if have:
                node = 0
                for letter in old.text(have[1], shared):
                    node = self.tree.extend(node, letter)
                self.best[state] = (have[0], node)
        self.prune_at = max(PRUNE_AT, 2 * len(self.tree.letters))

    def _common(self, a: int, b: int) -> int:
        x, y = self.tree.parting(a, b)
        return self.tree.depths[x] - (x != y)

    def result(self) -> tuple[int, str]:
        ends = [self.best[state] for state in ACCEPTED if self.best[state]]
        least = min(cost for cost, _ in ends)
        node = None
        for cost, found in ends:
            if cost == least and (node is None or self.tree.less(found, node)):
                node = found
        return least, "".join([*self.settled, self.tree.text(node)])


class Tally:
    """What the first pass gathers of a conversation."""

    def __init__(self) -> None:
        self.search, self.seen, self.last = Search(), set(), None
        self.turns, self.least, self.most, self.turn = 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, initial: bytes, blank: bool, truncated: bool, digest: bytes) -> None:
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        if self.last is not None and self.last + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.last = initial
        repeated = not blank and digest in self.seen
        if not blank:
            self.seen.add(digest)
        truncated = truncated and not blank and not repeated
        self.blank += blank
        self.duplicate += repeated
        self.truncated += truncated
        self.search.row(initial, blank or repeated, truncated)

    def result(self) -> list[object]:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        cost, audit = self.search.result()
        return [gaps if gaps <= LONGEST else None, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit]


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def one_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame, *more: str) -> DataFrame:
    """``conv_id, turn, role, text, times`` with nulls of role and text as one space."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), one_space("role").alias("role"),
        one_space("text").alias("text"), F.lit(1).alias("times"), *more,
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by a checksum of id and turn; dropped ones have ``times`` 0, repeated ones 2."""
    key = F.concat(one_space("conv_id"), F.lit(":"), one_space("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    rows = rows_of(conversations.withColumn("_fault", fault), "_fault")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, "")
        .when(F.col("_fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("_fault") == 0, 0).when(F.col("_fault") == 3, 2).otherwise(F.col("times")).alias("times"),
    )


def _with_digest(rows: DataFrame) -> DataFrame:
    """The digest orders rows of equal turns and roles alike in both passes."""
    both = F.concat(F.col("role").cast("binary"), F.lit(b"\0"), F.col("text").cast("binary"))
    return rows.withColumn("digest", F.unhex(F.sha2(both, 256)))


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, tuple]]:
    """Rows as tuples, and whether each begins a conversation."""
    last, begun = None, False
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in columns)):
            yield not begun or row[0] != last, row
            last, begun = row[0], True


def _in_batches(rows: Iterator[list], schema: pa.Schema, most: int = 1024, bytes_: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, (str, bytes)))
        if len(held) >= most or size >= bytes_:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(spark: SparkSession, conv_id: T.DataType, more: str) -> tuple[T.StructType, pa.Schema]:
    kinds = T.StructType([T.StructField("conv_id", conv_id), *T.StructType.fromDDL(more).fields])
    return kinds, spark.createDataFrame([], kinds).toArrow().schema


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (columns of ``rows_of``): fault counts, cost and audit."""
    spark = rows.sparkSession
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    kinds, arrow = _schema(spark, rows.schema["conv_id"].dataType, f"{counts}, audit string")
    trimmed = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", " " * 5))
    facts = _with_digest(rows).select(
        "conv_id", "turn", "role", "digest", "times",
        F.substring("role", 1, 1).cast("binary").alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    columns = ["conv_id", "turn", "initial", "blank", "truncated", "digest", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            conv_id, tally = None, None
            for begins, (of, *fact, times) in _by_conversation(batches, columns):
                if begins:
                    if tally:
                        yield [conv_id, *tally.result()]
                    conv_id, tally = of, Tally()
                for _ in range(times):
                    tally.row(*fact)
            if tally:
                yield [conv_id, *tally.result()]

        return _in_batches(found(), arrow)

    ordered = facts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return ordered.select(*columns).mapInArrow(run, kinds)


class Replay:
    """Applies an audit to the rows of its conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _free(self) -> bytes:
        role = FREE[self.state]
        self.state = STEPS[self.state, role[:1]]
        return role

    def inserted(self) -> Iterator[tuple[bytes, bytes]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._free(), b""

    def row(self, role: bytes, text: bytes) -> Iterator[tuple[bytes, bytes]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[self.state, role[:1]]
            yield role, text
        elif edit == "R":
            yield self._free(), text


def _replayed(
    rows: DataFrame, found: DataFrame, kinds: T.StructType, arrow: pa.Schema, carried: list[str],
    sink: Callable[[Iterator], Iterator[list]],
) -> DataFrame:
    """Sends each conversation's audit ahead of its rows and both through ``sink``."""
    texts = _with_digest(rows.filter("times > 0")).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "times",
        F.col("role").cast("binary").alias("_role"), F.col("text").cast("binary").alias("_text"),
        *[F.lit(None).cast(found.schema[name].dataType).alias(name) for name in carried],
    )
    ahead = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("times"), F.lit(None).cast("binary").alias("_role"),
        F.lit(None).cast("binary").alias("_text"), *carried,
    )
    columns = ["conv_id", "times", "_role", "_text", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(sink(_by_conversation(batches, columns)), arrow)

    ordered = ahead.unionByName(texts).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", "turn", "role", "digest"
    )
    return ordered.select(*columns).mapInArrow(run, kinds)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` after the edits of ``found`` (of ``audits``); places count from 1."""
    kinds, arrow = _schema(rows.sparkSession, rows.schema["conv_id"].dataType, "place bigint, role binary, text binary")

    def sink(stream):
        conv_id, replay, place = None, None, 0

        def numbered(made):
            nonlocal place
            for role, text in made:
                place += 1
                yield [conv_id, place, role, text]

        for begins, (of, times, role, text, audit) in stream:
            if begins:
                if replay:
                    yield from numbered(replay.inserted())
                conv_id, replay, place = of, Replay(audit), 0
            for _ in range(times):
                yield from numbered(replay.row(role, text))
        if replay:
            yield from numbered(replay.inserted())

    made = _replayed(rows, found, kinds, arrow, ["audit"], sink)
    return made.select("conv_id", "place", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def with_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``, of each conversation's repaired ``role:text`` lines."""
    carried = [*COUNTS, "audit"]
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    kinds, arrow = _schema(
        rows.sparkSession, rows.schema["conv_id"].dataType, f"{counts}, audit string, repaired_sha256 string"
    )

    def sink(stream):
        conv_id, replay, hashed, facts, begun = None, None, None, [], False

        def take(made):
            nonlocal begun
            for role, text in made:
                if begun:
                    hashed.update(b"\n")
                hashed.update(role + b":")
                hashed.update(text)
                begun = True

        for begins, (of, times, role, text, *carry) in stream:
            if begins:
                if replay:
                    take(replay.inserted())
                    yield [conv_id, *facts, hashed.hexdigest()]
                conv_id, replay, hashed, facts, begun = of, Replay(carry[-1]), hashlib.sha256(), carry, False
            for _ in range(times):
                take(replay.row(role, text))
        if replay:
            take(replay.inserted())
            yield [conv_id, *facts, hashed.hexdigest()]

    return _replayed(rows, found, kinds, arrow, carried, sink)


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(given(spark, folder, "conversations"))
    return with_digests(rows, written(audits(rows), "audits"))
