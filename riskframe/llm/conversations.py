"""Conversation repair: least edits that give alternating roles, by a dynamic programme with square-root checkpoints."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize

VISIBLE = r"[^\x20\x09-\x0D]"
ENDS = "[.!?]"
DAMAGE = 20  # one row in so many meets each kind of damage
OTHER = 3
INITIALS = {"s": 0, "u": 1, "a": 2}  # anything else: OTHER
FAULTS = ("none", "blank", "duplicate", "truncated")
TRUNCATED = 3
ROLES = {1: "user", 2: "assistant"}
# states: 0 nothing kept yet, 1 after system, 2 after user, 3 after assistant
AFTER_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, initial)
TURN = {0: 2, 1: 2, 2: 3, 3: 2}  # the state behind a written role: user, but assistant after user
WRITTEN = {0: 1, 1: 1, 2: 2, 3: 1}  # that role
END_COST = (0, 4, 2, 0)  # inserts that close a conversation
INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1
MEMO_ROWS = 24


def row_costs(code: int) -> tuple[int, int]:
    """Extra cost of a row that stays, -1 if it must go; and its initial."""
    initial, fault = code & 3, code >> 2
    return (-1 if fault in (1, 2) else CUT_OFF if fault == TRUNCATED else 0), initial


def step_back(code: int, later: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from a row on, by the state before it, given those from the next row on."""
    extra, initial = row_costs(code)
    own = []
    for state in range(4):
        cost = DELETE + later[state]
        if extra >= 0:
            cost = min(cost, REROLE + extra + later[TURN[state]])
            kept = AFTER_KEPT.get((state, initial))
            if kept is not None:
                cost = min(cost, extra + later[kept])
        own.append(cost)
    user, assistant = min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])
    return min(own[0], INSERT + user), min(own[1], INSERT + user), user, assistant


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of one conversation, one byte a row; of equal ones the ASCII-least audit.

    The backward pass keeps the cost vectors at every ``sqrt(n)``-th row only. Walking forward, the vectors of one
    block are computed again from the checkpoint behind it, and every step takes the first letter, in ASCII
    order, of an edit whose cost and whose rest add up to the least cost. So n rows need about 2 sqrt(n)
    vectors at a time.
    """
    n = len(codes)
    block = max(1, math.isqrt(n))
    vector, marks = END_COST, {n: END_COST}
    for i in range(n - 1, -1, -1):
        vector = step_back(codes[i], vector)
        if i % block == 0:
            marks[i] = vector
    total, state = vector[0], 0
    audit = bytearray()
    for start in range(0, n, block):
        end = min(start + block, n)
        vectors = [marks[end]]
        for i in range(end - 1, start - 1, -1):
            vectors.append(step_back(codes[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, end):
            here, later = vectors[i - start], vectors[i - start + 1]
            extra, initial = row_costs(codes[i])
            while True:
                if here[state] == DELETE + later[state]:
                    audit += b"D"
                elif here[state] == INSERT + here[TURN[state]]:
                    audit += b"I"
                    state = TURN[state]
                    continue
                else:
                    kept = AFTER_KEPT.get((state, initial))
                    if kept is not None and here[state] == extra + later[kept]:
                        audit += b"K"
                        state = kept
                    else:
                        audit += b"R"
                        state = TURN[state]
                break
    while END_COST[state]:
        audit += b"I"
        state = TURN[state]
    return total, audit.decode()


repair_short = lru_cache(100_000)(repair)


class Walk:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str, codes: bytes):
        self.audit, self.codes = audit, codes
        self.letter = self.row = self.state = 0

    def inserts(self) -> Iterator[tuple[str, str]]:
        """The rows inserted at this place."""
        while self.letter < len(self.audit) and self.audit[self.letter] == "I":
            yield ROLES[WRITTEN[self.state]], ""
            self.state = TURN[self.state]
            self.letter += 1

    def push(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What stands in place of the next row, rows inserted before it included."""
        yield from self.inserts()
        edit = self.audit[self.letter]
        if edit == "K":
            yield role, text
            self.state = AFTER_KEPT[self.state, self.codes[self.row] & 3]
        elif edit == "R":
            yield ROLES[WRITTEN[self.state]], text
            self.state = TURN[self.state]
        self.letter += 1
        self.row += 1


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after a damage that depends on conversation and turn only.

    ``crc32("conv_id:turn") % 20``, a null as one space: 0 drops the row, 1 empties its text, 2 takes the sentence ends out,
    3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key), F.lit(DAMAGE))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def last_visible_ends(text: Column) -> Column:
    """Whether the last character that is no white space ends a sentence."""
    bare = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.substring(bare, -1, 1).rlike(ENDS)


def numbered_rows(rows: DataFrame) -> DataFrame:
    """``at, conv_id, turn, role, text, digest``: rows numbered once, nulls as one space."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    base = base.select(F.monotonically_increasing_id().alias("at"), "*", F.md5("text").alias("digest"))
    return materialize(base, "conversation_rows")


def coded_rows(base: DataFrame) -> DataFrame:
    """``at, conv_id, turn, role, digest, code``: every row's initial and first fault in one byte.

    A repeat is a row whose role and text stand earlier in the conversation. The first place of every (conversation, role,
    text digest) is a minimum, combined before its shuffle, and comes back by the row's own number: neither a hot
    conversation nor a text that a third of all rows share is gathered anywhere. Texts are not shuffled.
    """
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn", "at")
    first = base.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("place")).select(F.col("place.at").alias("at"))
    initial = F.substring("role", 1, 1)
    letter = F.coalesce(*[F.when(initial == k, F.lit(v)) for k, v in INITIALS.items()], F.lit(OTHER))
    own = base.select(
        "at", "conv_id", "turn", "role", "digest", letter.alias("letter"),
        (~F.col("text").rlike(VISIBLE)).alias("blank"), (~last_visible_ends(F.col("text"))).alias("cut_off"),
    )
    seen = own.join(first.withColumn("first", F.lit(True)), "at", "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut_off"), TRUNCATED).otherwise(0)
    return seen.select("at", "conv_id", "turn", "role", "digest", (fault * 4 + F.col("letter")).cast("int").alias("code"))


LEGAL = {(0, 1), (1, 2), (2, 1)}
HEADER, CODE, TEXT = 0, 1, 2
STREAM = ["conv_id", "kind", "turn", "role", "digest", "at", "code", "text"]


class Conversation:
    """One conversation of the stream: first a byte a row, then its texts."""

    def __init__(self):
        self.codes = bytearray()
        self.least = self.most = self.walk = None
        self.turns = self.illegal = 0
        self.written, self.digest = 0, hashlib.sha256()

    def add_code(self, code: int, turn: int | None) -> None:
        if self.codes and (self.codes[-1] & 3, code & 3) not in LEGAL:
            self.illegal += 1
        self.codes.append(code)
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def solve(self) -> None:
        codes = bytes(self.codes)
        self.cost, self.audit = repair_short(codes) if len(codes) <= MEMO_ROWS else repair(codes)
        self.walk = Walk(self.audit, codes)

    def write(self, rows: Iterator[tuple[str, str]]) -> list[tuple[int, str, str]]:
        """Take repaired rows into the digest; the rows with their places."""
        out = []
        for role, text in rows:
            self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
            out.append((self.written, role, text))
            self.written += 1
        return out

    def report(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        faults = [sum(c >> 2 == k for c in self.codes) for k in range(1, len(FAULTS))]
        return gaps, *faults, self.illegal, self.cost, self.audit, self.digest.hexdigest()


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "place long, role string, text string"


def solved(rows: DataFrame, conversations: DataFrame, reports: bool) -> DataFrame:
    """One report per conversation, or the repaired rows.

    A conversation streams through one task in its order, twice: first a byte a row, which the programme needs as a whole,
    then the texts, which are hashed or given on as they come. So a conversation of a third of all rows takes one
    byte a row of memory (as its audit does) and the vectors between two checkpoints.
    """
    base = numbered_rows(rows)
    none = F.lit(None)
    heads = conversations.select("conv_id").distinct()
    parts = [
        heads.select("conv_id", F.lit(HEADER), none.cast("long"), none.cast("string"), none.cast("string"), none.cast("long"), none.cast("int"), none.cast("string")),
        coded_rows(base).select("conv_id", F.lit(CODE), "turn", "role", "digest", "at", "code", none.cast("string")),
        base.select("conv_id", F.lit(TEXT), "turn", "role", "digest", "at", none.cast("int"), "text"),
    ]
    parts = [p.toDF(*STREAM) for p in parts]
    stream = parts[0].union(parts[1]).union(parts[2]).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest", "at"
    )
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    fields = REPORT if reports else ROWS
    names = ["conv_id", *[f.split()[0] for f in fields.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, out = None, None, []

        def close():
            if own.walk is None:
                own.solve()
            written = own.write(own.walk.inserts())
            out.extend([(at, *own.report())] if reports else [(at, *w) for w in written])

        for batch in batches:
            types = [batch.schema.field(0).type, *TYPES[reports]]
            for conv_id, kind, turn, role, _, _, code, text in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == HEADER:
                    if own is not None:
                        close()
                    at, own = conv_id, Conversation()
                elif kind == CODE:
                    own.add_code(code, turn)
                else:
                    if own.walk is None:
                        own.solve()
                    written = own.write(own.walk.push(role, text))
                    if not reports:
                        out.extend((at, *w) for w in written)
            yield as_batch(out, names, types)
            out.clear()
        if own is not None:
            close()
            yield as_batch(out, names, types)

    return stream.mapInArrow(run, f"conv_id {id_type}, {fields}")


TYPES = {True: [pa.int64()] * 6 + [pa.string()] * 2, False: [pa.int64(), pa.string(), pa.string()]}


def as_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def audit_conversations(rows: DataFrame, damage: bool = False) -> DataFrame:
    """Faults and the cheapest repair of every conversation of ``conv_id, turn, role, text`` rows.

    Gives ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows are taken by turn, nulls first,
    rows of one turn by role and text digest. The first fault of a row counts: blank, duplicate (role and
    text seen earlier), truncated. Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one
    for blank and duplicate rows), Insert an empty user or assistant row 2; a truncated row that stays adds 1. The audit
    is the edits' initials; the repaired roles' initials are ``(s?(ua)+)?``.

    Null texts and roles count as one space, so the text is blank and the role no legal one. Null ids are one conversation,
    null turns come first. ``damage`` damages the rows first (``damaged``); conversations without a row left
    give zeros, an empty audit and the digest of nothing. An empty table gives no rows; other columns are ignored.
    Texts are compared by MD5.
    """
    return solved(damaged(rows) if damage else rows, rows, reports=True)


def repaired_conversations(rows: DataFrame, damage: bool = False) -> DataFrame:
    """The repaired rows themselves: ``conv_id, place, role, text`` with places from 0."""
    return solved(damaged(rows) if damage else rows, rows, reports=False)
