"""Repair of conversations: the cheapest edits that give each a sound order of roles, in a stream.

A sound conversation is empty, or an optional system message followed by pairs of user and assistant. Rows are kept (free), given
the role of user or assistant (3), deleted (4; blank and duplicate rows must be), and messages without text are inserted (3); a
truncated row that stays adds 3. Of the cheapest lists of edits, written as initials in order, the least one is taken.

1. Rows are dealt by conversation and sorted by turn; a stream carries the state of a dynamic program from batch to batch: for each of
   the four places in the order of roles the least cost so far, and how the lists that led there compare. These are few distinct
   states, so a row is one look-up in a table of steps. A step's pointers back, four of 6 bits, go into one integer.
2. Rows of the running conversation are held until it ends, and then edited backwards. Of a conversation with more than HELD rows or
   HELD_BYTES, the rows go out with their pointers and without edits, into the stored table in the shared folder; a second stream,
   over these pointers in falling order and without the texts, edits them.

So a task holds a bounded number of rows and one state, whatever the size of a conversation. A conversation is one task's stream, since
each state follows from the one before. Whether a row repeats an earlier one of its conversation is found before, by hashes of role
and text that are counted and joined, with no table of them in a task.

Defined cases: a null role or text counts as one space. Null turns come first; rows of one turn follow by role and text. A null
conv_id is a conversation of its own. Of repeated rows all but the first are duplicates. Only a role's first letter counts for the
order; a role without any letter stands outside it. Very long texts are rows like others. Other columns are kept; those with the
names of the new ones are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.common import drop_columns, fresh, numbered, quoted
from forumlens.session import stored

#: Rows and bytes of text of one conversation that a task holds; more go out with their pointers.
HELD, HELD_BYTES = 50_000, 32 << 20
#: Places in the order of roles: nothing yet, after system, after user, after assistant.
NAMES = {2: "user", 3: "assistant"}
FOLLOWS = {0: 2, 1: 2, 2: 3, 3: 2}
ENDS = (0, 3)
INSERT, RENAME, DELETE, CUT_OFF = 3, 3, 4, 3
SPACE = "\\x20\\x09-\\x0D"
LETTERS = "DKR"
FAULTS = ("sound", "blank", "duplicate", "truncated")
#: No list of edits leads to the place.
CLOSED = 63


def kept_as(place: int, initial: str) -> int | None:
    """Where a kept row leads to, None if it must not stand there."""
    if initial == "":
        return place
    if initial == "s":
        return 1 if place == 0 else None
    if initial in "ua":
        to = 2 if initial == "u" else 3
        return to if FOLLOWS[place] == to else None
    return None


@lru_cache(maxsize=None)
def step(state: tuple, initial: str, must_go: bool, cut_off: bool) -> tuple[tuple, int, int]:
    """The next state, what all its costs are short of, and the pointers back.

    A state has (cost, order) for each place, or None; the order compares the lists of edits.
    """
    found: dict[int, tuple] = {}
    for place, value in enumerate(state):
        if value is None:
            continue
        cost, order = value
        at = place
        for inserted in range(3):  # three would come back to where one leads
            ways = [("D", at, DELETE)]
            if not must_go:
                kept, more = kept_as(at, initial), CUT_OFF if cut_off else 0
                if kept is not None:
                    ways.append(("K", kept, more))
                ways.append(("R", FOLLOWS[at], RENAME + more))
            for letter, to, price in ways:
                way = (cost + INSERT * inserted + price, order, "I" * inserted + letter, place)
                if to not in found or way < found[to]:
                    found[to] = way
            at = FOLLOWS[at]
    least = min(way[0] for way in found.values())
    ranked = sorted(found, key=lambda to: found[to][1:3])
    after = tuple((found[to][0] - least, ranked.index(to)) if to in found else None for to in range(4))
    back = 0
    for to in range(4):
        way = found.get(to)
        code = CLOSED if way is None else way[3] | (len(way[2]) - 1) << 2 | LETTERS.index(way[2][-1]) << 4
        back |= code << 6 * to
    return after, least, back


FIRST = ((0, 0), None, None, None)


def ending(state: tuple) -> tuple[int, int]:
    """The last place and the number of messages inserted after the last row."""
    ways = []
    for place, value in enumerate(state):
        at = place
        for inserted in range(3 if value is not None else 0):
            if at in ENDS:
                ways.append((value[0] + INSERT * inserted, value[1], inserted, place))
            at = FOLLOWS[at]
    return min(ways)[3], min(ways)[2]


def backwards(back: int, place: int) -> tuple[int, str]:
    """The place before a row that leads to `place`, and the row's edits."""
    code = back >> 6 * place & 63
    return code & 3, "I" * (code >> 2 & 3) + LETTERS[code >> 4]


def roles_of(place: int, edits: str, role: str) -> list[str]:
    """The roles of what a row leaves, in order."""
    left = []
    for edit in edits:
        if edit == "K":
            left.append(role)
            place = kept_as(place, role[:1])
        elif edit != "D":
            place = FOLLOWS[place]
            left.append(NAMES[place])
    return left


def as_text(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)), F.lit(" "))


def sorted_by_conversation(df: DataFrame, *order: Column) -> DataFrame:
    return df.repartition(F.col("c0")).sortWithinPartitions(F.asc_nulls_first("c0"), *order)


def with_faults(turns: DataFrame, late: str, key: str, fault: str) -> DataFrame:
    """`turns` with the hash of role and text, and a fault: blank, duplicate (of an earlier turn; of the same turn only the stream can tell), truncated or none."""
    text = as_text("text")
    turns = turns.withColumn(key, F.unhex(F.sha2(F.concat(F.length(as_text("role")).cast("string"), F.lit(":"), as_text("role"), text), 256)))
    conv, at = fresh("conv", turns.columns), F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    conv_key = fresh("key", [*turns.columns, conv])
    many = turns.groupBy(F.col("conv_id").alias(conv), F.col(key).alias(conv_key)).agg(F.min(at).alias(late), F.count("*").alias("n"))
    many = many.filter("n > 1").drop("n")
    met = turns.join(many, F.col("conv_id").eqNullSafe(F.col(conv)) & (F.col(key) == F.col(conv_key)), "left")
    blank, ended = ~text.rlike(f"[^{SPACE}]"), text.rlike(f"[.!?][{SPACE}]*+\\z")
    kind = F.when(blank, 1).when(F.coalesce(at > F.col(late), F.lit(False)), 2).when(~ended, 3).otherwise(0)
    return met.withColumn(fault, kind.cast("int")).drop(conv, conv_key, late)


def forward(batches: Iterator[pa.RecordBatch], role_at: int, text_at: int, key_at: int, fault_at: int, names: list[str], held: int, held_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows with seq, fault, pointers, finish, edits and roles; columns: c0 is the conversation, the second one the turn."""
    rows: list[pa.RecordBatch] = []  # not yet sent
    seqs, faults, backs, finishes, edits, roles, own_roles = ([] for _ in range(7))
    bytes_held, first, begun, seq = 0, 0, False, 0  # `first` is the running conversation's first row among those not sent
    conversation = state = seen = None
    spilled = False

    def close() -> None:
        nonlocal spilled
        place, inserted = ending(state)
        if spilled:
            finishes[-1] = place | inserted << 2
        else:
            for i in range(len(backs) - 1, first - 1, -1):
                before, own = backwards(backs[i], place)
                if i == len(backs) - 1:
                    own += "I" * inserted
                edits[i], roles[i] = own, roles_of(before, own, own_roles[i])
                place = before
        spilled = False

    def send(n: int) -> Iterator[pa.RecordBatch]:
        """The first n rows."""
        nonlocal rows
        left = n
        while left:
            some = rows[0].slice(0, left)
            k = n - left
            span = slice(k, k + len(some))
            more = [pa.array(seqs[span], pa.int64()), pa.array(faults[span], pa.int32()), pa.array(backs[span], pa.int32()), pa.array(finishes[span], pa.int32())]
            more += [pa.array(edits[span], pa.string()), pa.array(roles[span], pa.list_(pa.string()))]
            kept = [some.column(i) for i in range(some.num_columns) if i not in (key_at, fault_at)]
            yield pa.RecordBatch.from_arrays([*kept, *more], names=names)
            left -= len(some)
            rows = [rows[0].slice(len(some)), *rows[1:]] if len(some) < len(rows[0]) else rows[1:]
        for values in (seqs, faults, backs, finishes, edits, roles, own_roles):
            del values[:n]

    for batch in batches:
        rows.append(batch)
        columns = [batch.column(i).to_pylist() for i in (0, 1, role_at, key_at, fault_at)]
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 1).to_pylist()
        for (conv, turn, role, key, fault), size in zip(zip(*columns), sizes):
            if not begun or conv != conversation:
                if begun:
                    close()
                conversation, state, seen, begun, seq, bytes_held, first = conv, FIRST, None, True, 0, 0, len(backs)
            if fault != 1 and seen == (turn, key):  # equal rows of one turn are neighbours
                fault = 2
            seen = (turn, key)
            role = " " if role is None else role
            state, _, back = step(state, role[:1], fault in (1, 2), fault == 3)
            for values, value in zip((seqs, faults, backs, finishes, edits, roles, own_roles), (seq, fault, back, None, None, None, role)):
                values.append(value)
            seq += 1
            bytes_held += size
        if begun and (len(backs) - first > held or bytes_held > held_bytes):
            spilled = True
        if spilled and len(backs) > first + 1:
            yield from send(len(backs) - 1)  # the last row waits, it may have to carry the end
            first = 0
        elif not spilled and first:
            yield from send(first)
            first = 0
    if begun:
        close()
        yield from send(len(backs))


def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c0, seq, edits, roles) from (c0, seq, role, back, finish) with the last row of a conversation first."""
    place = None
    for batch in batches:
        edits, roles = [], []
        for role, back, finish in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]):
            inserted = 0
            if finish is not None:
                place, inserted = finish & 3, finish >> 2
            place, own = backwards(back, place)
            own += "I" * inserted
            edits.append(own)
            roles.append(roles_of(place, own, " " if role is None else role))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(edits, pa.string()), pa.array(roles, pa.list_(pa.string()))], names=["c0", "seq", "edits", "roles"])


def repair(turns: DataFrame, held: int = HELD, held_bytes: int = HELD_BYTES) -> DataFrame:
    """`turns` with seq (place in its conversation), fault, edits (initials, in order) and roles (of what the row leaves)."""
    new = ["seq", "fault", "edits", "roles"]
    turns = drop_columns(turns, *new)
    lead = [c for c in turns.columns if c.lower() in ("conv_id", "turn")]
    lead.sort(key=str.lower)
    turns = turns.select(*[F.col(quoted(c)) for c in [*lead, *[c for c in turns.columns if c not in lead]]])
    names = turns.columns
    key = fresh("key", names)
    fault = fresh("fault", [*names, key])
    faulty = with_faults(turns, fresh("late", [*names, key, fault]), key, fault)
    low = [c.lower() for c in names]
    role_at, text_at, key_at, fault_at = low.index("role"), low.index("text"), len(names), len(names) + 1
    own = [*[f"c{i}" for i in range(len(names))], *["seq", "fault", "back", "finish", "edits", "roles"]]
    fields = [T.StructField(n, f.dataType) for n, f in zip(own, turns.schema.fields)]
    fields += [T.StructField("seq", T.LongType())] + [T.StructField(n, T.IntegerType()) for n in ("fault", "back", "finish")]
    fields += [T.StructField("edits", T.StringType()), T.StructField("roles", T.ArrayType(T.StringType()))]
    placed = sorted_by_conversation(numbered(faulty), F.asc_nulls_first("c1"), as_text(f"c{role_at}"), as_text(f"c{text_at}"))
    run = lambda batches: forward(batches, role_at, text_at, key_at, fault_at, own, held, held_bytes)
    passed = stored(placed.mapInArrow(run, T.StructType(fields)), "repair-steps")
    pointers = passed.filter("edits is null").select("c0", "seq", f"c{role_at}", "back", "finish")
    schema = T.StructType([fields[0], T.StructField("seq", T.LongType()), *fields[-2:]])
    traced = sorted_by_conversation(pointers, F.desc("seq")).mapInArrow(backward, schema)
    traced = traced.select(F.col("c0").alias("conv"), F.col("seq").alias("at"), F.col("edits").alias("e"), F.col("roles").alias("r"))
    rest = passed.filter("edits is null").join(traced, F.col("c0").eqNullSafe(F.col("conv")) & (F.col("seq") == F.col("at")))
    rest = rest.withColumns({"edits": F.col("e"), "roles": F.col("r")}).select(*passed.columns)
    named = F.get(F.array(*map(F.lit, FAULTS)), F.col("fault")).alias("fault")
    kept = [f"c{i}" for i in range(len(names))]
    return passed.filter("edits is not null").unionByName(rest).select(*kept, "seq", named, "edits", "roles").toDF(*names, *new)


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """The sound conversations: conv_id, seq, place (among what one row leaves), role, text."""
    edits = F.filter(F.split("edits", ""), lambda e: (e != "") & (e != "D"))
    left = F.transform(F.arrays_zip(edits.alias("edit"), F.col("roles").alias("role")), lambda x: F.struct(x["role"].alias("role"), F.when(x["edit"] == "I", F.lit("")).otherwise(as_text("text")).alias("text")))
    return repaired.select("conv_id", "seq", F.posexplode(left).alias("place", "message")).select("conv_id", "seq", "place", "message.role", "message.text")


def reports(repaired: DataFrame) -> DataFrame:
    """For each conversation its faults, the cost, the edits and a hash of the repaired `role:text` lines."""
    schema = T.StructType([T.StructField("conv_id", repaired.schema["conv_id"].dataType)])
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    for name in counts:
        schema.add(name, T.LongType())
    schema.add("audit", T.StringType()).add("repaired_sha256", T.StringType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conversation, report = False, None, None
        for batch in batches:
            done = []
            for conv, turn, role, text, fault, edits, roles in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                if not begun or conv != conversation:
                    if begun:
                        done.append((conversation, *report.row()))
                    conversation, begun, report = conv, True, Report()
                report.add(turn, " " if role is None else role, " " if text is None else text, fault, edits, roles)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*done), arrow)], names=names)
        if begun:
            last = (conversation, *report.row())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, arrow)], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    chosen = repaired.select(F.col("conv_id").alias("c0"), "turn", "role", "text", "fault", "edits", "roles", "seq")
    return sorted_by_conversation(chosen, F.asc("seq")).mapInArrow(run, schema)


class Report:
    def __init__(self):
        self.count = dict.fromkeys(FAULTS, 0)
        self.least = self.most = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.audit, self.hash, self.lines = [], sha256(), 0

    def add(self, turn, role: str, text: str, fault: str, edits: str, roles: list[str]) -> None:
        self.count[fault] += 1
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn  # they come in order
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.cost += INSERT * edits.count("I") + RENAME * edits.count("R") + DELETE * edits.count("D")
        self.cost += CUT_OFF * (fault == "truncated" and "D" not in edits)
        self.audit.append(edits)
        for edit, left in zip(edits.replace("D", ""), roles):
            line = f"{left}:{'' if edit == 'I' else text}"
            self.hash.update(("\n" + line if self.lines else line).encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return gaps, *[self.count[f] for f in FAULTS[1:]], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()
