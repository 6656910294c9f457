"""Conversation structure repair: the cheapest edits that make a conversation well formed.

Well formed are role initials ``(s?(ua)+)?``. Edits: Keep costs 0, Rerole to user or assistant 3,
Delete 4, Insert an empty user or assistant turn 3. Blank and duplicate rows must go; a truncated
row that stays adds 3. Of the cheapest edit sequences the one whose initials (D, I, K, R) come
first in ASCII order is taken. It is found by iterative-deepening A*: a depth-first search in that
order under a cost bound, which prunes by a lower bound of what is still to pay; states that fail
leave the cost they were proven to exceed in a table, which prunes later visits and gives the next
bound. Each edit leads from a state to one other state, so the first accepting path under the
least bound is the answer.

A conversation is cut into parts of up to ``PART`` rows, wherever its rows lie, so none is gathered
in one task. Where it has several parts, the costs between the four states of the grammar over
each part (min-plus matrices) tell exactly what is still to pay at each cut; every part is then
searched from every state it may begin in, and the states are chained. What is gathered of a
conversation are 16 numbers a part. Parts are searched in runs of ``RUN`` rows, cut alike.

Rows: a null role or text is one space. A role is known by its first character; one without (the
empty role) or with another than s, u, a is never kept as it is. Rows are taken by turn, null first;
equal turns by the digest of role and text, so reruns agree; rows equal in all are duplicates of
the first. A null conv_id is one conversation of its own. Texts of any length are
only hashed and looked at from their end; an empty table gives an empty one. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from paytide.session import stored

#: Rows of a part, as a power of two: no task holds more of one conversation.
PART_BITS = 10
#: Rows that one search goes over.
RUN = 32

KEEP, RENAME, DROP, ADD, OPEN_END = 0, 3, 4, 3, 3
FAR = 1 << 60
USER, ASSISTANT = "user", "assistant"
#: Faults of a row; a code is 3 * initial + fault.
CLEAN, GONE, CUT = range(3)
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
#: Where an inserted or renamed turn leads, and where a kept row of initial s, u, a or another does.
TURN_TO = (2, 2, 3, 2)
KEPT_TO = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: What is left to insert at the end of a conversation.
AT_END = (0, 6, 3, 0)

SPACES = " \t\n\x0b\x0c\r"


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn`` modulo 20; a null is one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, question and exclamation marks,
    3 repeats it, 4 makes it a user's. Repeated rows are damaged alike.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    text, kind = F.coalesce("text", F.lit(" ")), F.col("kind")
    keyed = turns.select("conv_id", "turn", "role", "text", (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("kind"))
    return keyed.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(kind == 4, USER).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def matrix(codes: str) -> list[int]:
    """Least cost from each state (before the part) to each (right after its last row)."""
    out = []
    for entry in STATES:
        cost = [0 if q == entry else FAR for q in STATES]
        for fault, to in map(_row, codes):
            cost[2] = min(cost[2], cost[0] + ADD, cost[1] + ADD, cost[3] + ADD)
            cost[3] = min(cost[3], cost[2] + ADD)
            after = [c + DROP for c in cost]
            for q in STATES if fault != GONE else ():
                stays = cost[q] + (OPEN_END if fault == CUT else 0)
                if to[q] is not None:
                    after[to[q]] = min(after[to[q]], stays + KEEP)
                after[TURN_TO[q]] = min(after[TURN_TO[q]], stays + RENAME)
            cost = [min(c, FAR) for c in after]
        out += cost
    return out


def _row(code: str) -> tuple[int, tuple]:
    """Fault of a row, and where keeping it leads from each state."""
    initial, fault = divmod(ord(code) - 97, 3)
    return fault, tuple(KEPT_TO[q][initial] for q in STATES)


def search(codes: str, entry: int, goal: list[int] | None) -> tuple[str, int]:
    """The initials of the edits over the rows, and the state behind them.

    goal: what is still to pay in each state behind the last row; None at a conversation's end,
    where turns may also be inserted behind the last row.
    """
    rows, n = [_row(c) for c in codes], len(codes)
    ending, least = goal or AT_END, min(goal or AT_END)
    rest = [least] * (n + 1)  # a lower bound: what the faults alone cost
    for i in range(n - 1, -1, -1):
        fault, to = rows[i]
        lowest = DROP if fault == GONE else OPEN_END if fault == CUT else 0
        if fault != GONE and to == (None,) * 4:
            lowest = min(DROP, lowest + RENAME)
        rest[i] = rest[i + 1] + lowest
    failed: dict[tuple[int, int], int] = {}  # state: a proven lower bound of what is still to pay

    def bound(i: int, q: int) -> int:
        return max(failed.get((i, q), 0), rest[i] if i < n else ending[q])

    def edits(i: int, q: int) -> list[tuple[str, int, int, int]]:
        """(initial, cost, next row, next state) in ASCII order."""
        turn = ("I", ADD, i, TURN_TO[q])
        if i == n:
            return [turn] if goal is None else []
        fault, to = rows[i]
        found = [("D", DROP, i + 1, q), turn]
        if fault != GONE:
            stays = OPEN_END if fault == CUT else 0
            if to[q] is not None:  # renaming it would cost more and lead to the same state
                found.append(("K", KEEP + stays, i + 1, to[q]))
            else:
                found.append(("R", RENAME + stays, i + 1, TURN_TO[q]))
        return found

    limit = bound(0, entry)
    while True:
        path: list[str] = []
        stack = [(0, entry, limit, iter(edits(0, entry)))]
        while stack:
            i, q, left, more = stack[-1]
            if i == n and (q in (0, 3) if goal is None else goal[q] <= left):
                return "".join(path), q
            for letter, cost, j, to in more:
                if cost + bound(j, to) <= left:
                    path.append(letter)
                    stack.append((j, to, left - cost, iter(edits(j, to))))
                    break
            else:
                after = [cost + bound(j, to) for _, cost, j, to in edits(i, q)]
                failed[i, q] = max(bound(i, q), left + 1, min(after, default=FAR))
                stack.pop()
                if path:
                    path.pop()
        limit = bound(0, entry)


def left_before(cost: list[int], goal: list[int] | None) -> list[int]:
    """What is still to pay before a part, from its matrix and from what is to pay behind it."""
    ahead = goal or AT_END
    return [min(min(cost[4 * q + to] + ahead[to] for to in STATES), FAR) for q in STATES]


def solved(codes: str, entry: int, goal: list[int] | None) -> tuple[str, int]:
    """As ``search``, in runs of ``RUN`` rows: a search grows with the square of its rows."""
    runs = [codes[i : i + RUN] for i in range(0, len(codes), RUN)]
    goals = [goal]
    for run in reversed(runs[1:]):
        goals.append(left_before(matrix(run), goals[-1]))
    q, audit = entry, ""
    for run in runs:
        letters, q = search(run, q, goals.pop())
        audit += letters
    return audit, q


def _batches(rows: Iterator[list], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _mapped(df: DataFrame, schema: str, each) -> DataFrame:
    """Rows that ``each`` makes of a row's values, batch by batch."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (made for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True) for made in each(*row))
        yield from _batches(rows, out)

    return df.mapInArrow(run, schema)


def _marked(turns: DataFrame) -> DataFrame:
    """The rows without nulls in role and text, and the digest of both."""
    filled = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text"))
    return filled.withColumn("digest", F.unhex(F.sha2(both, 256)))


def ordered(turns: DataFrame) -> DataFrame:
    """The rows in their order (``place``) without their texts: fault, code and part of each.

    Text is not moved for it. Rows are dealt by range over (conv_id, turn, digest and a number of
    its own), so that one conversation or one repeated row is spread like any other rows.
    """
    initial = F.substring("role", 1, 1)
    rows = _marked(turns).select(
        F.col("conv_id").alias("conv"),
        "turn",
        "digest",
        initial.alias("initial"),
        F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)).alias("ending"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("known"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv", "turn", "digest", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "turns")
    # the first of equal rows, without ever bringing them together
    first = rows.filter("ending <> ''").groupBy("conv", "digest").agg(F.min("place").alias("place"))
    rows = rows.join(first.select("place", F.lit(True).alias("is_first")), "place", "left")
    ending = F.col("ending")
    fault = F.when(ending == "", 1).when(F.col("is_first").isNull(), 2).when(~ending.isin(".", "!", "?"), 3).otherwise(0)
    rows = rows.select("conv", "place", "turn", "digest", "initial", "known", fault.alias("fault"))
    code = F.expr("char(97 + 3 * known + IF(fault = 0, 0, IF(fault = 3, 2, 1)))")
    return rows.withColumns({"part": F.expr(f"shiftright(place, {PART_BITS})"), "code": code}).drop("known")


def decided(rows: DataFrame) -> DataFrame:
    """(conv, part, at, codes, audit, entry, last): the edits of every part of every conversation."""
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]), "")
    parts = rows.groupBy("conv", "part").agg(F.min("place").alias("at"), codes.alias("codes"))
    ends = rows.groupBy("conv").agg(F.min("part").alias("first_part"), F.max("part").alias("last_part")).withColumnRenamed("conv", "conv_")
    parts = stored(parts.join(ends, F.col("conv").eqNullSafe(F.col("conv_"))).drop("conv_"), "parts")

    def alone(at, codes):
        yield at, codes, solved(codes, 0, None)[0], 0, True

    answer = "at long, codes string, audit string, entry int, last boolean"
    whole = _mapped(parts.filter("first_part = last_part").select("at", "codes"), answer, alone)
    several = parts.filter("first_part < last_part")

    def costs(at, part, codes):
        yield at, part, matrix(codes)

    # a part begins at one place of one conversation: its place names it
    costed = _mapped(several.select("at", "part", "codes"), "at long, part long, cost array<long>", costs)
    costed = costed.join(several.select("conv", F.col("at").alias("at_")), F.expr("at = at_")).groupBy("conv")
    costed = costed.agg(F.array_sort(F.collect_list(F.struct("part", "at", "cost"))).alias("parts"))

    def goals(parts):
        goal = None
        for x in reversed(parts):
            yield x["at"], goal
            goal = left_before(x["cost"], goal)

    def tried(at, codes, goal):
        found = [solved(codes, q, goal) for q in STATES]
        yield at, [a for a, _ in found], [q for _, q in found], goal is None

    goal = _mapped(costed.select("parts"), "at_ long, goal array<long>", goals)
    paths = several.join(goal, F.expr("at = at_")).select("at", "codes", "goal")
    paths = stored(_mapped(paths, "at long, audits array<string>, exits array<int>, last boolean", tried), "paths")
    chains = paths.join(several.select("conv", "part", F.col("at").alias("at_")), F.expr("at = at_")).groupBy("conv")
    chains = chains.agg(F.array_sort(F.collect_list(F.struct("part", "at", "exits"))).alias("parts"))

    def chained(parts):
        q = 0
        for x in parts:
            yield x["at"], q
            q = x["exits"][q]

    entries = _mapped(chains.select("parts"), "at_ long, entry int", chained)
    chosen = paths.join(entries, F.expr("at = at_")).select("at", F.expr("audits[entry]").alias("audit"), "entry", "last")
    chosen = chosen.join(several.select(F.col("at").alias("at_"), "codes"), F.expr("at = at_"))
    return whole.select("at", "codes", "audit", "entry", "last").union(chosen.select("at", "codes", "audit", "entry", "last"))


def _steps(at: int, codes: str, audit: str, entry: int, last: bool):
    """For each row: the turns inserted before it, its edit and new role; behind the last also those after it."""
    q, i, before, n = entry, 0, "", len(codes)
    held = None
    for letter in audit:
        if letter == "I":
            q = TURN_TO[q]
            before += "u" if q == 2 else "a"
            continue
        if held:
            yield *held, ""
        to = None
        if letter == "K":
            q = _row(codes[i])[1][q]
        elif letter == "R":
            q = TURN_TO[q]
            to = USER if q == 2 else ASSISTANT
        held = (at + i, before, letter, to)
        i, before = i + 1, ""
    yield *held, before


def repair(turns: DataFrame) -> DataFrame:
    """One row per edit of every conversation of ``turns`` (conv_id, turn, role, text).

    ``place`` and ``step`` order the edits of a conversation. ``edit`` is its initial; ``role`` and
    ``text`` are those of the repaired row, null where it is deleted; ``turn``, ``initial`` and
    ``fault`` (blank, duplicate, truncated or empty) are the row's own, null for inserted ones.
    """
    rows = stored(ordered(turns), "order")
    steps = _mapped(decided(rows), "at long, before string, edit string, renamed string, after string", _steps)
    rows = rows.join(steps, F.expr("place = at"))
    added = f"transform(filter(split({{}}, ''), x -> x <> ''), x -> struct('I' AS edit, IF(x = 'u', '{USER}', '{ASSISTANT}') AS renamed))"
    edits = F.expr(f"concat({added.format('before')}, array(struct(edit, renamed)), {added.format('after')})")
    fault = F.expr("array('', 'blank', 'duplicate', 'truncated')[fault]").alias("fault")
    edits = rows.select("conv", "place", "turn", "initial", fault, "digest", F.posexplode(edits).alias("step", "e"))
    edits = edits.select("conv", "place", "step", "e.edit", "e.renamed", "turn", "initial", "fault", "digest")
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    turn = edits.schema["turn"].dataType
    inserted = edits.filter("edit = 'I'").select(
        "conv", "place", "step", "edit", F.col("renamed").alias("role"), F.lit("").alias("text"), *none(turn, "turn"), *none("string", "initial", "fault")
    )
    deleted = edits.filter("edit = 'D'").select("conv", "place", "step", "edit", *none("string", "role", "text"), "turn", "initial", "fault")
    # what stays is the first of its role and text: one text for each (conversation, turn, digest) is enough
    texts = _marked(turns).groupBy(F.col("conv_id").alias("conv_"), F.col("turn").alias("turn_"), F.col("digest").alias("digest_"))
    texts = texts.agg(F.first("role").alias("role"), F.first("text").alias("text"))
    same = F.col("conv").eqNullSafe(F.col("conv_")) & F.col("turn").eqNullSafe(F.col("turn_")) & (F.col("digest") == F.col("digest_"))
    stays = edits.filter("edit IN ('K', 'R')").join(texts, same).select(
        "conv", "place", "step", "edit", F.coalesce("renamed", "role").alias("role"), "text", "turn", "initial", "fault"
    )
    return stays.unionByName(deleted).unionByName(inserted).withColumnRenamed("conv", "conv_id")


def _summaries(key: pa.DataType):
    """Conversations read as a stream of edits in order: nothing but counts and hashes is held."""
    schema = pa.schema(
        [("conv", key), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("sha", pa.string())]
    )

    class Conversation:
        def __init__(self, conv):
            self.conv, self.letters, self.hash, self.lines = conv, [], hashlib.sha256(), 0
            self.first = self.last = self.before = None
            self.turns = self.illegal = self.cost = 0
            self.faults = dict.fromkeys(("", "blank", "duplicate", "truncated"), 0)

        def add(self, edit, role, text, turn, initial, fault):
            self.letters.append(edit)
            self.cost += {"K": KEEP, "R": RENAME, "D": DROP, "I": ADD}[edit] + (OPEN_END if fault == "truncated" and edit != "D" else 0)
            if edit != "D":
                self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
                self.lines += 1
            if edit == "I":
                return
            self.faults[fault] += 1
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1

        def row(self):
            gaps = self.last - self.first + 1 - self.turns if self.turns else 0
            f = self.faults
            return [self.conv, gaps, f["blank"], f["duplicate"], f["truncated"], self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held = None
        for b in batches:
            for conv, *edit in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if held is None or conv != held.conv:
                    if held:
                        yield held.row()
                    held = Conversation(conv)
                held.add(*edit)
        if held:
            yield held.row()

    return lambda batches: _batches(rows(batches), schema)


def audit_conversations(turns: DataFrame) -> DataFrame:
    """Damage, faults, cost, edits and repaired digest of every conversation of ``turns``.

    A conversation whose rows are all dropped has zeros, no edits and the digest of nothing. The
    digest of a conversation is one hash over its whole repaired text, so its edits pass through
    one task, in order and one at a time.
    """
    edits = repair(damaged(turns))
    kind = edits.schema["conv_id"].dataType
    stream = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = f"conv {kind.simpleString()}, {', '.join(f'{c} long' for c in counts)}, audit string, sha string"
    found = stream.select("conv_id", "edit", "role", "text", "turn", "initial", "fault").mapInArrow(_summaries(to_arrow_type(kind)), schema)
    every = turns.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
