"""Repair of conversations by the cheapest edits, found by iterative-deepening A*.

A sound conversation is ``(s?(ua)+)?`` over the first letters of its roles: an optional system turn,
then pairs of a user's and an assistant's turn. Every turn is kept (0), given the role that is due
(1) or deleted (2); empty turns of the role that is due can be put anywhere (5). Blank turns and
turns whose role and text came before must be deleted; a truncated turn that stays adds 5. Of the
cheapest edits the ASCII-least letters D, I, K, R win.

Turns without their texts go through the search. They are range partitioned in the order of their
conversation, so that a conversation of any length is spread over tasks: a task folds its pieces,
and what it knows of a conversation that goes on elsewhere is the cheapest edits between each two
states, which fold again in order. Texts move once, to be edited in the order of their conversation;
that last step streams and holds one audit, never a conversation.

Nulls: a null role or text counts as one space, a null turn comes first and leaves no gap, rows with
a null conversation are one conversation. Rows of one turn are taken by role, then by a hash of the
text; equal rows are adjacent. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from larderlake.llm.tables import column, keep

# --- fixed values: what the edits cost --------------------------------------------------------------
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# --------------------------------------------------------------------------------------------------

#: Turns searched at once; longer conversations are folded from such pieces.
PIECE = 32
#: ASCII white space.
SPACES = " \t\n\x0b\f\r"
#: Rows of a result batch.
BATCH = 4096
#: Letters of text in a result batch after which it is sent.
BATCH_TEXT = 1 << 22

#: What came last: nothing, a system turn, a user's turn, an assistant's turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn of the role that is due.
DUE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SOUND_ENDS = (NOTHING, ASSISTANT)
#: Pairs of states that edits can lead through.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]

#: (cost, audit) by the states before and after.
Ways = dict[tuple[int, int], tuple[int, str]]


def _kept(kind: str, state: int) -> int | None:
    """The state after a turn is kept, if it may be."""
    if kind == "s":
        return SYSTEM if state == NOTHING else None
    if kind == "u":
        return None if state == USER else USER
    return ASSISTANT if kind == "a" and state == USER else None


def _alone(kind: str) -> int:
    """What a turn costs at least, not as a conversation's beginning."""
    return DELETE if kind == "d" or kind.isupper() else 0 if kind in "ua" else REROLE


def least_costs(kinds: str, end: str) -> tuple[list[int], list[int]]:
    """A lower bound for what each rest of the turns costs after others, and the next turn that may stay.

    Every turn alone, and neighbours of one role, of which not both can stay as they are; ``end`` is
    the letter that what follows may not meet, as if it were a turn.
    """
    n = len(kinds)
    low, follows = [0] * (n + 1), [n] * (n + 1)
    letters = kinds + end
    for i in range(n - 1, -1, -1):
        low[i], k = _alone(kinds[i]) + low[i + 1], follows[i + 1]
        follows[i] = k if kinds[i] == "d" else i
        if kinds[i] in "ua" and k < len(letters) and letters[k] == kinds[i]:
            low[i] = max(low[i], REROLE + DELETE * (k - i - 1) + low[min(k + 1, n)])
    return low, follows


@lru_cache(maxsize=1 << 16)
def cheapest(kinds: str, start: int, goals: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """Least cost and its ASCII-least edits that lead from a state through all turns to a goal.

    ``kinds`` has a letter for each turn: d must be deleted, s, u, a by role, x for other roles, in
    upper case if truncated. Only the ``last`` piece may end with insertions. Depth-first search in
    ASCII order within a bound that grows to the least cost seen beyond it; states that failed with
    as much left to spend are not tried again. The first path that is accepted is the answer.
    """
    n = len(kinds)
    # What ends in a user's turn has no assistant's turn last, and the other way round.
    end = {(USER,): "a", (ASSISTANT,): "u"}.get(goals, "")
    low, follows = least_costs(kinds, end)
    most = DELETE * n + 3 * INSERT  # deleting all turns and inserting what is due costs less
    systems = [False] * (n + 1)
    for i in range(n - 1, -1, -1):
        systems[i] = systems[i + 1] or kinds[i] in "sS"

    def rest(i: int, state: int) -> int:
        """A lower bound for the rest of a path."""
        if i == n:
            if state in goals:
                return 0
            return (INSERT if state == USER else 2 * INSERT) if last else most + 1
        if goals in ((NOTHING,), (SYSTEM,)):
            # Nothing may stay but one system turn.
            if state == goals[0]:
                return DELETE * (n - i)
            return DELETE * (n - i - 1) if state == NOTHING and systems[i] else most + 1
        if state == NOTHING:
            return low[i] - REROLE if systems[i] and low[i] else low[i]
        k = follows[i]
        if k < n and kinds[k] == ("u" if state == USER else "a"):
            if state != SYSTEM or kinds[k] == "a":
                return max(low[i], REROLE + DELETE * (k - i) + low[k + 1])
        return low[i]

    def edits(i: int, state: int):
        due = DUE[state]
        if i == n:
            if last:
                yield "I", INSERT, i, due
            return
        kind = kinds[i]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, due
        if kind == "d":
            return
        more = TRUNCATED if kind.isupper() else 0
        after = _kept(kind.lower(), state)
        if after is not None:
            yield "K", more, i + 1, after
        yield "R", REROLE + more, i + 1, due

    def search(i: int, state: int, left: int) -> str | None:
        nonlocal beyond
        if i == n and state in goals:
            return ""
        if failed.get((i, state), -1) >= left:
            return None
        for letter, cost, j, after in edits(i, state):
            need = cost + rest(j, after)
            if need > left:
                beyond = min(beyond, bound - left + need)
                continue
            found = search(j, after, left - cost)
            if found is not None:
                return letter + found
        failed[i, state] = left
        return None

    bound = max(0, rest(0, start))
    while bound <= most:
        beyond, failed = most + 1, {}
        audit = search(0, start, bound)
        if audit is not None:
            return bound, audit
        bound = beyond
    return None


def ways(kinds: str) -> Ways:
    """The cheapest edits of a piece between each two states."""
    found = {pair: cheapest(kinds, pair[0], (pair[1],), False) for pair in PAIRS}
    return {pair: way for pair, way in found.items() if way is not None}


def joined(first: Ways, second: Ways) -> Ways:
    """The cheapest edits of two pieces in a row; ties fall to the ASCII-least."""
    out: Ways = {}
    for (start, middle), (cost, audit) in first.items():
        for (begin, end), (more, rest) in second.items():
            if begin == middle:
                way = (cost + more, audit + rest)
                if (start, end) not in out or way < out[start, end]:
                    out[start, end] = way
    return out


def ended(found: Ways) -> tuple[int, str]:
    """The cheapest edits of a whole conversation, missing turns inserted at its end."""
    tail = {NOTHING: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
    return min(
        (cost + tail[end] * INSERT, audit + "I" * tail[end]) for (start, end), (cost, audit) in found.items() if start == NOTHING
    )


class _Part:
    """What a task knows of one conversation: counts, borders, and the edits of its turns so far."""

    FIELDS = ("low", "high", "turns", "rows", "first", "last", "blank", "duplicate", "truncated", "illegal")

    def __init__(self):
        self.low = self.high = self.first = self.last = None
        self.turns = self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.kinds = ""
        self.folded: list[tuple[int, Ways]] = []  # by doubling number of pieces, so that strings are joined rarely

    def add(self, turn, initial: str, copies: int, fresh: bool, blank: bool, truncated: bool) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.rows:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last, self.rows = initial, self.rows + copies
        self.illegal += copies - 1
        stays = 0
        if blank:
            self.blank += copies
        else:
            stays = int(fresh)
            self.duplicate += copies - stays
            self.truncated += bool(stays and truncated)
        if stays:
            kind = initial if initial in ("s", "u", "a") else "x"
            self.kinds += kind.upper() if truncated else kind
        copies -= stays
        while copies:
            step = min(copies, PIECE)
            self.kinds, copies = self.kinds + "d" * step, copies - step
            self._cut()
        self._cut()

    def _cut(self) -> None:
        while len(self.kinds) > PIECE:
            self.fold(1, ways(self.kinds[:PIECE]))
            self.kinds = self.kinds[PIECE:]

    def fold(self, size: int, found: Ways) -> None:
        while self.folded and self.folded[-1][0] <= size:
            before, other = self.folded.pop()
            size, found = size + before, joined(other, found)
        self.folded.append((size, found))

    def between(self) -> Ways:
        """Edits between each two states over all turns."""
        if self.kinds:
            self.fold(1, ways(self.kinds))
            self.kinds = ""
        found = self.folded[-1][1]
        for _, other in reversed(self.folded[:-1]):
            found = joined(other, found)
        return found

    def answer(self) -> tuple[int, str]:
        if not self.folded:
            return cheapest(self.kinds, NOTHING, SOUND_ENDS, True)
        return ended(self.between())

    def merge(self, other: dict, found: Ways) -> None:
        """Append the next part of the same conversation."""
        if other["low"] is not None:
            self.turns += other["turns"] - (other["low"] == self.high)
            self.low = other["low"] if self.low is None else self.low
            self.high = other["high"]
        if self.rows:
            self.illegal += self.last + other["first"] not in ("su", "ua", "au")
        else:
            self.first = other["first"]
        self.last = other["last"]
        for name in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + other[name])
        self.fold(len(next(iter(found.values()))[1]) + 1, found)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


#: What is told of every conversation, before its audit.
PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN = f"{', '.join(f'{name} long' for name in PLAN)}, audit string"
_BORDER = "turn long, role string, digest binary, low long, high long, turns long, rows long, first string, last string"
_WAYS = "ways array<struct<start:int,stop:int,cost:bigint,audit:string>>"


def _plan(part: _Part) -> dict:
    cost, audit = part.answer()
    faults = {name: getattr(part, name) for name in PLAN[1:-1]}
    return {"gaps": part.gaps(), **faults, "cost": cost, "audit": audit}


def _schema(conv: DataType, ddl: str) -> StructType:
    return StructType([StructField("conv", conv), *DataType.fromDDL(ddl).fields])


def _batch(rows: list[dict], schema: StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def _light(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversation, turn, role, text, and a digest of the text."""
    words = F.coalesce(column(rows, text, "string"), F.lit(" "))
    return rows.select(
        rows[f"`{conv}`"].alias("conv"),
        column(rows, turn, "long").alias("turn"),
        F.coalesce(column(rows, role, "string"), F.lit(" ")).alias("role"),
        F.unhex(F.sha2(words, 256)).alias("digest"),
        words.alias("text"),
    )


def _turns(rows: DataFrame) -> DataFrame:
    """A row per different turn: how often it stands there, and whether its role and text are new."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    facts = rows.select(
        "conv", "turn", "role", "digest", (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut")
    )
    found = keep(facts.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    # Only what stands in several turns needs to know its first one.
    again = found.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.count("*").alias("places"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none")
    )
    again = again.where("places > 1")
    same = found["conv"].eqNullSafe(again["c"]) & (found["role"] == again["r"]) & (found["digest"] == again["d"])
    first = F.col("places").isNull() | F.when(F.col("none"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    return found.join(again, same, "left").select(
        "conv", "turn", "role", "digest", "copies", first.alias("fresh"), "blank", "cut"
    )


def plan_repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``gaps`` counts turn numbers missing between the least and the largest, the next three the first
    fault of each row, ``illegal`` adjacent roles that may not follow each other, all before the
    repair. ``audit`` has a letter for each edit in order: Delete, Insert, Keep, Rerole.
    """
    light = _light(rows, conv, turn, role, text)
    kind = light.schema["conv"].dataType
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest"]
    found = keep(_turns(light), "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _schema(kind, f"{_PLAN}, {_BORDER}, {_WAYS}")
    parts = keep(found.mapInArrow(lambda batches: _parts(batches, schema), schema), "parts")
    names = [F.col("conv").alias(conv), *PLAN, "audit"]
    folded = _schema(kind, _PLAN)
    cut = parts.where("ways is not null").groupBy("conv").applyInArrow(lambda table: _fold(table, folded), folded)
    return parts.where("ways is null").select(*names).unionByName(cut.select(*names))


def _parts(batches: Iterator[pa.RecordBatch], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Conversations that lie inside the task are answered; its first and last may go on elsewhere."""
    part = name = begin = None
    first, out = True, []

    def border() -> dict:
        # Where this part of the conversation begins orders the parts.
        found = [{"start": s, "stop": t, "cost": c, "audit": a} for (s, t), (c, a) in part.between().items()]
        return {"conv": name, **begin, "ways": found, **{f: getattr(part, f) for f in _Part.FIELDS}}

    for rows in batches:
        columns = [rows.column(i).to_pylist() for i in range(rows.num_columns)]
        for conv, turn, role, digest, copies, fresh, blank, cut in zip(*columns):
            if part is None or conv != name:
                if part is not None:
                    out.append(border() if first else {"conv": name, **_plan(part)})
                    first = False
                    if len(out) >= BATCH:
                        yield _batch(out, schema)
                        out.clear()
                part, name, begin = _Part(), conv, {"turn": turn, "role": role, "digest": digest}
            part.add(turn, role[:1], copies, fresh, blank, cut)
    if part is not None:
        out.append(border())
        yield _batch(out, schema)


def _fold(table: pa.Table, schema: StructType) -> pa.Table:
    """Parts of one conversation, in order, become its plan."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"].encode(), r["digest"]))
    part = _Part()
    for row in rows:
        part.merge(row, {(w["start"], w["stop"]): (w["cost"], w["audit"]) for w in row["ways"]})
    return pa.Table.from_batches([_batch([{"conv": rows[0]["conv"], **_plan(part)}], schema)])


def _in_order(rows: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every conversation's plan, then its rows in order, within one partition."""
    light = _light(rows, conv, turn, role, text).withColumn("plan", F.lit(1))
    plan = plans.select(F.col(f"`{conv}`").alias("conv"), F.lit(0).alias("plan"), *PLAN, "audit")
    both = light.unionByName(plan, allowMissingColumns=True).repartition("conv")
    order = both.sortWithinPartitions("conv", "plan", F.asc_nulls_first("turn"), "role", "digest")
    return order.select("conv", "plan", "turn", "role", "text", "audit", *PLAN)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(plan, None) when a conversation begins, then (plan, (letter, turn, role, text)) for each turn that results."""
    plan, audit, at, state = None, "", 0, NOTHING

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, DUE[state]
            yield plan, ("I", None, ROLE[state], "")

    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for i, is_row in enumerate(columns["plan"]):
            if not is_row:
                yield from inserted()
                plan = {name: columns[name][i] for name in ("conv", *PLAN, "audit")}
                audit, at, state = plan["audit"], 0, NOTHING
                yield plan, None
                continue
            yield from inserted()
            letter, at = audit[at], at + 1
            if letter == "D":
                continue
            role = columns["role"][i]
            if letter == "R":
                state = DUE[state]
                role = ROLE[state]
            else:
                state = _kept(role[:1], state)
            yield plan, (letter, columns["turn"][i], role, columns["text"][i])
    if plan is not None:
        yield from inserted()


def apply_repairs(
    rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, place, edit, turn, role, text): the repaired conversations, places from 0; inserted turns have a null turn."""
    ordered = _in_order(rows, plans, conv, turn, role, text)
    schema = _schema(ordered.schema["conv"].dataType, "place long, edit string, turn long, role string, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for plan, edited in _edited(batches):
            if edited is None:
                place = 0
                continue
            out.append({"conv": plan["conv"], "place": place, **dict(zip(("edit", "turn", "role", "text"), edited))})
            place, size = place + 1, size + len(edited[3])
            if len(out) >= BATCH or size > BATCH_TEXT:
                yield _batch(out, schema)
                out, size = [], 0
        yield _batch(out, schema)

    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def repaired_digests(
    rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The plans with ``repaired_sha256``: hash of the repaired ``role:text``, joined by line ends.

    A hash over a whole conversation is one sequential computation; it streams.
    """
    ordered = _in_order(rows, plans, conv, turn, role, text)
    schema = _schema(ordered.schema["conv"].dataType, f"{_PLAN}, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current, hashed, place = [], None, None, 0
        for plan, edited in _edited(batches):
            if edited is None:
                if current:
                    out.append({**current, "repaired_sha256": hashed.hexdigest()})
                if len(out) >= BATCH:
                    yield _batch(out, schema)
                    out = []
                current, hashed, place = plan, hashlib.sha256(), 0
                continue
            _, _, role, words = edited
            hashed.update(f"{chr(10) if place else ''}{role}:{words}".encode())
            place += 1
        if current:
            out.append({**current, "repaired_sha256": hashed.hexdigest()})
        yield _batch(out, schema)

    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", conv)
