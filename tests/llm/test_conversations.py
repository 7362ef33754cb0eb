import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from larderlake.llm import conversations as c
from larderlake.llm.queries import QUERIES, damaged


def kinds_of(rows):
    """Faults and letters of a conversation's rows (role, text), by the letter of the contract."""
    seen, faults, letters = set(), [], []
    for role, text in rows:
        shown = [x for x in text if x not in c.SPACES]
        if not shown:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif shown[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append(None)
        seen.add((role, text))
        letters.append(role[:1])
    return faults, letters


def brute_audit(faults, letters):
    """Cheapest edits by dynamic programming over all rows, ties by the letters themselves."""
    n = len(faults)
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {(n, ""): (0, ""), (n, "a"): (0, ""), (n, "u"): (5, "I"), (n, "s"): (10, "II")}
    for i in range(n - 1, -1, -1):
        moves = {}
        for q in ("", "s", "u", "a"):
            found = [(2 + best[i + 1, q][0], "D" + best[i + 1, q][1])]
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if letters[i] == due[q] or (q == "" and letters[i] == "s"):
                    cost, rest = best[i + 1, letters[i]]
                    found.append((more + cost, "K" + rest))
                cost, rest = best[i + 1, due[q]]
                found.append((more + 1 + cost, "R" + rest))
            moves[q] = min(found)
        for q in moves:
            once, twice = moves[due[q]], moves[due[due[q]]]
            best[i, q] = min(moves[q], (5 + once[0], "I" + once[1]), (10 + twice[0], "II" + twice[1]))
    return best[0, ""]


def brute(rows):
    """One conversation's row of the result; rows are (turn, role, text) in order."""
    faults, letters = kinds_of([r[1:] for r in rows])
    cost, audit = brute_audit(faults, letters)
    turns = [r[0] for r in rows if r[0] is not None]
    out, state, i = [], "", 0
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    for letter in audit:
        if letter == "I":
            state = due[state]
            out.append(({"u": "user", "a": "assistant"}[state], ""))
            continue
        _, role, text = rows[i]
        i += 1
        if letter == "R":
            state = due[state]
            out.append(({"u": "user", "a": "assistant"}[state], text))
        elif letter == "K":
            state = role[:1]
            out.append((role, text))
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


def result(df, conv="conv_id"):
    names = [*c.PLAN, "audit", "repaired_sha256"]
    return {r[conv]: tuple(r[n] for n in names) for r in df.collect()}


def shuffled(conversations):
    rows = [(k, *r) for k, rows in conversations.items() for r in rows]
    random.Random(5).shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 6])
def test_search_finds_the_cheapest_and_least_edits(length):
    rng = random.Random(length)
    every = ["".join(k) for k in itertools.product("dsuaxSUAX", repeat=min(length, 3))]
    tried = every if length <= 3 else ["".join(rng.choices("dsuuuaaaxSUAX", k=length)) for _ in range(400)]
    for kinds in tried:
        faults = ["blank" if k == "d" else "truncated" if k.isupper() else None for k in kinds]
        assert c.cheapest(kinds, c.NOTHING, c.SOUND_ENDS, True) == brute_audit(faults, [k.lower() for k in kinds])


def test_bounds_never_exceed_costs():
    rng = random.Random(1)
    for _ in range(300):
        kinds = "".join(rng.choices("dsuaxSUAX", k=rng.randrange(1, 9)))
        for (start, stop), (cost, _) in c.ways(kinds).items():
            end = {c.USER: "a", c.ASSISTANT: "u"}.get(stop, "")
            assert c.least_costs(kinds, end)[0][0] - (start == c.NOTHING) <= cost


def brute_way(kinds, start, stop):
    """All edits of a piece, tried one by one; at most two insertions before a turn."""
    found = []

    def go(i, q, cost, audit, inserted):
        if i == len(kinds):
            if q == stop and not inserted:
                found.append((cost, audit))
            return
        if inserted < 2:
            go(i, c.DUE[q], cost + 5, audit + "I", inserted + 1)
        go(i + 1, q, cost + 2, audit + "D", 0)
        more = 5 * kinds[i].isupper()
        if kinds[i] != "d":
            letter = {"s": c.SYSTEM, "u": c.USER, "a": c.ASSISTANT}.get(kinds[i].lower())
            if letter == c.DUE[q] or (letter == c.SYSTEM and q == c.NOTHING):
                go(i + 1, letter, cost + more, audit + "K", 0)
            go(i + 1, c.DUE[q], cost + more + 1, audit + "R", 0)

    go(0, start, 0, "", 0)
    return min(found, default=None)


def test_pieces_between_any_two_states():
    rng = random.Random(2)
    for _ in range(250):
        kinds = "".join(rng.choices("dsuuaaxSUA", k=rng.randrange(1, 5)))
        found = c.ways(kinds)
        for start, stop in itertools.product(range(4), repeat=2):
            assert found.get((start, stop)) == brute_way(kinds, start, stop), (kinds, start, stop)


@pytest.mark.parametrize("size", [1, 2, 7, c.PIECE, c.PIECE + 1, 700])
def test_pieces_fold_to_the_same_edits(size):
    rng = random.Random(size)
    for _ in range(6):
        rows = [(rng.choice("suuaaax"), rng.choice(["a.", "b.", "c", "d!", " ", "e?"]) + str(rng.randrange(9)) + ".") for _ in range(size)]
        faults, letters = kinds_of(rows)
        part = c._Part()
        for i, (fault, letter) in enumerate(zip(faults, letters)):
            part.add(i, letter, 1, fault not in ("blank", "duplicate"), fault == "blank", fault == "truncated")
        assert part.answer() == brute_audit(faults, letters)
        assert c.ended(part.between()) == brute_audit(faults, letters)


def test_conversations_that_span_tasks(spark):
    rng = random.Random(3)
    made = {}
    for k, size in enumerate([1500, 1, 2, 3, 40, 0, 900]):
        made[k] = [
            (t + 2 * (t > 5), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["Yes.", "No", "", f"t{t}.", f"{t}"]))
            for t in range(size)
        ]
    made = {k: rows for k, rows in made.items() if rows}
    rows = spark.createDataFrame(shuffled(made), SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plans = c.plan_repairs(rows)
        found = result(c.repaired_digests(rows, plans))
        repaired = c.apply_repairs(rows, plans).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found == {k: brute(rows)[0] for k, rows in made.items()}
    for k, rows in made.items():
        mine = sorted((r for r in repaired if r.conv_id == k), key=lambda r: r.place)
        assert [(r.role, r.text) for r in mine] == brute(rows)[1]


def test_equal_rows_nulls_and_empty_tables(spark):
    made = {
        1: [(None, "user", "Hi."), (0, "user", "Hi."), (0, "user", "Hi."), (1, "assistant", "Yes.")],
        2: [(3, "assistant", "x" * 300_000), (4, "é", "a.")],
        3: [(None, " ", " ")],
        None: [(7, "user", "Who?"), (9, "assistant", "Me!")],
    }
    rows = spark.createDataFrame(shuffled(made), SCHEMA).withColumn("conv", F.lit("x")).withColumn("plan", F.lit(3))
    nulls = rows.withColumn("text", F.nullif("text", F.lit(" "))).withColumn("role", F.nullif("role", F.lit(" ")))
    for table in (rows, nulls):
        plans = c.plan_repairs(table)
        assert result(c.repaired_digests(table, plans)) == {k: brute(r)[0] for k, r in made.items()}
    none = rows.limit(0)
    assert c.repaired_digests(none, c.plan_repairs(none)).count() == 0
    assert c.apply_repairs(none, c.plan_repairs(none)).count() == 0


def test_query_returns_every_conversation(spark, tmp_path):
    rows = [(k, t, "user", "Yes.") for k in (1, 2, None) for t in (0, 1, 2, None)] + [(k, 0, None, None) for k in range(10, 60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = result(QUERIES["op11_conversation_repair"](spark, str(tmp_path)))
    left = {}
    for r in damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect():
        left.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    assert set(found) == {r[0] for r in rows} > set(left)
    for k in found:
        assert found[k] == brute(sorted(left.get(k, []), key=lambda r: (r[0] is not None, r[0] or 0)))[0]
