"""Turn repair against a plain dynamic program over whole edit strings."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tapeglass.llm import queries, turn_repair
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.01"
STRIPPED = "\x20\x09\x0a\x0b\x0c\x0d"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_plan(rows, costs=(1, 2, 5, 5)):
    """The plan of (turn, role, text) rows in order; every state keeps its cheapest whole edits and text."""
    rerole, delete, insert, stay = costs
    turns = [t for t, *_ in rows if t is not None]
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    seen, faults = set(), []
    for _, role, text in rows:
        cut = text.rstrip(STRIPPED)
        fault = "blank" if not cut else "duplicate" if (role, text) in seen else None if cut[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(states):
        made = dict(states)
        for _ in range(2):
            for state, (cost, audit, lines) in list(made.items()):
                to = following[state]
                option = (cost + insert, audit + "I", (*lines, names[to] + ":"))
                if to not in made or option[:2] < made[to][:2]:
                    made[to] = option
        return made

    states = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def offer(to, option):
            if to not in after or option[:2] < after[to][:2]:
                after[to] = option

        for state, (cost, audit, lines) in inserted(states).items():
            offer(state, (cost + delete, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more, to = stay if fault else 0, following[state]
            offer(to, (cost + rerole + more, audit + "R", (*lines, f"{names[to]}:{text}")))
            if role[:1] == to:
                offer(to, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            if state == "" and role[:1] == "s":
                offer("s", (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        states = after
    # Edits of equal cost are compared whole, so the least of all states' options before the first turn matters too.
    cost, audit, lines = min(option for state, option in inserted(states).items() if state in ("", "a"))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return {"gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": text}


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()


def plain_damage(rows):
    """(conv_id, turn, role, text) rows with their faults, by conversation, in order."""
    made = {}
    for conv, turn, role, text in rows:
        own = made.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif fault == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {conv: sorted(own, key=order) for conv, own in made.items()}


def plans(df):
    return {r["conv_id"]: {f: r[f] for f in FIELDS} for r in df.collect()}


def test_query(spark):
    rows = connect(SF_DIR).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    found = plans(queries.queries()["op12_turn_repair"](spark, SF_DIR))
    assert found == {conv: plain_plan(own) for conv, own in plain_damage(rows).items()}
    assert sum(p["cost"] for p in found.values()) > 20


EDGES = [
    (1, None, "user", "Hello."), (1, None, None, None), (1, 5, "assistant", "x" * 200_000 + "."), (1, 2, "", "Nameless."), (2, 0, "system", "Only."),
    (None, 3, "user", "No key."), (None, 4, "assistant", "None!"), (3, 0, "user", "  \n\t "), (4, 0, "User", "Big."), (4, 0, "robot", "Tie?"),
    (5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 9, "assistant", "Größe 数! "), (6, 2, "assistant", "cut"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = spark.createDataFrame(EDGES, "conv_id long, turn long, role string, text string")
    return rows.withColumns({name: F.lit("x") for name in ("conv", "kind", "digest", "copy", "fault", "chunk", "state", "said")})


def sorted_conversations(rows):
    made = {}
    for conv, turn, role, text in rows:
        made.setdefault(conv, []).append((turn, *(" " if v is None else v for v in (role, text))))
    return {conv: sorted(own, key=order) for conv, own in made.items()}


def test_edges(spark, edges):
    expected = {conv: plain_plan(own) for conv, own in sorted_conversations(EDGES).items()}
    assert plans(turn_repair.repair_plans(edges)) == expected
    none = edges.where("1 = 0")
    assert plans(turn_repair.repair_plans(none)) == {}
    empty = dict.fromkeys(FIELDS[:6], 0) | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    known = spark.createDataFrame([(7,), (7,), (1,), (None,)], "conv_id long")
    assert plans(turn_repair.repair_plans(edges, known)) == expected | {7: empty}
    assert plans(turn_repair.repair_plans(none, known)) == {7: empty, 1: empty, None: empty}
    assert plans(turn_repair.repair_plans(turn_repair.damaged(edges), edges)) == {conv: plain_plan(own) for conv, own in plain_damage(EDGES).items()}


def random_turns(seed, conversations):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "", "Why?", "x y.", "maybe"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(texts) if rng.random() < 0.6 else f"Text {turn}."))
    return rows


@pytest.mark.parametrize("costs", [(1, 2, 5, 5), (3, 4, 1, 1), (1, 1, 1, 1), (2, 2, 2, 6), (9, 1, 2, 0)])
def test_any_costs(spark, costs):
    rows = random_turns(sum(costs), 150)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    expected = {conv: plain_plan(own, costs) for conv, own in sorted_conversations(rows).items()}
    assert plans(turn_repair.repair_plans(turns, costs=turn_repair.Costs(*costs))) == expected


def test_giant_conversations_spill(spark):
    """Back pointers in chunks of seven turns give what whole conversations give, and so do the repaired turns."""
    rows = random_turns(5, 40) + [(99, t, random.Random(t).choice(["user", "assistant", "system"]), f"Line {t}" + "." * (t % 3 > 0)) for t in range(500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    made = turn_repair.repair_plans(turns, chunk=7)
    expected = {conv: plain_plan(own) for conv, own in sorted_conversations(rows).items()}
    assert plans(made) == expected
    repaired = {}
    for r in turn_repair.repaired_turns(turns, made).collect():
        repaired.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"]))
    for conv, plan in expected.items():
        own = sorted(repaired.get(conv, []))
        assert [place for place, *_ in own] == list(range(len(own)))
        text = "\n".join(f"{role}:{text}" for _, role, text, _ in own)
        assert hashlib.sha256(text.encode()).hexdigest() == plan["repaired_sha256"]
        assert "".join(edit for *_, edit in own) == plan["audit"].replace("D", "")


def test_values_of_the_program_stay_few():
    program = turn_repair.Program(turn_repair.Costs())
    value, rng = program.first, random.Random(1)
    for _ in range(20_000):
        value = program.step(value, rng.choice("suax"), rng.randint(0, 3))[0]
    assert len(program.known) < 2000
