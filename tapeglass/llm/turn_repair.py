"""Repair of the order of roles in conversations by cheapest edits.

A repaired conversation is empty, or an optional system turn and then pairs of a user and an assistant turn. Edits keep
a turn, change its role, delete it, or insert an empty one; blank and repeated turns must go, cut ones cost more if
they stay. Turns are dealt by conversation and sorted by turn, and one pass of mapInPandas carries the state of the
dynamic program over Arrow batches: for each state of the pattern the least cost, the rank of its edits among equally
cheap ones, a running hash of the repaired text, and per turn four bytes that say where each state came from. So a
conversation of any length takes the same memory but for those bytes; each full chunk of them is spilled as a row of
the output, which is staged in the shared folder, and a second pass walks the chunks of such conversations backwards.

Whether a text stood earlier in its conversation is not kept in memory either: the first turn of every (conversation,
role, text) is found by an aggregation, folded before its shuffle, and comes as a mark right before that turn.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.llm.common import staged

#: Turns whose back pointers a task holds.
CHUNK = 1 << 20
#: What counts as no character of a text.
SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED, SOUND = 1, 2, 3, 0
#: States: nothing given out, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What an inserted turn, or one with a new role, makes of a state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FINAL = (START, ASSISTANT)
EDITS = "DKR"
KNOWN, MARK, TURN = 0, 1, 2


@dataclass(frozen=True)
class Costs:
    """What edits cost; they must be positive but for keeping, which is free."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    stay_truncated: int = 5


class Program:
    """The dynamic program over turns. Values are per state (cost, rank) or None; equal ones are worked out once.

    Edits so far of two states never are a prefix of one another, since both end with the same turn, so ranks order all
    that can follow. A state that the assistant state can stand in for at less cost is dropped, which keeps the
    differences, and with them the number of distinct values, bounded.
    """

    def __init__(self, costs: Costs):
        self.costs = costs
        self.known: dict[tuple, tuple] = {}
        self.first = ((0, 0), None, None, None)

    def step(self, value: tuple, initial: str, fault: int) -> tuple:
        """(value after the turn, cost added to all of it, origins by state, packed origins)."""
        key = (value, initial if initial in ("s", "u", "a") else "", fault)
        if key not in self.known:
            self.known[key] = self._step(*key)
        return self.known[key]

    def _step(self, value: tuple, initial: str, fault: int) -> tuple:
        costs = self.costs
        must_go, extra = fault in (BLANK, DUPLICATE), costs.stay_truncated if fault == TRUNCATED else 0
        found: dict[int, list] = {}
        for state, held in enumerate(value):
            if held is None:
                continue
            at, spent = state, held[0]
            # Two insertions pass through all states that insertions reach.
            for inserted in range(3):
                before = "I" * inserted
                options = [(at, "D", costs.delete)]
                if not must_go:
                    if at == START and initial == "s":
                        options.append((SYSTEM, "K", extra))
                    if initial == "ua"[NEXT[at] - USER]:
                        options.append((NEXT[at], "K", extra))
                    options.append((NEXT[at], "R", costs.rerole + extra))
                for to, edit, cost in options:
                    found.setdefault(to, []).append((spent + cost, held[1], before + edit, state, inserted))
                at, spent = NEXT[at], spent + costs.insert
        best = {to: min(options) for to, options in found.items()}
        if ASSISTANT in best:
            limit = best[ASSISTANT][0]
            for to, slack in ((START, costs.delete), (SYSTEM, 0)):
                if to in best and best[to][0] > limit + slack:
                    del best[to]
        least = min(option[0] for option in best.values())
        ranks = {to: rank for rank, (_, to) in enumerate(sorted((option[1:3], to) for to, option in best.items()))}
        after = tuple((best[to][0] - least, ranks[to]) if to in best else None for to in range(4))
        origins = tuple((best[to][3], best[to][4], best[to][2][-1]) if to in best else None for to in range(4))
        packed = sum((origin[0] | origin[1] << 2 | EDITS.index(origin[2]) << 4) << (8 * to) for to, origin in enumerate(origins) if origin)
        return after, least, origins, packed

    def end(self, value: tuple) -> tuple[int, int, int]:
        """(cost, state, insertions behind the last turn) of the cheapest way to end."""
        options = []
        for state, held in enumerate(value):
            at, spent = state, held[0] if held else 0
            for inserted in range(3 if held else 0):
                if at in FINAL:
                    options.append((spent, held[1], inserted, state))
                at, spent = NEXT[at], spent + self.costs.insert
        cost, _, inserted, state = min(options)
        return cost, state, inserted


def edits_of(packed: array, state: int) -> tuple[str, int]:
    """The edits of a chunk of turns whose last one ends in `state`, and the state before its first."""
    parts = []
    for origins in reversed(packed):
        own = origins >> (8 * state) & 0xFF
        parts.append("I" * (own >> 2 & 3) + EDITS[own >> 4])
        state = own & 3
    parts.reverse()
    return "".join(parts), state


class Conversation:
    """Counts, program state and hashes of the conversation that a task is in."""

    def __init__(self, program: Program):
        self.program, self.value, self.cost = program, program.first, 0
        self.hashes = {START: hashlib.sha256()}
        self.packed, self.chunks = array("I"), 0
        self.low = self.high = self.last_turn = self.last_initial = None
        self.turns = self.illegal = self.rows = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn: str | None, role: str, text: str, first: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.low = int(turn) if self.low is None else self.low
            self.high, self.turns, self.last_turn = int(turn), self.turns + 1, turn
        initial = role[:1]
        if self.rows and (self.last_initial + initial) not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial, self.rows = initial, self.rows + 1
        fault = _fault(text, first)
        self.faults[fault] += 1
        self.value, added, origins, packed = self.program.step(self.value, initial, fault)
        self.cost += added
        self.packed.append(packed)
        self._hash(origins, role, text)

    def _hash(self, origins: tuple, role: str, text: str) -> None:
        made, kept = {}, None
        for to, origin in enumerate(origins):
            if origin is None:
                continue
            state, inserted, edit = origin
            if edit == "D" and not inserted:
                made[to] = self.hashes[state]  # shared with nothing that changes: changed ones are copies
                continue
            own = self.hashes[state].copy()
            at = _insert(own, state, inserted)
            if edit != "D":
                kept = kept or f":{text}".encode()
                own.update(b"" if at == START else b"\n")
                own.update((role if edit == "K" else ROLES[NEXT[at]]).encode())
                own.update(kept)
            made[to] = own
        self.hashes = made

    def chunk(self) -> bytes:
        """The back pointers held, which go."""
        packed, self.packed, self.chunks = zlib.compress(self.packed.tobytes(), 1), array("I"), self.chunks + 1
        return packed

    def end(self) -> dict:
        """The conversation's row; `audit` only if no chunk was spilled."""
        cost, state, inserted = self.program.end(self.value)
        own = self.hashes[state].copy()
        _insert(own, state, inserted)
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return {
            "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": self.cost + cost, "repaired_sha256": own.hexdigest(), "state": state, "inserted": inserted,
            "audit": None if self.chunks else edits_of(self.packed, state)[0] + "I" * inserted,
        }


def _insert(own, state: int, inserted: int) -> int:
    """Hash inserted turns; the state behind them."""
    for _ in range(inserted):
        own.update((b"" if state == START else b"\n") + ROLES[NEXT[state]].encode() + b":")
        state = NEXT[state]
    return state


def _fault(text: str, first: bool) -> int:
    text = text.rstrip(SPACES)
    if not text:
        return BLANK
    return DUPLICATE if not first else SOUND if text[-1] in ".!?" else TRUNCATED


def _read(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, conv_turn, role, text, digest) with one space for a NULL role or text."""
    rows = turns.select(
        F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    return rows.withColumn("digest", F.md5("text"))


ORDER = ["conv", "turn", "role", "digest", "kind"]


def _stream(rows: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """Turns by conversation and in order, each first one of its role and text behind a mark."""
    nulls_first = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min(nulls_first).alias("at"))
    marks = firsts.select("conv", F.lit(MARK).alias("kind"), F.col("at.turn").alias("turn"), "role", "digest")
    stream = rows.withColumn("kind", F.lit(TURN)).unionByName(marks, allowMissingColumns=True)
    if conversations is not None:
        known = conversations.distinct().withColumn("kind", F.lit(KNOWN))
        stream = stream.unionByName(known, allowMissingColumns=True)
    # Conversations and turns go to pandas as text, where NULL does not make other numbers inexact.
    dealt = stream.repartition("conv").sortWithinPartitions(*ORDER)
    return dealt.select(F.col("conv").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "digest", "kind", "text")


FIELDS = (
    "conv string, chunk long, packed binary, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string, state int, inserted int"
)


def _repaired(stream: DataFrame, costs: Costs, chunk: int) -> DataFrame:
    """A row per conversation (chunk NULL), and one per spilled chunk of back pointers."""

    def run(frames):
        import pandas as pd

        names, texts = [f.split()[0] for f in FIELDS.split(", ")], ("conv", "packed", "audit", "repaired_sha256")
        program, now, conv, marked = Program(costs), None, None, False
        out: list[dict] = []

        def frame():
            made = {n: pd.array([row.get(n) for row in out], dtype=object if n in texts else "Int64") for n in names}
            out.clear()
            return pd.DataFrame(made)

        def ended():
            if now is not None:
                last = now.end()
                if now.chunks:
                    out.append({"conv": conv, "chunk": now.chunks, "packed": now.chunk()})
                out.append({"conv": conv, **last})

        for batch in frames:
            for own, turn, role, kind, text in zip(*(batch[c].tolist() for c in ("conv", "turn", "role", "kind", "text"))):
                if now is None or own != conv:
                    ended()
                    now, conv, marked = Conversation(program), own, False
                if kind == MARK:
                    marked = True
                elif kind == TURN:
                    now.add(turn, role, text, marked)
                    marked = False
                    if len(now.packed) == chunk:
                        out.append({"conv": conv, "chunk": now.chunks, "packed": now.chunk()})
            yield frame()
        ended()
        yield frame()

    return stream.mapInPandas(run, FIELDS)


def _walked_back(rows: DataFrame) -> DataFrame:
    """(conv, chunk, edits) of the conversations that spilled chunks, the last chunk first."""
    ends = rows.where("chunk IS NULL AND audit IS NULL").select("conv", F.lit(None).cast("binary").alias("packed"), "chunk", "state", "inserted")
    chunks = rows.where("chunk IS NOT NULL").select("conv", "packed", "chunk", "state", "inserted")
    dealt = ends.unionByName(chunks).repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc_nulls_first())

    def run(frames):
        import pandas as pd

        state = inserted = 0
        for batch in frames:
            out = []
            for conv, packed, chunk, end, more in zip(*(batch[c].tolist() for c in ("conv", "packed", "chunk", "state", "inserted"))):
                if packed is None:
                    state, inserted = int(end), int(more)
                    continue
                held = array("I")
                held.frombytes(zlib.decompress(packed))
                edits, state = edits_of(held, state)
                out.append((conv, int(chunk), edits + "I" * inserted))
                inserted = 0
            yield pd.DataFrame(out, columns=["conv", "chunk", "edits"])

    return dealt.mapInPandas(run, "conv string, chunk long, edits string")


def repair_plans(
    turns: DataFrame, conversations: DataFrame | None = None, costs: Costs = Costs(), chunk: int = CHUNK,
    key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    audit holds the cheapest edits in order: Keep, Rerole, Delete, Insert; of equally cheap ones the least as text. The
    hash is that of the repaired `role:text` lines. Turns are taken by turn number, NULL first, and of equal numbers by
    role and the MD5 of the text, repeated rows next to each other. A NULL role or text counts as one space, an empty or
    other role fits nowhere but can be changed. Turns with a NULL key are a conversation of their own.

    Keys in `conversations` without a turn get zeros, an empty audit and the hash of nothing. An empty table gives no
    rows but those. Other columns are not read.
    """
    rows = _read(turns, key, turn, role, text)
    known = None if conversations is None else conversations.select(F.col(key).alias("conv"))
    made = staged(_repaired(_stream(rows, known), costs, chunk), "turn-repairs")
    pieces = _walked_back(made).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "edits"))).alias("pieces"))
    walked = pieces.select(F.col("conv").alias("_conv"), F.array_join(F.col("pieces.edits"), "").alias("walked"))
    ends = made.where("chunk IS NULL").join(walked, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    return ends.select(
        F.col("conv").cast(dict(turns.dtypes)[key]).alias(key), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.coalesce("audit", "walked").alias("audit"), "repaired_sha256",
    )


def repaired_turns(
    turns: DataFrame, plans: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, place, edit, role, text) of the repaired conversations, places from 0, from the audits of `plans`.

    Conversations without a plan are left out. Handles rows as `repair_plans` does.
    """
    kind = dict(turns.dtypes)[key]
    plan = plans.select(F.col(key).alias("conv"), F.col("audit").alias("text"), F.lit(KNOWN).alias("kind"))
    rows = _read(turns, key, turn, role, text).withColumn("kind", F.lit(TURN))
    dealt = rows.unionByName(plan, allowMissingColumns=True).repartition("conv")
    ordered = dealt.sortWithinPartitions("conv", F.col("kind") != KNOWN, "turn", "role", "digest")

    def run(frames):
        import pandas as pd

        conv, audit, at, place, state = None, None, 0, 0, START
        for batch in frames:
            out = []

            def inserts():
                nonlocal at, place, state
                while audit[at : at + 1] == "I":
                    state = NEXT[state]
                    out.append((conv, place, "I", ROLES[state], ""))
                    at, place = at + 1, place + 1

            for own, mark, said, words in zip(*(batch[c].tolist() for c in ("conv", "kind", "role", "text"))):
                if mark == KNOWN:
                    conv, audit, at, place, state = own, words, 0, 0, START
                    inserts()
                    continue
                if audit is None or own != conv:
                    audit = None
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = SYSTEM if edit == "K" and state == START and said[:1] == "s" else NEXT[state]
                    out.append((conv, place, edit, said if edit == "K" else ROLES[state], words))
                    place += 1
                inserts()
            yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])

    columns = ordered.select(F.col("conv").cast("string").alias("conv"), "kind", "role", "text")
    made = columns.mapInPandas(run, "conv string, place long, edit string, role string, text string")
    return made.select(F.col("conv").cast(kind).alias(key), "place", "edit", "role", "text")


def damaged(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with the faults that the CRC-32 of `key:turn` chooses, NULL as one space: one in twenty each is dropped,
    emptied, loses its sentence ends, is repeated, or gets the role user. Repeated rows get the same fault."""

    def plain(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain(key), F.lit(":"), plain(turn)).cast("binary")) % 20
    cut = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said"))
    rows = turns.select(F.col(key), F.col(turn), plain(role).alias("spoke"), plain(text).alias("said"), fault.alias("fault"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    faulty = rows.where("fault <> 0").select(
        key, turn, F.when(F.col("fault") == 4, "user").otherwise(F.col("spoke")).alias(role), cut.alias(text), copies.alias("copy")
    )
    return faulty.drop("copy")
