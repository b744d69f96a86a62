"""Chat formatting with a grammar that is read back to check it.

    conversation = turn*
    turn         = "### " role ": " text "</turn>\\n"

Inside roles and texts the control strings may not stand free. A control string after an odd number of backslashes
is text: (n - 1) / 2 backslashes and the string. After an even number it is control, and n / 2 backslashes belong to
the text before it. A turn is rendered as it is and parsed; if what comes back differs, its conflicting content is
escaped and it is parsed again, until it is identical. Turns parse alone or after each other alike, so conversations
of any length are formatted turn by turn.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, functions as F

OPEN, CLOSE, AFTER_ROLE = "### ", "</turn>\n", ": "
#: What ends a text or a role when it stands free.
IN_TEXT = re.compile(r"(\\*)(###|</turn>)")
IN_ROLE = re.compile(r"(\\*)(###|</turn>|:)")
AT_END = re.compile(r"\\+\Z")
ASSISTANT = "assistant"


class Malformed(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str, control: re.Pattern = IN_TEXT) -> str:
    doubled = AT_END.sub(lambda m: m[0] * 2, text)
    return control.sub(lambda m: m[1] * 2 + "\\" + m[2], doubled)


def unescape(text: str, control: re.Pattern = IN_TEXT) -> str:
    plain = control.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)
    return AT_END.sub(lambda m: m[0][: len(m[0]) // 2], plain)


def _until(text: str, at: int, control: re.Pattern, wanted: str, whole: str) -> int:
    """The position of the first free control string, which must begin `whole`."""
    while found := control.search(text, at):
        if len(found[1]) % 2 == 0:
            if found[2] != wanted or not text.startswith(whole, found.start(2)):
                raise Malformed(f"{found[2]!r} at {found.start(2)}")
            return found.start(2)
        at = found.end()
    raise Malformed("a turn does not end")


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the text as it stands) of every turn."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise Malformed(f"no turn begins at {at}")
        role_at = at + len(OPEN)
        role_end = _until(text, role_at, IN_ROLE, ":", AFTER_ROLE)
        start = role_end + len(AFTER_ROLE)
        end = _until(text, start, IN_TEXT, CLOSE.rstrip("\n"), CLOSE)
        turns.append((unescape(text[role_at:role_end], IN_ROLE), unescape(text[start:end]), start, end))
        at = end + len(CLOSE)
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn, escaped as far as it takes to read it back, and where its text begins and ends in it."""
    role_as, text_as = role, text
    while True:
        made = f"{OPEN}{role_as}{AFTER_ROLE}{text_as}{CLOSE}"
        try:
            turns = parse(made)
        except Malformed:
            turns = []
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return made, turns[0][2], turns[0][3]
        escaped = escape(role, IN_ROLE), escape(text)
        if (role_as, text_as) == escaped:
            raise Malformed(f"escaped text does not come back: {made!r}")
        role_as, text_as = escaped


def format_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: conv_id, turn, segment, loss_start, loss_end.

    A conversation's formatted text is its segments in ascending order of turn, then segment. The loss mask covers
    the texts of assistant turns, [loss_start, loss_end) in code points of the segment, and is NULL for others.
    NULL roles and texts count as empty, NULL turns come first, a NULL conversation is one of its own, repeated
    turns are repeated, an empty table gives no rows. Other columns are not read.
    """

    def run(frames):
        import pandas as pd

        for frame in frames:
            made = [render_turn(r or "", t or "") for r, t in zip(frame["role"], frame["text"])]
            masked = [r == ASSISTANT for r in frame["role"]]
            yield pd.DataFrame({
                "conv_id": frame["conv_id"],
                "turn": frame["turn"],
                "segment": [m[0] for m in made],
                "loss_start": pd.array([m[1] if on else None for m, on in zip(made, masked)], "Int32"),
                "loss_end": pd.array([m[2] if on else None for m, on in zip(made, masked)], "Int32"),
            })

    # Keys stay integers with NULLs through pandas as text.
    rows = conversations.select(
        F.col(conv).cast("string").alias("conv_id"), F.col(turn).cast("string").alias("turn"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    )
    made = rows.mapInPandas(run, "conv_id string, turn string, segment string, loss_start int, loss_end int")
    return made.withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")})


def formatted_texts(segments: DataFrame) -> DataFrame:
    """(conv_id, formatted), for conversations that fit one value."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "segment")))
    return segments.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda s: s["segment"]), "").alias("formatted"))


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted text and loss mask alone.

    Rows (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). A conversation's segments come
    sorted to one task, which parses and hashes them as they pass and holds one at a time.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ])
        now, turns, masked, sizes, done = (), None, None, None, []

        def row():
            return dict(zip(schema.names, (now, sizes[0], turns.hexdigest(), sizes[1], masked.hexdigest(), sizes[2])))

        for batch in batches:
            for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now:
                    if now != ():
                        done.append(row())
                    now, turns, masked, sizes = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, text, _, _ in parse(segment):
                    turns.update(f"{role}\n{text}\n".encode())
                    sizes[0] += 1
                if start is not None:
                    loss = unescape(segment[start:end])
                    masked.update(loss.encode())
                    sizes[1] += len(loss)
                sizes[2] += len(segment)
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
        if now != ():
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
