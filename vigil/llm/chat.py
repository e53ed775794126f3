"""Chats from event logs: fold deltas, edits and regenerations into messages, then render and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template of one turn. Inside roles and texts a backslash stands before each
# backslash and each "<" (in roles each ">" as well), so neither mark can occur in them.
OPEN, CLOSE = "<turn {}>\n", "</turn>\n"

EVENTS = "conv_id long, turn long, message string, seq long, kind string, role string, start long, stop long, text string"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """One turn as text, and the span of its message in it."""
    head = OPEN.format(escaped(role).replace(">", "\\>"))
    body = escaped(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def read_back(formatted: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    found = TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a turn of this template")
    return unescaped(found[1]), unescaped(found[2])


class Message:
    """State of one message: its pieces so far."""

    def __init__(self, role):
        self.role, self.pieces = role or "", []

    def apply(self, kind, role, start, stop, text):
        """delta appends; edit replaces the characters from start to stop; regenerate begins anew."""
        if kind == "delta":
            self.pieces.append(text or "")
        elif kind == "edit":
            whole = "".join(self.pieces)
            low, high = max(0, start or 0), len(whole) if stop is None else stop
            self.pieces = [whole[:low] + (text or "") + whole[max(low, high):]]
        elif kind == "regenerate":
            self.pieces = []
        elif kind == "open":
            self.role = role or ""


def _fold(loss_roles: frozenset):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()),
                            ("loss_start", pa.int64()), ("loss_stop", pa.int64())])
        conversation, place, offset, at, state = ("none",), 0, 0, None, None
        out, held = [], 0

        def close():
            nonlocal place, offset, held
            whole, start, stop = rendered(state.role, "".join(state.pieces))
            loss = state.role in loss_roles
            out.append((conversation, place, whole, offset + start if loss else None, offset + stop if loss else None))
            place, offset, held = place + 1, offset + len(whole), held + len(whole)

        def flush():
            nonlocal held
            rows = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.field(i).type) for i in range(5)],
                                              schema=schema)
            out.clear()
            held = 0
            return rows

        for batch in batches:
            for conv, turn, message, kind, role, start, stop, text in zip(
                    *(batch.column(c).to_pylist() for c in
                      ("conv_id", "turn", "message", "kind", "role", "start", "stop", "text")), strict=True):
                if at != (conv, turn, message):
                    if state is not None:
                        close()
                        if held > 4_000_000:
                            yield flush()
                    if conversation != conv:
                        conversation, place, offset = conv, 0, 0
                    at, state = (conv, turn, message), Message(role)
                state.apply(kind, role, start, stop, text)
        if state is not None:
            close()
        if out:
            yield flush()
    return run


def formatted_turns(events: DataFrame, loss_roles=("assistant",)) -> DataFrame:
    """Turns of all conversations as text: conv_id, place, formatted, loss_start, loss_stop.

    ``events`` has the columns of EVENTS: a log in which a message (conv_id, turn,
    message) is opened with its role, streamed in deltas, edited (characters from
    start to stop replaced) and regenerated (begun anew), in the order of seq. The
    log is partitioned by conversation and sorted; a task holds one message at a
    time, so a conversation of any length is folded without being gathered. The
    formatted conversation is its turns in order of place; loss_start and loss_stop
    are code points in it and null for roles without loss. Rows of a conversation
    come out together and in order.

    Order is by turn (nulls first), then message, then seq. A message without an
    open event takes the role of its first event; null texts and roles are empty;
    an unknown kind changes nothing; a null conv_id is a conversation. No events
    give no rows; other columns are not looked at.
    """
    names = [f.split()[0] for f in EVENTS.split(", ")]
    ordered = events.select(*names).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "message", "seq", "kind", "text")
    return ordered.mapInArrow(_fold(frozenset(loss_roles)),
                              "conv_id long, place long, formatted string, loss_start long, loss_stop long")


def _digests(batches: Iterator) -> Iterator:
    import pyarrow as pa
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    conversation, turns, loss, counts = ("none",), None, None, [0, 0, 0]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    done = []

    def closed():
        return conversation, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]

    def rows():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names=names)

    for batch in batches:
        for conv, formatted, start, stop in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_stop")), strict=True):
            if conversation != conv:
                if turns is not None:
                    done.append(closed())
                conversation, turns, loss, counts = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            role, text = read_back(formatted)
            turns.update(f"{role}\n{text}\n".encode())
            if start is not None:
                under = unescaped(formatted[start - counts[2]:stop - counts[2]])
                loss.update(under.encode())
                counts[1] += len(under)
            counts[0] += 1
            counts[2] += len(formatted)
        if len(done) > 10_000:
            yield rows()
            done.clear()
    if turns is not None:
        done.append(closed())
    yield rows()


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``formatted_turns``: turns and loss text as digests.

    Follows it without another shuffle; a digest is taken turn by turn.
    """
    return turns.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def events_of(conversations: DataFrame) -> DataFrame:
    """An event log that folds to the given turns (conv_id, turn, role, text); a null text is empty.

    Every message is streamed in four deltas. By a hash of its text, one in three
    is first drafted otherwise and regenerated, and one in three has a slip of the pen in
    front that an edit takes out. Equal (conv_id, turn) are ordered by role and text.
    """
    rows = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "CAST(role AS STRING) AS role",
        "coalesce(CAST(text AS STRING), '') AS text", "monotonically_increasing_id() AS uid")
    told = rows.selectExpr(
        "*", "concat_ws('/', coalesce(role, ''), sha2(text, 256), lpad(CAST(uid AS STRING), 20, '0')) AS message",
        "pmod(xxhash64(text, turn), 3) AS style", "CAST(ceil(length(text) / 4) AS INT) AS step")
    piece = "substring(text, {} * step + 1, {})".format

    def event(kind, text="''", start="CAST(NULL AS BIGINT)", stop="CAST(NULL AS BIGINT)", when="true"):
        return f"CASE WHEN {when} THEN struct('{kind}' AS kind, {start} AS start, {stop} AS stop, {text} AS text) END"

    log = [event("open"), event("delta", "concat('draft ', substring(text, 1, 40))", when="style = 1"),
           event("regenerate", when="style = 1"), event("delta", "'slip '", when="style = 2"),
           *[event("delta", piece(i, "step" if i < 3 else "length(text)")) for i in range(4)],
           event("edit", start="0L", stop="5L", when="style = 2")]
    numbered = told.select("conv_id", "turn", "message", "role", F.posexplode(F.expr(f"array({', '.join(log)})")).alias(
        "seq", "e")).where("e IS NOT NULL")
    return numbered.selectExpr("conv_id", "turn", "message", "CAST(seq AS BIGINT) AS seq", "e.kind", "role",
                               "e.start", "e.stop", "e.text")


# The added conversation.
ADDED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]

ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '<', ''))
                + length(role) + length('<turn >') + 1 + length('</turn>') + 1 AS size FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, sha256(text)), ''))
           AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
