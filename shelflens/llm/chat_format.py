"""Chat formatting (operator 11): rendered text that a deterministic parser reads back.

Grammar of the formatted text (one conversation is its segments, one after another)::

    conversation := turn*
    turn         := header body "</turn>" "\\n"
    header       := "### User: " | "### Assistant: " | "### System: "
                  | "### Role " JSON string ": "           (any other role)

Control strings are the five stems of ``STEMS``.  A body may hold one only with
backslashes behind its first character (``<\\/turn>``, ``#\\## User:``); the parser
takes one of them away, so no text is out of reach.  A turn is first rendered as
it is; its rendering is parsed and compared to the source, and only a turn that
does not come back is escaped, until it is identical.  Each segment is parsed and
compared once more as a whole.  Texts without conflicts stay untouched.

Turns are sorted by one range shuffle over ``(conv_id, turn, role, text)``, so a
conversation of any size is spread over partitions and written as segments of at
most ``SEGMENT_CHARS`` (or one longer turn): nothing ever holds a conversation.
Order: turn (null first), then role, then text; repeated rows are repeated turns.
A null text or role is empty; rows with a null conv_id are one conversation; extra
columns are ignored whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm.common import arrow

HEADERS = {"user": "### User: ", "assistant": "### Assistant: ", "system": "### System: "}
STEMS = ("### User:", "### Assistant:", "### System:", '### Role "', "</turn>")
CLOSE = "</turn>"
LOSS_ROLES = ("assistant",)
SEGMENT_CHARS = 1 << 20

_ROLES = {text: role for role, text in HEADERS.items()}
_STUFFED = "|".join(f"{re.escape(s[0])}(?:\\\\*){re.escape(s[1:])}" for s in STEMS)
_CONTROL = re.compile(_STUFFED)
_HEADER = re.compile('### (?:(User|Assistant|System)|Role ("(?:[^"\\\\]|\\\\.)*")): ')


class ParseError(ValueError):
    """The text is not of the grammar."""


def header(role: str) -> str:
    return HEADERS.get(role) or f"### Role {json.dumps(role)}: "


def escape(text: str) -> str:
    """One more backslash behind the first character of each control string, bare or not."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(body: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], body)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """``(role, text, start, end)`` of each turn, start and end being those of its body.

    A body ends at the first bare control string; one that does not close the turn
    is an error, as is anything else outside the grammar."""
    turns, at = [], 0
    while at < len(text):
        head = _HEADER.match(text, at)
        if not head:
            raise ParseError(f"no turn at {at}")
        role = head[1].lower() if head[1] else json.loads(head[2])
        start = head.end()
        for found in _CONTROL.finditer(text, start):
            if found[0][1] != "\\":
                break
        else:
            raise ParseError("open turn")
        if found[0] != CLOSE or text[found.end():found.end() + 1] != "\n":
            raise ParseError(f"turn cut at {found.start()}")
        turns.append((role, unescape(text[start:found.start()]), start, found.start()))
        at = found.end() + 1
    return turns


def _recovers(rendered: str, source) -> bool:
    try:
        return [t[:2] for t in parse(rendered)] == source
    except ParseError:
        return False


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The turn's rendering and the number of escapes it took to be read back."""
    body, passes = text, 0
    while not _recovers(f"{header(role)}{body}{CLOSE}\n", [(role, text)]):
        if passes:
            raise ParseError("escaped turn does not come back")
        body, passes = escape(body), passes + 1
    return f"{header(role)}{body}{CLOSE}\n", passes


def render(turns) -> tuple[str, list[tuple[int, int]], int]:
    """Formatted text of ``(role, text)`` turns, its loss spans (bodies of
    ``LOSS_ROLES``) and the number of escaped turns; checked by a parse of the whole."""
    pieces = [render_turn(*t) for t in turns]
    text = "".join(p for p, _ in pieces)
    back = parse(text)
    if [t[:2] for t in back] != list(turns):
        raise ParseError("segment does not come back")
    return text, [(s, e) for role, _, s, e in back if role in LOSS_ROLES], sum(n for _, n in pieces)


def format_chats(rows: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> formatted segments.

    ``conv_id, part, segment`` (the order of a conversation's segments), ``whole``
    (false if other rows may belong to the conversation), ``n_turns``, ``n_escaped``,
    ``text`` and ``loss_mask`` (spans of characters of ``text`` that are trained on)."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("part", T.IntegerType()),
                           T.StructField("segment", T.IntegerType()), T.StructField("whole", T.BooleanType()),
                           T.StructField("n_turns", T.LongType()), T.StructField("n_escaped", T.LongType()),
                           T.StructField("text", T.StringType()), T.StructField("loss_mask", T.ArrayType(span))])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        part, number, conv, turns, chars, cut = TaskContext.get().partitionId(), 0, None, [], 0, True

        def close(whole):
            text, mask, escaped = render(turns)
            return {"conv_id": conv, "part": part, "segment": number, "whole": whole, "n_turns": len(turns), "n_escaped": escaped,
                    "text": text, "loss_mask": [{"start": s, "end": e} for s, e in mask]}

        out = []
        for batch in batches:
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                other = bool(turns) and key != conv
                if other or chars >= SEGMENT_CHARS:
                    out.append(close(other and not cut))
                    # `cut`: the conversation may have rows elsewhere; the first one of a partition always may
                    number, turns, chars, cut = number + 1, [], 0, not other
                conv = key
                turns.append((role, text))
                chars += len(text) + len(role) + 16
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow_schema)
                out = []
        if turns:
            yield pa.RecordBatch.from_pylist([close(False)], arrow_schema)  # may go on in the next partition

    # the last key spreads equal rows over partitions; which of them is which does not matter
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    plain = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("copy"))
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    return arrow(ranged, run, schema)


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_escaped long")


def chat_digest(segments: DataFrame) -> DataFrame:
    """What the written segments hold, read back by the parser and the loss mask.

    A conversation in one segment is read where it lies.  Segments of others are
    brought together in order; a checksum is sequential by nature, so one task streams
    a conversation's segments, holding one at a time."""
    def run(batches):
        conv, state = None, None

        def done():
            turns, loss, n, masked, chars, escaped = state
            return [conv, n, turns.hexdigest(), masked, loss.hexdigest(), chars, escaped]

        names = [f.split()[0] for f in _DIGEST.split(", ")]
        kinds = [pa.string() if "sha" in c else pa.int64() for c in names]
        batch_of = lambda out: pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)
        for batch in batches:
            out = []
            for key, escaped, text, mask in zip(*(batch.column(k) for k in range(4))):
                key, text = key.as_py(), text.as_py()
                if state is None or key != conv:
                    if state is not None:
                        out.append(done())
                    conv, state = key, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                for role, said, _, _ in parse(text):
                    state[0].update(f"{role}\n{said}\n".encode())
                    state[2] += 1
                for piece in mask.as_py():
                    said = unescape(text[piece["start"]:piece["end"]])
                    state[1].update(said.encode())
                    state[3] += len(said)
                state[4] += len(text)
                state[5] += escaped.as_py()
            if out:
                yield batch_of(out)
        if state is not None:
            yield batch_of([done()])

    columns = ["conv_id", "n_escaped", "text", "loss_mask"]
    split = segments.where("not whole")
    # equal ids lie together: the null id's key differs from all others'
    together = split.repartition(F.col("conv_id")).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "segment")
    alone = arrow(segments.where("whole").select(*columns), run, _DIGEST)
    return alone.unionByName(arrow(together.select(*columns), run, _DIGEST))
