"""Chat formatting from an event log: fold, render, read back.

A log row is an event (conv_id, turn, copy, seq, kind, role, text) on a message
(conv_id, turn, copy):

* ``message``: opens the message with its role and a first text;
* ``delta``: appends text, as streamed;
* ``edit``: replaces the text so far;
* ``regenerate``: drops the text so far; the next deltas build it anew.

``fold`` deals events by message, sorts them by sequence and folds them while
they stream by, so a task holds the text of one message and a conversation with
a third of all events is spread over many tasks.  ``render`` turns messages into
segments; the segments of a conversation in order are its training text.
``read_back`` parses segments again; it streams each conversation in order with
running digests, so memory does not grow with a conversation.  (A digest over a
whole conversation is sequential: one task reads its segments, once.)

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  In role and text every ``<``,
followed by any number of backslashes and a ``|``, gets one more backslash, so no
control string can appear; a role's backslash and line feed are escaped too.
Texts of the role ``assistant`` are under the loss mask.

Defined results: NULL text or role is empty; a NULL turn sorts first; events of
equal sequence are taken by kind, role and text; a message without a ``message``
event has an empty role; rows with the same turn are separate messages (copies),
ordered by role and text; a NULL conv_id is a conversation of its own; no rows
give no conversations.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
MASKED_ROLE = "assistant"
EVENT_KINDS = ("message", "delta", "edit", "regenerate")
_KEY = ["conv_id", "turn", "copy"]
_OUT_ROWS = 2048


def escape(text: str) -> str:
    return re.sub(r"<(\\*\|)", r"<\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*\|)", r"<\1", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain)


def render_message(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}"


def parse_message(segment: str) -> tuple[str, str]:
    if not (segment.startswith(START) and segment.endswith(END)):
        raise ValueError("a segment lacks its control strings")
    role, _, text = segment[len(START) : -len(END)].partition("\n")
    return unescape_role(role), unescape(text)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= _OUT_ROWS or size >= 1 << 22:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def events_of(conversations: DataFrame) -> DataFrame:
    """Finished rows (conv_id, turn, role, text) as the log of a session that ends with them.

    Other roles' texts arrive in three pieces.  A masked role's message first streams an
    answer that is given up and regenerated, then streams a middle piece and a first one,
    and an edit puts these right before the last piece arrives.  Events are not in order.
    """
    order = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "copy", F.row_number().over(order).cast("long")
    )
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    one, two = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
    first, middle = F.substr(text, F.lit(1), one), F.substr(text, one + 1, two - one)
    last = F.substr(text, two + 1)

    def events(*steps: tuple[str, Column]) -> Column:
        made = [
            F.struct(
                F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"),
                F.when(F.lit(kind == "message"), F.col("role")).alias("role"), part.alias("text"),
            )
            for seq, (kind, part) in enumerate(steps)
        ]
        return F.array(*made[::2], *made[1::2][::-1])

    masked = events(
        ("message", F.lit("")), ("delta", last), ("regenerate", F.lit(None).cast("string")),
        ("delta", middle), ("delta", first), ("edit", F.concat(first, middle)), ("delta", last),
    )
    plain = events(("message", first), ("delta", middle), ("delta", last))
    event = F.explode(F.when(F.col("role") == MASKED_ROLE, masked).otherwise(plain))
    return rows.select(*_KEY, event.alias("e")).select(*_KEY, "e.*")


def _fold_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, role, parts = None, "", []
    for *at, _, kind, event_role, text in rows:
        if at != key:
            if key is not None:
                yield *key, role, "".join(parts)
            key, role, parts = at, "", []
        if kind == "message":
            role, parts = event_role or "", [text or ""]
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts = [text or ""]
        elif kind == "regenerate":
            parts = []
        else:
            raise ValueError(f"unknown event kind {kind!r}")
    if key is not None:
        yield *key, role, "".join(parts)


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, copy, role, text."""
    schema = pa.schema(
        [*((k, pa.int64()) for k in _KEY), ("role", pa.string()), ("text", pa.string())]
    )
    dealt = (
        events.select(*[F.col(k).cast("long") for k in _KEY], "seq", "kind", "role", "text")
        .repartition(*_KEY)
        .sortWithinPartitions(*_KEY, "seq", "kind", "role", "text")
    )
    return dealt.mapInArrow(
        lambda batches: _batches(_fold_rows(_rows(batches)), schema),
        "conv_id long, turn long, copy long, role string, text string",
    )


def render(messages: DataFrame) -> DataFrame:
    """Segments: conv_id, turn, copy, segment, and the masked span [from, to) in it, if any."""
    schema = pa.schema(
        [
            *((k, pa.int64()) for k in _KEY), ("segment", pa.string()),
            ("mask_from", pa.int64()), ("mask_to", pa.int64()),
        ]
    )

    def rendered(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *at, role, text in rows:
            role = role or ""
            segment = render_message(role, text or "")
            first = len(START) + len(escape_role(role)) + 1
            masked = (first, len(segment) - len(END)) if role == MASKED_ROLE else (None, None)
            yield *at, segment, *masked

    return messages.select(*_KEY, "role", "text").mapInArrow(
        lambda batches: _batches(rendered(_rows(batches)), schema),
        "conv_id long, turn long, copy long, segment string, mask_from long, mask_to long",
    )


def _read_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, state = (), None
    for conv, segment, first, stop in rows:
        if (conv,) != key:
            if state is not None:
                yield _digests(key[0], state)
            key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
        role, text = parse_message(segment)
        state[0] += 1
        state[1].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        if first is not None:
            masked = unescape(segment[first:stop])
            state[2] += len(masked)
            state[3].update(masked.encode("utf-8", "replace"))
        state[4] += len(segment)
    if state is not None:
        yield _digests(key[0], state)


def _digests(conv: int | None, state: list) -> tuple:
    turns, turns_sha, chars, loss_sha, formatted = state
    return conv, turns, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), formatted


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation: turns, masked text and size, parsed from the rendered segments."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ]
    )
    ordered = segments.repartition("conv_id").sortWithinPartitions(*_KEY)
    return ordered.select("conv_id", "segment", "mask_from", "mask_to").mapInArrow(
        lambda batches: _batches(_read_rows(_rows(batches)), schema),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
