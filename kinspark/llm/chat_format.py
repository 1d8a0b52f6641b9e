"""Chat formatting from event logs.

A conversation is a log of events, ordered by ``seq``:

* ``start``       opens message ``message`` with a role (text: its first words),
* ``delta``       appends text to the message,
* ``edit``        replaces the message's text (role given: its role too),
* ``regenerate``  drops this message and all after it as they were until now,
                  and opens it anew.

The latest regeneration at or below a message is found on ids alone, and undoes
the message's events before it.  The rest are partitioned by (conversation, message), sorted, and
folded while they stream by: a conversation holding a third of all events is
spread over its messages, and a task holds one message at a time.  Rendering and reading back
go turn by turn as well; only a digest over a whole conversation brings its
turns together, and streams over them.  A turn is rendered as

    <|im_start|>ROLE \\n TEXT \\n <|im_end|> \\n

(without the blanks).  A control string inside a text gets a backslash before it
and before the backslashes that stand there, and loses it when read: a control
string counts only if no backslash stands before it.  In roles, backslash and
line feed are escaped.

The output has one row per turn: its segment of the formatted conversation and
the loss span within it (assistant texts).  A conversation's text is its
segments in order.

Defined results: null text or role counts as empty; events of one conversation
with equal seq are ordered by kind (start first), role and text; rows of a
conversation table that repeat a turn are turns of their own, ordered by role
and text (their message is the pair of turn and copy); null conv_id is a conversation; an empty log gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinspark.session import table

# The control strings of the template and of other common templates.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_ANY = "|".join(map(re.escape, CONTROL))
# the look behind comes first, so a run of backslashes is looked over once
_ESCAPE = re.compile(rf"(?<!\\)(?=\\*(?:{_ANY}))")
_UNESCAPE = re.compile(rf"(?<!\\)\\(?=\\*(?:{_ANY}))")
LOSS_ROLE = "assistant"
#: Characters of a delta when a table of finished turns is written as a log.
DELTA_CHARS = 512


def escape(text: str) -> str:
    """One more backslash before every control string and the backslashes it follows."""
    return _ESCAPE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's segment, and the span of its escaped text within it."""
    head = f"{OPEN}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}\n{CLOSE}\n", len(head), len(head) + len(body)


def parse_turn(segment: str) -> tuple[str, str]:
    """(role, text) of one rendered turn; fails if it is not one."""
    marks = [m for m in re.finditer(rf"(?<!\\)(?:{_ANY})", segment)]
    if [m.group() for m in marks] != [OPEN, CLOSE] or marks[0].start() or segment[marks[1].end() :] != "\n":
        raise ValueError("not a rendered turn")
    role, _, text = segment[len(OPEN) : marks[1].start() - 1].partition("\n")
    return unescape_role(role), unescape(text)


def turns_as_log(turns: DataFrame) -> DataFrame:
    """A table (conv_id, turn, role, text) as a log: a start event per turn and its text in deltas."""
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("*", F.struct("turn", F.row_number().over(order).alias("copy")).alias("message"))
    parts = F.expr(f"if(text = '', array(''), regexp_extract_all(text, '(?s).{{1,{DELTA_CHARS}}}', 0))")  # one pass over the text
    rows = rows.select("conv_id", "message", "role", F.posexplode(parts).alias("part", "delta"))
    kind = F.when(F.col("part") == 0, "start").otherwise("delta")
    seq = F.struct(F.col("message").alias("major"), F.col("part").cast("bigint").alias("minor"))
    return rows.select("conv_id", seq.alias("seq"), kind.alias("kind"), "message", "role", F.col("delta").alias("text"))


_KINDS = ("start", "regenerate", "edit", "delta")  # also the order of events with equal seq


def final_events(log: DataFrame, together: bool = False) -> DataFrame:
    """The events that no later regeneration undoes, sorted by conversation, message and order.

    Events of a message share a partition; ``together`` says that they do so already.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in _KINDS]), F.col("kind"))
    rows = log.select("conv_id", "message", "kind", "role", "text", F.struct("seq", rank, "role", "text").alias("at"))
    if not log.where("kind = 'regenerate'").select("kind").isEmpty():
        rows = _not_undone(rows)
    if not together:
        rows = rows.repartition("conv_id", "message")
    return rows.sortWithinPartitions("conv_id", "message", "at").select("conv_id", "message", "kind", "role", "text")


def _not_undone(rows: DataFrame) -> DataFrame:
    """Events that come no earlier than the latest regeneration at or below their message; what is looked up holds ids, not texts."""

    def same(a: str, b: str, *names: str) -> Column:
        return reduce(and_, [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names])

    again = rows.where("kind = 'regenerate'").groupBy("conv_id", "message").agg(F.max("at").alias("last"))
    touched = again.select("conv_id").distinct()
    named = rows.select("conv_id", "message").distinct().alias("m").join(touched.alias("t"), same("m", "t", "conv_id"), "left_semi")
    latest = named.join(again.alias("r"), same("m", "r", "conv_id", "message"), "left").select("m.*", "r.last")
    upto = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)
    latest = latest.select("conv_id", "message", F.max("last").over(upto).alias("last"))
    judged = rows.alias("e").join(latest.alias("l"), same("e", "l", "conv_id", "message"), "left")
    return judged.where("l.last IS NULL OR e.at >= l.last").select("e.*")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted events to rows (conv_id, message, segment, loss_start, loss_end); one message is held at a time."""
    key, role, parts, out = None, "", [], []

    def close() -> None:
        if key is not None:
            segment, start, end = render_turn(role, "".join(parts))
            loss = (start, end) if role == LOSS_ROLE else (None, None)
            out.append((*key, segment, *loss))

    for batch in batches:
        for *this, kind, new_role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if this != key:
                close()
                key, role, parts = this, "", []
            if kind in ("start", "regenerate"):
                role, parts = new_role or "", [text or ""]
            elif kind == "edit":
                role, parts = role if new_role is None else new_role, [text or ""]
            else:
                parts.append(text or "")
        kinds = [("conv_id", pa.int64()), ("message", batch.column(1).type), *_TURN_FIELDS]
        yield _batch(out, kinds)
        out.clear()
    close()
    if out:
        yield _batch(out, kinds)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


_TURN_FIELDS = [("segment", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())]


def format_log(log: DataFrame, together: bool = False) -> DataFrame:
    """Rendered turns (conv_id, message, segment, loss_start, loss_end) of every conversation."""
    message = log.schema["message"].dataType.simpleString()
    out = f"conv_id long, message {message}, segment string, loss_start int, loss_end int"
    return final_events(log, together).mapInArrow(_fold, out)


def read_turns(formatted: DataFrame) -> DataFrame:
    """(conv_id, message, body, loss, masked, chars) read from each segment: role, line feed and text; whether the loss mask covers
    anything; what it covers where that is not the text; characters of the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for segment, start, end in zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True):
                role, text = parse_turn(segment)
                masked = None if start is None else unescape(segment[start:end])
                out.append((role, text, start is not None, None if masked == text else masked, len(segment)))
            columns = [pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(_READ)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=names)

    names = ["conv_id", "message", *[n for n, _ in _READ]]
    message = formatted.schema["message"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id long, message {message}, role string, text string, loss boolean, masked string, chars long")


_READ = [("role", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("masked", pa.string()), ("chars", pa.int64())]
_DIGEST_FIELDS = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation, from its turns as they stream by."""
    key, out = (), []
    state: list = []

    def close() -> None:
        if key != ():
            n, turns, chars, loss, total = state
            out.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), total))

    for batch in batches:
        for conv_id, _, role, text, loss, masked, chars in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv_id != key:
                close()
                key, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss:
                masked = text if masked is None else masked
                state[2] += len(masked)
                state[3].update(masked.encode())
            state[4] += chars
        yield _batch(out, _DIGEST_FIELDS)
        out.clear()
    close()
    yield _batch(out, _DIGEST_FIELDS)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation of ``format_log``'s output, read back turn by turn and put in order for the digests."""
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return read_turns(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "message").mapInArrow(_digested, out)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, LOSS_ROLE, text)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return conversation_digests(format_log(turns_as_log(turns), together=True))
