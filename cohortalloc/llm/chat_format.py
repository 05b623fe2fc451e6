"""Chat formatting with a grammar round trip.

Template.  A turn is ``### Role:``, a newline, its text, a newline and
``</turn>`` with a newline.  The role is capitalised if that can be undone,
and percent-encoded where it holds signs of the template.

Method.  Each turn is rendered with its text as it is, the result is parsed
again by a deterministic parser (a header line, text up to the first closing
line not escaped, nothing else), and the recovered turn is compared with the
source.  Where they differ, every control string of the text (an opening
``### Name:``, a ``</turn>``, with any backslashes before it) gets one more
backslash, until the parse gives the source back; the parser takes one
backslash off each.  So plain texts stay as they are, and any text at all
comes back.

Loss mask.  The spans of the assistant's text (escaped form, without header
and closing line) within the formatted text.

Edge cases.  A NULL text or role counts as empty.  Turns stand in the order
of (turn, role, text), NULL turns first; turns that are equal in all three
all stay.  Conversations with a NULL id form one conversation.  An empty
table gives an empty result.  Columns other than those named are ignored.

Scale.  Turns are dealt out by ranges of (conversation, turn), so the turns
of one conversation of any size are rendered, and its parts parsed, by many
tasks; a task passes over its turns one by one and writes parts of at most
about ``PART_CHARS`` code points (more only for one longer turn).  Only the
two running digests of a conversation need all its text in order: they are
taken in one pass over the parsed parts, part by part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, ship_package, shuffle_partitions, table

PART_CHARS = 1 << 18
LEARNED_ROLE = "assistant"
CLOSE = "</turn>"

_CONTROL = re.compile(r"\\*(?:### [^\s:<\\]*:|</turn>)")
_ESCAPED = re.compile(r"\\(\\*(?:### [^\s:<\\]*:|</turn>))")
_HEADER = re.compile(r"### ([^\s:<\\]*):\n")
#: The first closing string that is not escaped.
_CLOSING = re.compile(r"(?<!\\)</turn>")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def role_name(role: str) -> str:
    """``Assistant`` for ``assistant``; others that would not come back are marked by a ``=``."""
    name = quote(role, safe="")
    shown = name[:1].upper() + name[1:]
    return shown if role_of(shown) == role else f"={name}"


def role_of(name: str) -> str:
    if name.startswith("="):
        return unquote(name[1:])
    return unquote(name[:1].lower() + name[1:])


def parse_turn(rendered: str, at: int) -> tuple[str, str, int, int, int] | None:
    """(role, text, text's begin, text's end, end of turn) of the turn that begins at ``at``."""
    head = _HEADER.match(rendered, at)
    if not head:
        return None
    tail = _CLOSING.search(rendered, head.end())
    if not tail or rendered[tail.start() - 1] != "\n" or rendered[tail.end() : tail.end() + 1] != "\n":
        return None
    end = tail.start() - 1
    if end < head.end():
        return None
    return role_of(head[1]), unescape(rendered[head.end() : end]), head.end(), end, tail.end() + 1


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn of a formatted text."""
    out, at = [], 0
    while at < len(rendered):
        turn = parse_turn(rendered, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append(turn[:4])
        at = turn[4]
    return out


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, begin and end of its text), escaped until it parses back to the source."""
    header = f"### {role_name(role)}:\n"
    shown = text
    for _ in range(4):  # the second round parses back: no escaped control string closes a turn
        rendered = f"{header}{shown}\n{CLOSE}\n"
        turn = parse_turn(rendered, 0)
        if turn and turn[:2] == (role, text) and turn[4] == len(rendered):
            return rendered, len(header), len(header) + len(shown)
        shown = escape(shown)
    raise ValueError("a turn does not come back from its formatted text")


def _stream(batches, columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def format_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, part, formatted, loss): formatted parts, in order of ``part``, with the loss spans within each."""
    spark = ship_package(turns.sparkSession)
    rows = turns.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    # the bounds of the ranges hold beginnings of texts, never whole ones
    ranges = ["key", "turn", "role", F.substring("text", 1, 32)]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *ranges).sortWithinPartitions("key", "turn", "role", "text")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        key_type, held = None, []
        first = TaskContext.get().partitionId() << 32  # parts of later ranges come later

        def record(key, part, formatted, loss):
            held.append((key, part, formatted, loss))

        def flush():
            columns = list(zip(*held)) if held else [(), (), (), ()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], spans)],
                names=[key, "part", "formatted", "loss"],
            )

        now, part, pieces, size, loss, begun, waiting = None, first, [], 0, [], False, 0
        for batch in batches:
            key_type = batch.schema.field("key").type
            for k, r, t in _stream([batch], ("key", "role", "text")):
                if begun and (k != now or size >= PART_CHARS):
                    record(now, part, "".join(pieces), loss)
                    waiting += size
                    part, pieces, size, loss = part + 1, [], 0, []
                now, begun = k, True
                shown, a, b = render_turn(r, t)
                if r == LEARNED_ROLE:
                    loss.append({"start": size + a, "end": size + b})
                pieces.append(shown)
                size += len(shown)
                if waiting >= PART_CHARS:
                    yield flush()
                    waiting = 0
        if begun:
            record(now, part, "".join(pieces), loss)
            yield flush()

    kind = turns.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        run, f"`{key}` {kind}, part long, formatted string, loss array<struct<start:bigint,end:bigint>>"
    )


def parsed_parts(parts: DataFrame, key: str) -> DataFrame:
    """(key, part, n, turns, learned, chars): what a part holds, read from its formatted text alone.

    ``turns`` is the text the turns' digest runs over, ``learned`` the
    unescaped text under the loss mask.
    """

    def run(batches):
        for batch in batches:
            made = []
            for formatted, loss in _stream([batch], ("formatted", "loss")):
                turns = parse(formatted)
                learned = "".join(unescape(formatted[span["start"] : span["end"]]) for span in loss)
                made.append((len(turns), "".join(f"{r}\n{t}\n" for r, t, _, _ in turns), learned, len(formatted)))
            columns = list(zip(*made)) if made else [()] * 4
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("part"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["key", "part", "n", "turns", "learned", "chars"],
            )

    rows = parts.select(F.col(key).alias("key"), "part", "formatted", "loss")
    kind = parts.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, part long, n long, turns string, learned string, chars long")


def read_back(parts: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted conversations."""
    spark = ship_package(parts.sparkSession)
    rows = parsed_parts(parts, key)
    rows = rows.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "part")
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        now, begun, key_type, out = None, False, None, []
        n = loss_chars = chars = 0
        turns, learned = hashlib.sha256(), hashlib.sha256()

        def flush():
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out.clear()
            return made

        for batch in batches:
            key_type = batch.schema.field("key").type
            for k, more, said, loss, size in _stream([batch], ("key", "n", "turns", "learned", "chars")):
                if begun and k != now:
                    out.append((now, n, turns.hexdigest(), loss_chars, learned.hexdigest(), chars))
                    n = loss_chars = chars = 0
                    turns, learned = hashlib.sha256(), hashlib.sha256()
                now, begun = k, True
                turns.update(said.encode())
                learned.update(loss.encode())
                n, loss_chars, chars = n + more, loss_chars + len(loss), chars + size
            yield flush()
        if begun:
            out.append((now, n, turns.hexdigest(), loss_chars, learned.hexdigest(), chars))
            yield flush()

    kind = parts.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and number -7 full of control strings, formatted and read back; see the module."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    return read_back(materialise(format_conversations(turns.unionByName(added)), "formatted"))
