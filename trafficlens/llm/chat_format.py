"""Chat formatting by a compiled template (operator 12).

``format_chats`` renders a table with one row per turn into conversations, with
the ranges a model is to learn; ``read_chats`` reads turns and learnt text back
from that output alone. The template language is in ``chat_template``.

Turns are range-partitioned by (conversation, turn, ...), so even a
conversation that holds a third of all rows is rendered by many tasks. A task
renders its sorted rows one by one and writes a part whenever a conversation
ends or a part is long enough; it never holds more than one part. Parts that
are a whole conversation are read back and digested where they are; only the
others (two a task at most, and those of very long conversations) are brought
together per conversation, streamed in order through the digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat_template import Template, Writer
from .common import ship, text_or_empty

# marks of the default template: start of a turn, end of its role, end of the turn
CONTROLS = ("<turn>", "<say>", "</turn>")
DEFAULT_TEMPLATE = """
{#- the texts under generation are those a model is to learn -#}
{% for message in messages -%}
<turn>{{ message.role | escape }}<say>
{%- if message.role == "assistant" %}{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else %}{{ message.text | escape }}{% endif -%}
</turn>
{% endfor -%}
"""
PART = 1 << 20  # characters from which a part is closed
ROWS = 2000  # rows of an output batch at most


def escaper(controls: Sequence[str] = CONTROLS) -> tuple[Callable[[object], str], Callable[[str], str]]:
    """Escape and unescape: a backslash becomes two, the k-th control string a
    backslash and the k-th letter, so no control string is left in a text."""
    if not 0 < len(controls) <= 26 or any(not c or "\\" in c for c in controls):
        raise ValueError("give 1 to 26 control strings without backslashes")
    code = {"\\": "\\\\"} | {c: "\\" + chr(ord("a") + i) for i, c in enumerate(controls)}
    back = {v[1]: k for k, v in code.items()}
    special = re.compile("|".join(re.escape(c) for c in sorted(code, key=len, reverse=True)))

    def escape(text: object) -> str:
        return special.sub(lambda m: code[m[0]], "" if text is None else str(text))

    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: back[m[1]], text, flags=re.S)

    return escape, unescape


def compile_template(source: str = DEFAULT_TEMPLATE, controls: Sequence[str] = CONTROLS) -> Template:
    """A template with the filter ``escape`` for these control strings."""
    return Template(source, {"escape": escaper(controls)[0]})


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, borders: bool) -> DataFrame:
    """Turns in order, a range of them in each partition."""
    rows = df.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        text_or_empty(role_col).alias("_role"),
        text_or_empty(text_col).alias("_text"),
    )
    # equal rows may stand in any order, so a row number splits any number of them
    rows = rows.withColumn("_tie", F.sha2("_text", 256)).withColumn("_row", F.monotonically_increasing_id())
    key = ["_turn", "_role", "_tie", "_row"]
    if borders:
        ends = rows.groupBy("_conv").agg(F.min(F.struct(*key)).alias("_lo"), F.max(F.struct(*key)).alias("_hi"))
        met = rows.alias("r").join(ends.alias("e"), F.col("r._conv").eqNullSafe(F.col("e._conv")))
        rows = met.select("r.*", *[(F.col(f"e.{c}._row") == F.col("r._row")).alias(f"{c}_row") for c in ("_lo", "_hi")])
    return rows.repartitionByRange("_conv", *key).sortWithinPartitions("_conv", *key).drop("_tie", "_row")


class _Parts:
    """Output rows of one task."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if self.size >= PART or len(self.rows) >= ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.size = [], 0


_MARKS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_chats(
    df: DataFrame,
    template: str = DEFAULT_TEMPLATE,
    controls: Sequence[str] = CONTROLS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_chars: int = PART,
    **values: object,
) -> DataFrame:
    """``<conv_col>, part, is_whole, formatted, marks``: each conversation in
    one or more parts, to be joined in order of ``part`` (a number that grows
    within a conversation, not its index). ``marks`` are the ranges under
    ``generation``, in code points from the part's start. ``values`` are
    further names the template may read.

    Null roles and texts are empty. Rows of equal turn are ordered by role and
    then by the SHA-256 of their text; null turns come first; repeated rows are
    turns of their own. A null conversation id is a conversation like others.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    compiled = compile_template(template, controls)
    _, _, _, borders = compiled.turnwise()
    borders = bool(borders) or any(_renders(f, values) for f in (compiled.turnwise()[0], compiled.turnwise()[2]))
    rows = _ordered(df, conv_col, turn_col, role_col, text_col, borders)
    conv_type = rows.schema["_conv"].dataType.simpleString()

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        head, turn, tail, _ = compile_template(template, controls).turnwise()
        out: _Parts | None = None
        conv, writer, seen, started, number = None, Writer(), False, False, 0
        first_conv, split = True, False

        def close(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal writer, number
            part = "".join(writer.parts)
            marks = [{"start": a, "end": b} for a, b in writer.marks]
            yield from out.add((conv, (task << 40) + number, whole, part, marks), len(part))
            writer, number = Writer(), number + 1

        for batch in batches:
            if out is None:
                fields = [("c", batch.schema.field("_conv").type), ("p", pa.int64()), ("w", pa.bool_()), ("f", pa.string()), ("m", _MARKS)]
                out = _Parts(pa.schema([(n, t) for n, (_, t) in zip((conv_col, "part", "is_whole", "formatted", "marks"), fields)]))
            lo, hi = ([batch.column(c).to_pylist() for c in ("_lo_row", "_hi_row")]) if borders else ([False] * batch.num_rows,) * 2
            columns = [batch.column(c) for c in ("_conv", "_role", "_text")]
            for c, role, text, first, last in zip(*(x.to_pylist() for x in columns), lo, hi):
                if seen and c != conv:
                    # the first conversation of a task may have begun in the task before
                    yield from close(whole=not first_conv and not split)
                    first_conv = split = False
                elif seen and writer.length >= part_chars:
                    yield from close(whole=False)
                    split = True
                conv, seen = c, True
                if first:
                    head(dict(values), writer)
                turn(values, {"role": role, "text": text}, first, last, writer)
                if last:
                    tail(dict(values), writer)
        if seen:
            yield from close(whole=False)  # the next task may go on with it
        if out is not None:
            yield from out.flush()

    schema = f"`{conv_col}` {conv_type}, part bigint, is_whole boolean, formatted string, marks array<struct<start:int,end:int>>"
    return rows.mapInArrow(render, schema)


def _renders(part: Callable, values: dict) -> bool:
    writer = Writer()
    part(dict(values), writer)
    return writer.length > 0


def read_turns(formatted: str, unescape: Callable[[str], str], controls: Sequence[str] = CONTROLS) -> list[tuple[str, str]]:
    """Role and text of each turn, from the formatted text alone."""
    begin, say, end = map(re.escape, controls[:3])
    turn = re.compile(rf"{begin}(.*?){say}(.*?){end}\n", re.S)
    turns, at = [], 0
    while at < len(formatted):
        m = turn.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


class _Digest:
    """What ``read_chats`` returns of a conversation, part by part."""

    def __init__(self):
        self.turns, self.learnt = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss = 0

    def add(self, n: int, turns: bytes, learnt: bytes, loss: int, chars: int) -> None:
        self.turns.update(turns)
        self.learnt.update(learnt)
        self.n, self.loss, self.chars = self.n + n, self.loss + loss, self.chars + chars

    def row(self, conv: object) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars


def read_chats(parts: DataFrame, controls: Sequence[str] = CONTROLS, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, from the parts of ``format_chats`` with a
    template of the default layout: ``<conv_col>, n_turns, turns_sha256`` (of
    role, newline, text, newline of each turn), ``loss_chars, loss_sha256`` (of
    all text under the marks, unescaped), ``formatted_chars``."""
    spark = parts.sparkSession
    ship(spark)
    conv_type = parts.schema[conv_col].dataType.simpleString()
    order = ("c", "p", "w", "n", "t", "l", "k", "x")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unescape = escaper(controls)
        for batch in batches:
            rows = []
            convs = batch.column(0)
            for number, whole, text, marks in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                turns = read_turns(text, unescape, controls)
                said = "".join(f"{role}\n{body}\n" for role, body in turns).encode()
                learnt = "".join(unescape(text[m["start"] : m["end"]]) for m in marks)
                row = (len(turns), said, learnt.encode(), len(learnt), len(text))
                if whole:
                    d = _Digest()
                    d.add(*row)
                    row = (d.n, d.turns.digest(), d.learnt.digest(), d.loss, d.chars)
                rows.append((number, whole, *row))
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([convs, *(pa.array(c, t) for c, t in zip(columns, types))], names=list(order))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, conv, digest = None, None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            if schema is None:
                names = (conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
                kinds = (batch.schema.field("c").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                schema = pa.schema(list(zip(names, kinds)))
            rows = []
            for c, whole, n, turns, learnt, loss, chars in zip(*(batch.column(x).to_pylist() for x in ("c", "w", "n", "t", "l", "k", "x"))):
                if digest is not None and (whole or c != conv):
                    rows.append(digest.row(conv))
                    digest = None
                if whole:
                    rows.append((c, n, turns.hex(), loss, learnt.hex(), chars))
                    continue
                digest, conv = digest or _Digest(), c
                digest.add(n, turns, learnt, loss, chars)
            if rows:
                yield made(rows)
        if digest is not None:
            yield made([digest.row(conv)])

    narrow = parts.select(conv_col, "part", "is_whole", "formatted", "marks")
    pieces = narrow.mapInArrow(read, f"c {conv_type}, p bigint, w boolean, n bigint, t binary, l binary, k bigint, x bigint")
    together = pieces.repartition("c").sortWithinPartitions("c", "p")
    schema = f"`{conv_col}` {conv_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return together.mapInArrow(fold, schema)
