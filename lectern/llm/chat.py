"""Chat formatting: conversations rendered by a compiled template, with the loss under generation markers.

The turns of a conversation are brought together and sorted by a shuffle, then streamed: each
task renders its conversations turn by turn and writes pieces of about ``PIECE``
characters, so a conversation of any length needs the memory of its longest turn.

Control strings inside texts are escaped by one backslash behind their first
character; a control string that already has backslashes there gets one more, so
``unescape`` is the exact inverse.

A null role or text is empty.  Turns that tie are ordered by role and text, repeated
rows are kept.  Rows without a conversation form one of their own.  Columns
other than the four named ones are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm.template import compile_template

PIECE = 1 << 16

TEMPLATE = """\
{%- for m in messages -%}
  {%- if m.role == 'user' -%} [INST]{{ m.text | escape }}[/INST]
  {%- elif m.role == 'assistant' -%} <s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>
  {%- elif m.role == 'system' -%} <<SYS>>{{ m.text | escape }}<</SYS>>
  {%- else -%} <<ROLE>>{{ m.role | escape }}<</ROLE>>{{ m.text | escape }}<</TURN>>
  {%- endif -%}
{%- endfor -%}
"""
_CONTROL = r"([\[<])(\\{})(/?INST\]|/?s>|</?(?:SYS|ROLE|TURN)>>)"
_PLAIN, _ESCAPED = re.compile(_CONTROL.format("*")), re.compile(_CONTROL.format("+"))
_TURN = re.compile(
    r"\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<text>.*?)<</TURN>>", re.S,
)


def escape(text: str | None) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def format_conversations(
    df: DataFrame, conversation: str, turn: str, role: str, text: str, template: str = TEMPLATE
) -> DataFrame:
    """Pieces of each rendered conversation, in order within a partition.

    (conversation, piece, text, generated: spans of its characters, last: the conversation ends here).
    """
    compile_template(template, {"escape": escape})  # a wrong template fails here, not in a task
    names = {conversation: "conversation", turn: "turn", role: "role", text: "text"}
    turns = df.select(*[F.col(k).alias(v) for k, v in names.items()])
    turns = turns.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")
    schema = T.StructType().add("conversation", df.schema[conversation].dataType).add("piece", "long").add("text", "string")
    span = T.StructType().add("start", "long").add("end", "long")
    schema = schema.add("generated", T.ArrayType(span)).add("last", "boolean")
    arrow = to_arrow_schema(schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template, {"escape": escape})
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("conversation", "role", "text")]))
        held, size = [], 0
        for name, own in groupby(rows, key=lambda r: r[0]):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in own)
            for piece in _pieces(name, compiled({"messages": messages})):
                held.append(piece)
                size += len(piece["text"])
                if size >= 16 * PIECE or len(held) >= 5000:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return turns.mapInArrow(render, schema)


def _pieces(name: object, fragments: Iterator[tuple[str, bool]]) -> Iterator[dict]:
    number, parts, spans, size = 0, [], [], 0
    for text, generated in fragments:
        if size >= PIECE:
            yield {"conversation": name, "piece": number, "text": "".join(parts), "generated": spans, "last": False}
            number, parts, spans, size = number + 1, [], [], 0
        if generated:
            spans.append({"start": size, "end": size + len(text)})
        parts.append(text)
        size += len(text)
    yield {"conversation": name, "piece": number, "text": "".join(parts), "generated": spans, "last": True}


def read_back(pieces: Iterator[tuple[str, list[dict]]]) -> Iterator[tuple[str, object]]:
    """("turn", (role, text)) and ("loss", text) of one conversation rendered with ``TEMPLATE``."""
    left = ""
    for text, spans in pieces:
        for span in spans:
            yield "loss", unescape(text[span["start"] : span["end"]])
        left += text
        end = 0
        for m in _TURN.finditer(left):
            if m.start() != end:
                raise ValueError("text between turns")
            if m["role"] is not None:
                yield "turn", (unescape(m["role"]), unescape(m["text"]))
            else:
                yield "turn", (m.lastgroup, unescape(m[m.lastgroup]))
            end = m.end()
        left = left[end:]
    if left:
        raise ValueError("a turn is not ended")


def digests(pieces: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: turns, text under the loss, sizes.

    ``pieces`` must come straight from ``format_conversations``, in its order.
    """
    schema = T.StructType().add("conversation", pieces.schema["conversation"].dataType).add("n_turns", "long")
    schema = schema.add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string")
    schema = schema.add("formatted_chars", "long")
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("conversation", "text", "generated", "last")]))
        held = []
        for name, own in groupby(rows, key=lambda r: r[0]):
            turns, loss, size = hashlib.sha256(), hashlib.sha256(), 0
            n = loss_chars = 0

            def counted(own=own):
                nonlocal size
                for _, text, spans, _ in own:
                    size += len(text)
                    yield text, spans

            for kind, value in read_back(counted()):
                if kind == "turn":
                    n += 1
                    turns.update(f"{value[0]}\n{value[1]}\n".encode())
                else:
                    loss_chars += len(value)
                    loss.update(value.encode())
            held.append({
                "conversation": name, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": size,
            })
            if len(held) >= 5000:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return pieces.mapInArrow(digest, schema)
