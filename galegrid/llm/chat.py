"""Chat formatting: conversations rendered by a compiled template, and read back.

`formatted` renders each conversation as a stream of pieces, marked where a model learns to
write. Control strings inside roles and texts are escaped, so that no text can end its turn or
open another, and `read_back` gives the same turns again from the formatted text alone.

Conversations are dealt by key and sorted by turn; each task then goes through its rows once and
holds one turn. A conversation of any length is bounded by its longest turn. It stays in one
task, as its hash runs over its turns in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that mean something to one of the usual templates.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for message in messages -%}"
    + START
    + "{{ message.role | escape_name }}\n"
    + "{%- if message.role == 'assistant' %}{{ '\\n' }}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    + "{% else %}{{ '\\n' ~ (message.text | escape) }}{% endif -%}"
    + END
    + "{{ '\\n' }}{% endfor %}"
)
_PLAIN = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    """Put a backslash behind the first character of each control string.

    One that has backslashes there already gets one more, so `unescape` always finds the way back.
    """
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_name(name: str) -> str:
    """As `escape`, for a role: line ends become `\\n`, and backslashes double."""
    return escape(name.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_name(name: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))


FILTERS = {"escape": escape, "escape_name": escape_name}


def pieces(turns: Iterable[tuple[str, str]], template: str = TEMPLATE) -> Iterator[tuple[str, bool]]:
    """The rendering of (role, text) turns."""
    render = compile_template(template, FILTERS)
    yield from render(messages=({"role": r, "text": t} for r, t in turns))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 500).columns))


def _sent(rows: Iterator[tuple], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def formatted(
    conversations: DataFrame,
    template: str = TEMPLATE,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Rows (key, part, piece, learned): the pieces of each conversation, part counting from 0.

    The pieces of a conversation follow each other in one partition. Turns go by `turn`, equal
    ones by role and text; a null turn comes first, a null role or text is empty. Rows with a null
    key are one conversation.
    """
    compile_template(template, FILTERS)  # an error is raised here, not in a task
    columns = [F.col(f"`{c}`") for c in (key, turn, role, text)]
    named = conversations.select(*[c.alias(n) for c, n in zip(columns, ("k", "turn", "role", "text"))])
    filled = named.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
    dealt = filled.repartition("k").sortWithinPartitions("k", "turn", "role", "text").select("k", "role", "text")
    schema = pa.schema([("k", pa.int64()), ("part", pa.int64()), ("piece", pa.string()), ("learned", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)

        def out() -> Iterator[tuple]:
            for k, rows in groupby(_rows(batches), key=lambda r: r[0]):
                made = render(messages=({"role": r, "text": t} for _, r, t in rows))
                for part, (piece, learned) in enumerate(made):
                    yield k, part, piece, learned

        yield from _sent(out(), schema)

    made = dealt.select(F.col("k").cast("bigint"), "role", "text").mapInArrow(
        run, "k bigint, part bigint, piece string, learned boolean"
    )
    return made.withColumnRenamed("k", key)


def turns_of(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, from pieces of formatted text cut anywhere."""
    held: list[str] = []
    tail = ""
    for part in parts:
        held.append(part)
        # The end of a turn may lie across pieces; only the last few characters matter for that.
        look = tail + part
        tail = look[-len(END) :]
        if END not in look:
            continue
        rest = "".join(held)
        while (end := rest.find(END + "\n")) >= 0:
            yield _turn(rest[:end])
            rest = rest[end + len(END) + 1 :]
        held, tail = [rest], rest[-len(END) :]
    rest = "".join(held)
    while (end := rest.find(END + "\n")) >= 0:
        yield _turn(rest[:end])
        rest = rest[end + len(END) + 1 :]
    if rest:
        raise ValueError(f"{len(rest)} characters after the last turn")


def _turn(marked: str) -> tuple[str, str]:
    if not marked.startswith(START):
        raise ValueError(f"no turn starts at {marked[:20]!r}")
    role, line, text = marked[len(START) :].partition("\n")
    if not line:
        raise ValueError("a turn without a line for its role")
    return unescape_name(role), unescape(text)


def read_back(rendered: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation what its formatted text holds, from the rows of `formatted`.

    n_turns, turns_sha256 (role, line end, text, line end of each turn), loss_chars and
    loss_sha256 (the unescaped text that is learned), formatted_chars.
    """
    schema = pa.schema(
        [(key, pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for k, rows in groupby(_rows(batches), key=lambda r: r[0]):
                whole, learned, held = hashlib.sha256(), hashlib.sha256(), []
                count = {"turns": 0, "loss": 0, "all": 0}

                def close() -> None:
                    # A learned span ends: it is unescaped as one text.
                    span = unescape("".join(held))
                    held.clear()
                    learned.update(span.encode("utf-8"))
                    count["loss"] += len(span)

                def texts() -> Iterator[str]:
                    for _, piece, flag in rows:
                        count["all"] += len(piece)
                        if flag:
                            held.append(piece)
                        elif held:
                            close()
                        yield piece

                for role, text in turns_of(texts()):
                    whole.update(f"{role}\n{text}\n".encode("utf-8"))
                    count["turns"] += 1
                if held:
                    close()
                yield k, count["turns"], whole.hexdigest(), count["loss"], learned.hexdigest(), count["all"]

        yield from _sent(out(), schema)

    kinds = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rendered.select(key, "piece", "learned").mapInArrow(run, f"`{key}` bigint, {kinds}")
