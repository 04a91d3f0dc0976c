"""Chat formatting: conversations rendered by a compiled template, and read back.

The template (``chat_template``) is compiled once per task into closures.  Blocks of turns are rendered
apart, since a turn depends on its own message and place only; places come from a count per
block.  The output has one row per page: text, and the spans a model is to learn.

Control strings begin with ``<|``.  The filter ``escape`` puts a backslash more between
these two characters wherever they meet in a text, so a text cannot open or close a turn, and
taking it out gives the text back.  Roles are put on one line first.

Defined results: NULL text and NULL role are empty.  NULL conversation ids are one
conversation.  Turns without number come first; rows of one turn stand by role, then text, and
repeated rows are turns each.  An empty table gives no page.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .chat_template import Template, many_lines, unescape
from .turns import arrow_schema, block_heads, block_of, in_order, record_batches, runs

START, END = "<|im_start|>", "<|im_end|>"
CHAT = (
    "{% for message in messages %}"
    + START + "{{ message.role | line | escape }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.content | escape }}{% endgeneration %}"
    "{% else %}{{ message.content | escape }}{% endif %}"
    + END + "\n{% endfor %}"
)
PAGES = "conv_id long, block long, page int, text string, marks array<long>"
TURNS = "conv_id long, block long, page int, place int, role string, text string"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def render(
    conversations: DataFrame,
    source: str = CHAT,
    *,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    page_characters: int = 1 << 20,
) -> DataFrame:
    """Pages (conv_id, block, page, text, marks) of all conversations, written once.

    ``marks`` holds the first and one past the last code point of each span to learn.  A page ends behind the turn that
    brings it to ``page_characters``.
    """
    Template(source)  # fails here, not in a task
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(conv_column).cast("long").alias("conv_id"), block_of(F.col(turn_column)).alias("block"), F.col(turn_column).cast("long").alias("turn"),
        text(role_column).alias("role"), text(text_column).alias("text"),
    )
    none = F.lit(None)
    heads = block_heads(rows).select("conv_id", "block", F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                                     none.cast("string").alias("role"), none.cast("string").alias("text"), "before", "total")
    turns = rows.select("conv_id", "block", F.lit(1).alias("kind"), "turn", "role", "text", none.cast("long").alias("before"), none.cast("long").alias("total"))
    ordered = in_order(heads.unionByName(turns), ["conv_id", "block"], ["kind", "turn", "role", "text"])
    schema = arrow_schema(PAGES)

    def write(batches):
        template = Template(source)

        def pages():
            for (conv_id, block), found in runs(batches, 2):
                *_, before, total = next(found)
                turns = ((row[4], row[5]) for row in found)
                for number, page in enumerate(template.pages(turns, before, total, page_characters)):
                    yield conv_id, block, number, "".join(page.parts), [x for mark in page.marks for x in mark]

        yield from record_batches(pages(), schema)

    return materialise(ordered.mapInArrow(write, PAGES))


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn on a page of the standard template."""
    at = 0
    while at < len(text):
        line, end = text.index("\n", at), text.index(END, at)
        if not text.startswith(START, at) or line > end:
            raise ValueError(f"no turn at {at}")
        yield many_lines(unescape(text[at + len(START):line])), unescape(text[line + 1:end])
        at = end + len(END) + 1


def turns(pages: DataFrame) -> DataFrame:
    """The turns as they stand on the pages, unescaped; no shuffle."""
    schema = arrow_schema(TURNS)

    def read(batches):
        def rows():
            for batch in batches:
                for conv_id, block, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                    for place, (role, content) in enumerate(read_turns(text)):
                        yield conv_id, block, page, place, role, content

        yield from record_batches(rows(), schema)

    return pages.select("conv_id", "block", "page", "text").mapInArrow(read, TURNS)


def digests(pages: DataFrame) -> DataFrame:
    """Counts and SHA-256 sums per conversation, from its pages in order.

    A sum runs over its text from the first to the last character, so one task reads the pages of a
    conversation one after the other; it holds one page.
    """
    schema = arrow_schema(DIGESTS)

    def read(batches):
        def rows():
            for (conv_id,), found in runs(batches, 1):
                n, loss_chars, chars = 0, 0, 0
                whole, loss = hashlib.sha256(), hashlib.sha256()
                for *_, text, marks in found:
                    chars += len(text)
                    for role, content in read_turns(text):
                        n += 1
                        whole.update(f"{role}\n{content}\n".encode())
                    for start, end in zip(marks[::2], marks[1::2]):
                        learnt = unescape(text[start:end])
                        loss_chars += len(learnt)
                        loss.update(learnt.encode())
                yield conv_id, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

        yield from record_batches(rows(), schema)

    return in_order(pages.select("conv_id", "block", "page", "text", "marks"), ["conv_id"], ["block", "page"]).mapInArrow(read, DIGESTS)
