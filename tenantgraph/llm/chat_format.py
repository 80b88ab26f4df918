"""Conversations through the template compiler, dealt by conversation and streamed turn by turn.

Rows are dealt by conversation and sorted by turn; a task never holds more than one turn and an Arrow batch, however long
the conversation. A digest over all turns of one conversation is sequential by its nature, so a conversation isn't split;
its rendering and reading are streamed instead.

Defined results: a null text or role is empty. Ties in turn go by role, then text; null turns come first. Rows with a
null conversation form one. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantgraph.llm.chat_template import Reader, formatter


def ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _stream(batches: Iterator[pa.RecordBatch], of: Callable[[int | None, Iterator[dict]], Iterator[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs `of` over each conversation's messages and collects its rows into batches of a few megabytes at most."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    held, size = [], 0
    for conv, turns in groupby(rows(), key=lambda r: r[0]):
        for row in of(conv, ({"turn": t, "role": role, "text": text} for _, t, role, text in turns)):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 1 << 21:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, piece, text, under_loss): the formatted text of each conversation in pieces, in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("under_loss", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, _ = formatter()
        return _stream(batches, lambda conv, messages: ((conv, i, text, loss) for i, (text, loss) in enumerate(template.render(messages=messages)) if text), schema)

    return ordered(conversations).mapInArrow(run, "conv_id long, piece long, text string, under_loss boolean")


def read_back(conversations: DataFrame) -> DataFrame:
    """One row per conversation: counts and digests of the turns and of the text under the loss, read back from the formatted text."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def digest(conv: int | None, pieces: Iterator[tuple[str, bool]]) -> tuple:
        _, escaper = formatter()
        reader = Reader(escaper)
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = 0
        for text, under in pieces:
            chars += len(text)
            for role, said in reader.feed(text):
                n += 1
                turns.update(f"{role}\n{said}\n".encode())
            if under:
                own = escaper.unescape(text)
                loss_chars += len(own)
                loss.update(own.encode())
        reader.close()
        return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, _ = formatter()
        return _stream(batches, lambda conv, messages: iter([digest(conv, template.render(messages=messages))]), schema)

    return ordered(conversations).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
