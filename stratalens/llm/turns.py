"""Conversations as blocks of turns, streamed in order.

A block is a run of ``BLOCK_TURNS`` turn numbers of one conversation.  Blocks are what the
shuffle deals out, so a conversation with a third of all rows is shared by many tasks.  A task reads
the rows of its blocks in order, one after the other, and holds one block or less.  Rows of one
turn number, or without any, stand in one block; they are streamed too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_TURNS = 256
LOWEST = -(1 << 63)


def block_of(turn: Column) -> Column:
    """The number of a turn's block; turns that are NULL have one of their own, before all others."""
    return F.coalesce(F.floor(turn / BLOCK_TURNS).cast("long"), F.lit(LOWEST))


def block_heads(rows: DataFrame) -> DataFrame:
    """(conv_id, block, before, total): rows of the conversation's earlier blocks, and all of its rows.

    One row per block goes through the window, not one per turn.
    """
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    of_conversation = Window.partitionBy("conv_id")
    earlier = of_conversation.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(of_conversation).alias("total")
    )


def in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of equal ``keys`` in one task, one after the other, sorted by ``order``; NULL comes first."""
    return rows.repartition(*keys).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in (*keys, *order)))


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(values of the first ``keys`` columns, their rows) from sorted batches; rows are read as they are asked for."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, key=lambda row: row[:keys])


def record_batches(rows: Iterable[tuple], schema: pa.Schema, characters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded size."""
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if size >= characters:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))
