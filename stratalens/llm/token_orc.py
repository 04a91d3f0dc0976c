"""Token ids in ORC files: ordered by document id, with row indexes and Bloom filters.

``write_tokens`` sorts documents into ranges of their id, encodes them and writes one row
per document, ``ids array<int>``, which ORC stores as run-length encoded integers in
stripes.  Row indexes hold the least and largest id of every ``row_index_stride`` rows,
Bloom filters the ids themselves, so a lookup reads few row groups and a scan is split at
stripes.  A row also holds the tokens before it in its own file; ``read_tokens`` adds the
totals of the files before it.

Defined results: NULL text counts as empty and gets the end id alone.  Rows with equal ids
stay separate, ordered by a hash of the text; NULL ids come first.  An empty table gives
an empty file set that reads back as no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import batch_rows, free_memory, lean, running_offsets
from .word_tokens import encoder, slices

SCHEMA = "doc_id long, part int, before long, n_tokens int, ids array<int>"
# A worker holds the texts of one batch at a time.
BATCH_ROWS = 1000


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 1,
    stripe_bytes: int = 64 << 20,
    row_index_stride: int = 1000,
    bloom_fpp: float = 0.01,
    slice_bytes: int = 1 << 20,
    **bounds: int,
) -> None:
    """Encode ``text_column`` with a blank-dropping tokenizer file and write ORC below ``path``.

    ``slice_bytes`` of text at a time and ``bounds`` (``most_words``, ``most_cores``) of a worker's tables trade memory for time only.
    """
    kind = pa.schema([
        ("doc_id", pa.int64()), ("part", pa.int32()), ("before", pa.int64()),
        ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32())),
    ])

    def encode(batches):
        code, part, before = encoder(tokenizer, False, **bounds), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), slice_bytes):
                ids, lengths = code.closed_ids(texts, end_id)
                ends = np.cumsum(lengths)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(np.full(len(texts), part, dtype=np.int32)),
                     pa.array(before + ends - lengths), pa.array(lengths.astype(np.int32)),
                     pa.ListArray.from_arrays(offsets, pa.array(ids.view("<i4")))],
                    schema=kind,
                )
                at, before = at + len(texts), before + int(ends[-1])
            free_memory()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ranges = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        (
            ranges.mapInArrow(encode, SCHEMA)
            .write.option("orc.stripe.size", stripe_bytes)
            .option("orc.row.index.stride", row_index_stride)
            .option("orc.bloom.filter.columns", "doc_id")
            .option("orc.bloom.filter.fpp", bloom_fpp)
            .orc(path)
        )


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as written.  A filter on ``doc_id`` is checked against row indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document in the files: (doc_id, start, n_tokens, ids); ``start`` counts the ids of all before it.

    The driver adds up one number per file written and sends these sums, never more, to the executors.
    """
    rows = token_files(spark, path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).collect()
    found = np.array(running_offsets([(x.part, x.tokens) for x in totals]), dtype=np.int64).reshape(-1, 2)
    # An Arrow table: a list of rows would go through Python workers of another kind, which then idle in each executor.
    offsets = spark.createDataFrame(pa.table({"part": pa.array(found[:, 0].astype(np.int32)), "offset": pa.array(found[:, 1])}))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def with_checksum(rows: DataFrame, ids: str = "ids", into: str = "ids_crc32") -> DataFrame:
    """Replace a column of ids by the CRC-32 of them as little-endian unsigned 32-bit integers."""
    kept = [c for c in rows.columns if c != ids]
    schema = rows.select(*kept, F.lit(0).cast("long").alias(into)).schema

    def checksums(batches):
        for batch in batches:
            lists = batch.column(len(kept))
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).view(np.uint8)
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            sums = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(sums, pa.int64())], names=[*kept, into]
            )

    return rows.select(*kept, ids).mapInArrow(lean(checksums), schema)
