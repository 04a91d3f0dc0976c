"""Token counts from flat, unindexed token files by a scan for end-of-document ids.

A file is nothing but token ids of fixed width.  ``count_tokens`` cuts it into blocks, finds
the end ids of each block with one vectorised comparison and keeps their positions.  A
document may start blocks before it ends, so each block then gets the position of the last
end id and the number of end ids before it: a prefix scan over one small row per block.
The first document of a block starts behind that carried position, all others behind their
predecessor.

``write_flat`` makes such files from texts, one per task, with the ids of the documents as
a table beside them.

Defined results: NULL and empty texts are documents of one token, the end id.  Ids behind
the last end id of a file are a document with ``complete`` false.  Empty files and empty
folders have no documents.  A file whose size is no multiple of the width is an error.
Repeated rows and NULL ids stay separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shared import one_task_each, open_folder
from .word_tokens import encoder, slices

BLOCKS = "file string, block long, n_ends long, last_end long, ends array<long>, size long"


def write_flat(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 2,
) -> DataFrame:
    """Write one token file per task and return (file, ordinal, doc_id), also written.

    The end id's own string in a text is ordinary text.  A task writes under a temporary
    name and renames, and a repeated task writes the same bytes under the same name.
    """
    kind = f"<u{width}"

    def write(batches):
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}.bin"
        system, folder = open_folder(path)
        system.create_dir(folder, recursive=True)
        hidden, code, ordinal = f"{folder}/_temporary-{task.taskAttemptId()}-{name}", encoder(tokenizer, True, kind), 0
        with system.open_output_stream(hidden, compression=None) as out:
            for batch in batches:
                for texts in slices(batch.column(1)):
                    out.write(code.closed_ids(texts, end_id)[0].tobytes())
                rows = len(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * rows, pa.string()), pa.array(np.arange(ordinal, ordinal + rows)), batch.column(0)],
                    names=["file", "ordinal", "doc_id"],
                )
                ordinal += rows
        system.move(hidden, f"{folder}/{name}")

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return materialise(rows.mapInArrow(write, "file string, ordinal long, doc_id long"))


def count_tokens(
    spark: SparkSession, path: str, files: DataFrame, end_id: int, *, width: int = 2, block_tokens: int = 4 << 20
) -> DataFrame:
    """(file, ordinal, start, n_tokens, complete) of every document in the named files, end ids counted.

    ``files`` has a column ``file``: names below ``path``.
    """
    kind = np.dtype(f"<u{width}")

    def sizes(batches):
        system, folder = open_folder(path)
        for pdf in batches:
            found = system.get_file_info([f"{folder}/{n}" for n in pdf["file"]]) if len(pdf) else []
            if any(x.size % width for x in found):
                raise ValueError(f"a token file is no multiple of {width} bytes")
            yield pd.DataFrame({"file": pdf["file"], "size": [x.size // width for x in found]})

    def scan(batches):
        system, folder = open_folder(path)
        for pdf in batches:
            rows = []
            for name, block, size in zip(pdf["file"], pdf["block"], pdf["size"]):
                first = int(block) * block_tokens
                with system.open_input_file(f"{folder}/{name}") as file:
                    data = file.read_at(min(block_tokens, size - first) * width, first * width)
                ends = np.flatnonzero(np.frombuffer(data, dtype=kind) == end_id) + first
                rows.append((name, block, len(ends), int(ends[-1]) if len(ends) else None, ends, size))
            yield pd.DataFrame(rows, columns=["file", "block", "n_ends", "last_end", "ends", "size"]).astype({"last_end": "Int64"})

    blocks = (
        one_task_each(materialise(files.select("file").distinct())).mapInPandas(sizes, "file string, size long").where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / block_tokens))))
    )
    found = materialise(one_task_each(materialise(blocks)).mapInPandas(scan, BLOCKS))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        "file", "block",
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("carry"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("ordinal"),
    )
    ends = found.select("file", "block", "ends").join(carried, ["file", "block"]).select(
        "file", "ordinal", F.concat(F.array("carry"), "ends").alias("edges")
    )
    complete = ends.select("file", "ordinal", "edges", F.posexplode(F.slice("edges", 2, 2**31 - 1)).alias("i", "end")).select(
        "file",
        (F.col("ordinal") + F.col("i")).alias("ordinal"),
        (F.get("edges", F.col("i")) + 1).alias("start"),
        (F.col("end") - F.get("edges", F.col("i"))).alias("n_tokens"),
        F.lit(True).alias("complete"),
    )
    rest = found.groupBy("file").agg(
        F.sum("n_ends").alias("ordinal"), (F.coalesce(F.max("last_end"), F.lit(-1)) + 1).alias("start"), F.max("size").alias("size")
    ).where("start < size").select("file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete"))
    return complete.union(rest)
