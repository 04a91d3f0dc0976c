"""Helpers shared by the operators of this package.

A word is a maximal run of characters other than the six ASCII blanks (space and
U+0009 to U+000D), which is exactly how ``bytes.split`` cuts UTF-8 text; ``lower`` on
bytes touches A to Z only.
"""

from __future__ import annotations

import ctypes
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SENT_ROWS = 1_000_000
MOST_TASKS = 20_000
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text with A to Z in lower case; NULL has none."""
    return text.encode().lower().split() if text else []


def new_folder(spark: SparkSession, label: str) -> str:
    """The name of a folder not used yet, below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as URI or plain path, and the path on it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most so many rows to Python at a time, for jobs run inside whose rows are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_TABLES: dict = {}


def worker_table(key, make: Callable):
    """What ``make`` returned for this key in this Python worker; it outlives the task, and asking for another drops it."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def free_memory() -> None:
    """Give back what this Python worker no longer uses; allocators keep it otherwise, and Spark keeps the worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def drop_worker_tables() -> None:
    """Free what an earlier operator left in this Python worker, which Spark uses again."""
    _TABLES.clear()
    free_memory()


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over batches, after which the worker gives back its memory: it may idle while other stages run."""

    def run(batches: Iterator) -> Iterator:
        drop_worker_tables()
        yield from work(batches)
        free_memory()

    return run


def one_task_each(rows: DataFrame) -> DataFrame:
    """Rows that stand for files or blocks, dealt out one by one.

    They are too small for Spark to tell how much work hangs on them; with a number given, it does not put them together.
    """
    return rows.repartition(max(1, min(rows.count(), MOST_TASKS)))


def few(df: DataFrame) -> bool:
    """Whether ``df``, of one or a few numbers per row, is small enough to be sent to every executor."""
    return df.count() <= SENT_ROWS


def only(df: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``column`` is (not, for an anti join) in ``ids``; these are sent out if they are few."""
    return df.join(F.broadcast(ids) if few(ids) else ids, column, how)


def fraction(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the values and the seed only; 52 bits of an MD5 digest."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def running_offsets(totals: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """From (part, amount) to (part, amounts of all lower parts)."""
    offsets, before = [], 0
    for part, amount in sorted(totals):
        offsets.append((part, before))
        before += amount
    return offsets


def range_index(bounds: Sequence[tuple], first: Column, *rest: Column) -> Column:
    """The number of ``bounds`` below a key, so range k holds the keys above bound k - 1 up to bound k.

    Keys are compared part by part; the first is a long, NULL lowest, the others must not be
    NULL.  ``bounds`` is sorted.  Most rows are placed by one vectorised search of the first part.
    """
    lowest = -(1 << 63)
    heads = np.array([lowest if b[0] is None else b[0] for b in bounds], dtype=np.int64)
    tails = [tuple(b[1:]) for b in bounds]

    @F.pandas_udf("int")
    def place(head: pd.Series, *tail: pd.Series) -> pd.Series:
        x = head.to_numpy(dtype=np.int64)
        low, high = np.searchsorted(heads, x, "left"), np.searchsorted(heads, x, "right")
        for i in np.flatnonzero(low < high):
            low[i] = bisect_left(tails, tuple(t.iloc[i] for t in tail), low[i], high[i])
        return pd.Series(low.astype(np.int32))

    return place(F.coalesce(first.cast("long"), F.lit(lowest)), *rest)
