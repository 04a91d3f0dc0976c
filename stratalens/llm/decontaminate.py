"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The symbols are words.  A benchmark item gives every run of ``window`` words as a
pattern, or the whole item if it is shorter.  Patterns of one length form one table:

* the shift table says, for a block of two neighbouring words, how far a window can move
  before it can end with a pattern; a block that is in no pattern lets it skip all but one
  of the window's words,
* where the shift is zero, the block is the end of some patterns, and the bucket of that
  end holds them,
* a direct comparison of the words confirms or refutes each.

Documents are scanned where they lie: no shuffle, no join.  Patterns travel to the
executors in chunks of at most ``chunk`` windows, whose number is counted before; a larger
benchmark is scanned in several passes over numbered rows, whose hits are joined to the rows once.

Defined results: NULL or empty text has no words and no hits.  Rows with the same item id
are one item; an item without words has no pattern.  NULL item ids are left out.  Rows and columns of
the documents stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .shared import drop_worker_tables, free_memory

# ASCII other than letters and digits parts words; A to Z become a to z.
_CUTS = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)
# The same words for the JVM; A to Z are letters there.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PATTERNS = "window string, items array<string>"
HITS = "n_words long, n_hit long, spans array<long>, items array<string>"


def search_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, A to Z in lower case."""
    return text.encode().translate(_CUTS).split() if text else []


class WuManber:
    """Tables for patterns of one length, each a tuple of words."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]], length: int):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple]] = {}
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets.setdefault(pattern[length - self.block:], []).append(pattern)

    def find(self, text: list[bytes]) -> list[tuple[int, tuple]]:
        """(start, pattern) of every occurrence."""
        found, length, block, far = [], self.length, self.block, self.far
        shift, end, last = self.shift.get, length, len(text)
        while end <= last:
            key = (text[end - 2], text[end - 1]) if block == 2 else (text[end - 1],)
            step = shift(key, far)
            if step == 0:
                start = end - length
                seen = tuple(text[start:end])
                found.extend((start, p) for p in self.buckets[key] if p == seen)
                step = 1
            end += step
        return found


def windows(benchmark: DataFrame, *, id_column: str = "item_id", text_column: str = "text", window: int = 10) -> DataFrame:
    """Distinct windows of all items, words joined by a blank, with the items that have them."""

    def cut(batches):
        for pdf in batches:
            rows = []
            for item, text in zip(pdf["item"], pdf["text"]):
                w = [x.decode() for x in search_words(text)]
                runs = {" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else ()
                rows.extend((r, item) for r in runs)
            yield pd.DataFrame(rows, columns=["window", "item"])

    named = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    runs = named.where("item IS NOT NULL").mapInPandas(cut, "window string, item string")
    return runs.groupBy("window").agg(F.collect_set("item").alias("items"))


def _scan(patterns: list[tuple[str, list[str]]]):
    """A column function that finds the hits of these patterns."""

    @F.pandas_udf(HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        drop_worker_tables()
        owners = {tuple(w.encode() for w in p.split(" ")): i for p, i in patterns}
        by_length: dict[int, list[tuple]] = {}
        for p in owners:
            by_length.setdefault(len(p), []).append(p)
        tables = [WuManber(p, n) for n, p in sorted(by_length.items())]
        for texts in batches:
            rows = []
            for text in texts:
                w = search_words(text)
                found = [(start, start + t.length, p) for t in tables for start, p in t.find(w)]
                merged = _union([(a, b) for a, b, _ in found])
                names = {i for _, _, p in found for i in owners[p]}
                rows.append((len(w), sum(b - a for a, b in merged), [x for s in merged for x in s], sorted(names)))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "spans", "items"])
        free_memory()

    return scan


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((int(a), int(b)))
    return merged


def mark_hits(
    docs: DataFrame,
    patterns: DataFrame,
    *,
    text_column: str = "text",
    into: str = "hits",
    chunk: int = 200_000,
) -> DataFrame:
    """Add ``into``: struct(n_words, n_hit, spans, items).

    ``spans`` lists first and one past the last word of each hit run; ``items`` the items,
    in order, with a window in the text.  ``chunk`` is the most windows sent out at once.
    """
    patterns = materialise(patterns)
    passes = max(1, -(-patterns.count() // chunk))
    part = lambda k: _scan([(x.window, x["items"]) for x in patterns.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == k).collect()])
    if passes == 1:
        return docs.withColumn(into, part(0)(F.col(text_column)))
    # Rows are numbered and written once, whatever the number of passes; a pass writes its hits only.
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()))
    hits = [
        materialise(rows.select("__row", part(k)(F.col(text_column)).alias("hit")).where("hit.n_hit > 0").select("__row", "hit.spans", "hit.items"))
        for k in range(passes)
    ]
    merged = reduce(DataFrame.union, hits).groupBy("__row").agg(
        F.flatten(F.collect_list("spans")).alias("__spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items")
    ).withColumn("__spans", _merged(F.col("__spans")))
    found = F.struct(
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("__spans.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__spans.spans", F.array().cast("array<long>")).alias("spans"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
    )
    return rows.join(merged, "__row", "left").withColumn(into, found).select(*docs.columns, into)


def _merged(spans: Column) -> Column:
    """The union of spans that several passes found in one text."""

    @F.pandas_udf("n_hit long, spans array<long>")
    def merge(rows: pd.Series) -> pd.DataFrame:
        found = [_union([*zip(s[::2], s[1::2])]) for s in rows]
        return pd.DataFrame({"n_hit": [sum(b - a for a, b in m) for m in found], "spans": [[x for s in m for x in s] for m in found]})

    return merge(spans)
