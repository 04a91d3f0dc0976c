"""Sharding by sampled splitters: contiguous ranges of the key with near-equal bytes.

1. Rows with the same key are counted, so a key held by very many rows is one row.
2. A sample is drawn by hash, each key with a probability in proportion to its bytes.  Its
   weighted quantiles are the splitters of ``ranges`` key ranges.
3. Every range is measured over all rows.  Ranges more than twice as full as they should
   be, by bytes or keys, are sampled again and subdivided, until none is left.
4. Bytes before each range are added up; within a range a window adds the rest, so the
   exact position of every row is known and row r goes to the shard that its middle byte
   falls into.  Shards differ by the size of a row at their borders, not by sampling error.

The sample and the ranges are bounded by ``ranges * oversample`` and ``ranges``, which the
driver holds; a range holds about ``range_rows`` keys, so ranges grow in number and not in
size.  The result depends on rows only, not on how they are partitioned.

Keys are (id, CRC-32 of the text, size).  Defined results: NULL text has no bytes and CRC-32
0; NULL ids come first; rows with equal keys are interchangeable and get neighbouring
slots, possibly across a border.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shared import MOST_TASKS, range_index, running_offsets

KEY = ("doc_id", "text_crc32", "size")
COPY_RUN = 1 << 14
ROW_OVERHEAD = 8


def key_columns(id_column: str, text_column: str) -> list[Column]:
    data = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    return [F.col(id_column).cast("long"), F.crc32(data), (F.octet_length(data) + ROW_OVERHEAD).cast("long")]


def measured(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_crc32, size) per row; size: UTF-8 bytes and ``ROW_OVERHEAD``."""
    return docs.select(*(c.alias(n) for c, n in zip(key_columns(id_column, text_column), KEY)))


def _sample(keys: DataFrame, per_byte: float, seed: int) -> list[tuple]:
    """Sorted (key, weight) of keys drawn with probability min(1, bytes * per_byte)."""
    u = F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(1 << 53)) / F.lit(float(1 << 53))
    chance = F.least(F.lit(1.0), F.col("size") * F.col("n") * F.lit(per_byte))
    drawn = keys.where(u < chance).select(*KEY, (F.col("size") * F.col("n") / chance).alias("weight")).collect()
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size)
    return [((r.doc_id, r.text_crc32, r["size"]), r.weight) for r in sorted(drawn, key=order)]


def _quantiles(sample: list[tuple], pieces: int) -> list[tuple]:
    """The keys that end the first ``pieces - 1`` of equal shares of the sample's weight."""
    total, seen, bounds = sum(w for _, w in sample), 0.0, []
    for key, weight in sample:
        before, seen = seen, seen + weight
        if int(seen * pieces / total) > int(before * pieces / total) and len(bounds) < pieces - 1:
            bounds.append(key)
    return bounds


def split_ranges(keys: DataFrame, ranges: int, *, oversample: int = 64, seed: int = 7) -> tuple[DataFrame, list]:
    """``keys`` (key, n) with a column ``range``, and per range its number, bytes and rows."""
    total = keys.agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.count("*").alias("keys")).first()
    if not total["keys"]:
        return keys.withColumn("range", F.lit(0)), []
    fair_bytes, fair_keys = total["bytes"] / ranges, total["keys"] / ranges
    bounds = _quantiles(_sample(keys, ranges * oversample / total["bytes"], seed), ranges)
    order = lambda k: (k[0] is not None, k[0] or 0, *k[1:])
    while True:
        placed = keys.withColumn("range", range_index(bounds, *map(F.col, KEY)))
        found = placed.groupBy("range").agg(
            F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows"), F.count("*").alias("keys"),
            F.min(F.struct(*KEY)).alias("first"),
        ).collect()
        full = {r.range: r for r in found if r["keys"] > 1 and max(r["bytes"] / fair_bytes, r["keys"] / fair_keys) > 2}
        # A range that one large row fills cannot come below twice the share; leave it when few keys are left.
        full = {k: r for k, r in full.items() if r["keys"] / fair_keys > 2 or r["keys"] > oversample}
        if not full:
            return placed, [(r.range, r["bytes"], r.rows) for r in found]
        seed += 1
        added = set()
        for k, r in full.items():
            pieces = 1 + int(max(r["bytes"] / fair_bytes, r["keys"] / fair_keys))
            inside = placed.where(F.col("range") == k)
            by_keys = inside.withColumn("n", F.lit(1) / F.col("size"))
            weighted = inside if r["bytes"] / fair_bytes > r["keys"] / fair_keys else by_keys
            amount = r["bytes"] if weighted is inside else r["keys"]
            upper = bounds[k] if k < len(bounds) else None
            more = [b for b in _quantiles(_sample(weighted, pieces * oversample / amount, seed), pieces) if b != upper]
            added.update(more or [tuple(r["first"])])
        bounds = sorted({*bounds, *added}, key=order)


def assign_shards(
    rows: DataFrame, shards: int, *, range_rows: int = 5_000_000, oversample: int = 64
) -> DataFrame:
    """(doc_id, text_crc32, size, shard, slot) for rows from ``measured``.

    Slots count up from 0 in each shard, in key order.
    """
    spark = rows.sparkSession
    keys = materialise(rows.groupBy(*KEY).agg(F.count("*").alias("n")))
    ranges = max(4 * shards, -(-keys.count() // range_rows))
    placed, found = split_ranges(keys, ranges, oversample=oversample)
    whole = sum(b for _, b, _ in found)
    byte_offsets = running_offsets([(k, b) for k, b, _ in found])
    row_offsets = dict(running_offsets([(k, n) for k, _, n in found]))
    offsets = spark.createDataFrame(
        [(k, b, row_offsets[k]) for k, b in byte_offsets], "range int, bytes_before long, rows_before long"
    )
    before = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.join(offsets, "range").select(
        *KEY, "n",
        (F.col("bytes_before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0))).alias("at"),
        (F.col("rows_before") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("position"),
    )
    each = _copies(keys, summed)
    sharded = materialise(each.select(
        *KEY,
        F.least(F.lit(shards - 1), F.expr(f"(2 * (at + copy * size) + size) * {shards} div {2 * max(whole, 1)}")).cast("int").alias("shard"),
        (F.col("position") + F.col("copy")).alias("position"),
    ))
    first = sharded.groupBy("shard").agg(F.min("position").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(*KEY, "shard", (F.col("position") - F.col("first")).alias("slot"))


def _copies(keys: DataFrame, summed: DataFrame) -> DataFrame:
    """Each row of ``summed`` ``n`` times, with ``copy`` from 0 on; ``keys`` has the same ``n``.

    A key with very many copies is cut into runs of ``COPY_RUN`` first, which are dealt out one by one.
    """
    number = F.col("n").cast("long")
    runs = keys.where(number > COPY_RUN).agg(F.sum(F.ceil(number / COPY_RUN))).first()[0]
    few = summed.where(number <= COPY_RUN).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
    if not runs:
        return few
    cut = summed.where(number > COPY_RUN).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((number - 1) / COPY_RUN))))
    cut = cut.repartition(min(int(runs), MOST_TASKS)).withColumn("run", F.col("run") * COPY_RUN)
    many = cut.withColumn("copy", F.explode(F.sequence(F.col("run"), F.least(number, F.col("run") + COPY_RUN) - 1))).drop("run")
    return few.unionByName(many)


def shard_ends(assigned: DataFrame) -> list[tuple]:
    """The last key of every shard but the last."""
    ends = assigned.groupBy("shard").agg(F.max(F.struct(*KEY)).alias("last")).orderBy("shard").collect()
    return [tuple(r["last"]) for r in ends[:-1]]


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write whole rows as Parquet, one folder per shard, sorted by key.

    Shards that got no rows have no folder, and numbers count the others.  Copies of one key on a border go to the lower shard.
    """
    key = key_columns(id_column, text_column)
    placed = docs.withColumn("shard", range_index(shard_ends(assigned), *key))
    placed.repartitionByRange("shard", *key).sortWithinPartitions("shard", *key).write.partitionBy("shard").parquet(path)
