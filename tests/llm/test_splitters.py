"""Shards: near-equal bytes, gapless slots, the same result from other partitions."""

import zlib

import pytest
from cases import SCHEMA, documents, frame
from pyspark.sql import functions as F

from stratalens.llm import splitters


def rows_of(texts):
    return [(i, t, None, None, None) for i, t in texts]


CASES = {
    "documents": documents() + [(None, "x", None, None, None), (None, None, None, None, None)],
    "one id for all": rows_of((7, "t" * (i % 50)) for i in range(3000)),
    "one row repeated": rows_of((7, "same") for _ in range(2000)) + rows_of((i, "y") for i in range(500)),
    "one huge": rows_of([(3, "z" * 200_000), *((i, "abc") for i in range(400))]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_shards(spark, name):
    rows, shards = CASES[name], 7
    results = []
    for partitions in (1, 4):
        df = frame(spark, rows, extra=["shard", "n", "range"]).repartition(partitions)
        got = splitters.assign_shards(splitters.measured(df), shards, oversample=8).collect()
        results.append(sorted(map(str, got)))
    assert results[0] == results[1]
    assert sorted((str(r.doc_id), r.text_crc32, r["size"]) for r in got) == sorted(
        (str(i), zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t, *_ in rows)
    size, slots = [0] * shards, {}
    for r in got:
        size[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in got)
    assert all(abs(s - sum(size) / shards) <= largest for s in size)
    order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_overfull_ranges_are_subdivided(spark):
    df = frame(spark, rows_of((i, "q") for i in range(5000)))
    keys = splitters.measured(df).groupBy(*splitters.KEY).count().withColumnRenamed("count", "n")
    _, found = splitters.split_ranges(keys, 20, oversample=1)
    assert max(n for *_, n in found) <= 2 * 5000 / 20


def test_write_and_empty(spark, tmp_path):
    df = frame(spark)
    splitters.write_shards(df, splitters.assign_shards(splitters.measured(df), 5), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == df.count() and back.select("shard").distinct().count() == 5
    assert splitters.assign_shards(splitters.measured(spark.createDataFrame([], SCHEMA)), 5).count() == 0


def test_very_many_copies_of_one_key(spark):
    """Copies are made in runs by several tasks, and no row holds an array of all of them."""
    n = 40 * splitters.COPY_RUN + 5
    keys = spark.createDataFrame([(1, 5, 10, n), (2, 6, 10, 3)], "doc_id long, text_crc32 long, size long, n long")
    made = splitters._copies(keys, keys)
    spread = made.where("doc_id = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 3
    got = made.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_distinct("copy").alias("own"), F.min("copy"), F.max("copy")).collect()
    assert sorted(tuple(r) for r in got) == [(1, n, n, 0, n - 1), (2, 3, 3, 0, 2)]


def test_shards_of_copies_in_runs(spark, monkeypatch):
    monkeypatch.setattr(splitters, "COPY_RUN", 7)
    df = frame(spark, CASES["one row repeated"])
    cut = splitters.assign_shards(splitters.measured(df), 5).collect()
    monkeypatch.setattr(splitters, "COPY_RUN", 1 << 14)
    assert sorted(map(str, cut)) == sorted(map(str, splitters.assign_shards(splitters.measured(df), 5).collect()))
