"""Reconciliation by checksums, and look-ups that read few row groups."""

import random

import pytest
from pyspark.sql import functions as F

from stratalens.operators import audit
from stratalens.sources import lake


def rows(seed, n=3000):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "a", "b"]), rng.choice([None, 1.5, -2.0]), rng.choice([None, "x", ""])) for i in range(n)]


SCHEMA = "k bigint, j string, v double, w string"


@pytest.mark.parametrize("buckets", [1, 7, 1 << 14])
def test_buckets_find_what_the_whole_comparison_finds(spark, buckets):
    left = rows(1)
    right = [(k, j, v if k % 500 else 9.0, w) for k, j, v, w in left if k % 700] + [(9000, None, None, None), (None, "a", 1.5, "x")]
    # Values that change places between columns are no equal rows.
    left, right = [*left, (9001, "a", None, "x"), (9002, None, 1.5, "a")], [*right, (9001, "a", None, None), (9002, "a", 1.5, None)]
    a, b = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (left, right))
    found, whole = (sorted(map(str, f(a, b, ["k", "j"], ["v", "w"]).collect())) for f in (lambda *x: audit.reconcile_by_buckets(*x, buckets), audit.reconcile))
    assert found == whole and len(found) > 10


def test_equal_tables_exchange_checksums_only(spark, monkeypatch):
    a = spark.createDataFrame(rows(2), SCHEMA)
    fed = []
    monkeypatch.setattr(audit, "reconcile", lambda left, right, *x: fed.append(left.count() + right.count()) or left)
    audit.reconcile_by_buckets(a, a.repartition(5).orderBy(F.desc("v")), ["k"], ["j", "v", "w"])
    assert fed == [0]
    one = a.withColumn("w", F.when(F.col("k") == 1234, "changed").otherwise(F.col("w")))
    assert [r.bucket is not None for r in audit.differing_buckets(a, one, ["k"], ["j", "v", "w"], 1 << 14).collect()] == [True]
    audit.reconcile_by_buckets(a, one, ["k"], ["j", "v", "w"])
    # One bucket of each side, which holds few keys beside the changed one.
    assert 2 <= fed[1] < 20


def test_bucket_sums_are_added_up_before_the_shuffle(spark):
    plan = audit.bucket_sums(spark.createDataFrame(rows(3), SCHEMA), ["k"], ["v"], 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan


def test_lookup_reads_few_row_groups(spark, tmp_path):
    ids = [2 * i for i in range(60_000)]
    df = spark.createDataFrame([(i, "2024-25", "x" * 20 + str(i)) for i in ids], "entity_id bigint, school_year string, name string")
    for name, lookup in (("plain", None), ("clustered", "entity_id")):
        lake.write_partitioned(df.orderBy(F.rand(3)), f"{tmp_path}/{name}", ("school_year",), lookup=lookup, group_bytes=200_000)

    def scanned(name, key):
        found = lake.read_partitioned(spark, f"{tmp_path}/{name}").where(F.col("entity_id") == key)
        got = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(got), leaf.metrics().apply("numOutputRows").value()

    assert scanned("plain", 40_000)[1] >= 20_000
    hits, read = scanned("clustered", 40_000)
    assert hits == 1 and 0 < read < 10_000
    # Odd keys lie between those that are there; only the Bloom filter can rule their row group out.
    missed = [scanned("clustered", k) for k in (20_001, 40_001, 60_001)]
    assert all(hits == 0 for hits, _ in missed) and sum(read for _, read in missed) < 20_000
