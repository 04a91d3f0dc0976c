import math
import random

import pytest
from pyspark.sql import functions as F

from stratalens.functions.distribution import (
    collapse,
    count_stable,
    earth_mover,
    first_positive,
    is_complete,
    levels,
    percentages,
    with_moments,
)
from stratalens.operators.counts import derived_total, lower_band, net_gain, records_to_counts
from stratalens.operators.moments import entity_moments, performance_score
from stratalens.scales import EARLY_READING, READING_7, SEVEN_TO_THREE

ARRAYS = "id int, counts array<double>"


def moments_of(spark, rows, **options):
    df = spark.createDataFrame([(i, [float(x) if x is not None else None for x in r]) for i, r in enumerate(rows)], ARRAYS)
    shares = df.withColumn("shares", percentages("counts", len(rows[0])))
    return {row["id"]: row for row in with_moments(shares, len(rows[0]), **options).collect()}


def test_golden_moments(spark):
    got = moments_of(spark, [[50, 0, 0, 0, 50], [20, 20, 20, 20, 20], [0, 0, 0, 0, 100]])
    assert (got[0].ordinal_mean, got[0].ordinal_sd, got[0].ordinal_skew) == (3, 2, 0)
    assert got[0].ordinal_kurt == pytest.approx(-2) and got[0].bimodality_coef == pytest.approx(1)
    assert got[1].ordinal_sd == pytest.approx(math.sqrt(2)) and got[1].ordinal_kurt == pytest.approx(1.7 - 3)
    assert got[1].bimodality_coef == pytest.approx(1 / 1.7)
    assert (got[2].ordinal_mean, got[2].ordinal_sd) == (5, 0)
    assert got[2].ordinal_skew is None and got[2].ordinal_kurt is None and got[2].bimodality_coef is None


def test_reference_shapes_of_the_bimodality_coefficient(spark):
    got = moments_of(spark, [[2, 3, 5, 20, 70], [18, 22, 25, 20, 15]])
    for i, p in enumerate(([0.02, 0.03, 0.05, 0.2, 0.7], [0.18, 0.22, 0.25, 0.2, 0.15])):
        mean = sum(x * w for x, w in zip(p, range(1, 6)))
        m2, m3, m4 = (sum(x * (w - mean) ** k for x, w in zip(p, range(1, 6))) for k in (2, 3, 4))
        skew, kurt = m3 / m2**1.5, m4 / m2**2
        assert got[i].ordinal_mean == pytest.approx(mean)
        assert got[i].bimodality_coef == pytest.approx((skew**2 + 1) / kurt)


def test_zero_sd_policy_and_partial_groups(spark):
    got = moments_of(spark, [[0, 7, 0], [1, None, 2], [0, 0, 0], [3, -1, 2], [1, 1, 0]], zero_sd="null_all")
    assert got[0].ordinal_mean is None and got[0].ordinal_sd is None
    assert got[1].ordinal_mean is None and got[1].shares[0] == pytest.approx(100 / 3) and got[1].shares[1] is None
    assert got[2].shares == [None] * 3 and got[3].shares == [None] * 3
    assert got[4].ordinal_mean == pytest.approx(1.5)


def test_completeness_modes(spark):
    df = spark.createDataFrame([(0, [1.0, None]), (1, [0.0, 0.0]), (2, [2.0, 3.0]), (3, [None, None])], ARRAYS)
    c = levels("counts", 2)
    rows = df.select(*[F.coalesce(is_complete(c, m), F.lit(False)).alias(m) for m in ("any", "all", "positive_sum")])
    assert [tuple(r) for r in rows.collect()] == [
        (True, False, True), (True, False, False), (True, True, True), (False, False, False)
    ]


def test_earth_mover(spark):
    pairs = [
        ([100, 0, 0, 0, 0], [0, 0, 0, 0, 100], 4), ([50, 0, 0, 0, 50], [0, 0, 100, 0, 0], 2),
        ([10, 20, 30, 20, 20], [10, 20, 30, 20, 20], 0),
    ]
    rng = random.Random(3)
    for _ in range(40):
        a, b = ([rng.random() for _ in range(5)] for _ in range(2))
        a, b = [100 * x / sum(a) for x in a], [100 * x / sum(b) for x in b]
        want = sum(abs(sum(a[:k]) - sum(b[:k])) for k in range(1, 5)) / 100
        gap = sum((x - y) * w for x, y, w in zip(a, b, range(1, 6))) / 100
        assert want >= abs(gap) - 1e-12
        pairs.append((a, b, want))
    df = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b], float(w)) for a, b, w in pairs],
                               "a array<double>, b array<double>, want double")
    for row in df.select("want", earth_mover(levels("a", 5), levels("b", 5)).alias("got")).collect():
        assert row.got == pytest.approx(row.want, abs=1e-9)


def test_collapse_seven_to_three(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]), (1, [None] * 6 + [5.0])], ARRAYS)
    rows = df.select(collapse("counts", SEVEN_TO_THREE.mapping).alias("c")).collect()
    assert rows[0].c == [1 + 2 + 8, 4 + 16, 32 + 64] and rows[1].c == [0, 0, 5]
    assert READING_7.levels[-1] == "Grade Ready"


def test_count_stability_limits(spark):
    df = spark.createDataFrame([(100.0, 125.0), (100.0, 126.0), (0.0, 5.0), (None, 5.0), (5.0, None)], "a double, b double")
    got = [r[0] for r in df.select(count_stable(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, False, False]


def test_first_positive_chain(spark):
    df = spark.createDataFrame([(5.0, 1.0, 2.0), (0.0, 1.0, 2.0), (0.0, 0.0, 0.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(first_positive([F.col("a"), F.col("b"), F.col("c")])).collect()] == [5, 1, 0]


def test_derived_total_takes_one_language_per_grade(spark):
    rows = [
        (1, "G1", None, [1.0] * 5), (1, "G2", "MT", [0.0] * 5), (1, "G2", "Fil", [2.0] * 5),
        (1, "G3", "MT", [None] * 5), (1, "G3", "Fil", [3.0] * 5), (1, "G3", "Eng", [9.0] * 5),
    ]
    df = spark.createDataFrame(rows, "entity_id int, grade string, lang string, counts array<double>")
    assert derived_total(df, ["entity_id"], 5, EARLY_READING.language_chains).first().derived_total == 5 + 10 + 15


def test_equal_weights_are_degenerate_and_missing_levels_are_left_out(spark):
    df = spark.createDataFrame([(1, [3.0, 1.0, 4.0, 1.0, 5.0]), (2, [1.0, None, 3.0, 0.0, 0.0]), (3, [0.0] * 5)], ARRAYS)
    equal = {r.id: r.performance for r in performance_score(df, ["id"], [7] * 5).collect()}
    assert equal[1] == pytest.approx(20) and equal[2] == pytest.approx(25) and equal[3] is None


def test_records_and_bands(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 3, "b"), (2, 2, "a")], "entity_id int, level int, tp string")
    counts = records_to_counts(df, ["entity_id", "tp"], F.col("level"), 3)
    got = {(r.entity_id, r.tp): r.counts for r in counts.collect()}
    assert got == {(1, "a"): [2, 0, 0], (1, "b"): [0, 0, 1], (2, "a"): [0, 1, 0]}
    assert {r.entity_id: r.lower_band for r in lower_band(counts, ["entity_id"], 3, 2).collect()} == {1: 2, 2: 1}
    gains = {r.entity_id: (r.net_gain_upper, r.net_gain_top)
             for r in net_gain(counts, "entity_id", F.col("tp") == "a", F.col("tp") == "b", 3).collect()}
    assert gains == {1: (1, 1), 2: (None, None)}


def test_group_order_does_not_matter(spark):
    rng = random.Random(5)
    rows = [(i % 3, f"g{i}", [float(rng.randint(0, 9)) for _ in range(5)]) for i in range(18)]
    schema = "entity_id int, g string, counts array<double>"
    a = entity_moments(spark.createDataFrame(rows, schema), ["entity_id"], 5)
    b = entity_moments(spark.createDataFrame(rows[::-1], schema), ["entity_id"], 5)
    left = {r.entity_id: r for r in a.collect()}
    for r in b.collect():
        assert r.ordinal_mean == pytest.approx(left[r.entity_id].ordinal_mean) and 1 <= r.ordinal_mean <= 5
