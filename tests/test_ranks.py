import random

import numpy as np
import pandas as pd
import pytest

from stratalens.operators import ranks
from stratalens.operators.ranks import exact_quantiles, percentile_ranks, value_ladder, z_scores


def test_tied_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 10.0), (3, 10.0), (4, 20.0), (5, None)], "id int, x double")
    got = {r.id: r.p for r in percentile_ranks(df, {"x": "p"}).collect()}
    assert got == {1: 0.25, 2: 0.625, 3: 0.625, 4: 1.0, 5: None}


@pytest.mark.parametrize("limit", [ranks.BROADCAST_ROW_LIMIT, 0])
def test_ranks_equal_pandas_with_a_hot_value(spark, monkeypatch, limit):
    """A third of all rows share one value; with limit 0 the salted shuffle join is used."""
    monkeypatch.setattr(ranks, "BROADCAST_ROW_LIMIT", limit)
    rng = random.Random(1)
    rows = [(i, 7.0 if i % 3 == 0 else float(rng.randint(-500, 500)), rng.random()) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = percentile_ranks(df, {"x": "px", "y": "py"}).toPandas().set_index("id").sort_index()
    want = pd.DataFrame(rows, columns=["id", "x", "y"]).set_index("id").rank(pct=True)
    assert len(got) == len(rows)
    np.testing.assert_allclose(got["px"], want["x"], rtol=0, atol=1e-12)
    np.testing.assert_allclose(got["py"], want["y"], rtol=0, atol=1e-12)
    assert got["py"].mean() == pytest.approx((len(rows) + 1) / (2 * len(rows)))


def test_ladder_by_group_counts_every_row(spark):
    rows = [(i % 4, float(i * i % 97)) for i in range(2000)]
    ladder = value_ladder(spark.createDataFrame(rows, "g int, x double"), "x", ["g"])
    got = ladder.df.toPandas()
    assert ladder.rows == 2000 and ladder.rungs == len(got) and got["n"].sum() == 2000
    frame = pd.DataFrame(rows, columns=["g", "x"])
    for (g, x), below in got.set_index(["g", "x"])["below"].items():
        assert below == ((frame.g == g) & (frame.x < x)).sum()


def test_quantiles_equal_numpy(spark):
    rng = random.Random(2)
    rows = [(i % 3, rng.choice([1.0, 2.5, rng.random()])) for i in range(1501)]
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(spark.createDataFrame(rows, "g int, x double"), "x", probabilities, ["g"]).collect()
    assert len(got) == 18
    for r in got:
        assert r.quantile == pytest.approx(np.quantile([x for g, x in rows if g == r.g], r.probability))


def test_z_scores_of_constant_and_single_rows(spark):
    constant = spark.createDataFrame([(1, 4.0, 1.0), (2, 4.0, 3.0)], "id int, x double, y double")
    got = {r.id: (r.x_z, r.y_z) for r in z_scores(constant, ["x", "y"]).collect()}
    assert got[1][0] == 0 and got[2][0] == 0 and got[1][1] == pytest.approx(-(0.5**0.5))
    single = spark.createDataFrame([(1, 4.0)], "id int, x double")
    assert z_scores(single, ["x"]).first().x_z is None
