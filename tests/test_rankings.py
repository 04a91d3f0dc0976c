import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalens.operators.keysets import keep_first, without_members
from stratalens.operators.pca import derive_weights
from stratalens.operators.robustness import (
    cutoff_overlap,
    random_weights,
    rank_correlations,
    rank_spread,
    ranks_by_draw,
    top_list_kendall,
)
from stratalens.plans.pairwise import pairwise_table
from stratalens.plans.ranking import NEED_WEIGHTS, priority_list, rank_entities, ranking_summary
from stratalens.plans.scoring import score_timepoints
from stratalens.plans.segments import build_segments
from stratalens.scales import EARLY_READING, Group, Scale

COLUMNS = ["entity_id", "mean_end", "sd_end", "skew_end", "delta_mean", "delta_sd", "delta_skew", "assessed_count", "fund_per_learner"]


def inputs(n=80, seed=0):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(rng.normal(size=(n, len(COLUMNS) - 1)), columns=COLUMNS[1:])
    frame["assessed_count"] = rng.integers(10, 30, n).astype(float)
    frame["fund_per_learner"] = rng.integers(1, 9, n).astype(float)
    frame.loc[3, "skew_end"] = np.nan
    frame.loc[5, "fund_per_learner"] = np.nan
    frame.insert(0, "entity_id", range(n))
    return frame


def to_spark(spark, frame):
    rows = [[None if isinstance(v, float) and np.isnan(v) else v for v in row] for row in frame.astype(object).values.tolist()]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'entity_id' else 'double'}" for c in frame.columns))


def pandas_ranking(frame):
    d = frame.dropna(subset=["mean_end", "delta_mean", "assessed_count", "fund_per_learner"]).set_index("entity_id").fillna(0)
    z = lambda s: (s - s.mean()) / s.std()
    parts = [5 - d.mean_end, -d.delta_mean, d.sd_end, d.skew_end, d.delta_sd, d.delta_skew]
    need = sum(w * z(p) for w, p in zip(NEED_WEIGHTS.values(), parts))
    score = need.rank(pct=True) * d.assessed_count.rank(pct=True) * z(-d.fund_per_learner).rank(pct=True)
    return need, score


def test_ranking_equals_pandas(spark):
    frame = inputs()
    need, score = pandas_ranking(frame)
    df = to_spark(spark, frame)
    ranked = rank_entities(df, "entity_id")
    got = ranked.toPandas()
    assert list(got.entity_id) == list(score.sort_index().sort_values(ascending=False, kind="stable").index)
    got = got.set_index("entity_id").loc[score.index]
    np.testing.assert_allclose(got.need_score, need)
    np.testing.assert_allclose(got.priority_score, score)
    np.testing.assert_allclose(got.priority_pctile, score.rank(pct=True))
    summary = ranking_summary(df).first()
    assert tuple(summary) == (80, 1, 79)
    cohort = spark.createDataFrame([(int(score.idxmax()),)], "entity_id int")
    top = [r.entity_id for r in priority_list(ranked, "entity_id", 5, cohort).collect()]
    assert len(top) == 5 and score.idxmax() not in top
    assert without_members(ranked, cohort, "entity_id").count() == 78


def test_robustness(spark):
    frame = inputs(seed=1)
    ranked = rank_entities(to_spark(spark, frame), "entity_id").toPandas()
    df = spark.createDataFrame(ranked)
    draws = random_weights(NEED_WEIGHTS, 6, seed=9)
    assert draws == random_weights(NEED_WEIGHTS, 6, seed=9) and draws != random_weights(NEED_WEIGHTS, 6, seed=8)
    got = ranks_by_draw(df, "entity_id", draws).toPandas().pivot(index="entity_id", columns="draw", values="position")
    base = ranked.set_index("entity_id")
    for i, d in enumerate(draws):
        need = sum(d[n] * base[f"z_{n}"] for n in NEED_WEIGHTS).round(9)
        score = need.rank(pct=True) * base.impact_pctile * base.capacity_gap_pctile
        want = score.rank(ascending=False, method="min")
        assert (got[i] == want.loc[got.index]).all()
    spread = rank_spread(ranks_by_draw(df, "entity_id", draws), "entity_id", 10).toPandas().set_index("entity_id")
    quartiles = got.quantile([0.25, 0.75], axis=1)
    np.testing.assert_allclose(spread.iqr.loc[got.index], (quartiles.loc[0.75] - quartiles.loc[0.25]))
    scores = df.select("entity_id", "priority_score", "need_score")
    rho = rank_correlations(scores, "priority_score", ["need_score"]).first().spearman
    assert rho == pytest.approx(base.priority_score.corr(base.need_score, method="pearson"), abs=0.5)
    a, b = base.priority_score.rank(), base.need_score.rank()
    assert rho == pytest.approx(a.corr(b))
    overlap = {r.cutoff: r.common for r in cutoff_overlap(scores, "priority_score", "need_score", [10, 30]).collect()}
    for k in (10, 30):
        tops = [set(base[c].nlargest(k).index) for c in ("priority_score", "need_score")]
        assert overlap[k] == len(tops[0] & tops[1])
    tau = top_list_kendall(scores, "entity_id", "priority_score", "need_score", 20).first()
    top = base.nlargest(20, "priority_score")
    signs = [np.sign(x.priority_score - y.priority_score) * np.sign(x.need_score - y.need_score)
             for _, x in top.iterrows() for _, y in top.iterrows()]
    assert tau.entities == 20 and tau.kendall == pytest.approx(sum(signs) / (20 * 19))


def test_pca_weights_equal_numpy(spark):
    rng = np.random.default_rng(2)
    groups, scale = (Group("A"), Group("B")), Scale("s", ("low", "mid", "high"))
    columns = [f"{g.label} {level}" for g in groups for level in scale.levels]
    factor = rng.normal(size=(60, 1))
    data = factor @ np.array([[-1, 0.2, 1, -0.8, 0.1, 0.9]]) + 0.3 * rng.normal(size=(60, 6))
    rows = [[float(x) for x in row] for row in data] + [[None] * 6]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns))
    got = derive_weights(df, groups, scale)
    scaled = (data - data.mean(0)) / data.std(0)
    first = np.linalg.svd(scaled, full_matrices=False)[2][0]
    want = np.array([first[i::3].mean() for i in range(3)])
    want = want if want[-1] >= 0 else -want
    np.testing.assert_allclose(got.loadings, want, atol=1e-9)
    assert got.rows == 60 and got.weights[0] == 0 and got.weights[2] == 100
    positional = derive_weights(df, groups, scale, legacy_positional=True)
    slices = np.array([first[:2].mean(), first[2:4].mean(), first[4:].mean()])
    np.testing.assert_allclose(np.abs(positional.loadings), np.abs(slices), atol=1e-9)
    with pytest.raises(ValueError):
        derive_weights(df.limit(3), groups, scale)


def test_scoring_arguments(spark):
    df = spark.createDataFrame([(1, "t", "G1", None, [1.0] * 5)], "entity_id int, tp string, grade string, lang string, counts array<double>")
    with pytest.raises(ValueError):
        score_timepoints(df, EARLY_READING, ["entity_id", "tp"], scoring="mean")
    with pytest.raises(ValueError):
        score_timepoints(df, EARLY_READING, ["entity_id", "tp"])
    assert score_timepoints(df, EARLY_READING, ["entity_id", "tp"], weights=[1] * 5).first().perf == pytest.approx(20)


def test_pairwise_layout(spark):
    rows = []
    for tp in ("BoSY 2024-25", "EoSY 2024-25"):
        rows += [(1, tp, g.grade, g.lang, [20.0] * 5) for g in EARLY_READING.groups]
    rows += [(2, "BoSY 2024-25", "G1", None, [1.0] * 5)]
    counts = spark.createDataFrame(rows, "entity_id int, timepoint_label string, grade string, lang string, counts array<double>")
    scores = score_timepoints(counts, EARLY_READING, ["entity_id", "timepoint_label"], scoring="ordinal")
    scores = scores.withColumnRenamed("derived_total", "total_assessed").withColumns(
        {c: F.lit("x") for c in ("School Name", "Region", "Division", "District")}
    )
    weights = dict(zip(EARLY_READING.scale.levels, (0, 10, 20, 50, 100)))
    table = pairwise_table(
        counts, scores, EARLY_READING, build_segments()[0], weights=weights,
        metadata=["School Name", "Region", "Division", "District"],
    )
    assert len(table.columns) == 92 and table.columns[12].startswith("BoSY 2024-25 Developing")
    got = {r.entity_id: r.asDict() for r in table.collect()}
    assert got[1]["Progress Score"] == 0 and got[1]["EoSY 2024-25 Grade Level Weighted"] == pytest.approx(20)
    assert got[2]["Student Count Mismatch"] and got[2]["Progress Score"] is None and got[2]["BoSY 2024-25 G1 Developing"] == 20


def test_keep_first_has_a_stated_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, None, 5)], "k int, v string, o int")
    got = {r.k: r.v for r in keep_first(df, ["k"], [F.col("o")]).collect()}
    assert got == {1: "a", 2: None}


def test_kendall_counts_ties_once(spark, monkeypatch):
    """A third of all rows tied under the first score, and pairs tied under both: no window row per tied row."""
    rng = np.random.default_rng(3)
    rows = [(i, 1.0 if i % 3 == 0 else float(rng.integers(2, 40)), float(rng.integers(0, 4))) for i in range(240)]
    sign = lambda x: (x > 0) - (x < 0)
    want = sum(sign(a[1] - b[1]) * sign(a[2] - b[2]) for a in rows for b in rows) / (240 * 239)
    seen, joined = [], type(spark.range(1)).join

    def counted(left, right, *args, **kwargs):
        if "_ones_before" in right.columns:
            seen.append(left.groupBy("_bit").count().agg(F.max("count")).first()[0])
        return joined(left, right, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1)), "join", counted)
    got = top_list_kendall(spark.createDataFrame(rows, "entity_id int, a double, b double"), "entity_id", "a", "b").first()
    assert got.entities == 240 and got.kendall == pytest.approx(want)
    assert seen and max(seen) <= len({r[1:] for r in rows}) < 200


def test_kendall_of_more_rows_than_an_int_squares(spark):
    """50,000 rows have more pairs than a 32-bit integer can count."""
    size = 50_000
    i = np.arange(size)
    cells, counts = np.unique(np.stack([i % 7, i % 7 * (i % 3) + i % 2]), axis=1, return_counts=True)
    a, b = cells
    want = counts @ (np.sign(a[:, None] - a) * np.sign(b[:, None] - b)) @ counts / (size * (size - 1))
    rows = spark.range(size).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 7 * (id % 3) + id % 2 AS DOUBLE) AS b")
    got = top_list_kendall(rows, "id", "a", "b").first()
    assert want > 0.1 and got.entities == size and got.kendall == pytest.approx(want)
