import difflib
import random

import pytest
from pyspark.sql import functions as F

from stratalens.functions.text import edit_ratio
from stratalens.operators.matching import area_candidates, block_ratio, fuzzy_matches, join_funds, match_areas, matched, normalised
from stratalens.operators.nearest import nearest_names

AREAS = [
    ("c1", "Alpha", "Region I (Ilocos Region)", "North"), ("c2", "Beta", "Region I (Ilocos Region)", "North"),
    ("c3", "City of Gamma", "NCR", "City of Gamma"), ("c4", "Delta", "NCR", "South"), ("c5", "Delta", "NIR", "East"),
    ("c6", "San Fernando", "NIR", "East"),
]
FUNDS = [
    (1, "Region I", "North", "Alpha City", "City"), (2, "Region IX", "North", "Beta", "Municipality"),
    (3, "NCR", "Metro", "Gamma", "City"), (4, "NIR", "West", "Delta", "City"), (5, "NIR", "East", "San Fernado", "City"),
    (6, "NIR", "East", "Nothing Alike", "City"), (7, "NIR", "East", "San Fernando", "Province"),
]


def tables(spark):
    areas = spark.createDataFrame(AREAS, "area_code string, area_name string, r string, p string")
    funds = spark.createDataFrame(FUNDS, "id int, region string, province string, area string, area_type string")
    return funds, normalised(areas, "r", "p", "area_name")


@pytest.mark.parametrize("similarity", ["edit", "blocks"])
def test_cascade(spark, similarity):
    funds, areas = tables(spark)
    log = {r.id: r for r in match_areas(funds, areas, similarity=similarity).collect()}
    assert {i: (r.match_type, r.area_code) for i, r in log.items()} == {
        1: ("exact", "c1"), 2: ("exact_cross_region", "c2"), 3: ("independent_city", "c3"),
        4: ("fuzzy_region_only", "c5"), 5: ("fuzzy_region+province", "c6"), 6: ("unmatched", None),
    }
    assert log[3].matched_to == "City of Gamma" and log[5].similarity > 0.9 and log[6].similarity < 0.8


@pytest.mark.parametrize("similarity", ["edit", "blocks"])
def test_no_match_is_lost(spark, similarity):
    """Against brute force over all pairs of a scope."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    areas = [(f"k{i:03d}", w, f"r{i % 2}", f"p{i % 4}") for i, w in enumerate(words)]
    targets = []
    for i in range(120):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 2)):
            w.insert(rng.randrange(len(w) + 1), rng.choice("abc"))
        targets.append((f"r{rng.randint(0, 1)}", f"p{rng.randint(0, 3)}", "".join(w)))
    targets = list(dict.fromkeys(targets))
    candidates = area_candidates(
        spark.createDataFrame(areas, "area_code string, name_norm string, region_norm string, province_norm string")
        .withColumnRenamed("name_norm", "area_name").selectExpr("*", "area_name AS name_norm")
    )
    df = spark.createDataFrame(targets, "region_norm string, province_norm string, name_norm string")
    got = {(r.region_norm, r.province_norm, r.name_norm): r for r in fuzzy_matches(df, candidates, similarity=similarity).collect()}

    def ratio(a, b):
        if similarity == "blocks":
            return difflib.SequenceMatcher(None, a, b).ratio()
        previous = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            current = [i]
            for j, y in enumerate(b, 1):
                current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
            previous = current
        return 1 - previous[-1] / max(len(a), len(b))

    hits = 0
    for r, p, n in targets:
        want = ("unmatched", None)
        for kind, ok in (
            ("region+province", lambda c: c[2] == r and c[3] == p), ("province_only", lambda c: c[3] == p),
            ("region_only", lambda c: c[2] == r),
        ):
            scored = sorted((-ratio(n, c[1]), c[1], c[0]) for c in areas if ok(c))
            if scored and -scored[0][0] >= 0.8:
                want = (f"fuzzy_{kind}", scored[0][2])
                break
        row = got[(r, p, n)]
        assert row.fuzzy_kind == want[0]
        if not want[1]:
            near = min((-ratio(n, c[1]), c[1], c[0]) for c in areas if c[2] == r)
            assert (row.fuzzy_code, round(row.fuzzy_ratio, 9)) == (near[2], round(-near[0], 9))
        if want[1]:
            hits += 1
            assert row.fuzzy_code == want[1]
    assert hits > 20 and len(got) == len(targets)


def test_funds_keep_one_row_per_school(spark):
    funds, areas = tables(spark)
    found = matched(match_areas(funds, areas))
    twice = found.unionByName(found)
    schools = areas.select("area_code", "province_norm").withColumnRenamed("area_code", "code").selectExpr(
        "code AS entity_id", "code AS area_code", "province_norm"
    )
    got = {r.entity_id: r for r in join_funds(schools, twice, []).collect()}
    assert len(got) == len(AREAS) and got["c1"].fund_area == "Alpha City"
    assert got["c4"].fund_area is None and got["c6"].fund_area == "San Fernado"


def test_threshold_below_the_safe_limit_is_refused(spark):
    with pytest.raises(ValueError):
        fuzzy_matches(None, None, threshold=0.4)


def made_names(rng, count):
    syllables = [c + v + e for c in "bcdghklmnpqrstwy" for v in "aeiou" for e in ("", "n", "ng", "s")]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(count)]


def changed(rng, name):
    letters = list(name)
    for _ in range(max(2, len(letters) // 3)):
        letters[rng.randrange(len(letters))] = rng.choice("aeioubcdqxz")
    return "".join(letters)


@pytest.mark.parametrize("similarity, whole", [("edit", 0), ("blocks", 0), ("edit", 600), ("edit", 1_000_000)])
def test_nearest_names_against_all_pairs(spark, similarity, whole):
    rng = random.Random(9)
    names = made_names(rng, 150)
    rows = [("r0" if i % 3 else f"r{i % 4}", n, (f"k{i:03d}", n.upper())) for i, n in enumerate(names)] + [("r5", "", ("k", "")), ("r1", "ñandú", ("z", "Z")), (None, "x", ("q", "Q"))]
    rows = list({(r, n): (r, n, a) for r, n, a in rows}.values())
    odd = ["", "x", "qqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqq", "ñ", "ba^$", "zzzz", "kalakalakalakala"]
    targets = [(rng.choice(["r0", "r1", "r2", "r3", "r5", "none", None]), changed(rng, rng.choice(names))) for _ in range(80)]
    targets += [(r, x) for x in odd for r in ("r0", "r1", "r5")]
    left = spark.createDataFrame(targets, "region string, _target string")
    right = spark.createDataFrame(rows, "region string, _name string, _area struct<area_code:string,area_name:string>")
    found, _ = nearest_names(left, right, ["region"], edit_ratio if similarity == "edit" else block_ratio, similarity, whole)
    pairs = left.distinct().join(right, "region")
    ratio = (edit_ratio if similarity == "edit" else block_ratio)(F.col("_target"), F.col("_name"))
    best = F.min(F.struct((-ratio).alias("order"), "_name", "_area.area_code", "_area.area_name"))
    want = {(r.region, r._target): tuple(r.best) for r in pairs.groupBy("region", "_target").agg(best.alias("best")).collect()}
    got = {(r.region, r._target): tuple(r._found) for r in found.collect()}
    assert got == want and len(want) > 60


def test_nearest_names_compares_few_pairs(spark):
    """A region with a third of all names: a few hundredths of its pairs are compared."""
    compared = []
    for count in (1500, 3000):
        rng = random.Random(3)
        names = list(dict.fromkeys(made_names(rng, count)))
        rows = [("hot" if i % 3 == 0 else f"r{i % 50}", n, (str(i), n)) for i, n in enumerate(names)]
        targets = [(r, changed(rng, n)) for r, n, _ in rows if r == "hot"]
        _, pairs = nearest_names(
            spark.createDataFrame(targets, "region string, _target string"),
            spark.createDataFrame(rows, "region string, _name string, _area struct<area_code:string,area_name:string>"), ["region"],
            whole_pairs=0,
        )
        hot = sum(r == "hot" for r, *_ in rows)
        compared.append((pairs.count() / len(targets), hot))
    (few, small), (more, large) = compared
    assert few < 0.03 * small and more < 0.04 * large


@pytest.mark.parametrize("similarity", ["edit", "blocks"])
def test_near_miss_shares_no_pair(spark, similarity):
    """A near miss is the nearest name of the region, also if no two neighbouring characters agree."""
    candidates = spark.createDataFrame([("k", "abcdef", "r", "p", "abcdef")], "area_code string, area_name string, region_norm string, province_norm string, name_norm string")
    target = spark.createDataFrame([("r", "p", "badcfe")], "region_norm string, province_norm string, name_norm string")
    row = fuzzy_matches(target, candidates, similarity=similarity).first()
    want = difflib.SequenceMatcher(None, "badcfe", "abcdef").ratio() if similarity == "blocks" else 1 - 4 / 6
    assert (row.fuzzy_kind, row.fuzzy_name) == ("unmatched", "abcdef") and row.fuzzy_ratio > 0
    assert similarity == "edit" or abs(row.fuzzy_ratio - want) < 1e-9
