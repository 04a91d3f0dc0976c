"""Targets against a plain filling, draws against their rates."""

import math
import random

from cases import SCHEMA, frame
from pyspark.sql import functions as F

from stratalens.llm import mixture


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Fill by weight, close the sources above their most, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, rest, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in above}
        rest -= sum(most * sizes[s] for s in above)
        open_ -= above
    return target


def test_targets(spark):
    draw = random.Random(4)
    for n in (1, 2, 5, 40):
        sizes = {f"s{i}" if i % 5 else f"ü{i}": draw.choice([0, 3, 50, 2000, 10**6]) for i in range(n)} | {None: 77}
        rows = [(s, v // 2) for s, v in sizes.items()] + [(s, v - v // 2) for s, v in sizes.items()]
        got = mixture.targets(spark.createDataFrame(rows, "source string, size long")).collect()
        want = filled(sizes)
        assert {r.source: r.source_size for r in got} == sizes
        assert all(math.isclose(r.target, want[r.source], rel_tol=1e-12) for r in got)


def test_draws(spark):
    rows = [(i, "w " * (1 + i % 9), None, f"s{i % 4}" if i % 7 else None, 0) for i in range(4000)]
    rows += [(None, None, None, None, None), (None, "x y", None, "s1", 0), (3, "", None, "s1", 0), (5, rows[5][1], None, "s1", 0)]
    docs = frame(spark, rows, extra=["target", "source_size", "rate", "copies"])
    docs = docs.withColumn("size", mixture.word_count(F.col("text")))
    drawn = mixture.drawn_number(F.col("doc_id"), F.col("text"), "t")
    mixed = mixture.draw(docs, mixture.targets(docs), drawn)
    got = mixed.collect()
    assert len(got) == len(rows) and {r.target for r in got} == {"kept"}
    taken, target = {}, {}
    for r in got:
        assert 0 <= r.mix.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.size * r.mix.copies
        target[r.source] = r.mix.target
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)
    assert sorted(map(str, got)) == sorted(map(str, mixed.collect()))
    emitted = mixture.emit(mixed)
    assert emitted.columns == docs.columns and emitted.count() == sum(r.mix.copies for r in got)


def test_words(spark):
    texts = [None, "", " \x0b\x0c\r\n\t", "a\u00a0b", "ab\tc\n", "日本"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixture.word_count(F.col("text"))).collect()] == [0, 0, 0, 1, 2, 1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA).withColumn("size", F.lit(1))
    assert mixture.draw(docs, mixture.targets(docs), F.lit(0.5)).count() == 0
