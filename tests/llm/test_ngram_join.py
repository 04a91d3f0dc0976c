"""Links and components against all pairs."""

import random

import pytest
from cases import SCHEMA, documents, frame
from pyspark.sql import functions as F

from stratalens.llm import ngram_join, shared
from stratalens.llm.components import components


def sets_of(rows, width=5):
    out = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        out[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    return out


def grouped(sets, percent=80):
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, groups=12):
    """Groups of near copies, exact copies, short texts and a passage shared by many."""
    draw, rows = random.Random(seed), []
    word = lambda: f"w{draw.randrange(3000)}"
    passage = [word() for _ in range(40)]
    for g in range(groups):
        base = [word() for _ in range(draw.choice([1, 4, 5, 6, 8, 9, 12, 30, 80, 200]))]
        for _ in range(draw.choice([1, 2, 3, 8])):
            copy = [word() if draw.random() < draw.choice([0, 0, 0.01, 0.03]) else x for x in base] + [word() for _ in range(draw.randrange(2))]
            rows.append(copy)
    rows += [passage + [word() for _ in range(draw.randrange(2, 25))] for _ in range(30)]
    rows += [rows[0], rows[0], [], ["a"], ["a"], ["b"]]
    ids = draw.sample(range(10_000), len(rows))
    return [(i, " ".join(r).upper() if i % 3 == 0 else "\n ".join(r), None, None, None) for i, r in zip(ids, rows)]


def of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "LONG_LIST", [32, 3, 8][seed])
    rows = corpus(seed)
    assert of(ngram_join.similar_documents(frame(spark, rows, extra=["cid", "n", "digest"]))[0]) == grouped(sets_of(rows))


def test_without_sending_lists(spark, monkeypatch):
    monkeypatch.setattr(shared, "SENT_ROWS", -1)
    monkeypatch.setattr(ngram_join, "LONG_LIST", 4)
    rows = corpus(9, groups=6)
    assert of(ngram_join.similar_documents(frame(spark, rows))[0]) == grouped(sets_of(rows))


def test_documents_and_odd_rows(spark):
    rows = documents()
    assert of(ngram_join.similar_documents(frame(spark, rows))[0]) == grouped(sets_of(rows))
    text = " ".join(f"x{i}" for i in range(40))
    odd = [(None, text, None, None, None), (5, text, None, None, None), (5, text, None, None, None), (7, text + " end", None, None, None), (8, None, None, None, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.similar_documents(frame(spark, odd))[0].collect())
    assert got == [(-1, 36, -1), (5, 36, 5), (5, 36, 5), (7, 37, 5), (8, 0, 8)]
    assert ngram_join.similar_documents(spark.createDataFrame([], SCHEMA))[0].count() == 0


def linked(sets, percent=80):
    """(a, b) of every two similar classes, and (documents, links) per class."""
    classes = {}
    for i in sorted(i for i in sets if sets[i]):
        classes.setdefault(frozenset(sets[i]), []).append(i)
    names = {ids[0]: s for s, ids in classes.items()}
    links = {
        (a, b) for a in names for b in names
        if a < b and 100 * len(names[a] & names[b]) >= percent * len(names[a] | names[b])
    }
    return links, {ids[0]: (len(ids), sum(ids[0] in x for x in links)) for ids in classes.values()}


@pytest.mark.parametrize("seed, block", [(0, 2000), (1, 3)])
def test_every_link_between_classes(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "LONG_LIST", [32, 3][seed])
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    base = [f"c{k}" for k in range(120)]
    copies = [(20_000 + k, " ".join([*base[:k], "own", *base[k:]]), None, None, None) for k in range(3, 60, 3)]
    rows = corpus(seed, groups=6) + copies
    classes, links = ngram_join.class_links(frame(spark, rows))
    want_links, want_classes = linked(sets_of(rows))
    assert sorted((r.a, r.b) for r in links.collect()) == sorted(want_links)
    assert {r.class_id: (r.n_documents, r.n_links) for r in classes.collect()} == want_classes
    assert all(want_classes[20_000 + k][1] >= 18 for k in range(3, 60, 3))


def form_letters(copies, own):
    """Texts of one common part and ``own`` words of their own before it."""
    common = [f"f{k}" for k in range(200)]
    return [(k, " ".join([f"o{k}x{x}" for x in range(own)] + common), None, None, None) for k in range(copies)]


@pytest.mark.parametrize("own, similar", [(30, False), (21, True)])
def test_form_letters_form_no_pairs(spark, monkeypatch, own, similar):
    """Lists of a common part that comes last in sets too different from each other."""
    seen, sides = [], ngram_join._list_sides

    def counted(rows, percent):
        a, b = sides(rows, percent)
        seen.append((rows.count(), a.join(b, ngram_join.CELL).count()))
        return a, b

    monkeypatch.setattr(ngram_join, "_list_sides", counted)
    rows = form_letters(60, own)
    assert of(ngram_join.similar_documents(frame(spark, rows))[0]) == grouped(sets_of(rows))
    links, classes = linked(sets_of(rows))
    assert bool(links) == similar
    if not similar:
        (entries, pairs), = seen
        assert entries >= 60 and pairs == 0


def test_size_bands(spark):
    """A band and the next one hold every larger set similar to a set, also at the very bound."""
    for percent in (80, 67, 100):
        sizes = spark.range(1, 3000).select(F.col("id").alias("n"), F.floor(F.col("id") * 100 / percent).alias("m"))
        band = ngram_join._size_band
        assert sizes.where(band(F.col("m"), percent) > band(F.col("n"), percent) + 1).count() == 0


def test_boundary_is_the_cheapest():
    cheap, dear = ngram_join.light_boundary({10: 100, 40: 100}, 1.0, 80), ngram_join.light_boundary({10: 100, 40: 100}, 50.0, 80)
    assert cheap < 10 <= dear


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(draw.randrange(100, 200), draw.randrange(100, 200)) for _ in range(70)] + [(500, i) for i in range(501, 540)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in {x for a, b in edges if a != b for x in (a, b)}}
