"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import SCHEMA, documents, frame, lowered

from stratalens.llm import phrases


def expected(rows, longest=3, least=10, percent=50, first=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts[lang].update(tuple(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    result = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i:i + n] for p, a in candidates.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= percent * f[p[i:i + n]]
        }
        kept = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            result.add((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return result


def made(seed):
    draw = random.Random(seed)
    words = ["New", "york", "city", "Of", "the", "é", "É", "日本", "a b", "x\x01", "rare", "hot"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!?"]) for _ in range(draw.randrange(60)))
    rows = [(i, text(), draw.choice(["en", "de", None]), None, None) for i in range(200)]
    rows += [(300 + i, "hot " * draw.randrange(40), "en", None, None) for i in range(30)] + [(400, f"once{i} " * 2, "de", None, None) for i in range(20)]
    return rows + rows[:3] + [(500, None, None, None, None), (501, "", "xx", None, None), (None, " . ", "xx", None, None)]


@pytest.mark.parametrize("sent, chunk", [(1_000_000, 1 << 21), (1_000_000, 50), (3, 1 << 21)])
def test_phrases(spark, monkeypatch, sent, chunk):
    monkeypatch.setattr(phrases, "WINDOW_WORDS", chunk)
    rows = made(chunk + sent) + documents()
    got = phrases.mine(frame(spark, rows, extra=["w1", "n", "f"]).repartition(5), sent_words=sent)
    assert {tuple(r) for r in got.collect()} == expected(rows)


@pytest.mark.parametrize("longest, sent", [(2, 1_000_000), (4, 1_000_000), (4, 0)])
def test_other_lengths(spark, longest, sent):
    rows = made(longest)
    got = [tuple(r) for r in phrases.mine(frame(spark, rows), longest=longest, least=4, percent=70, first=15, sent_words=sent).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows, longest, 4, 70, 15)


def test_windows_of_many_columns():
    ids = np.array([5, 6, 0, 5, 6, 7, 5, 6, 0], dtype=np.int64)
    for base in (8, 1 << 30):
        columns, times = phrases.distinct_windows(ids, 3, base)
        assert dict(zip(zip(*(c.tolist() for c in columns)), times.tolist())) == {
            (5, 6, 0): 2, (6, 0, 0): 2, (5, 6, 7): 1, (6, 7, 5): 1, (7, 5, 6): 1}


def test_products_beyond_64_bits(spark):
    a = 3_000_000_000
    counts = spark.createDataFrame([("x", ["p"], a + 1), ("x", ["q"], a + 2), ("x", ["p", "q"], a)], "lang string, words array<string>, f long")
    row = phrases.score_cuts(counts).first()
    assert row.score == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_empty(spark):
    assert phrases.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.mine(spark.createDataFrame([(1, None, None, None, 0), (2, "one", None, None, 0)], SCHEMA)).count() == 0
