"""Repetition rules against plain loops."""

import random
import re

import pytest
from cases import SCHEMA, documents, frame

from stratalens.llm import repetition
from stratalens.llm.repetition import SuffixBlock, figures, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    text = text or ""
    w = WORD.findall(text)
    longest, covered = 0, set()
    for i in range(len(w)):
        for j in range(i):
            n = 0
            while i + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= least:
                longest = max(longest, n)
                covered.update(range(i, i + n), range(j, j + n))
    triples = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {t for t in triples if triples.count(t) > 1}
    repeated = {k for i, t in enumerate(triples) if t in twice for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeated), len(covered), longest)


@pytest.mark.parametrize("seed", range(6))
def test_figures_of_random_texts(seed):
    draw = random.Random(seed)
    texts = [None, "", "a", "a a a a a a a a a a a a a a"]
    for _ in range(40):
        words = [draw.choice("abcd"[: draw.randrange(1, 5)]) for _ in range(draw.randrange(60))]
        texts.append("".join(x + draw.choice([" ", "\n", " # "]) for x in words))
    for least in (2, 3, 4, 7, 10):
        assert figures(texts, least) == [brute(t, least) for t in texts]


def test_suffix_order():
    text = [w.encode() for w in "b a n a n a b a".split()]
    block = SuffixBlock([text])
    assert sorted(block.rounds[-1]) == list(range(len(text) + 1))


def test_documents(spark):
    rows = [r for r in documents() if len(r[1] or "") < 4000] + [(0, "x", None, None, None), (None, None, None, None, None)]
    rows.append((5000, "the same ten words stand here once more and again " * 12, None, None, None))
    got = judge(frame(spark, rows, extra=["n_words", "kept"])).collect()
    assert len(got) == len(rows)
    for row, r in zip(rows, got):
        want = brute(row[1], 10)
        f = r.repetition
        assert tuple(f)[:7] == want and (r.doc_id, r.n_words) == (row[0], "kept")
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert f.base_failed == failed
        assert f.kept == (not failed and want[5] <= 0.4 * want[0] and want[6] <= 0.3 * want[0])
    assert not got[-1].repetition.kept


def test_repeat_beyond_the_base_rule(spark):
    draw = random.Random(3)
    part = " ".join(str(draw.random()) for _ in range(60))
    rest = " ".join(str(draw.random()) for _ in range(130))
    r = judge(frame(spark, [(1, f"{part} {rest} {part}", None, None, 1)])).first().repetition
    assert (r.covered_words, r.longest_repeat, r.base_failed, r.kept) == (120, 60, False, False)


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_one_very_long_text_keeps_few_ranks(monkeypatch, seed):
    draw = random.Random(100 + seed)
    texts = [" ".join(draw.choice("abc"[: 1 + seed % 3]) for _ in range(draw.randrange(80))) for _ in range(15)]
    want = {least: figures(texts, least) for least in (1, 2, 3, 7, 10)}
    monkeypatch.setattr(repetition, "ROUND_WORDS", 0)
    for least, rows in want.items():
        assert figures(texts, least) == rows
    block = SuffixBlock([[b"x"] * 5000])
    assert len(block.rounds) == 2 and block.longest_repeats(10).max() == 4999
