"""Wu-Manber search against a search at every place."""

import random
import re

from cases import SCHEMA, frame, lowered

from stratalens.llm import decontaminate
from stratalens.llm.decontaminate import WuManber, mark_hits, windows
from stratalens.session import materialise

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window=10):
    w, hit, found = WORD.findall(lowered(text)), set(), set()
    for item, words in items:
        p = WORD.findall(lowered(words))
        for i in range(max(1, len(p) - window + 1)) if p else ():
            q = p[i:i + window]
            for j in range(len(w) - len(q) + 1):
                if w[j:j + len(q)] == q:
                    hit.update(range(j, j + len(q)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def inputs():
    draw = random.Random(2)
    word = lambda: draw.choice(["on", "the", "Re", "é", "x1", "日本"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 9, 10, 11, 14, 25, 40])]
    items += [(3, items[3][1]), (70, items[8][1]), (None, "on the re"), (71, None), (72, "!!! ...")]
    docs = [(0, None, None, None, None), (1, "", None, None, None), (2, " ?! ", None, None, None), (None, items[8][1], None, None, None)]
    for i in range(60):
        parts = [draw.choice(items)[1] or "" if draw.random() < 0.3 else word() + draw.choice([" ", ", ", "\n", "-"]) for _ in range(draw.randrange(40))]
        docs.append((10 + i, " ".join(parts).upper() if i % 4 == 0 else " ".join(parts), None, None, None))
    return items, [*docs, docs[5], docs[5]]


def test_against_every_place(spark):
    items, docs = inputs()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for chunk in (200_000, 20):
        got = mark_hits(frame(spark, docs, extra=["items", "n_hit"]), windows(benchmark), chunk=chunk).collect()
        want = sorted((d[0] is not None, d[0] or 0, *brute(d[1], [i for i in items if i[0] is not None])) for d in docs)
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.hits.n_words, r.hits.n_hit, list(r.hits["items"])) for r in got) == want
        assert {r.n_hit for r in got} == {"kept"}


def test_skips_and_buckets():
    table = WuManber([tuple(b"a b c d e".split()), tuple(b"x y c d e".split())], 5)
    assert table.far == 4 and table.shift[(b"d", b"e")] == 0 and table.shift[(b"x", b"y")] == 3
    assert [s for s, _ in table.find(b"q x y c d e a b c d e".split())] == [1, 6]


def test_empty_tables(spark):
    no_docs, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert mark_hits(no_docs, windows(items)).count() == 0
    r = mark_hits(frame(spark, [(1, "a b", None, None, 3)]), decontaminate.windows(no_items)).first()
    assert (r.hits.n_words, r.hits.n_hit) == (2, 0)


def test_texts_are_written_once_for_any_number_of_passes(spark, monkeypatch):
    items, docs = inputs()
    benchmark = windows(spark.createDataFrame(items, "item_id long, text string"))
    written = []
    monkeypatch.setattr(decontaminate, "materialise", lambda df: written.append(df.columns) or materialise(df))
    one = mark_hits(frame(spark, docs), benchmark).collect()
    assert len(written) == 1
    many = mark_hits(frame(spark, docs), benchmark, chunk=10).collect()
    assert sum("text" in columns for columns in written) == 1 and len(written) > 5
    assert sorted(map(str, one)) == sorted(map(str, many))
