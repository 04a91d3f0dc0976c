"""Lattice scores against sums over all spellings, base scores against counts."""

import collections
import math
import re
import zlib

import pytest
from cases import SCHEMA, documents, frame, lowered
from pyspark.sql import functions as F

from stratalens.llm.lattice import Lattice, score_texts
from stratalens.llm.queries import PIECES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 = 2"


def all_spellings(model, text):
    """The probability of a text as a sum over every spelling."""
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in model.pieces:
            total += math.exp(model.pieces[text[:n]]) * all_spellings(model, text[n:])
    if text[0] not in model.pieces:
        total += math.exp(sum(model.bytes[b] for b in text[0].encode())) * all_spellings(model, text[1:])
    return total


def test_forward_recursion():
    model = Lattice(tokenizer_path(PIECES), {300: 7, 1000: 50, 263: 9}, 4)
    for word in ("a", "the", "window", "naïve", "日本x", "\U0001F9FF", "▁▁", "aaaaaaaa"):
        assert math.isclose(model.log_probability(word), math.log(all_spellings(model, "▁" + word)), rel_tol=1e-9)
    mass = sum(map(math.exp, [*model.pieces.values(), *model.bytes.values(), model.end]))
    assert mass < 1 + 1e-9


@pytest.mark.parametrize("block", [16_000_000, 5_000])
def test_scores(spark, block):
    rows = documents() + [documents()[0], (None, "no id", None, None, None)]
    got = score_texts(frame(spark, rows, extra=["block", "word", "place"]).repartition(3), tokenizer_path(PIECES), F.expr(HELD_OUT), block_characters=block)
    got = got.collect()
    assert len(got) == len(rows)
    texts = [(r[0], WORD.findall(lowered(r[1]))) for r in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter(t for i, w in texts if not held(i) for t in [*w, None])
    n, v = sum(count.values()), len(count)
    want = collections.defaultdict(list)
    for i, w in texts:
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in [*w, None])
        want[i].append((held(i), len(w) + 1, sum(count[t] > 0 for t in [*w, None]), n, base))
    scores = {}
    for r in got:
        row = want[r.doc_id].pop()
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == row[:4] and math.isclose(r.base_score, row[4], rel_tol=1e-9)
        assert r.score < 0
        scores[r.doc_id] = r.score
    # A text of all the words of two others scores as both, but for one end.
    both = frame(spark, [(1, "one more", None, None, 0), (2, "word", None, None, 0), (3, "more one\nWord", None, None, 0), (4, None, None, None, 0)])
    s = {r.doc_id: r.score for r in score_texts(both, tokenizer_path(PIECES), F.lit(False)).collect()}
    assert math.isclose(s[1] + s[2] - s[4], s[3], rel_tol=1e-9)


def test_without_training_or_rows(spark):
    df = frame(spark, [(1, "a b", None, None, 0)])
    r = score_texts(df, tokenizer_path(PIECES), F.lit(True)).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score < 0
    assert score_texts(spark.createDataFrame([], SCHEMA), tokenizer_path(PIECES), F.lit(False)).count() == 0


def test_score_from_training_texts_to_end(spark):
    """The score of whole texts, recomputed from counts of the vocabulary's own segmentation and all spellings."""
    import sentencepiece

    rows = [(1, "the cat sat", None, None, 0), (2, "The cat, the", None, None, 0), (3, "at a hat", None, None, 0), (4, "", None, None, 0), (5, None, None, None, 0)]
    held = {3}
    got = {r.doc_id: r.score for r in score_texts(frame(spark, rows), tokenizer_path(PIECES), F.col("doc_id") == 3).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    counts, ends = collections.Counter(), 0
    for i, text, *_ in rows:
        if i not in held:
            ends += 1
            for w in WORD.findall(lowered(text)):
                counts.update(model.encode(w))
    usable = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and "▁" not in model.id_to_piece(i)[1:]]
    total = sum(counts[i] for i in usable) + ends + len(usable) + 1
    chance = {model.id_to_piece(i): (counts[i] + 1) / total for i in usable if not model.is_byte(i)}

    def spelled(text):
        return sum((chance[text[:n]] * spelled(text[n:]) for n in range(1, len(text) + 1) if text[:n] in chance), 0.0) if text else 1.0

    for i, text, *_ in rows:
        want = sum(math.log10(spelled("▁" + w)) for w in WORD.findall(lowered(text))) + math.log10((ends + 1) / total)
        assert math.isclose(got[i], want, rel_tol=1e-9), i
