"""Phrase collocation mining by top-order marginalisation.

Every word starts one window: the word and the lead columns behind it, padded where the
piece ends.  Only these longest windows are counted.  The count of a shorter phrase is the sum
over all windows that begin with it, so a ROLLUP over the counted windows gives the counts of
every length at once, and no n-grams of another length are ever made.

Words too rare to stand in a phrase pad a window just as the end of a piece does, which changes no
count of a candidate.  The vocabulary is counted first.  If the words that remain
are at most ``sent_words``, they are sent to the executors as numbers and windows are counted as
numbers; beyond that windows keep their words and are cut by DataFrame functions, with the same
result.

A phrase is cut after each of its words in turn; the cut with the least
floor(10^6 a² / (l r)) counts.  Products are decimals of 38 digits.

Defined results: NULL text is empty, NULL language is ``und``.  A to Z are lowered.  Repeated
rows count each.  An empty table, or one without candidates, gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shared import SENT_ROWS, drop_worker_tables, running_offsets
from .word_tokens import slices

BREAKS = ",;:!?\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A full stop marks every end of a piece, since no word holds one.
_MARKED = bytes.maketrans((_UPPER + BREAKS).encode(), (_UPPER.lower() + "." * len(BREAKS)).encode())
WINDOW_WORDS = 1 << 20
PHRASE_SALTS = 64


def _lang_and_text(docs: DataFrame, lang_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words with a full stop where pieces end) of a bounded number of texts at a time."""
    langs, at = batch.column(0).to_pylist(), 0
    for texts in slices(batch.column(1)):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(langs[at:at + len(texts)], texts.to_pylist()):
            by_lang.setdefault(lang, []).append(text.encode().translate(_MARKED).replace(b".", b" . "))
        at += len(texts)
        for lang, found in by_lang.items():
            yield lang, b" . ".join(found).split()


def vocabulary(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, written once."""

    def count(batches):
        drop_worker_tables()
        for batch in batches:
            for lang, found in _runs(batch):
                counted = Counter(found)
                counted.pop(b".", None)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(counted), pa.string()), "word": pa.array([w.decode() for w in counted], pa.string()),
                    "n": pa.array(list(counted.values()), pa.int64()),
                })

    counted = rows.mapInArrow(count, "lang string, word string, n long")
    return materialise(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _numbered(words: DataFrame) -> DataFrame:
    """(lang, word, id) with ids from 1 on without gaps, in order of language and word."""
    placed = materialise(words.select("lang", "word").orderBy("lang", "word").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    offsets = F.create_map(*(F.lit(x) for pair in running_offsets([(r.part, r.n) for r in sizes] or [(0, 0)]) for x in pair))
    return placed.select("lang", "word", (offsets[part] + F.col("place").bitwiseAND((1 << 33) - 1) + 1).cast("int").alias("id"))


def distinct_windows(ids: np.ndarray, longest: int, base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct padded windows of a run of ids below ``base``, 0 being a break, as columns, and how often each occurs."""
    padded = np.concatenate([ids, np.zeros(longest - 1, dtype=np.int64)])
    columns = [ids]
    for k in range(1, longest):
        lead = padded[k:k + len(ids)].copy()
        lead[columns[-1] == 0] = 0
        columns.append(lead)
    columns = [c[ids > 0] for c in columns]
    key, span = columns[0], base
    for column in columns[1:]:
        if span * base >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            span = len(key)
        key, span = key * base + column, span * base
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], times


def _numbered_windows(rows: DataFrame, numbered: DataFrame, longest: int) -> DataFrame:
    """Windows of word numbers, 0 as padding, counted per chunk of text; a number implies its language."""
    ids: dict[str, dict[bytes, int]] = {}
    for r in numbered.toLocalIterator():
        ids.setdefault(r.lang, {})[r.word.encode()] = r.id
    sent = rows.sparkSession.sparkContext.broadcast(ids)
    names = [f"w{k}" for k in range(1, longest + 1)]

    def cut(batches):
        drop_worker_tables()
        by_lang = sent.value
        base = 1 + max((max(d.values()) for d in by_lang.values()), default=0)
        held, size = [], 0

        def flush():
            columns, times = distinct_windows(np.concatenate(held), longest, base)
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), pa.array(times.astype(np.int64))], names=[*names, "n"])

        for batch in batches:
            for lang, found in _runs(batch):
                get = by_lang.get(lang, {}).get
                # A break parts the runs.
                held.append(np.array([*(get(w, 0) for w in found), 0], dtype=np.int64))
                size += len(found)
                if size >= WINDOW_WORDS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(cut, ", ".join(f"{n} int" for n in names) + ", n long")


def _worded_windows(rows: DataFrame, longest: int) -> DataFrame:
    """Windows of words with their language, empty words as padding, one row per word of the corpus."""
    marked = F.translate("text", _UPPER + BREAKS, _UPPER.lower() + "." * len(BREAKS))
    words = F.split(F.replace(marked, F.lit("."), F.lit(" . ")), "[ \t]+")
    rows = rows.select("lang", words.alias("words"))
    leads = [F.slice("words", k + 1, F.size("words")).alias(f"w{k + 1}") for k in range(longest)]
    windows = rows.select("lang", F.inline(F.arrays_zip(*leads)))
    ends = lambda c: F.col(c).isNull() | F.col(c).isin("", ".")
    windows = windows.where(~ends("w1"))
    for k in range(2, longest + 1):
        windows = windows.withColumn(f"w{k}", F.when((F.col(f"w{k - 1}") == "") | ends(f"w{k}"), "").otherwise(F.col(f"w{k}")))
    return windows.withColumn("n", F.lit(1).cast("long"))


def marginals(windows: DataFrame, keys: Sequence[str], longest: int, least: int) -> DataFrame:
    """(keys, size, f) of every phrase counted ``least`` times or more; keys beyond its size are NULL.

    Longest windows are counted once; the ROLLUP over them sums all shorter prefixes.  Both
    read the same shuffle.  ``keys`` are columns before the words, such as a language.
    """
    words = [f"w{k}" for k in range(1, longest + 1)]
    counted = windows.groupBy(*keys, *words).agg(F.sum("n").alias("f"))
    last = {"int": F.lit(0), "string": F.lit("")}[dict(windows.dtypes)["w1"]]
    # One condition over key and sum stays above the aggregation, so that both branches share its exchange.
    whole = counted.where(F.when(F.col(words[-1]) == last, F.lit(0)).otherwise(F.col("f")) >= least)
    parts = [whole.select(*keys, *words, F.lit(longest).alias("size"), "f")]
    if longest > 1:
        above = [*keys, *words[:-1]]
        rolled = counted.rollup(*above).agg(F.sum("f").alias("f"), F.grouping_id().alias("level"))
        sizes = {(1 << (longest - 1 - k)) - 1: k for k in range(1, longest)}
        size = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))[F.col("level").cast("int")]
        ended = F.greatest(*(F.when((F.col("size") == k) & (F.col(f"w{k}") == last), 1).otherwise(0) for k in range(1, longest)), F.lit(0))
        shorter = rolled.where(F.col("f") >= least).withColumn("size", size).where(F.col("size").isNotNull() & (ended == 0))
        empty = F.lit(None).cast(dict(windows.dtypes)["w1"]).alias(words[-1])
        parts.append(shorter.select(*above, empty, "size", "f"))
    return materialise(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def phrase_counts(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    longest: int = 3,
    least: int = 10,
    sent_words: int = SENT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, words, f) of all phrases found ``least`` times or more, and totals (lang, n) of all words."""
    rows = _lang_and_text(docs, lang_column, text_column)
    counted = vocabulary(rows)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least)
    columns = [f"w{k}" for k in range(1, longest + 1)]
    if frequent.count() <= sent_words:
        numbered = materialise(_numbered(frequent))
        found = marginals(_numbered_windows(rows, numbered, longest), [], longest, least)
        for k, column in enumerate(columns):
            names = F.broadcast(numbered.select(F.col("id").alias(column), F.struct("lang", "word").alias(f"named{k}")))
            found = found.join(names, column, "left")
        found = found.select(
            "named0.lang", F.slice(F.array(*(F.col(f"named{k}.word") for k in range(longest))), F.lit(1), F.col("size")).alias("words"), "f"
        )
    else:
        found = marginals(_worded_windows(rows, longest), ["lang"], longest, least)
        found = found.select("lang", F.slice(F.array(*columns), F.lit(1), F.col("size")).alias("words"), "f")
    return materialise(found), totals


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def score_cuts(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of every phrase of two words or more, at the cut that counts."""
    keyed = counts.select("lang", _joined(F.col("words")).alias("phrase"), "f")
    phrases = counts.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    size = F.size("words")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumns({
        "left": _joined(F.slice("words", F.lit(1), F.col("k"))), "right": _joined(F.slice("words", F.col("k") + 1, size - F.col("k"))),
    })
    side = lambda part, name: keyed.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    priced = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    big = lambda c: F.col(c).cast("decimal(19,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    priced = priced.withColumns({"top": (big("a") * big("a")).cast("decimal(31,0)") * million, "bottom": big("l") * big("r")})
    best = priced.withColumn("score", F.expr("top div bottom")).groupBy("lang", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "words", _joined(F.col("words")).alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def drop_contained(candidates: DataFrame, *, longest: int, percent: int = 50) -> DataFrame:
    """Without candidates that stand inside a longer one which occurs ``percent`` of their times or more."""
    if longest < 3:
        return candidates
    size = F.size("words")

    def inside(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1)))
        return F.when(size > n, F.transform(starts, lambda i: _joined(F.slice("words", i, n)))).otherwise(F.array().cast("array<string>"))

    parts = F.array_distinct(F.flatten(F.array(*map(inside, range(2, longest)))))
    holders = candidates.where(size > 2).select("lang", F.explode(parts).alias("phrase"), "a")
    holders = holders.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    joined = candidates.join(holders, ["lang", "phrase"], "left")
    return joined.where(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True))).drop("longer")


def top_phrases(candidates: DataFrame, first: int) -> DataFrame:
    """The ``first`` of each language by score, count and phrase, with their rank.

    Each of ``PHRASE_SALTS`` parts of a language keeps its own first rows, so no task sorts a whole language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PHRASE_SALTS))
    near = candidates.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    near = near.where(F.col("rank") <= first).drop("part")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)


def mine(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    longest: int = 3,
    least: int = 10,
    percent: int = 50,
    first: int = 2000,
    sent_words: int = SENT_ROWS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first phrases of 2 to ``longest`` words."""
    counts, totals = phrase_counts(
        docs, text_column=text_column, lang_column=lang_column, longest=longest, least=least, sent_words=sent_words
    )
    candidates = drop_contained(materialise(score_cuts(counts)), longest=longest, percent=percent)
    ranked = top_phrases(candidates, first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
